"""Deduplication, decontamination and the join against plain versions on odd texts."""

import dataclasses
import random

import brute
import numpy as np
import pytest
from llm_data import docs, nothing, rows  # noqa: F401
from llm_same import same

from clickscore.llm import decontamination, jaccard_join, line_dedup, reference_dedup, suffix_dedup
from clickscore.llm.graph import components

ONE = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
FOUR = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def test_suffix_dedup(docs, rows):
    same(suffix_dedup.op1(docs), brute.suffix_dedup(rows), ONE)


def test_suffix_dedup_of_crowded_anchors(docs, rows, monkeypatch):
    crowded = dataclasses.replace(suffix_dedup.KIND, heavy=3, block_bytes=20_000)
    monkeypatch.setattr(suffix_dedup, "KIND", crowded)
    from pyspark.sql import functions as F

    got = suffix_dedup.dedup(docs, crowded).withColumn("kept_sha256", F.sha2("kept", 256))
    same(got, brute.suffix_dedup(rows), ONE)


def strings_of(*parts):
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), offsets


@pytest.mark.parametrize("letters", [1, 2, 256])
def test_suffix_order_is_the_sorted_one(letters):
    rng = random.Random(letters)
    parts = [bytes(rng.randrange(letters) for _ in range(n)) for n in [*range(14), 60, 60]]
    parts += [parts[-1], parts[-2][7:], b"", parts[-2] + b"\0", parts[-1][:31] + parts[-2][31:]]
    rows = [(i, k) for i, x in enumerate(parts) for k in range(len(x) + 1)]
    rows.sort(key=lambda r: [(1, b) for b in parts[r[0]][r[1]:]] + [(0, r[0])])
    suffixes = [parts[i][k:] for i, k in rows]
    prefix = lambda a, b: next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    data, offsets = strings_of(*parts)
    place, shared = suffix_dedup.collection_order(data, offsets, 40)
    assert place.tolist() == [offsets[i] + k + i for i, k in rows]
    assert shared.tolist() == [0] + [min(40, prefix(a, b)) for a, b in zip(suffixes, suffixes[1:])]


def test_suffix_order_takes_four_bytes_a_round(monkeypatch):
    written = []
    write = suffix_dedup.Columns.write
    monkeypatch.setattr(suffix_dedup.Columns, "write", lambda self, name, values: (written.append(name), write(self, name, values)))
    suffix_dedup.collection_order(*strings_of(b"ab" * 84, b"b" * 100), 100)
    assert written.count("transform") <= 1 + 168 // 4


def test_substring_dedup(docs, rows):
    same(reference_dedup.op4(docs), brute.substring_dedup(rows), FOUR)


def test_substring_dedup_of_crowded_anchors(docs, rows):
    from pyspark.sql import functions as F

    crowded = dataclasses.replace(reference_dedup.KIND, heavy=3, block_bytes=20_000)
    got = reference_dedup.dedup(docs, crowded).withColumn("kept_sha256", F.sha2("kept", 256))
    same(got, brute.substring_dedup(rows), FOUR)


def test_line_dedup(docs, rows):
    same(line_dedup.op2(docs), brute.line_dedup(rows), ["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def test_line_dedup_uses_no_python(docs):
    plan = line_dedup.op2(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def items_of(rows):
    words = rows[9][1].split()
    return [
        (1, " ".join(words[15:45])), (2, "one TWO, three"), (3, None), (4, ""), (None, " ".join(words[20:40])),
        (1, " ".join(words[15:45])), (10, "never in any of the texts at all, whatever they hold, not once"),
    ]


SIX = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_decontamination(spark, docs, rows):
    items = items_of(rows)
    table = spark.createDataFrame(items, "item_id bigint, text string")
    same(decontamination.op3(docs, table), brute.decontamination(rows, items), SIX)


def test_decontamination_in_blocks(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 100)
    once = list(dict.fromkeys(rows))
    items = items_of(rows)
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.op3(docs.dropDuplicates(["doc_id", "text"]), table)
    same(got, brute.decontamination(once, items), SIX)


def test_no_items(spark, docs, rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    same(decontamination.op3(docs, none), brute.decontamination(rows, []), SIX)


@pytest.mark.parametrize("short, block", [(256, 200_000), (3, 2_000)])
def test_jaccard_join(docs, rows, monkeypatch, short, block):
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", short)
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", block)
    same(jaccard_join.op9(docs), brute.jaccard(rows), ["doc_id", "n_shingles", "component_id", "n_links"])


def test_required_overlap():
    for n in range(1, 40):
        for m in range(1, 40):
            for k in range(0, min(n, m) + 1):
                assert (100 * k >= 85 * (n + m - k)) == (k >= jaccard_join.required(n, m))


def test_light_boundary_follows_the_cost():
    assert jaccard_join.boundary({5: 1000}) >= 5
    assert jaccard_join.boundary({20: 1000}) < 20


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (90, 101), (7, 7)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(61)} | {90: 90, 100: 90, 101: 90}


def test_empty_tables(spark, nothing):
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    for made in (
        suffix_dedup.op1(nothing), reference_dedup.op4(nothing), line_dedup.op2(nothing),
        decontamination.op3(nothing, items), jaccard_join.op9(nothing),
    ):
        assert made.count() == 0
