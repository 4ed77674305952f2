"""Rows that share a doc_id but not a text are nodes of their own."""

import random

import brute
import corpus_pipeline
import pytest
from llm_data import sentence
from llm_same import same

from clickscore.llm import jaccard_join


def near(text, at):
    return " ".join("edit" if i == at else w for i, w in enumerate(text.split()))


def shared_ids():
    rng = random.Random(12)
    a, b, c, d, e, f = (sentence(rng, 60) for _ in range(6))
    rows = [
        (5, a), (5, b), (2, near(a, 30)), (7, near(b, 20)), (7, c), (7, c), (9, near(c, 10)), (1, None), (1, ""), (1, "  "),
        (8, d), (8, near(d, 40)), (None, e), (None, f), (3, near(e, 50)), (3, near(f, 5)),
    ]
    return rows, (8, d), (8, near(d, 40))


@pytest.mark.parametrize("short, block", [(256, 200_000), (1, 100)])
def test_shared_ids(spark, monkeypatch, short, block):
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", short)
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", block)
    rows, one, two = shared_ids()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    same(jaccard_join.op9(docs), brute.jaccard(rows), ["doc_id", "n_shingles", "component_id", "n_links"])
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs, "").collect()]
    assert (one in kept) + (two in kept) == 1
    # (2, A') stands for (5, A), (5, B) for (7, B'), (7, C) for (9, C'), NULL ids for (3, E') and (3, F').
    want = [rows[i] for i in (1, 2, 4, 7, 8, 9, 12, 13)]
    assert sorted((x for x in kept if x not in (one, two)), key=repr) == sorted(want, key=repr)
