"""Importance resampling and its radix sort against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from llm_data import docs, nothing, rows  # noqa: F401
from llm_same import same
from pyspark.sql import functions as F

from clickscore.llm import importance as I


def buckets_of(text):
    w = brute.LETTERS.findall((text or "").translate(brute.LOW))
    runs = [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]
    return len(w), [zlib.crc32(x.encode()) % 10000 for x in runs]


def plain(rows, items, percent=5):
    parts = [buckets_of(t) for _, t in rows]
    s = Counter(b for _, own in parts for b in own)
    t = Counter(b for x in items for b in buckets_of(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1.0) * (big_s + 10000.0)) / ((s[b] + 1.0) * (big_t + 10000.0))))
    out = []
    for (d, _), (n, own) in zip(rows, parts):
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, own))
        out.append([d, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296.0))), None, n])
    fit = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for place, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = place + 1
    return [tuple(r[:5]) for r in out]


COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def test_checksums_of_runs_of_any_length():
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcé日Z1") for _ in range(n))
    texts = [" ".join(word(rng.choice([1, 5, 21, 62, 63, 64, 65, 130, 4100])) for _ in range(rng.randint(0, 20))) for _ in range(30)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    bucket, row, _ = I.feature_buckets(data, offsets)
    want = [(i, b) for i, t in enumerate(texts) for b in buckets_of(t)[1]]
    assert sorted(zip(row.tolist(), bucket.tolist())) == sorted(want)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "the target speaks of passage one two three words"), (2, None), (2, "passage " * 30), (None, "")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_resampling_of_odd_texts(docs, rows, items):
    texts = [r["text"] for r in items.collect()]
    # Rows that share an id and a score are the same text here, so any of them may be drawn.
    same(I.op11(docs, items), plain(rows, texts), COLUMNS)
    drawn = I.resample(docs, items, percent=100).filter("rank is not null")
    want = [r for r in plain(rows, texts, 100) if r[4] is not None]
    same(drawn, want, COLUMNS)


def test_without_documents_or_target(docs, nothing, rows, items):
    assert I.op11(nothing, items).count() == 0
    same(I.op11(docs, items.filter("item_id > 9")), plain(rows, []), COLUMNS)


def test_resampling_sql(spark):
    from compare import difference, duck

    folder = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    assert difference(I.op11(docs, items), duck(folder), I.SQL) is None


@pytest.mark.parametrize("wide", [False, True])
def test_radix_positions(spark, wide):
    """Ties, NULLs, negative values, values across all of a long, a hot key; several blocks."""
    rng = random.Random(5)
    far = [-(2**63), 2**63 - 1, 0, -1] if wide else [0, 7, 7, 300]
    rows = [(rng.choice([*far, 1, 2, None]) if i % 3 else 1, rng.choice([*far, 5, None]), i) for i in range(40000)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c int").repartition(6, "c")
    got = I.radix_positions(df, [("a", True), ("b", False)]).orderBy("position").collect()
    key = lambda a, b: (a is None, -(a or 0), b is None, b or 0)
    assert [r["position"] for r in got] == list(range(len(rows)))
    assert [key(r["a"], r["b"]) for r in got] == sorted(key(a, b) for a, b, _ in rows)
    assert sorted(r["c"] for r in got) == list(range(len(rows)))


def test_radix_positions_of_one_key_and_none(spark):
    df = spark.range(50).select(F.lit(3).cast("long").alias("a"), "id")
    assert sorted(r["position"] for r in I.radix_positions(df, [("a", True)]).collect()) == list(range(50))
    assert I.radix_positions(df.filter("id < 0"), [("a", True)]).count() == 0
    nulls = df.withColumn("a", F.lit(None).cast("long"))
    assert sorted(r["position"] for r in I.radix_positions(nulls, [("a", True)]).collect()) == list(range(50))
