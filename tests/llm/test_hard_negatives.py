"""Hard negatives against a plain search and SQL."""

import math
import random

import numpy as np
import pytest
from llm_same import same

from clickscore.llm import hard_negatives as H

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
LONG = 2**63 - 1


def plain(rows):
    """Rows are (vec_id, vector, label)."""
    own = set()
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = tuple(max(-LONG - 1, min(LONG, math.floor(256 * float(np.float32(x))))) for x in v)
        own.add((i, (y + 1) % 10 if i % 7 == 0 else y, whole))
    out = []
    for a, la, va in own:
        if a % 100:
            continue
        scored = [(-max(-LONG - 1, min(LONG, sum(x * z for x, z in zip(va, v)))), i, y) for i, y, v in own if i != a and len(v) == len(va)]
        positives = sorted(s[:2] for s in scored if s[2] == la)[:5]
        for p, pid in positives:
            near = sorted((s, i) for s, i, y in scored if y != la and 80 * -p <= 100 * -s <= 100 * -p)[:5]
            out += [(a, pid, k + 1, i, -p, -s) for k, (s, i) in enumerate(near)]
    return out


def vectors(n, dim=6, seed=4):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = []
    for i in range(n):
        y = 0 if rng.random() < 0.4 else rng.randrange(4)
        rows.append((i * 5, [c + rng.gauss(0, 0.4) for c in centre[rng.randrange(4)]], y))
    return rows


def odd_rows():
    rows = vectors(300)
    same_vector = rows[3][1]
    rows += [(2000 + i, same_vector, i % 3) for i in range(90)]  # one vector under many ids: ties
    rows += [rows[0], rows[0], rows[20], (0, rows[1][1], 2), (100, None, 1), (200, [1.0, None, 2.0], 1)]
    rows += [(300, [math.nan] * 6, 1), (400, [math.inf] + [0.0] * 5, 0), (None, rows[0][1], 1), (500, rows[5][1], None)]
    rows += [(9000 + 100 * i, [1.0, 2.0, float(i)], i % 2) for i in range(8)]  # another length
    rows += [(11000 + 100 * i, [], i % 2) for i in range(3)]
    rows += [(-700 - i, [0.0] * 6, i % 2) for i in range(3)]
    rows += [(20000 + 50 * i, [3e38, 1e18 + i * 1e17], i % 2) for i in range(6)]  # beyond a long
    return rows


def table(spark, rows):
    schema = "vec_id bigint, embedding array<float>, label int, slot string, anchor_id string, q int"
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], schema).repartition(5)


@pytest.mark.parametrize("block, anchors", [(2048, 1024), (16, 3)])
def test_hard_negatives_of_odd_rows(spark, monkeypatch, block, anchors):
    monkeypatch.setattr(H, "BLOCK", block)
    monkeypatch.setattr(H, "ANCHOR_BLOCK", anchors)
    rows = odd_rows()
    want = plain(rows)
    assert len({w[0] for w in want}) > 10
    same(H.op13(table(spark, rows)), want, COLUMNS)


def test_no_rows_and_few_rows(spark):
    rows = vectors(300)
    assert H.op13(table(spark, rows).filter("vec_id < -5")).count() == 0
    few = [(100, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 0.875], 2)]
    same(H.op13(table(spark, few)), plain(few), COLUMNS)
    assert len(plain(few)) == 1


def test_whole_numbers_beyond_doubles_are_exact():
    a = np.array([[2**30 + 1, 3], [2**31, -1], [2**40, 0]])
    got = H.products(a, a)
    assert got.dtype == object and got[0].tolist()[:2] == [(2**30 + 1) ** 2 + 9, (2**30 + 1) * 2**31 - 3]
    assert got[2, 2] == H.LONG


def test_hard_negatives_sql(spark):
    from compare import difference, duck

    folder = "/root/testdata/sf0.001"
    got = H.op13(spark.read.parquet(f"{folder}/embeddings.parquet"))
    assert difference(got, duck(folder), H.SQL) is None


def test_repeated_anchors_are_not_broadcast(spark, monkeypatch):
    """Anchors times deals grow with the square of the rows, which Spark's estimate does not see."""
    monkeypatch.setattr(H, "BLOCK", 16)
    blocks, n, n_anchor = H.packed(H.usable(table(spark, vectors(300))))
    joined = H.block_pairs(blocks, n, H.anchors_of(blocks, n_anchor))
    assert n > 10 and joined.count() > 10
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
