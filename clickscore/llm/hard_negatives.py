"""Hard negatives by slot-decomposed selection.

An anchor's positives bound windows of scores: negatives from 80 to 100 per cent of the
positive's score.  The windows overlap, so they are not searched one by one.  Their upper
limits cut the scores below the best positive into disjoint slots; every negative lies in one
slot, combiners keep the best few of each slot, and a window's answer is the beginning of its
own slot followed by those below it: a suffix of the slots in descending order.

Vectors are packed into blocks of bounded size.  Anchors, a stated share of all rows, meet all
blocks as products of two blocks; the scores of a pair of blocks never leave its task, only the
best few per anchor (and slot) do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickscore.llm import tokens as T
from clickscore.llm.frames import stored

POSITIVES = 5
NEGATIVES = 5
#: A negative's score is at least this share of the positive's, in per cent, and at most all of it.
LOWEST_PERCENT = 80
ANCHOR_STEP = 100
SCALE = 256
#: Vectors of one block, and anchors of one block.
BLOCK = 2048
ANCHOR_BLOCK = 1024
#: Products below this are exact in doubles; larger ones are taken in whole numbers of any size.
EXACT = 2.0**46
LONG = 2**63 - 1

ROW = "struct<vec_id:bigint,label:int,q:array<bigint>>"
ANCHOR = ["anchor_id", "anchor_key"]


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and whole-number vector ``q`` of the rows that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & whole).select(
        "vec_id", moved.cast("int").alias("label"),
        F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double"))).alias("q"),
    )


def is_anchor(vec_id: Column) -> Column:
    return vec_id % ANCHOR_STEP == 0


def row_key() -> Column:
    return F.xxhash64("vec_id", "label", "q")


def packed(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """Blocks of about ``BLOCK`` different rows of one dimension; how many blocks, how many of anchors.

    A row's block is a hash of the whole row: rows spread evenly whatever label or vector is
    frequent, and equal rows meet in one block, where the set keeps one of them (already before
    the shuffle).
    """
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor(F.col("vec_id"))).alias("a")).first()
    n = max(1, math.ceil(sizes["n"] / BLOCK))
    blocks = rows.groupBy(F.size("q").alias("dim"), F.pmod(row_key(), F.lit(n)).alias("block")).agg(
        F.collect_set(F.struct("vec_id", "label", "q")).alias("rows")
    )
    return stored(blocks, "vectors"), n, max(1, math.ceil(sizes["a"] / ANCHOR_BLOCK))


def anchors_of(blocks: DataFrame, n_anchor: int) -> DataFrame:
    rows = blocks.select("dim", F.explode(F.filter("rows", lambda x: is_anchor(x["vec_id"]))).alias("x"))
    return rows.select("dim", "x.*").withColumn("key", row_key()).withColumn("part", F.pmod(F.hash("key"), F.lit(n_anchor)))


def block_pairs(blocks: DataFrame, n: int, anchors: DataFrame) -> DataFrame:
    """Every block of vectors beside every block of anchors of its dimension.

    Anchor blocks are repeated once per deal of blocks, not once per block.  There are as many deals as
    shuffle partitions at most, and as make the repeated anchors as many as the vectors.  Spark takes
    the repeated anchors for as small as they are once and would broadcast them, so both sides are shuffled.
    """
    deals = min(n, ANCHOR_STEP, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = [c for c in anchors.columns if c not in ("dim", "part")]
    groups = anchors.groupBy("dim", "part").agg(F.collect_list(F.struct(*own)).alias("anchors"))
    dealt = groups.select("dim", "anchors", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("deal"))
    left = blocks.select("dim", "rows", (F.col("block") % deals).cast("int").alias("deal")).repartition(deals, "dim", "deal")
    return left.join(dealt.hint("merge"), ["dim", "deal"]).select("rows", "anchors")


def _matrix(rows: pa.StructArray, name: str = "q") -> np.ndarray:
    values = rows.field(name).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(rows), -1) if len(rows) else values.reshape(0, 0)


def _numbers(rows: pa.StructArray, name: str) -> np.ndarray:
    return rows.field(name).to_numpy(zero_copy_only=False)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows: doubles where these are exact, else integers up to the bounds of a long."""
    size = lambda x: float(np.abs(x.astype(np.float64)).max(initial=0.0))
    if size(a) * size(b) * max(a.shape[1], 1) < EXACT:
        return a.astype(np.float64) @ b.astype(np.float64).T
    whole = a.astype(object) @ b.astype(object).T
    return np.maximum(np.minimum(whole, LONG), -LONG - 1)


def leading(group: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of every group: higher scores first, ties by the smaller ``tie``."""
    rank = np.unique(score, return_inverse=True)[1] if score.dtype == object else score
    order = np.lexsort((tie, -rank, group))
    own = group[order]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else own
    count = np.diff(np.append(first, len(own)))
    return order[np.arange(len(own)) - np.repeat(first, count) < k]


def _long(score: np.ndarray) -> pa.Array:
    if score.dtype == object:
        return pa.array([int(s) for s in score], pa.int64())
    return pa.array(score.astype(np.int64))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.StructArray, pa.StructArray]]:
    """Pairs of a block of vectors and at most ``ANCHOR_BLOCK`` anchors."""
    for batch in batches:
        for i in range(batch.num_rows):
            rows, anchors = batch.column(0).slice(i, 1).flatten(), batch.column(1).slice(i, 1).flatten()
            for start in range(0, len(anchors), ANCHOR_BLOCK):
                yield rows, anchors.slice(start, ANCHOR_BLOCK)


def _answer(anchors: pa.StructArray, row: np.ndarray, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    own = {"anchor_id": pa.array(_numbers(anchors, "vec_id")[row]), "anchor_key": pa.array(_numbers(anchors, "key")[row])}
    own |= columns
    return pa.RecordBatch.from_arrays(list(own.values()), names=list(own))


def best_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, anchors in _parts(batches):
        s = products(_matrix(anchors), _matrix(rows))
        ids = _numbers(rows, "vec_id")
        fit = _numbers(anchors, "label")[:, None] == _numbers(rows, "label")[None, :]
        fit &= _numbers(anchors, "vec_id")[:, None] != ids[None, :]
        if s.dtype != object and s.shape[1] > POSITIVES:
            s[~fit] = -np.inf
            fit &= s >= np.partition(s, -POSITIVES, axis=1)[:, -POSITIVES][:, None]
        a, b = np.nonzero(fit)
        got = leading(a, s[a, b], ids[b], POSITIVES)
        a, b = a[got], b[got]
        yield _answer(anchors, a, {"positive_id": pa.array(ids[b]), "positive_score": _long(s[a, b])})


def best_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best of every anchor's slots; ``uppers`` are the anchor's upper limits, descending."""
    for rows, anchors in _parts(batches):
        s = products(_matrix(anchors), _matrix(rows))
        ids = _numbers(rows, "vec_id")
        limits = anchors.field("uppers")
        count = np.asarray(limits.value_lengths())
        held = np.repeat(np.arange(len(count)), count)
        place = T.spread(np.zeros(len(count), np.int64), count)
        flat = limits.flatten().to_numpy(zero_copy_only=False).astype(s.dtype)
        upper = np.full((len(count), POSITIVES), -np.inf if s.dtype != object else -(10**60), s.dtype)
        upper[held, place] = flat
        least = np.minimum.reduceat(flat, np.cumsum(count) - count) if len(flat) else flat
        fit = (s <= upper[:, :1]) & (100 * s >= LOWEST_PERCENT * least[:, None])
        fit &= _numbers(anchors, "label")[:, None] != _numbers(rows, "label")[None, :]
        fit &= _numbers(anchors, "vec_id")[:, None] != ids[None, :]
        a, b = np.nonzero(fit)
        score = s[a, b]
        slot = (upper[a] >= score[:, None]).sum(axis=1) - 1
        # Windows from higher slots begin higher, so what the slot's own window leaves out nobody takes.
        near = 100 * score >= LOWEST_PERCENT * upper[a, slot]
        a, b, score, slot = a[near], b[near], score[near], slot[near]
        got = leading(a * POSITIVES + slot, score, ids[b], NEGATIVES)
        yield _answer(
            anchors, a[got],
            {"slot": pa.array(slot[got].astype(np.int32)), "negative_id": pa.array(ids[b[got]]), "negative_score": _long(score[got])},
        )


def best(found: DataFrame, keys: list[str], score: str, tie: str, k: int) -> DataFrame:
    """The ``k`` best rows of every key; Spark keeps as many before the shuffle already."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(score), tie))
    return found.withColumn("place", place).filter(F.col("place") <= k)


def mine(vectors: DataFrame) -> DataFrame:
    """Negatives of every anchor and positive.

    Columns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; an
    anchor's positives are its ``POSITIVES`` best other rows of its label, and each gets its
    ``NEGATIVES`` best rows of another label between 80 and 100 per cent of its own score.

    Rows with a NULL id, label or vector, or with a NULL or non-finite component, take no part.
    Rows that agree in id, label and vector are one row; rows that share only the id are rows
    of their own, but none is a positive or negative of another one.  Vectors of different
    lengths have no score; those without components score 0.  Components and scores beyond a
    long count as its bounds.  Ties go to the smaller id.  Other columns are ignored; an empty
    table gives an empty result.
    """
    blocks, n, n_anchor = packed(usable(vectors))
    anchors = stored(anchors_of(blocks, n_anchor), "anchors")
    ids = "anchor_id long, anchor_key long"
    found = block_pairs(blocks, n, anchors).mapInArrow(best_positives, f"{ids}, positive_id long, positive_score long")
    positives = stored(
        best(found, ANCHOR, "positive_score", "positive_id", POSITIVES).filter("positive_score >= 0").drop("place"),
        "positives",
    )
    limits = positives.groupBy(*ANCHOR).agg(F.sort_array(F.collect_set("positive_score"), asc=False).alias("uppers"))
    bounded = anchors.join(
        limits, (F.col("vec_id") == F.col("anchor_id")) & (F.col("key") == F.col("anchor_key"))
    ).drop(*ANCHOR)
    slots = block_pairs(blocks, n, bounded).mapInArrow(
        best_negatives, f"{ids}, slot int, negative_id long, negative_score long"
    )
    kept = best(slots, [*ANCHOR, "slot"], "negative_score", "negative_id", NEGATIVES)
    # At most POSITIVES * NEGATIVES rows an anchor, in descending order of slots and scores.
    line = F.sort_array(F.collect_list(F.struct("slot", "place", "negative_id", "negative_score")))
    lines = kept.groupBy(*ANCHOR).agg(line.alias("line"))
    own = F.array_position("uppers", F.col("positive_score")) - 1
    suffix = F.slice(F.filter("line", lambda x: x["slot"] >= F.col("slot")), 1, NEGATIVES)
    inside = F.filter(suffix, lambda x: F.lit(100).cast("decimal(20,0)") * x["negative_score"] >= LOWEST_PERCENT * F.col("positive_score").cast("decimal(20,0)"))
    return (
        positives.join(limits, ANCHOR).withColumn("slot", own).join(lines, ANCHOR)
        .select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("at", "x"))
        .select(
            "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("x.negative_id").alias("negative_id"),
            "positive_score", F.col("x.negative_score").alias("negative_score"),
        )
    )


def op13(vectors: DataFrame) -> DataFrame:
    return mine(vectors)


SQL = f"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % {ANCHOR_STEP} = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}
)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND {LOWEST_PERCENT} * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= {NEGATIVES}
"""
