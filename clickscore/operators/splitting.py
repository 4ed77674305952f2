"""Exact, seeded, stratified splits and folds without moving the rows.

Rows are ordered inside each class by a hash of their id.  A split needs only the
hash value at a given rank, so the rank is located by counting hash prefixes (a
bounded table) and the split itself is a filter: no sort, no shuffle of rows, and
the same answer however the data is partitioned.
"""

from __future__ import annotations

import itertools
import math
import random
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscore.contract import FOLDS, SEED, TEST_SHARE

_DIGITS = 3  # hex digits per counting pass: 4,096 prefixes
_GROUPS = 16**_DIGITS
_KEY = "__hash_key"
_WIDTH = 32  # hex digits of an id's hash


def hash_key(row_id: str = "row_id", seed: int = SEED) -> Column:
    """Hash of the id; a NULL id is an id like any other."""
    return F.md5(F.concat(F.coalesce(F.col(row_id).cast("string"), F.lit("")), F.lit(f"-{seed}")))


def row_hash(df: DataFrame) -> Column:
    """Hash of the whole row, which tells rows apart that repeat an id.

    Rows that are equal in every column share it and always stay together.
    """
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant", "udt")]
    return F.lpad(F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in plain])), 16, "0")


def _beyond(key: Column, rest: Column, cut: str) -> Column:
    """Whether a row comes after the cut; the whole row is hashed only where ids' hashes are equal."""
    head, tail = cut[:_WIDTH], cut[_WIDTH:]
    return (key > F.lit(head)) | ((key == F.lit(head)) & (rest > F.lit(tail)))


def _cut_keys(
    df: DataFrame,
    label: str,
    row_id: str,
    seed: int,
    ranks_of: Callable[[dict[Any, int]], dict[Any, list[int]]],
    most: int = _GROUPS,
) -> dict[Any, list[str]]:
    """Per class, the hash keys (id, then row) at the wanted 1-based ranks (rank 0 gives '').

    Every pass counts prefixes of the id's hash; a prefix with at most ``most`` rows is counted
    by whole key, row included, in the last one.  So a pass brings back at most 4,096 counts per
    open prefix.
    """
    keyed = df.select(
        F.col(label).alias("y"), hash_key(row_id, seed).alias("key"), row_hash(df).alias("rest")
    ).filter(F.col("y").isNotNull())

    def count_prefixes(frame: DataFrame, width: int) -> dict:
        rows = (
            frame.groupBy("y", F.substring("key", 1, width).alias("head"))
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()  # at most 4,096 per open prefix
        )
        table: dict = defaultdict(list)
        for r in rows:
            table[r["y"], r["head"][: width - _DIGITS]].append((r["head"], r["n"]))
        return {k: sorted(v) for k, v in table.items()}

    width = _DIGITS
    table = count_prefixes(keyed, width)
    sizes = {y: sum(n for _, n in v) for (y, _), v in table.items()}
    # Open targets: (class, position) -> (prefix, rank inside it, rows inside it).
    ranks = ranks_of(sizes)
    wanted = {
        (y, j): ("", r, sizes[y]) for y, rs in ranks.items() for j, r in enumerate(rs) if r > 0
    }
    while wanted:
        for (y, j), (head, rank, size) in wanted.items():
            if len(head) >= width:
                continue
            for prefix, n in table[y, head]:
                if rank <= n:
                    wanted[y, j] = (prefix, rank, n)
                    break
                rank -= n
        if all(size <= most for _, _, size in wanted.values()) or width + _DIGITS > _WIDTH:
            break
        width += _DIGITS
        heads = sorted({h for h, _, _ in wanted.values()})
        open_rows = keyed.filter(F.substring("key", 1, width - _DIGITS).isin(heads))
        table = count_prefixes(open_rows, width)

    keys: dict[Any, list[str]] = {y: [""] * len(rs) for y, rs in ranks.items()}
    if wanted:
        heads = sorted({h for h, _, _ in wanted.values()})
        open_rows = keyed.filter(F.substring("key", 1, len(heads[0])).isin(heads))
        counts = open_rows.groupBy("y", F.concat("key", "rest").alias("key")).agg(F.count(F.lit(1)).alias("n")).collect()
        for (y, j), (head, rank, _) in wanted.items():
            for key, n in sorted((r["key"], r["n"]) for r in counts if r["y"] == y and r["key"].startswith(head)):
                keys[y][j] = key
                rank -= n
                if rank <= 0:
                    break
    return keys


def holdout_quota(sizes: Mapping[Any, int], share: float = TEST_SHARE) -> dict[Any, int]:
    """Rows per class in the test set: largest remainder of ceil(share * n)."""
    n = sum(sizes.values())
    take = math.ceil(share * n)
    exact = {y: c * take / n for y, c in sizes.items()}
    quota = {y: math.floor(v) for y, v in exact.items()}
    spare = take - sum(quota.values())
    for y in sorted(sizes, key=lambda y: (quota[y] - exact[y], str(y)))[:spare]:
        quota[y] += 1
    return quota


def stratified_split(
    df: DataFrame,
    label: str = "label",
    row_id: str = "row_id",
    share: float = TEST_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Add boolean ``is_test``; every class gives exactly its quota."""
    cuts = _cut_keys(
        df, label, row_id, seed, lambda sizes: {y: [q] for y, q in holdout_quota(sizes, share).items()}
    )
    test = F.lit(None).cast("boolean")
    for y, (cut,) in cuts.items():
        test = F.when(F.col(label) == F.lit(y), ~_beyond(F.col(_KEY), row_hash(df), cut)).otherwise(test)
    # The hash is a column of its own, so a row computes it once.
    return df.withColumn(_KEY, hash_key(row_id, seed)).withColumn("is_test", test).drop(_KEY)


def stratified_folds(
    df: DataFrame, label: str = "label", row_id: str = "row_id", k: int = FOLDS, seed: int = SEED
) -> DataFrame:
    """Add ``fold`` 0..k-1; inside each class fold sizes differ by one at most."""

    def bounds(sizes: dict[Any, int]) -> dict[Any, list[int]]:
        out = {}
        for y, n in sizes.items():
            base, extra = divmod(n, k)
            out[y] = list(itertools.accumulate(base + (i < extra) for i in range(k - 1)))
        return out

    cuts = _cut_keys(df, label, row_id, seed, bounds)
    fold = F.lit(None).cast("int")
    for y, edges in cuts.items():
        number = F.lit(0)
        for e in edges:
            number = number + F.when(_beyond(F.col(_KEY), row_hash(df), e), 1).otherwise(0)
        fold = F.when(F.col(label) == F.lit(y), number).otherwise(fold)
    return df.withColumn(_KEY, hash_key(row_id, seed)).withColumn("fold", fold).drop(_KEY)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight n / (2 n_c) per class, and the positive-class weight."""
    pos = F.sum(F.col(label).cast("int"))
    sizes = df.filter(F.col(label).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(pos, F.lit(0)).alias("pos")
    )
    neg = F.col("n") - F.col("pos")

    def line(value: int, size: Column) -> Column:
        return F.struct(
            F.lit(value).alias("label"),
            size.alias("n_rows"),
            F.round(F.try_divide(F.col("n").cast("double"), F.lit(2.0) * size), 6).alias("balanced_weight"),
            F.round(neg.cast("double") / F.greatest(F.col("pos"), F.lit(1)), 4).alias("positive_weight"),
        )

    return sizes.select(F.inline(F.array(line(0, neg), line(1, F.col("pos")))))


def balanced_weight(df: DataFrame, label: str = "label") -> Column:
    """A weight column from the two class sizes."""
    w = {r["label"]: r["balanced_weight"] for r in class_weights(df, label).collect()}
    y = F.col(label).cast("int")
    return F.when(y == 1, F.lit(w[1] or 0.0)).otherwise(F.lit(w[0] or 0.0))


def sample_params(
    grid: Mapping[str, Sequence[Any]], n: int, seed: int = SEED
) -> list[dict[str, Any]]:
    """Draws without replacement from a discrete grid; the whole grid if it is smaller."""
    names = sorted(grid)
    every = [dict(zip(names, v)) for v in itertools.product(*(grid[k] for k in names))]
    return random.Random(seed).sample(every, min(n, len(every)))


def head_rows(df: DataFrame, n: int, row_id: str = "row_id") -> DataFrame:
    return df.orderBy(row_id).limit(n)
