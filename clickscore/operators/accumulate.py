"""Exact running totals over a totally ordered column, without a single-task window.

A window with no PARTITION BY sorts everything in one task.  Here the ordered
column is cut into slices at approximate quantiles, each slice is accumulated on
its own, and the totals of the earlier slices are added.  The cuts only decide
how even the slices are; the result is exact for any cuts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscore.functions.numbers import double_array
from clickscore.session import cut_lineage

ROWS_PER_SLICE = 250_000
LEAST_SLICES, MOST_SLICES = 8, 65_536


def slice_cuts(rows: DataFrame, order: str, per_slice: int = ROWS_PER_SLICE) -> list[float]:
    """Cut points that spread the distinct values of ``order`` evenly.

    Works on raw rows: one column-pruned pass with a count and a mergeable sketch, no shuffle,
    and a finer sketch only where the count asks for more slices.  The number of slices follows the number of rows, so a slice stays sortable at
    any size.  Between two neighbouring cuts lies about one slice's share of the rows, hence
    at most that many distinct values, however often one value repeats.
    """
    few = [i / LEAST_SLICES for i in range(1, LEAST_SLICES)]
    n, cuts = rows.agg(F.count(order), F.percentile_approx(order, double_array(few), F.lit(10 * LEAST_SLICES))).first()
    slices = min(MOST_SLICES, max(LEAST_SLICES, -(-n // per_slice)))
    if slices > LEAST_SLICES:
        probs = double_array([i / slices for i in range(1, slices)])
        cuts = rows.agg(F.percentile_approx(order, probs, F.lit(10 * slices))).first()[0]
    return sorted({c for c in cuts or [] if math.isfinite(c)})


def running_totals(
    df: DataFrame,
    order: str,
    totals: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = True,
    cuts: Sequence[float] = (),
) -> DataFrame:
    """Add ``cum_<c>`` for every c in totals: the inclusive running sum by ``order``.

    ``df`` has one row per (by, order), so pre-aggregate ties first.  ``by`` is a
    low-cardinality grouping such as a model name; a group may be of any size
    because it is always spread over the slices.
    """
    by = list(by)
    direction = F.desc if descending else F.asc

    def upto(keys: list[str], order_col: str, end: int):
        keyed = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        return keyed.orderBy(direction(order_col)).rowsBetween(Window.unboundedPreceding, end)

    splits = [float("-inf"), *(cuts or [0.0]), float("inf")]  # any cuts do
    sliced = Bucketizer(splits=splits, inputCol=order, outputCol="_slice").transform(df)
    sliced = sliced.withColumn("_slice", F.col("_slice").cast("int"))
    keys = [*by, "_slice"]
    # One row per slice and group, so this window is at most len(cuts) + 1 rows.
    before = upto(by, "_slice", -1)
    offsets = (
        sliced.groupBy(*keys)
        .agg(*[F.sum(c).alias(f"_s_{c}") for c in totals])
        .select(
            *keys,
            *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in totals],
        )
    )
    inside = upto(keys, order, Window.currentRow)
    local = sliced.withColumns({f"_l_{c}": F.sum(c).over(inside) for c in totals})
    # The window above already partitioned the rows by the join keys.
    joined = local.join(offsets, keys, "left")
    return joined.select(
        *df.columns,
        *[(F.col(f"_l_{c}") + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in totals],
    )


def numbered(df: DataFrame, by: str, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with 1, 2, 3... by ``order`` inside every ``by``, however many rows one ``by`` has.

    Rows are sorted over ranges of (by, order) and written; a range knows its own places, and
    how many rows of the same ``by`` lie in earlier ranges comes from one count per range.
    """
    keys = [F.col(by), *order]
    at = F.monotonically_increasing_id()
    kept = cut_lineage(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", at))
    # The upper bits of the number are the range's.
    kept = kept.withColumn("_range", F.shiftright("_at", 33))
    parts = kept.groupBy(by, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).withColumnRenamed(by, "_by")
    joined = kept.withColumnRenamed("_range", "_own").join(
        parts, (F.col(by) == F.col("_by")) & (F.col("_own") == F.col("_range"))
    )
    return joined.select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias(name))
