"""Connected components by alternating stars, without collecting edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.llm.frames import stored


def _large(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Every node hangs its smaller neighbours, and itself, on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` of all nodes of the edges ``(a, b)``; the label is the smallest node.

    Ends when a round changes nothing; the number of rounds grows with the logarithm of the
    longest chain.  Every round is written, so a lost executor repeats one round at most.
    """
    now = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    state = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == state:
            break
        state = mark
        now = stored(_small(_large(now)), "edges")
    own = now.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(own)
