"""Running totals and percentiles against numpy, on the paths used for big inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickscore.operators.accumulate import running_totals, slice_cuts
from clickscore.operators.quantiles import exact_percentiles


def skewed(spark, n=30_000):
    """A third of the rows share one value; the rest have many distinct ones and NULLs."""
    h = F.abs(F.xxhash64("id"))
    x = (
        F.when(F.col("id") % 3 == 0, F.lit(7.0))
        .when(F.col("id") % 101 == 0, F.lit(None).cast("double"))
        .otherwise((h % 1_000_003).cast("double") / 977.0)
    )
    return spark.range(n).select("id", x.alias("x"), (h % 5 == 0).cast("bigint").alias("hit"))


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("per_slice", [50, 10**9, None])
def test_running_totals(spark, per_slice, descending):
    df = skewed(spark).filter("x IS NOT NULL")
    cuts = slice_cuts(df, "x", per_slice) if per_slice else []
    grouped = df.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.sum("hit").alias("hit"))
    got = running_totals(grouped, "x", ["n", "hit"], descending=descending, cuts=cuts).toPandas()
    got = got.sort_values("x", ascending=not descending)
    assert (got["n"].cumsum() == got["cum_n"]).all()
    assert (got["hit"].cumsum() == got["cum_hit"]).all()


def test_running_totals_by_group_keeps_groups_apart(spark):
    df = skewed(spark, 5_000).filter("x IS NOT NULL").withColumn("g", (F.col("id") % 2).cast("string"))
    grouped = df.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    got = running_totals(grouped, "x", ["n"], by=["g"], cuts=slice_cuts(df, "x", 40)).toPandas()
    for _, part in got.groupby("g"):
        part = part.sort_values("x", ascending=False)
        assert (part["n"].cumsum() == part["cum_n"]).all()


@pytest.mark.parametrize("accuracy", [20, 300, 10_000])
def test_percentiles_equal_numpy(spark, accuracy):
    df = skewed(spark)
    probs = [0.0, 0.001, 0.25, 1 / 3, 0.5, 0.75, 0.99, 1.0]
    want_x = df.toPandas()
    odd = "CASE WHEN id % 2 = 1 THEN x END"
    got = exact_percentiles(
        df, {"x": ("x", probs), "odd": (odd, [0.5]), "none": ("NULL", [0.5])}, accuracy
    )
    values = want_x["x"].dropna().to_numpy()
    assert np.allclose(got["x"], np.quantile(values, probs), rtol=0, atol=1e-9)
    odd_values = want_x.loc[want_x["id"] % 2 == 1, "x"].dropna().to_numpy()
    assert got["odd"][0] == pytest.approx(np.median(odd_values), abs=1e-9)
    assert got["none"] == [None]


@pytest.mark.parametrize("values,median", [([1.0, 2.0, 3.0, 10.0], 2.5), ([5.0], 5.0), ([2.0, 2.0], 2.0)])
def test_median_of_few_rows(spark, values, median):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_percentiles(df, {"v": ("v", [0.5])})["v"] == [median]


def test_infinite_cells_are_no_numbers(spark):
    from clickscore.functions.numbers import number_sql

    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, float("inf"), float("-inf"), float("nan"), None)], "v double")
    assert exact_percentiles(df, {"v": (number_sql("v"), [0.5])})["v"] == [1.5]
