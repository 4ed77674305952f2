"""Cleaning, validation, profile and relevance on hand-made frames."""

import numpy as np
import pytest
from conftest import frame
from pyspark.sql import functions as F

from clickscore.contract import SESSION
from clickscore.operators import cleaning as B
from clickscore.operators import profiling as D
from clickscore.operators import relevance as R
from clickscore.operators import validation as V
from clickscore.operators.accumulate import numbered

NAN = float("nan")


def problems(df):
    return sorted((p["rule"], p["field"]) for r in V.validate_sessions(df).collect() for p in r["problems"])


def test_valid_session_has_no_problems(spark):
    assert problems(frame(spark, {}, {"PageValues": None})) == []


def test_each_rule_fires(spark):
    assert problems(frame(spark, {"ProductRelated": -5})) == [("negative", "ProductRelated")]
    assert problems(frame(spark, {"BounceRates": 4.2})) == [("rate_out_of_range", "BounceRates")]
    assert problems(frame(spark, {"ExitRates": NAN})) == [("rate_out_of_range", "ExitRates")]
    assert problems(frame(spark, {"Informational_Duration": 300.0})) == [
        ("time_without_pages", "Informational_Duration")
    ]
    assert problems(frame(spark, {}).drop("PageValues")) == [("missing", "PageValues")]
    text = frame(spark, {}).withColumn("PageValues", F.lit("many"))
    assert problems(text) == [("not_numeric", "PageValues")]


def test_one_row_can_have_several_problems(spark):
    df = V.validate_sessions(frame(spark, {"BounceRates": -1.0, "ExitRates": 2.0}, {}))
    assert V.valid_rows(df).count() == 1 and V.quarantined_rows(df).count() == 1
    assert {(r["rule"], r["n"]) for r in V.problem_counts(df).collect()} == {
        ("negative", 1), ("rate_out_of_range", 1),
    }


def test_dedupe_treats_null_as_equal_and_keeps_smallest_id(spark):
    df = frame(spark, {"Month": None}, {"Month": None}, {})
    assert sorted(r["row_id"] for r in B.dedupe(df, row_id="row_id").collect()) == [0, 2]
    assert B.dedupe(df).count() == 2
    got = B.duplicate_stats(df).first()
    assert (got["n_rows"], got["n_duplicates"], got["duplicate_pct"]) == (3, 1, 33.333)


def test_session_without_pages_gives_zero_ratios(spark):
    idle = dict.fromkeys([c for pair in SESSION.visits for c in pair], 0)
    idle = {k: float(v) if k.endswith("Duration") else v for k, v in idle.items()}
    got = B.add_session_features(frame(spark, idle)).first()
    assert (got["TotalPages"], got["AvgDurationPerPage"], got["ProductPageRatio"]) == (0, 0, 0)
    again = B.add_session_features(B.add_session_features(frame(spark, {})))
    assert again.columns.count("TotalPages") == 1


def test_segments_overlap_and_can_be_empty(spark):
    df = frame(spark, {"PageValues": 1.0}, {"PageValues": 50.0}, {"Revenue": False, "BounceRates": 0.2, "PageValues": 0.0})
    tags = {r["row_id"]: r["segments"] for r in B.with_segments(df).collect()}
    assert tags[0] == [] and tags[1] == [B.BUYER]
    assert tags[2] == [B.BOUNCER, B.WINDOW_SHOPPER]
    presets = {r["segment"] for r in D.segment_presets(df).collect()}
    assert presets == {B.BUYER, B.BOUNCER, B.WINDOW_SHOPPER}
    with pytest.raises(KeyError):
        B.segment(df, "nobody")


def test_preset_mode_is_the_smallest_on_ties_and_codes_stay_numbers(spark):
    rows = [{"Revenue": False, "BounceRates": 0.2, "Browser": b} for b in (10, 9, 9, 10)]
    got = D.segment_presets(frame(spark, *rows)).filter(F.col("segment") == B.BOUNCER).first()
    assert got["Browser"] == 9 and isinstance(got["Browser"], int)


def test_quality_counts_nan_as_null_and_minus_zero_as_zero(spark):
    df = spark.createDataFrame([(0.0, "a", True), (-0.0, None, False), (NAN, "a", None)], "x double, s string, b boolean")
    got = {r["column"]: r for r in D.quality(df).collect()}
    assert (got["x"]["n_null"], got["x"]["n_unique"], got["x"]["pct_zero"]) == (1, 1, 66.67)
    assert (got["s"]["n_null"], got["s"]["n_unique"], got["s"]["pct_zero"]) == (1, 1, None)
    assert (got["b"]["n_unique"], got["b"]["pct_zero"]) == (2, 33.33)
    assert D.null_total(df).first()["n_null"] == 3


def test_conversion_leaves_out_null_levels(spark):
    df = frame(spark, {"VisitorType": None}, {}, {"Revenue": False})
    rows = D.conversion_by(df, "VisitorType").collect()
    assert [(r["level"], r["sessions"], r["conversion_pct"]) for r in rows] == [("Returning_Visitor", 2, 50.0)]


def test_months_come_in_calendar_order(spark):
    df = frame(spark, {"Month": "Dec"}, {"Month": "Feb"}, {"Month": "June"})
    assert [r["level"] for r in D.conversion_by(df, "Month").collect()] == ["Feb", "June", "Dec"]
    missing = {r["month"] for r in D.calendar_coverage(df).filter("NOT present").collect()}
    assert len(missing) == 9 and "Jan" in missing


def test_constant_column_has_no_correlation_one_bin_and_no_skew(spark):
    df = spark.createDataFrame([(0.1, float(i)) for i in range(5)], "c double, x double")
    pairs = {(r["feature_a"], r["feature_b"]): r["corr"] for r in R.correlation_pairs(df, ["c", "x"]).collect()}
    assert pairs[("c", "x")] is None and pairs[("x", "x")] == pytest.approx(1.0)
    bins = [r for r in D.histogram(df, ["c", "x"]).collect()]
    assert [r["count"] for r in bins if r["column"] == "c"] == [5]
    assert sum(r["count"] for r in bins if r["column"] == "x") == 5
    out = {r["column"]: r for r in D.outliers(df, ["c", "x"]).collect()}
    assert out["c"]["skew"] == 0.0 and out["c"]["n_outliers"] == 0


def test_correlation_uses_rows_where_both_are_present(spark):
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=200), rng.normal(size=200)
    y = y + 0.5 * x
    rows = [(float(a) + 1e6, None if i % 7 == 0 else float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double")
    keep = [i for i in range(200) if i % 7]
    got = R.correlation_pairs(df, ["x", "y"]).filter("feature_a <> feature_b").first()["corr"]
    assert got == pytest.approx(np.corrcoef(x[keep], y[keep])[0, 1], abs=1e-9)


def test_mutual_information_of_a_copy_is_the_entropy(spark):
    df = frame(spark, *[{"Revenue": i % 4 == 0, "Browser": 1 + (i % 4 == 0), "Region": 1} for i in range(40)])
    got = {r["feature"]: r["mutual_information"] for r in R.mutual_information(df, numeric=["PageValues"]).collect()}
    assert got["Browser"] == pytest.approx(-(0.25 * np.log(0.25) + 0.75 * np.log(0.75)), abs=1e-5)
    assert got["Region"] == 0 and got["PageValues"] == 0


def test_outlier_skew_is_bias_corrected(spark):
    v = [1.0, 2.0, 2.0, 3.0, 50.0]
    df = spark.createDataFrame([(x,) for x in v], "v double")
    a = np.array(v) - np.mean(v)
    n = len(v)
    want = np.sqrt(n * (n - 1)) / (n - 2) * np.mean(a**3) / np.mean(a**2) ** 1.5
    got = D.outliers(df, ["v"]).first()
    assert got["skew"] == pytest.approx(want, abs=6e-4) and got["n_outliers"] == 1


def test_table_contract_spots_changes(spark):
    df = frame(spark, {}, {"Month": "May"})
    facts = {r["check"]: r["actual"] for r in V.table_contract(df).collect()}
    again = V.table_contract(df.repartition(3), rows=2, rate_pct=100.0, checksum=facts["checksum"])
    assert all(r["passed"] for r in again.collect())
    changed = V.table_contract(df.withColumn("Month", F.lit("Nov")), rows=3, rate_pct=15.0, checksum=facts["checksum"])
    assert {r["check"] for r in changed.filter("NOT passed").collect()} == {"row_count", "target_rate_pct", "checksum"}
    short = V.table_contract(df.drop("Month"))
    assert {r["check"] for r in short.filter("NOT passed").collect()} == {"columns_present"}


@pytest.mark.parametrize("ranges", [1, 7])
def test_positions_inside_groups_of_any_size(spark, ranges):
    rows = [("big", f"v{i:05d}") for i in range(5000)] + [("small", "b"), ("small", None), ("small", "a"), (None, "x")]
    df = spark.createDataFrame(rows, "g string, v string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = {(r["g"], r["v"]): r["position"] for r in numbered(df.filter("g is not null"), "g", [F.asc_nulls_last("v")]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [got["big", f"v{i:05d}"] for i in range(5000)] == list(range(1, 5001))
    assert (got["small", "a"], got["small", "b"], got["small", None]) == (1, 2, 3)


def test_code_catalog_lists_the_first_codes_and_counts_all(spark):
    df = frame(spark, *[{"Browser": 50 - i} for i in range(45)], {"Browser": None})
    got = {r["column"]: r for r in D.code_catalog(df).collect()}
    assert got["Browser"]["n_unique"] == 45 and got["Browser"]["values"] == [str(i) for i in range(6, 36)]
