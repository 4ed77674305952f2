import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickscore.operators import deciding as H
from clickscore.operators import evaluation as G


def pairs(spark, rows):
    return spark.createDataFrame(
        [(i, float(p), int(y)) for i, (p, y) in enumerate(rows)], "row_id bigint, probability double, label int"
    )


def brute_ap(rows):
    pos = sum(y for _, y in rows)
    total = seen = hits = 0.0
    for s in sorted({p for p, _ in rows}, reverse=True):
        got = [y for p, y in rows if p == s]
        seen, hits = seen + len(got), hits + sum(got)
        total += sum(got) / pos * hits / seen
    return total


def brute_auc(rows):
    good = [p for p, y in rows if y]
    bad = [p for p, y in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


SCORES = st.lists(
    st.tuples(st.sampled_from([0.0, 0.05, 0.1, 0.3, 0.5, 0.5001, 0.7, 0.95, 1.0]), st.integers(0, 1)),
    min_size=2, max_size=40,
).filter(lambda rows: 0 < sum(y for _, y in rows) < len(rows))


@settings(max_examples=8, deadline=None)
@given(SCORES)
def test_ranking_metrics_with_ties(spark, rows):
    got = G.metric_suite(pairs(spark, rows)).first()
    assert got["pr_auc"] == pytest.approx(brute_ap(rows), abs=6e-5)
    assert got["roc_auc"] == pytest.approx(brute_auc(rows), abs=6e-5)
    assert got["brier"] == pytest.approx(np.mean([(p - y) ** 2 for p, y in rows]), abs=6e-5)


@settings(max_examples=6, deadline=None)
@given(SCORES)
def test_sweep_counts_every_threshold(spark, rows):
    sweep = {r["threshold"]: r for r in G.threshold_sweep(pairs(spark, rows)).collect()}
    assert len(sweep) == 91
    for t in (0.05, 0.1, 0.3, 0.5, 0.7, 0.95):
        tp = sum(y for p, y in rows if p >= t)
        fp = sum(1 - y for p, y in rows if p >= t)
        r = sweep[t]
        assert (r["true_positive"], r["false_positive"]) == (tp, fp)
        assert r["n_flagged"] == tp + fp
        assert r["expected_value"] == 7 * tp - 5 * fp


def test_sliced_path_equals_single_slice(spark, monkeypatch):
    rows = [((i * 37 % 1009) / 1009, int(i * 53 % 11 < 3)) for i in range(3000)]
    df = pairs(spark, rows)
    want = G.metric_suite(df).first()
    monkeypatch.setattr(G, "slice_cuts", lambda d, c: [i / 50 for i in range(1, 50)])
    assert G.metric_suite(df).first() == want
    points = G.roc_points(df).collect()
    assert len(points) == len({p for p, _ in rows})
    assert max(r["tpr"] for r in points) == 1.0


def test_average_precision_is_stepwise_not_trapezoidal(spark):
    rows = [(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0), (0.5, 1), (0.4, 0)]
    df = pairs(spark, rows)
    assert G.ranking_value(df, "pr_auc") == pytest.approx((1 + 2 / 3 + 3 / 5) / 3)
    assert G.ranking_value(df, "pr_area_trapezoid") != pytest.approx(G.ranking_value(df, "pr_auc"))


# Published cells of one operating point and the metrics printed beside them.
CELLS = {"tn": 1931, "fp": 128, "fn": 114, "tp": 268}
METRICS = {
    "accuracy": 0.9009, "balanced_accuracy": 0.8197, "precision": 0.6768,
    "recall": 0.7016, "f1": 0.6889, "mcc": 0.6301,
}


@pytest.fixture(scope="module")
def published(spark):
    kinds = [(0.1, 0, CELLS["tn"]), (0.9, 0, CELLS["fp"]), (0.1, 1, CELLS["fn"]), (0.9, 1, CELLS["tp"])]
    return pairs(spark, [(p, y) for p, y, n in kinds for _ in range(n)])


def test_point_metrics_of_published_cells(published):
    got = G.point_metrics(published, 0.7).first()
    assert {m: got[m] for m in METRICS} == METRICS


def test_campaign_value_of_published_cells(published):
    assert G.campaign_value(published, 0.7).first()["expected_value"] == 1236.0


def test_classification_report_of_published_cells(published):
    got = {r["class"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in
           G.classification_report(published, 0.7).collect()}
    assert got["No purchase"] == (0.9443, 0.9378, 0.9410, 2059)
    assert got["Purchase"] == (0.6768, 0.7016, 0.6889, 382)
    assert got["accuracy"] == (None, None, 0.9009, 2441)
    assert got["macro avg"] == (0.8105, 0.8197, 0.8150, 2441)
    assert got["weighted avg"] == (0.9024, 0.9009, 0.9016, 2441)


def test_single_class_has_no_auc_and_zero_scores(spark):
    got = G.metric_suite(pairs(spark, [(0.2, 0), (0.8, 0)])).first()
    assert got["roc_auc"] is None
    assert (got["precision"], got["recall"], got["f1"], got["mcc"], got["pr_auc"]) == (0, 0, 0, 0, 0)
    assert got["balanced_accuracy"] == 0.5


def test_empty_frame(spark):
    df = spark.createDataFrame([], "row_id bigint, probability double, label int")
    assert G.metric_suite(df).first()["accuracy"] == 0
    assert G.calibration_curve(df).count() == 0
    assert H.batch_summary(df).first()["n_sessions"] == 0


def test_null_scores_are_left_out(spark):
    df = spark.createDataFrame([(0.9, 1), (None, 1), (0.1, None)], "probability double, label int")
    assert G.confusion(df).first()["true_positive"] == 1
    assert sum(r["n_flagged"] for r in G.threshold_sweep(df).filter("threshold = 0.5").collect()) == 1


def test_calibration_bins_are_open_below(spark):
    got = G.calibration_curve(pairs(spark, [(0.0, 0), (0.1, 0), (0.1000001, 1), (0.3, 1), (1.0, 1)]))
    assert {(r["bin_lower"], r["bin_upper"]): r["count"] for r in got.collect()} == {
        (0.0, 0.1): 2, (0.1, 0.2): 1, (0.2, 0.3): 1, (0.9, 1.0): 1,
    }


def test_optimal_threshold_takes_lowest_on_ties_and_checks_the_column(spark):
    sweep = spark.createDataFrame([(0.2, 5.0), (0.4, 7.0), (0.3, 7.0)], "threshold double, gain double")
    assert G.optimal_threshold(sweep, "gain").first()["threshold"] == 0.3
    with pytest.raises(KeyError):
        G.optimal_threshold(sweep, "profit")


def test_top_errors_are_confident_and_stable(spark):
    df = pairs(spark, [(0.9, 0), (0.9, 0), (0.6, 0), (0.2, 1), (0.1, 1), (0.95, 1)])
    assert [r["row_id"] for r in G.top_errors(df, "false_positive", n=2).collect()] == [0, 1]
    assert [r["row_id"] for r in G.top_errors(df, "false_negative", n=2).collect()] == [4, 3]
    with pytest.raises(ValueError):
        G.top_errors(df, "true_positive")


def test_drift_names_the_offenders(spark):
    cols = "pr_auc double, roc_auc double, f1 double, recall double, precision double"
    a = spark.createDataFrame([(0.75, 0.93, 0.68, 0.70, 0.67)], cols)
    b = spark.createDataFrame([(0.745, 0.94, 0.66, 0.70, 0.67)], cols)
    bad = {r["metric"] for r in G.metric_drift(a, b).filter("NOT within_tolerance").collect()}
    assert bad == {"f1"}


def test_more_rows_are_flagged_under_a_lower_threshold(spark):
    df = pairs(spark, [(i / 100, i % 2) for i in range(100)])
    flags = [H.batch_summary(df, t).first()["n_flagged"] for t in (0.3, 0.5, 0.7, 0.9)]
    assert flags == sorted(flags, reverse=True) and len(set(flags)) == 4


def test_policies_collapse_when_thresholds_agree(spark):
    df = pairs(spark, [(0.9, 1)] * 20 + [(0.1, 0)] * 20)
    policies = H.threshold_policies(G.threshold_sweep(df))
    assert [r["policy"] for r in policies.collect()] == [H.BALANCED]
    labels = H.policy_labels(df, policies)
    assert labels.count() == 40


def test_actions_at_their_limits(spark):
    df = pairs(spark, [(0.95, 1), (0.7, 1), (0.55, 1), (0.05, 0), (0.049, 0), (1.0, 1)])
    got = [r["recommendation"].split(" - ")[0] for r in H.with_decisions(df, 0.7).orderBy("row_id").collect()]
    assert got == ["High intent", "Likely to convert", "On the margin", "Low intent", "Very low intent", "High intent"]


def test_lift_without_a_baseline_is_zero(spark):
    df = pairs(spark, [(0.5, 0)])
    assert H.with_lift(df).first()["lift"] == 0.0
    assert math.isclose(H.with_lift(df, 10.0).first()["lift"], 5.0)
