import numpy as np
import pytest
from conftest import TYPICAL, frame
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from clickscore.contract import SESSION
from clickscore.operators import explaining as X
from clickscore.operators import learning as L
from clickscore.operators import profiling as D
from clickscore.operators import scoring as Sc
from clickscore.sources import models as M

BOTH = pytest.mark.parametrize("family", ["linear", "trees"])


@pytest.fixture
def model(request, family):
    return request.getfixturevalue(family)


def probs(df, model):
    return [r["probability"] for r in L.probability_of(df, model).orderBy("row_id").collect()]


@BOTH
def test_odd_sessions_score_between_zero_and_one(spark, model):
    zero = {c: type(TYPICAL[c])(0) for c in SESSION.numeric}
    huge = {"ProductRelated": 100_000, "ProductRelated_Duration": 1e6, "PageValues": 5e4}
    unseen = {"Browser": 999, "TrafficType": 888, "Month": "nan", "VisitorType": "Robot"}
    empty = {c: None for c in (*SESSION.numeric, "Month", "Weekend")}
    got = probs(frame(spark, zero, huge, unseen, empty), model)
    assert len(got) == 4 and all(0.0 <= p <= 1.0 for p in got)


@BOTH
def test_scoring_is_repeatable_and_row_wise(spark, unique, model):
    few = unique.orderBy("row_id").limit(30)
    batch = probs(few, model)
    assert batch == probs(few.repartition(7), model)
    single = few.filter(F.col("row_id") == few.first()["row_id"])
    assert probs(single, model)[0] == pytest.approx(batch[0], abs=1e-12)


def test_unknown_and_missing_levels_encode_as_zeros(spark, linear):
    df = frame(spark, {"Browser": 999}, {})
    rows = L.transform_rows(df, linear).select(
        F.col("_row.row_id").alias("row_id"), L.vector_to_array("features").alias("v")
    ).orderBy("row_id").collect()
    slots = [i for i, n in enumerate(L.feature_names(linear)) if n.startswith("Browser_")]
    assert sum(rows[0]["v"][i] for i in slots) == 0
    assert sum(rows[1]["v"][i] for i in slots) == 1


def test_feature_names_line_up_with_the_vector(training, linear):
    names = L.feature_names(linear)
    assert len(names) == linear.stages[-1].numFeatures == len(set(names))
    assert names[:2] == ["Administrative", "Administrative_Duration"] and "Month_Nov" in names
    assert L.fitted_levels(linear)["Weekend"] == ["False", "True"]


def test_numeric_branch_uses_median_and_population_deviation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,), (float("nan"),)], "x double")
    got = L.NumericBranch(inputCols=["x"]).fit(df).transform(df).toPandas()
    filled = np.array([1, 2, 3, 10, 2.5, 2.5])
    assert np.allclose(got[f"x{L.Z}"], (filled - filled.mean()) / filled.std())
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert set(L.NumericBranch(inputCols=["x"]).fit(flat).transform(flat).toPandas()[f"x{L.Z}"]) == {0.0}


def test_mode_imputation_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b", 10), ("a", 9), (None, None)], "s string, n int")
    got = L.mode_impute(df, ["s", "n"]).collect()[2]
    assert (got["s"], got["n"]) == ("a", 9)


def test_caller_columns_survive_whatever_they_are_called(spark, linear):
    df = frame(spark, {}).withColumns(
        {c: F.lit(c) for c in ("features", "prediction_note", "TotalPages", "Month__s", "rawPrediction", "label")}
    )
    got = Sc.score(df, linear)
    assert got.columns == [*df.columns, *Sc.SCORE_COLUMNS]
    assert got.first()["features"] == "features" and got.first()["TotalPages"] == "TotalPages"


def test_missing_features_are_refused(spark, linear):
    with pytest.raises(ValueError, match="ExitRates"):
        Sc.score(frame(spark, {}).drop("ExitRates"), linear)


def test_label_and_action_follow_the_threshold(spark, unique, linear):
    low = Sc.score(unique, linear, 0.1).filter("prediction = 'Purchase'").count()
    high = Sc.score(unique, linear, 0.9).filter("prediction = 'Purchase'").count()
    assert low > high
    full = Sc.predict_sessions(unique, linear, 0.5)
    wrong = full.filter((F.col("probability") >= 0.5) != (F.col("predicted_class") == 1))
    assert wrong.count() == 0


def test_linear_contributions_add_up(unique, training, linear):
    got = X.attribute(unique, linear, training, top_n=None)
    assert got.agg(F.max(F.abs("residual"))).first()[0] < 1e-8
    sizes = [abs(e["value"]) for e in got.first()["contributions"]]
    assert sizes == sorted(sizes, reverse=True)


@BOTH
def test_contributions_are_ranked_and_limited(request, unique, training, family):
    model = request.getfixturevalue(family)
    got = X.attribute(unique, model, training, top_n=3).collect()
    assert len(got) == unique.count()
    for r in got:
        sizes = [abs(e["value"]) for e in r["contributions"]]
        assert len(sizes) <= 3 and sizes == sorted(sizes, reverse=True) and all(s > 1e-9 for s in sizes)


def test_ablation_of_one_changed_field_is_exact(spark, training, trees):
    typical = X.typical_values(training)
    df = training.limit(1).select(F.lit(1).cast("bigint").alias("row_id"), *[v.alias(c) for c, v in typical.items()])
    df = df.withColumn("PageValues", F.lit(90.0))
    got = X._attribute_by_ablation(df, trees, training, None, "row_id", SESSION, 1e-9).first()
    assert {e["feature"] for e in got["contributions"]} <= {"PageValues"}
    assert got["residual"] == pytest.approx(0.0, abs=1e-9)


def test_contributions_of_trees_add_up(spark, unique, training, trees):
    got = X.attribute(unique, trees, training, smallest=-1.0).collect()
    assert len(got) == unique.count()
    for r in got:
        assert abs(r["residual"]) < 1e-9
        assert {e["feature"] for e in r["contributions"]} == set(L.feature_names(trees))
        start = np.log(r["base_probability"] / (1 - r["base_probability"]))
        total = start + sum(e["value"] for e in r["contributions"])
        assert 1 / (1 + np.exp(-total)) == pytest.approx(r["probability"], abs=1e-9)


@pytest.mark.parametrize("feature", ["PageValues", "ProductRelated", "BounceRates"])
@pytest.mark.parametrize("family", ["linear", "trees", "forest"])
def test_curves_equal_scored_copies(spark, unique, family, feature, request):
    from catalog import queries
    from conftest import SMALL

    model = queries.fitted(spark, SMALL, family)
    ranges = D.numeric_ranges(unique, columns=[feature])
    few = unique.limit(40).persist()
    grid = X._grid(feature, ranges, 12, SESSION)
    curve = X.sensitivity(few, model, feature, ranges, n=12)
    copies = X._sensitivity_by_copies(few, model, feature, grid, "row_id", SESSION)
    a = {(r["row_id"], r["value"]): r["probability"] for r in curve.collect()}
    b = {(r["row_id"], r["value"]): r["probability"] for r in copies.collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-12
    spans = X.sensitivity_spans(few, model, feature, ranges, n=12)
    assert spans.exceptAll(X.sensitivity_span(curve).select(*spans.columns)).count() == 0
    assert "Exchange" not in spans._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]


def test_global_contribution_is_sorted(unique, training, linear):
    values = [r[1] for r in X.global_contribution(unique, linear, training).collect()]
    assert values and values == sorted(values, reverse=True)


def test_importance_is_sorted_and_named(spark, linear, trees):
    for m in (linear, trees):
        rows = L.feature_importance(m, spark).collect()
        assert [r["feature"] for r in rows] != [] and rows[0]["importance"] >= rows[-1]["importance"]
        assert {r["feature"] for r in rows} == set(L.feature_names(m))
    assert L.feature_importance(trees, spark, top=15).count() == 15


def test_sensitivity_sweeps_to_the_99th_percentile(spark, unique, linear):
    ranges = D.numeric_ranges(unique)
    few = unique.orderBy("row_id").limit(3)
    curve = X.sensitivity(few, linear, "PageValues", ranges, n=10)
    rows = curve.collect()
    assert len(rows) == 30 and min(r["value"] for r in rows) == 0.0
    p99 = ranges.filter(F.col("column") == "PageValues").first()["p99"]
    assert max(r["value"] for r in rows) == pytest.approx(p99, abs=1e-6)
    span = X.sensitivity_span(curve).collect()
    assert all(r["min_probability"] <= r["max_probability"] for r in span)
    with pytest.raises(ValueError):
        X.sensitivity(few, linear, "Month", ranges)


def test_sweep_falls_back_to_maximum_then_one():
    assert X.sweep_values(0.0, 8.0, 5)[-1] == 8.0
    assert X.sweep_values(0.0, 0.0, 5)[-1] == 1.0


def test_short_numbers_print_like_four_significant_digits(spark):
    values = [0.0, 1.0, 59.6806, 1136.628, 0.0145, -22.9661, 9999.7, 12345.0, 63973.5222, 1e-5, 2.5e-4,
              0.99996, 3.14159e12, 100.0, 7.0, -0.00012345, 99.996]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(X.short_number(F.col("v"))).collect()]
    assert got == [f"{v:.4g}" for v in values]


def test_saved_models_score_the_same(spark, unique, linear, tmp_path):
    path = M.save_model(linear, str(tmp_path / "model"))
    again = M.load_model(spark, path)
    assert M.load_model(spark, path) is again
    assert probs(unique, again) == probs(unique, linear)
    with pytest.raises(FileNotFoundError):
        M.load_model(spark, str(tmp_path / "nothing"))


def test_cards_append_and_give_the_threshold(spark, tmp_path):
    path = str(tmp_path / "cards")
    assert M.operating_threshold(M.read_cards(spark, path)) == 0.5
    for when, t in (("2024-01-01", 0.6), ("2024-02-01", 0.7)):
        M.model_card(spark, model_name="m", trained_at=when, operating_threshold=t,
                     metrics={"f1": 0.5}, top_features=[("a", 0.1)]).write.mode("append").parquet(path)
    assert M.operating_threshold(M.read_cards(spark, path)) == 0.7


def test_evaluator_is_average_precision(spark, training, linear):
    scored = linear.transform(training)
    pdf = L.probability_of(training, linear).select("probability", "label").toPandas()
    seen = pdf.sort_values("probability", ascending=False)
    groups = seen.groupby("probability", sort=False)["label"].agg(["sum", "count"])
    ap = (groups["sum"] * groups["sum"].cumsum() / groups["count"].cumsum()).sum() / groups["sum"].sum()
    assert L.AveragePrecisionEvaluator().evaluate(scored) == pytest.approx(ap, abs=1e-9)


def test_search_picks_the_best_mean(training):
    two = training.withColumn("fold", F.col("fold") % 2)
    classifier = LogisticRegression(labelCol="label", weightCol="weight", maxIter=3, standardization=False)
    candidate = L.Candidate(classifier, {"regParam": [100.0, 1e-3]}, "why")
    got = L.tune("linear", candidate, two, draws=2, parallelism=4)
    folds = L.fold_vectors(two, parallelism=2)
    means = {v: L.cross_validate(classifier, [{classifier.regParam: v}], folds)[0] for v in (100.0, 1e-3)}
    assert got.best_params["regParam"] == str(max(means, key=means.get))
    assert got.tuned_pr_auc == round(max(means.values()), 4)
    assert got.improvement == round(got.tuned_pr_auc - got.baseline_pr_auc, 4)


def test_candidates_draw_from_their_grids():
    families = L.candidates(1_000)
    assert len(L.sample_params(families["Logistic Regression"].grid, 30)) == 12
    assert len(L.sample_params(families["Random Forest"].grid, 30)) == 30
    for c in families.values():
        for name in c.grid:
            c.estimator.getParam(name)


def test_leakage_arms_and_delta(training):
    classifier = LogisticRegression(labelCol="label", weightCol="weight", maxIter=3, standardization=False)
    got = {r["model"]: r for r in L.leakage_experiment(classifier, training, training).collect()}
    a, b = got["with_PageValues"], got["without_PageValues"]
    assert got["delta"]["pr_auc"] == pytest.approx(b["pr_auc"] - a["pr_auc"], abs=1e-4)
    assert "PageValues" not in SESSION.without("PageValues").features
    with pytest.raises(ValueError):
        SESSION.without("Nothing")


def test_scaling_takes_infinite_cells_as_missing(spark):
    df = frame(spark, {"PageValues": 1.0}, {"PageValues": 3.0}, {"PageValues": float("inf")}, {"PageValues": float("nan")})
    got = [r["PageValues"] for r in L.standard_scale(df, ["PageValues"]).orderBy("row_id").collect()]
    assert got == [-1.0, 1.0, None, None]
