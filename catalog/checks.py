"""Model-dependent operators as statements that must hold for every row.

Each query computes a value in two ways, or a rule and what it should follow, and returns one
row per checked row with the comparison; the SQL says for which rows it has to be true.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import queries as Q
from catalog.oracle import UNIQUE
from clickscore.contract import SESSION
from clickscore.functions import decisions as D
from clickscore.operators import alignment as C
from clickscore.operators import explaining as X
from clickscore.operators import learning as L
from clickscore.operators import profiling as Dp
from clickscore.operators import scoring as Sc
from clickscore.operators import splitting as E
from clickscore.operators.trees import SecondOrderTrees
from clickscore.plans import training
from clickscore.session import work_folder
from clickscore.sources.models import load_model, save_model

CLOSE = 1e-9


def _same(left: DataFrame, right: DataFrame, column: str = "purchase_probability") -> DataFrame:
    """Per row_id, whether both sides have it with the same value."""
    a, b = left.select("row_id", F.col(column).alias("l")), right.select("row_id", F.col(column).alias("r"))
    near = F.coalesce(F.abs(F.col("l") - F.col("r")) <= CLOSE, F.lit(False))
    return a.join(b, "row_id", "full").select("row_id", near.alias("same"))


def _direct(spark: SparkSession, folder: str, family: str = "linear") -> DataFrame:
    return Sc.score(Q.unique_sessions(spark, folder), Q.fitted(spark, folder, family), 0.7)


def saved_scores(spark: SparkSession, folder: str) -> DataFrame:
    path = save_model(Q.fitted(spark, folder), work_folder(spark, "model"))
    return _same(_direct(spark, folder), Sc.score(Q.unique_sessions(spark, folder), load_model(spark, path), 0.7))


def stream_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _same(_direct(spark, folder), Q._scored_stream(spark, folder, False))


def history_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every appended row of the history sink, against the direct score."""
    return _same(_direct(spark, folder), Q._scored_stream(spark, folder, True))


def upload_scores(spark: SparkSession, folder: str) -> DataFrame:
    """An upload in text, aligned and scored, against the typed sessions."""
    got = Sc.score_upload(Q.upload("padded")(spark, folder), Q.fitted(spark, folder))[0]
    aligned = got.withColumn("row_id", F.col("session_id").cast("bigint"))
    typed = Sc.score(Q.sessions(spark, folder), Q.fitted(spark, folder))
    return _same(aligned, typed)


def decisions_follow(family: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        full = Sc.predict_sessions(Q.unique_sessions(spark, folder), Q.fitted(spark, folder, family), 0.7)
        p = F.col("probability")
        action = F.when(p >= 0.7, p >= 0.95).otherwise(p < 0.05)
        said = F.col("recommendation").isin(D.ACTIONS["sure"], D.ACTIONS["none"])
        return full.select(
            "row_id",
            ((F.col("prediction") == "Purchase") == (p >= 0.7)).alias("label_follows"),
            (said == action).alias("action_follows"),
            (p.between(0.0, 1.0)).alias("is_probability"),
        )

    return run


def residual(family: str):
    """Base and all contributions give every row's probability again."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        model = Q.fitted(spark, folder, family)
        told = X.attribute(Q.unique_sessions(spark, folder), model, Q.training_rows(spark, folder), smallest=-1.0)
        moved = F.aggregate("contributions", F.lit(0.0), lambda a, e: a + e["value"])
        base = F.col("base_probability")
        if family == "forest":
            again = base + moved
        else:
            again = 1 / (1 + F.exp(-(F.log(base / (1 - base)) + moved)))
        return told.select(
            "row_id", ((F.abs("residual") < 1e-6) & (F.abs(again - F.col("probability")) < 1e-9)).alias("additive")
        )

    return run


def curve_points(family: str, feature: str):
    """Spans found inside the rows against the lowest and highest of forty scored copies of each."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        once, model = Q.unique_sessions(spark, folder), Q.fitted(spark, folder, family)
        ranges = Dp.numeric_ranges(once, columns=[feature])
        grid = X._grid(feature, ranges, X.SWEEP_POINTS, SESSION)
        copies = X._sensitivity_by_copies(once, model, feature, grid, "row_id", SESSION)
        found = copies.groupBy("row_id").agg(
            F.count(F.lit(1)).alias("n_points"), F.min("probability").alias("low"), F.max("probability").alias("high")
        )
        near = lambda a, b: F.abs(F.col(a) - F.col(b)) < 1e-12
        spans = X.sensitivity_spans(once, model, feature, ranges)
        return found.join(spans, "row_id").select(
            "row_id", "n_points", (near("low", "min_probability") & near("high", "max_probability")).alias("same")
        )

    return run


def global_slots(spark: SparkSession, folder: str) -> DataFrame:
    """The global table has every transformed feature, with the mean of the row values."""
    once, model, back = Q.unique_sessions(spark, folder), Q.fitted(spark, folder), Q.training_rows(spark, folder)
    table = X.global_contribution(once, model, back)
    rows = X.attribute(once, model, back, smallest=-1.0).select(F.inline("contributions"))
    mean = rows.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean"))
    names = spark.createDataFrame([(n,) for n in L.feature_names(model)], "feature string")
    found = names.join(table, "feature", "left").join(mean, "feature", "left").select(
        (F.abs(F.col("mean_abs_contribution") - F.col("mean")) < CLOSE).alias("same")
    )
    return found.agg(F.count_if(~F.coalesce("same", F.lit(False))).alias("n_wrong"), (F.count(F.lit(1)) > 0).alias("some"))


def leakage_arms(spark: SparkSession, folder: str) -> DataFrame:
    """The experiment's two arms on the shared split: sizes, and the delta of every metric."""
    rows = E.stratified_split(Q.training_rows(spark, folder), L.LABEL)
    sizes = rows.agg(F.count_if("is_test").alias("n_test"), F.count(F.lit(1)).alias("n_rows"))
    got = {r["model"]: r for r in Q.all_queries()["leakage_experiment"](spark, folder).collect()}  # three report rows
    kept, left_out, delta = got["with_PageValues"], got["without_PageValues"], got["delta"]
    metrics = [m for m in delta.asDict() if m != "model"]
    right = len(got) == 3 and all(abs(left_out[m] - kept[m] - delta[m]) < 2e-4 for m in metrics)
    return sizes.withColumn("delta_right", F.lit(right))


def importance(family: str):
    """Every transformed feature once, with a share that is not negative; largest first."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        model = Q.fitted(spark, folder, family)
        table = L.feature_importance(model, spark)
        rows = table.collect()  # one row per slot
        values = [r["importance"] for r in rows]
        last = model.stages[-1]
        own = last.coefficients.toArray() if family == "linear" else last.featureImportances.toArray()
        want = {n: abs(float(v)) for n, v in zip(L.feature_names(model), own)}
        in_order = values == sorted(values, reverse=True)
        return spark.createDataFrame(
            [(r["feature"], in_order and want.get(r["feature"]) == r["importance"] >= 0) for r in rows], "feature string, fine boolean"
        )

    return run


def search(spark: SparkSession, folder: str) -> DataFrame:
    """The search over the whole linear grid finds at least the baseline."""
    found = Q.all_queries()["cross_validated_search"](spark, folder)
    gain = F.col("tuned_pr_auc") - F.col("baseline_pr_auc")
    n = Q.training_rows(spark, folder).count()
    return found.select(
        "model", (gain >= 0).alias("not_worse"), (F.abs(gain - F.col("improvement")) < 2e-4).alias("gain_right"), F.lit(n).alias("n_rows")
    )


def trained(spark: SparkSession, folder: str) -> DataFrame:
    """The whole training plan over the three families: one is selected, all are tested on the same rows.

    The logistic family searches its whole grid; the trees are small ones, so that the plan ends soon.
    """
    shared = {"labelCol": L.LABEL, "weightCol": L.WEIGHT}
    rows = Q.sessions(spark, folder)
    linear = L.candidates(rows.count())["Logistic Regression"]
    families = {
        "Logistic Regression": linear,
        "Random Forest": L.Candidate(RandomForestClassifier(numTrees=3, maxDepth=4, seed=42, **shared), {"minInstancesPerNode": [1, 4]}, "a"),
        "Gradient Boosted Trees": L.Candidate(SecondOrderTrees(maxIter=3, maxDepth=2, **shared), {"minChildWeight": [1.0, 5.0]}, "b"),
    }
    got = training.train(rows, families=families, draws=2, parallelism=4, folds=2)
    table = got.tables["model_test_comparison"].collect()  # one row per family
    best = max(table, key=lambda r: r["pr_auc"])["model"]
    card = got.card.first()
    cells, sizes = sum(card["confusion"].values()), card["dataset"]
    right = got.name == best == card["model_name"] and cells == sizes["test_rows"] == card["calibration"]["n_sessions"]
    made = [(r["model"], right and 0 <= r["pr_auc"] <= 1, sizes["rows_used"], cells) for r in table]
    return spark.createDataFrame(made, "model string, consistent boolean, n_rows bigint, n_test bigint")


def scored_file(spark: SparkSession, folder: str) -> DataFrame:
    """The written file against scoring the typed sessions."""
    written = Q.all_queries()["score_file"](spark, folder)
    typed = Sc.score(Q.sessions(spark, folder), Q.fitted(spark, folder))
    left = written.select(
        F.col("session_id").cast("bigint").alias("row_id"), F.col("purchase_probability").cast("double").alias("purchase_probability")
    )
    return _same(left, typed)


def alignment_report(spark: SparkSession, folder: str) -> DataFrame:
    """How every defective upload was matched: strategy, columns, notes, trust."""
    rows = []
    for style in ("exact", "renamed", "anonymous", "padded"):
        got = C.align(Q.upload(style)(spark, folder), allow_positional=style == "anonymous")
        rows.append((style, got.strategy, len(got.mapping), len(got.notes), got.trustworthy))
    return spark.createDataFrame(
        rows, "style string, strategy string, n_columns bigint, n_notes bigint, trustworthy boolean"
    )


def all_queries() -> dict:
    return {
        "alignment_report": alignment_report,
        "check_saved_scores": saved_scores,
        "check_stream_scores": stream_scores,
        "check_history_rows": history_rows,
        "check_upload_scores": upload_scores,
        "check_decisions_linear": decisions_follow("linear"),
        "check_decisions_trees": decisions_follow("trees"),
        "check_decisions_forest": decisions_follow("forest"),
        "check_decisions_boosted": decisions_follow("boosted"),
        "check_linear_residual": residual("linear"),
        "check_trees_residual": residual("trees"),
        "check_forest_residual": residual("forest"),
        "check_boosted_residual": residual("boosted"),
        "check_global_contribution": global_slots,
        "check_sensitivity": curve_points("linear", "PageValues"),
        "check_sensitivity_trees": curve_points("trees", "PageValues"),
        "check_sensitivity_derived": curve_points("trees", "ProductRelated"),
        "check_leakage_arms": leakage_arms,
        "check_importance_linear": importance("linear"),
        "check_importance_trees": importance("trees"),
        "check_search": search,
        "check_score_file": scored_file,
        "check_train": trained,
    }


def all_sql() -> dict[str, str]:
    U = f"WITH {UNIQUE}"
    same = f"{U} SELECT row_id, true AS same FROM u"
    additive = f"{U} SELECT row_id, true AS additive FROM u"
    points = f"{U} SELECT row_id, 40::BIGINT AS n_points, true AS same FROM u"
    follow = f"{U} SELECT row_id, true AS label_follows, true AS action_follows, true AS is_probability FROM u"
    return {
        "alignment_report": """SELECT * FROM (VALUES ('exact', 'exact', 17::BIGINT, 0::BIGINT, true),
            ('renamed', 'normalised', 17, 1, true), ('anonymous', 'positional', 17, 2, false),
            ('padded', 'exact', 17, 0, true)) t(style, strategy, n_columns, n_notes, trustworthy)""",
        "check_saved_scores": same,
        "check_stream_scores": same,
        "check_history_rows": same,
        "check_upload_scores": f"{U} SELECT row_id, true AS same FROM s",
        "check_decisions_linear": follow,
        "check_decisions_trees": follow,
        "check_decisions_forest": follow,
        "check_decisions_boosted": follow,
        "check_linear_residual": additive,
        "check_trees_residual": additive,
        "check_forest_residual": additive,
        "check_boosted_residual": additive,
        "check_global_contribution": "SELECT 0::BIGINT AS n_wrong, true AS some",
        "check_sensitivity": points,
        "check_sensitivity_trees": points,
        "check_sensitivity_derived": points,
        "check_leakage_arms": f"""{U} SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) AS n_test, count(*) AS n_rows,
          true AS delta_right FROM u""",
        "check_search": f"""{U} SELECT 'Logistic Regression' AS model, true AS not_worse, true AS gain_right,
          count(*)::INTEGER AS n_rows FROM u""",
        "check_score_file": f"{U} SELECT row_id, true AS same FROM s",
        "check_train": f"""{U} SELECT model, true AS consistent, (SELECT count(*) FROM u) AS n_rows,
          (SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) FROM u) AS n_test
          FROM (VALUES ('Logistic Regression'), ('Random Forest'), ('Gradient Boosted Trees')) t(model)""",
    }
