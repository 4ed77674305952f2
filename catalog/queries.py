"""Every operator as a query over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscore.contract import SESSION
from clickscore.functions import decisions as rules
from clickscore.operators import alignment as C
from clickscore.operators import cleaning as B
from clickscore.operators import deciding as H
from clickscore.operators import evaluation as G
from clickscore.operators import explaining as X
from clickscore.operators import learning as L
from clickscore.operators import profiling as Dp
from clickscore.operators import relevance as R
from clickscore.operators import runs as J
from clickscore.operators import scoring as Sc
from clickscore.operators import splitting as E
from clickscore.operators import validation as V
from clickscore.operators.trees import SecondOrderTrees
from clickscore.plans.batch_scoring import score_file
from clickscore.plans.profile import write_input_profile
from clickscore.session import work_folder
from clickscore.sources import clickstream as src
from clickscore.sources import readers
from clickscore.sources.models import calibration_block, load_model, model_card, read_cards, save_model
from clickscore.sources.writers import append_rows, write_json, write_scored, write_table
from clickscore.streaming import scoring as K

# The supplied tables that take no part in the text operators.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# The spellings the text categories are brought to.
SPELLINGS = {
    "Month": ["Feb", "Mar", "May", "June", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"],
    "VisitorType": ["New_Visitor", "Other", "Returning_Visitor"],
}

Query = Callable[[SparkSession, str], DataFrame]


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    return src.scored_from_events(src.read_table(spark, folder, "events"))


def rivals(spark: SparkSession, folder: str) -> DataFrame:
    return src.model_scores_from_events(src.read_table(spark, folder, "events"))


def big_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return src.scored_from_lineitem(src.read_table(spark, folder, "lineitem"))


def _on(source: Query, op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: op(source(spark, folder))


def _drift(df: DataFrame) -> DataFrame:
    suites = G.compare_models(df)
    return G.metric_drift(
        suites.filter(F.col("model") == "by_value"), suites.filter(F.col("model") == "by_key")
    )


def evaluation_queries() -> dict[str, Query]:
    # Columns are made inside the queries: this table needs no session.
    return {
        "confusion": _on(pairs, G.confusion),
        "confusion_normalised": _on(pairs, G.confusion_normalised),
        "point_metrics": _on(pairs, G.point_metrics),
        "balanced_accuracy": _on(pairs, lambda d: G.point_metrics(d).select("balanced_accuracy")),
        "mcc": _on(pairs, lambda d: G.point_metrics(d).select("mcc")),
        "roc_auc": _on(pairs, G.roc_auc),
        "average_precision": _on(pairs, G.average_precision),
        "pr_area_trapezoid": _on(pairs, G.pr_area_trapezoid),
        "brier": _on(pairs, G.brier),
        "metric_suite": _on(pairs, G.metric_suite),
        "metric_suite_lineitem": _on(big_pairs, G.metric_suite),
        "campaign_value": _on(pairs, G.campaign_value),
        "threshold_sweep": _on(pairs, G.threshold_sweep),
        "threshold_sweep_lineitem": _on(big_pairs, G.threshold_sweep),
        "optimal_threshold_f1": _on(pairs, lambda d: G.optimal_threshold(G.threshold_sweep(d))),
        "optimal_threshold_value": _on(
            pairs, lambda d: G.optimal_threshold(G.threshold_sweep(d), "expected_value")
        ),
        "calibration_curve": _on(pairs, G.calibration_curve),
        "calibration_summary": _on(pairs, G.calibration_summary),
        "outcome": _on(
            pairs, lambda d: G.with_outcome(d).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
        ),
        **{
            f"top_errors_{kind}": _on(
                pairs,
                lambda d, kind=kind: G.top_errors(d, kind).select(
                    "row_id", "label", "probability", "predicted", "outcome"
                ),
            )
            for kind in ("false_positive", "false_negative")
        },
        "outcome_profile": _on(pairs, lambda d: G.outcome_profile(d, ["value", "k"])),
        "classification_report": _on(pairs, G.classification_report),
        "roc_points": _on(pairs, G.roc_points),
        "pr_points": _on(pairs, G.pr_points),
        "prevalence": _on(pairs, G.prevalence),
        "compare_models": _on(rivals, G.compare_models),
        "select_model": _on(rivals, lambda d: G.select_model(G.compare_models(d))),
        "metric_drift": _on(rivals, _drift),
        "class_label": _on(
            pairs, lambda d: d.select("row_id", rules.class_label(F.col("label")).alias("class_label"))
        ),
        "confidence_band": _on(
            pairs, lambda d: d.select("row_id", rules.confidence_band(d["probability"]).alias("confidence_band"))
        ),
        "recommendation": _on(
            pairs, lambda d: d.select("row_id", rules.recommendation(d["probability"], 0.5).alias("recommendation"))
        ),
        "verdict": _on(pairs, lambda d: d.select("row_id", rules.verdict(d["probability"], 0.5).alias("verdict"))),
        "decisions": _on(
            pairs,
            lambda d: H.with_decisions(d, 0.7).select(
                "row_id", "predicted_class", "prediction", "threshold",
                "confidence_band", "recommendation",
            ),
        ),
        "threshold_policies": _on(pairs, lambda d: H.threshold_policies(G.threshold_sweep(d))),
        "policy_labels": _on(
            pairs,
            lambda d: H.policy_labels(
                d.select("row_id", "probability"), H.threshold_policies(G.threshold_sweep(d))
            ).select("row_id", "policy", "threshold", "prediction"),
        ),
        "lift": _on(
            pairs, lambda d: H.with_lift(d).select("row_id", "baseline_pct", "lift", "lift_points")
        ),
        "batch_summary": _on(pairs, H.batch_summary),
        "top_sessions": _on(pairs, lambda d: H.top_sessions(d).select("row_id", "probability", "label")),
        "prediction_history": _on(
            pairs, lambda d: H.prediction_history(d).select("row_id", "scored_at", "probability")
        ),
    }


# --- sessions -------------------------------------------------------------------------

_kept: dict[tuple[str, str, str], DataFrame] = {}


def _keep(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Tables that many queries start from are derived once per application."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _kept:
        _kept[key] = build().persist()
    return _kept[key]


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    events = src.read_table(spark, folder, "events")
    return _keep(spark, folder, "sessions", lambda: src.sessions_from_events(events))


def unique_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return _keep(
        spark,
        folder,
        "unique",
        lambda: B.add_session_features(B.dedupe(sessions(spark, folder), row_id="row_id")),
    )


def upload(style: str) -> Query:
    return lambda spark, folder: src.uploads_from_sessions(sessions(spark, folder), style)


def damaged_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """The session table as text, with values no valid session can have."""
    k = F.floor(F.col("row_id") / 200_000)
    broken = sessions(spark, folder).withColumns({c: F.col(c).cast("string") for c in SESSION.numeric})
    return broken.withColumns(
        {
            "ProductRelated": F.when(k % 7 == 1, "-5").otherwise(F.col("ProductRelated")),
            "BounceRates": F.when(k % 11 == 2, "4.2").otherwise(F.col("BounceRates")),
            "PageValues": F.when(k % 13 == 3, "n/a").otherwise(F.col("PageValues")),
            "Informational": F.when(k % 5 == 4, "0").otherwise(F.col("Informational")),
            "ExitRates": F.when(k % 17 == 5, F.lit(None)).otherwise(F.col("ExitRates")),
        }
    )


def session_queries() -> dict[str, Query]:
    once = unique_sessions

    def aligned(style: str) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = upload(style)(spark, folder)
            got = C.align(df, levels=SPELLINGS)
            last = len(df.columns) - 1 if style != "padded" else 0
            return got.tracked.select(
                F.col(f"{C.SOURCE}.c{last}").cast("bigint").alias("row_id"), *SESSION.features
            )

        return run

    def notes(style: str) -> Query:
        return lambda spark, folder: C.align(
            upload(style)(spark, folder), levels=SPELLINGS
        ).coercion_counts()

    def gate(d: DataFrame) -> DataFrame:
        """The gate with the checksum that the same rows have in another order and layout."""
        other = V.table_contract(d.repartition(7, "Month")).filter(F.col("check") == "checksum").first()["actual"]
        hidden = F.col("check") == "checksum"
        return V.table_contract(d, checksum=other).select(
            "check", *[F.when(~hidden, F.col(c)).alias(c) for c in ("expected", "actual")], "passed"
        )

    def refused(spark: SparkSession, folder: str) -> DataFrame:
        """Every supplied table as an upload: refused by name, and what scoring misses."""
        rows = []
        for name in TABLES:
            table = src.read_table(spark, folder, name)
            said, missing = "", ""
            try:
                C.match_columns(table.columns, allow_positional=False)
            except ValueError as exc:
                said = str(exc)
            try:
                C.require_columns(table)
            except ValueError as exc:
                missing = str(exc)
            rows.append((name, said.split(":")[0], missing.split(":")[0], len(table.columns)))
        return spark.createDataFrame(rows, "source string, alignment string, scoring string, n_columns bigint")

    validated = _on(damaged_sessions, V.validate_sessions)
    return {
        "sessions": sessions,
        "dedupe": _on(sessions, lambda d: B.dedupe(d, row_id="row_id")),
        "duplicate_stats": _on(sessions, B.duplicate_stats),
        "features_target": _on(sessions, B.features_target),
        "session_features": _on(once, lambda d: d.select("row_id", *[
            F.round(c, 6).alias(c) for c in SESSION.engineered])),
        "segment": _on(
            once, lambda d: B.with_segments(d).select("row_id", F.explode("segments").alias("segment"))
        ),
        "table_contract": _on(sessions, gate),
        **{
            f"align_{s}": aligned(s)
            for s in ("exact", "renamed", "anonymous", "recased", "yes_no", "decimal_codes",
                      "broken_numbers", "padded")
        },
        "coercion_counts_broken": notes("broken_numbers"),
        "coercion_counts_recased": notes("recased"),
        "validate_sessions": _on(validated, V.problem_counts),
        "quarantined_rows": _on(validated, lambda d: V.quarantined_rows(d).select(
            "row_id", F.inline("problems"))),
        "refusals": refused,
        "valid_rows": _on(validated, lambda d: V.valid_rows(d).select("row_id")),
        "quality": _on(sessions, lambda d: Dp.quality(d, SESSION.columns)),
        "null_total": _on(sessions, lambda d: Dp.null_total(d, SESSION.columns)),
        "code_catalog": _on(
            sessions, lambda d: Dp.code_catalog(d).withColumn("values", F.array_join("values", ","))
        ),
        "zero_inflation": _on(sessions, Dp.zero_inflation),
        "target_balance": _on(sessions, Dp.target_balance),
        "baseline_rate": _on(once, Dp.baseline_rate),
        "outliers": _on(once, Dp.outliers),
        "correlation_matrix": _on(once, R.correlation_matrix),
        "high_correlation_pairs": _on(
            once,
            lambda d: R.high_correlation_pairs(d).withColumn("abs_corr", F.round("abs_corr", 6)),
        ),
        "target_correlation": _on(once, R.target_correlation),
        "conversion_by_month": _on(once, lambda d: Dp.conversion_by(d, "Month")),
        "conversion_by_visitor": _on(once, lambda d: Dp.conversion_by(d, "VisitorType")),
        "conversion_by_weekend": _on(once, lambda d: Dp.conversion_by(d, "Weekend")),
        "calendar_coverage": _on(once, Dp.calendar_coverage),
        "mutual_information": _on(once, R.mutual_information),
        "histogram": _on(once, lambda d: Dp.histogram(d).select(
            "column", "bin", F.round("lower", 6).alias("lower"),
            F.round("upper", 6).alias("upper"), "count")),
        "standardised_box": _on(once, Dp.standardised_box),
        "numeric_ranges": _on(once, lambda d: Dp.numeric_ranges(d).withColumns(
            {c: F.round(c, 6) for c in ("median", "p99")})),
        "category_levels": _on(once, Dp.category_levels),
        "segment_presets": _on(once, Dp.segment_presets),
        "stratified_split": _on(pairs, lambda d: E.stratified_split(d).select("row_id", "is_test")),
        "stratified_folds": _on(pairs, lambda d: E.stratified_folds(d).select("row_id", "fold")),
        "class_weights": _on(pairs, E.class_weights),
        "head_rows": _on(pairs, lambda d: E.head_rows(d, 500).select("row_id", "probability")),
    }


# --- imputation, models, explanations -----------------------------------------------


def gappy_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """The session table with missing values in every kind of column."""
    k = F.floor(F.col("row_id") / 200_000)
    gone = lambda test, c: F.when(~test, F.col(c)).alias(c)
    holes = {"Month": k % 13 == 2, "Browser": k % 17 == 4, "Weekend": k % 19 == 5}
    return sessions(spark, folder).select(
        "row_id",
        *[gone(k % 50 == 3, c) for c in SESSION.numeric],
        *[gone(holes[c], c) if c in holes else F.col(c) for c in SESSION.categorical],
    )


_models: dict[tuple[str, str, str], PipelineModel] = {}


def training_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _keep(
        spark, folder, "training", lambda: L.training_frame(unique_sessions(spark, folder))
    )


def fitted(spark: SparkSession, folder: str, family: str = "linear") -> PipelineModel:
    """A small model of each kind, fitted once per application on the whole table."""
    key = (spark.sparkContext.applicationId, folder, family)
    if key not in _models:
        shared = {"labelCol": L.LABEL, "weightCol": L.WEIGHT}
        kinds = {
            "linear": LogisticRegression(maxIter=15, regParam=1e-3, standardization=False, **shared),
            "trees": GBTClassifier(maxIter=5, maxDepth=4, seed=42, **shared),
            "forest": RandomForestClassifier(numTrees=5, maxDepth=4, seed=42, **shared),
            "boosted": SecondOrderTrees(maxIter=5, maxDepth=4, **shared),
        }
        _models[key] = L.fit_model(kinds[family], training_rows(spark, folder))
    return _models[key]


def _scored_stream(spark: SparkSession, folder: str, history: bool) -> DataFrame:
    """Drain a stream over the session table into a sink and read the sink back."""
    source, sink, log = (work_folder(spark, n) for n in ("stream-in", "stream-out", "stream-log"))
    unique_sessions(spark, folder).select("row_id", *SESSION.features).write.parquet(source)
    stream = K.read_session_stream(spark, source, spark.read.parquet(source).schema)
    scored = K.score_stream(stream, fitted(spark, folder))
    write = K.write_history_stream if history else K.write_scored_stream
    write(scored, sink, log, once=True).awaitTermination()
    if history:
        # Every appended row, not only the latest.
        return spark.read.parquet(sink).select("row_id", "purchase_probability", "prediction")
    return spark.read.parquet(sink).select("row_id", *Sc.SCORE_COLUMNS)


# Every field, every derived feature and one-hot slots of every category.
SLOTS = (
    "Month_Nov", "Month_Feb", "VisitorType_Other", "VisitorType_New_Visitor", "Weekend_True", "Weekend_False",
    "OperatingSystems_1", "Browser_2", "Region_3", "TrafficType_4",
)


def model_queries() -> dict[str, Query]:
    once = unique_sessions

    def with_model(op: Callable[..., DataFrame], family: str = "linear") -> Query:
        return lambda spark, folder: op(once(spark, folder), fitted(spark, folder, family))

    def explained(op: Callable[..., DataFrame], family: str) -> Query:
        return lambda spark, folder: op(
            once(spark, folder), fitted(spark, folder, family), training_rows(spark, folder)
        )

    def curve(d: DataFrame, m: PipelineModel) -> DataFrame:
        return X.sensitivity(d, m, "PageValues", Dp.numeric_ranges(d, columns=["PageValues"]))

    def spans(d: DataFrame, m: PipelineModel) -> DataFrame:
        return X.sensitivity_spans(d, m, "PageValues", Dp.numeric_ranges(d, columns=["PageValues"]))

    def uploaded(spark: SparkSession, folder: str) -> DataFrame:
        return Sc.score_upload(upload("padded")(spark, folder), fitted(spark, folder))[0]

    def leakage(spark: SparkSession, folder: str) -> DataFrame:
        rows = E.stratified_split(training_rows(spark, folder), L.LABEL)
        classifier = LogisticRegression(
            labelCol=L.LABEL, weightCol=L.WEIGHT, maxIter=10, regParam=1e-3, standardization=False
        )
        return L.leakage_experiment(classifier, rows.filter(~F.col("is_test")), rows.filter("is_test"))

    def tuning(spark: SparkSession, folder: str) -> DataFrame:
        rows = training_rows(spark, folder)
        name = "Logistic Regression"
        found = L.tune(name, L.candidates(rows.count())[name], rows, parallelism=4)
        return L.tuning_table([found], spark).select("model", "baseline_pr_auc", "tuned_pr_auc", "improvement")

    def drawn(spark: SparkSession, folder: str) -> DataFrame:
        """Draws without replacement: as many as the grid has points give the whole grid."""
        n = training_rows(spark, folder).count()
        settings = E.sample_params(L.candidates(n)["Logistic Regression"].grid, 30)
        rows = [(round(1.0 / (s["regParam"] * n), 6), s["elasticNetParam"]) for s in settings]
        return spark.createDataFrame(rows, "inverse_strength double, l1_share double")

    def imputed(op, columns) -> Query:
        return _on(gappy_sessions, lambda d: op(d, columns).select("row_id", *columns))

    return {
        "median_impute": imputed(L.median_impute, SESSION.numeric),
        "mode_impute": imputed(L.mode_impute, SESSION.categorical),
        "standard_scale": _on(
            once,
            lambda d: L.standard_scale(d).select(
                "row_id", *[F.round(c, 4).alias(c) for c in SESSION.numeric]
            ),
        ),
        "feature_vector": with_model(
            lambda d, m: L.transform_rows(d, m).select(
                F.col("_row.row_id").alias("row_id"), F.posexplode(vector_to_array("features")).alias("slot", "x")
            ).select("row_id", "slot", F.round("x", 6).alias("value"))
        ),
        "drop_features": _on(
            once, lambda d: d.select("row_id", *SESSION.without("PageValues", "Month", "TotalPages").features)
        ),
        "sample_params": drawn,
        "feature_names": lambda spark, folder: spark.createDataFrame(
            [(i, n) for i, n in enumerate(L.feature_names(fitted(spark, folder)))], "slot int, feature string"
        ),
        "fitted_levels": lambda spark, folder: L.fitted_levels_table(fitted(spark, folder), spark),
        "feature_importance_linear": lambda spark, folder: L.feature_importance(fitted(spark, folder), spark),
        "feature_importance_trees": lambda spark, folder: L.feature_importance(
            fitted(spark, folder, "trees"), spark
        ),
        "score": with_model(lambda d, m: Sc.score(d, m, 0.7)),
        "score_trees": with_model(lambda d, m: Sc.score(d, m, 0.7), "trees"),
        "score_forest": with_model(lambda d, m: Sc.score(d, m, 0.7), "forest"),
        "score_boosted": with_model(lambda d, m: Sc.score(d, m, 0.7), "boosted"),
        "score_upload": uploaded,
        "predict_sessions": with_model(lambda d, m: Sc.predict_sessions(d, m, 0.7)),
        "cross_validated_search": tuning,
        "leakage_experiment": leakage,
        "attribute_linear": explained(X.attribute, "linear"),
        "attribute_trees": explained(X.attribute, "trees"),
        "global_contribution": explained(X.global_contribution, "linear"),
        "contribution_source": _on(
            once,
            lambda d: X.with_contribution_source(
                d.withColumn("feature", F.explode(F.lit([*SESSION.features, *SESSION.engineered, *SLOTS])))
            ).select("row_id", "feature", "shown"),
        ),
        "sensitivity_grid": _on(once, lambda d: X.sensitivity_grid(Dp.numeric_ranges(d))),
        "sensitivity": with_model(curve),
        "sensitivity_span": with_model(spans),
        "sensitivity_span_trees": with_model(spans, "trees"),
        "score_stream": lambda spark, folder: _scored_stream(spark, folder, False),
        "history_stream": lambda spark, folder: _scored_stream(spark, folder, True),
    }


# --- run history ------------------------------------------------------------------------


def runs(spark: SparkSession, folder: str) -> DataFrame:
    return src.runs_from_orders(
        src.read_table(spark, folder, "orders"), src.read_table(spark, folder, "customer")
    )


def run_queries() -> dict[str, Query]:
    return {
        "classify_runs": _on(
            runs, lambda d: J.classify_runs(d).select("run_id", "run_name", "status", "is_model_run", "n_values")
        ),
        "runs_wide": _on(runs, J.runs_wide),
        "runs_comparison": _on(runs, J.runs_comparison),
        "latest_session": _on(runs, J.latest_session),
        "runs_summary": _on(runs, J.runs_summary),
        "record_run": recorded_runs,
    }


def recorded_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A session and a model run per event type, recorded while running and when finished."""
    path = work_folder(spark, "history") + ".parquet"
    start = datetime(2024, 1, 1)
    stats = src.read_table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    for i, r in enumerate(stats.orderBy("event_type").collect()):  # a handful of types
        kind, n = r
        for at, status in ((1, "RUNNING"), (2, "FINISHED")):
            when = start.replace(hour=at)
            append_rows(J.record_run(spark, f"s-{kind}", kind, start, status, recorded_at=when), path)
            metrics = {"test_pr_auc": n * at, "note": "text"}
            append_rows(
                J.record_run(spark, f"m-{kind}", kind, start, status, f"s-{kind}", {"rows": n}, metrics, {"t": at}, when), path
            )
    history = J.classify_runs(readers.read_runs(spark, path))
    wide = J.runs_wide(readers.read_runs(spark, path)).select("run_id", "`metrics.test_pr_auc`", "`params.rows`")
    return history.select("run_id", "status", "is_model_run", "n_values").join(wide, "run_id")


# --- sources and sinks, each as a round trip through files ----------------------------------


def _tall(tables: dict[str, DataFrame]) -> DataFrame:
    """The stored profile's tables as rows (table, row, field, value), numbers in four decimals."""
    keys = {"numeric_ranges": ["column"], "category_levels": ["column", "position"], "segment_presets": ["segment"], "baseline_rate": []}

    def text(df: DataFrame, c: str) -> Column:
        kind = dict(df.dtypes)[c]
        if kind == "double":
            return F.round(c, 4).cast("decimal(30,4)").cast("string")
        return F.col(c).cast("string")

    parts = []
    for name, df in tables.items():
        own = F.concat_ws("/", F.lit(""), *[F.col(k).cast("string") for k in keys[name]])
        cells = F.array(*[
            F.struct(F.lit(c).alias("field"), text(df, c).alias("value")) for c in df.columns if c not in keys[name]
        ])
        parts.append(df.select(F.lit(name).alias("source"), own.alias("row"), F.inline(cells)))
    return reduce(DataFrame.unionByName, parts)


def source_queries() -> dict[str, Query]:
    def sessions_file(spark: SparkSession, folder: str) -> DataFrame:
        path = write_table(sessions(spark, folder), work_folder(spark, "table"), "sessions.csv", "csv")
        return readers.read_sessions(spark, path)

    def upload_file(spark: SparkSession, folder: str) -> DataFrame:
        path = write_scored(upload("broken_numbers")(spark, folder), work_folder(spark, "up") + ".csv")
        got = C.align(readers.read_upload(spark, path), levels=SPELLINGS)
        return got.tracked.select(
            F.col(f"{C.SOURCE}.c17").cast("bigint").alias("row_id"), *SESSION.features
        )

    def json_file(spark: SparkSession, folder: str) -> DataFrame:
        table = Dp.outliers(unique_sessions(spark, folder))
        path = write_json(table, work_folder(spark, "doc"), "outliers")
        row = F.from_json("value", table.schema).alias("r")
        return spark.read.text(path).select(row).select("r.*")

    def stored_profile(spark: SparkSession, folder: str) -> DataFrame:
        place = work_folder(spark, "profile")
        write_input_profile(sessions(spark, folder), place)
        return _tall(readers.read_profile(spark, place))

    def stored_runs(spark: SparkSession, folder: str) -> DataFrame:
        path = append_rows(runs(spark, folder), work_folder(spark, "runs") + ".parquet")
        return J.classify_runs(readers.read_runs(spark, path)).select(
            "run_id", "run_name", "status", "is_model_run", "n_values"
        )

    def wide_export(spark: SparkSession, folder: str) -> DataFrame:
        wide = J.runs_wide(runs(spark, folder)).drop("run_id")
        path = write_table(wide, work_folder(spark, "wide"), "runs.csv", "csv")
        return J.runs_wide(readers.read_wide_runs(spark, path)).drop("run_id")

    def scored_file(spark: SparkSession, folder: str) -> DataFrame:
        path = write_scored(upload("padded")(spark, folder), work_folder(spark, "up") + ".csv")
        out = work_folder(spark, "scored")
        score_file(spark, path, out, fitted(spark, folder))
        return spark.read.option("header", True).csv(out)

    def saved_model(spark: SparkSession, folder: str) -> DataFrame:
        path = save_model(fitted(spark, folder), work_folder(spark, "model"))
        scored = Sc.score(unique_sessions(spark, folder), load_model(spark, path), 0.7)
        return scored.select("row_id", *Sc.SCORE_COLUMNS)

    def card(spark: SparkSession, folder: str) -> DataFrame:
        scored = pairs(spark, folder)
        t = G.optimal_threshold(G.threshold_sweep(scored)).first()["threshold"]
        path = work_folder(spark, "cards")
        model_card(
            spark,
            model_name="by_value",
            operating_threshold=t,
            metrics=G.metric_suite(scored, t).first().asDict(),
            confusion=G.confusion(scored, t).first().asDict(),
            calibration=calibration_block(G.calibration_summary(scored), G.calibration_curve(scored)),
        ).write.parquet(path)
        return read_cards(spark, path)

    def cells(spark: SparkSession, folder: str) -> DataFrame:
        return card(spark, folder).select("model_name", "operating_threshold", F.explode("confusion").alias("cell", "n"))

    def bins(spark: SparkSession, folder: str) -> DataFrame:
        return card(spark, folder).select(F.inline("calibration.bins"))

    return {
        "read_sessions": sessions_file,
        "read_upload": upload_file,
        "read_runs": stored_runs,
        "read_wide_runs": wide_export,
        "read_profile": stored_profile,
        "write_json": json_file,
        "score_file": scored_file,
        "save_load_model": saved_model,
        "model_card": cells,
        "model_card_calibration": bins,
    }


def all_queries() -> dict[str, Query]:
    return {
        **evaluation_queries(),
        **session_queries(),
        **run_queries(),
        **source_queries(),
        **model_queries(),
    }
