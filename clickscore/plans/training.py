"""From a raw session table to a selected, evaluated and described model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.contract import DEFAULT_THRESHOLD, FOLDS, SEARCH_DRAWS, SEED, SESSION, Contract
from clickscore.operators import cleaning, evaluation, explaining, learning, splitting
from clickscore.sources.models import calibration_block, model_card


@dataclass
class Trained:
    name: str
    model: PipelineModel
    threshold: float
    value_threshold: float
    tables: dict[str, DataFrame] = field(repr=False, default_factory=dict)
    card: DataFrame | None = field(repr=False, default=None)


def _as_map(df: DataFrame, key: str) -> dict[str, dict[str, float]]:
    """A report table of a few rows as nested numbers."""
    return {r[key]: {k: v for k, v in r.asDict().items() if k != key and v is not None} for r in df.collect()}


def train(
    df: DataFrame,
    contract: Contract = SESSION,
    row_id: str = "row_id",
    families: dict[str, learning.Candidate] | None = None,
    draws: int = SEARCH_DRAWS,
    seed: int = SEED,
    parallelism: int = 2,
    folds: int = FOLDS,
) -> Trained:
    """De-duplicate, split, tune every family, select on the held-out rows, choose thresholds.

    Model and thresholds are selected on the same held-out rows that are reported.
    """
    spark = df.sparkSession
    n_raw = df.count()
    rows = cleaning.dedupe(df, contract, row_id).persist()  # the split reads it several times
    split = splitting.stratified_split(rows, contract.target, row_id, seed=seed).persist()
    sizes = split.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("test"),
        F.round(F.lit(100.0) * F.avg(F.col(contract.target).cast("int")), 3).alias("rate"),
    ).first()
    n_train = sizes["n"] - sizes["test"]
    fit_rows = learning.training_frame(split.filter(~F.col("is_test")), contract, row_id, folds).persist()
    held = split.filter("is_test").withColumn("label", F.col(contract.target).cast("int")).persist()

    families = families or learning.candidates(n_train, seed)
    vectors = learning.fold_vectors(fit_rows, contract, parallelism)
    tuned = {
        name: learning.tune(name, c, fit_rows, contract, draws, seed, parallelism, vectors)
        for name, c in families.items()
    }
    vectors.release()
    scored = evaluation.stack_models(
        {
            name: learning.probability_of(held, t.model).select(row_id, "label", "probability")
            for name, t in tuned.items()
        }
    ).persist()
    comparison = evaluation.compare_models(scored)
    name = evaluation.select_model(comparison).first()["model"]
    best = tuned[name]
    chosen = learning.probability_of(held, best.model).persist()

    sweep = evaluation.threshold_sweep(chosen).persist()
    t_f1 = evaluation.optimal_threshold(sweep, "f1").first()["threshold"]
    t_value = evaluation.optimal_threshold(sweep, "expected_value").first()["threshold"]
    leakage = learning.leakage_experiment(families[name].estimator, fit_rows, held, contract)
    importance = learning.feature_importance(best.model, spark)
    tables = {
        "model_tuning_comparison": learning.tuning_table(list(tuned.values()), spark),
        "model_test_comparison": comparison,
        "threshold_sweep": sweep,
        "classification_report": evaluation.classification_report(chosen, t_f1),
        "calibration_curve": evaluation.calibration_curve(chosen),
        "calibration_summary": evaluation.calibration_summary(chosen),
        "error_false_positives": evaluation.top_errors(chosen, "false_positive", t_f1, tie=row_id),
        "error_false_negatives": evaluation.top_errors(chosen, "false_negative", t_f1, tie=row_id),
        "error_outcome_profile": evaluation.outcome_profile(chosen, contract.numeric, t_f1),
        "feature_importance": importance,
        "global_contribution": explaining.global_contribution(
            held, best.model, fit_rows, row_id=row_id, contract=contract
        ),
        "leakage_experiment": leakage,
    }
    cells = evaluation.confusion(chosen, t_f1).first().asDict()
    value = evaluation.campaign_value(chosen, t_f1).first()["expected_value"]
    card = model_card(
        spark,
        model_name=name,
        rationale=best.rationale,
        params=best.best_params,
        dataset={
            "raw_rows": n_raw, "duplicates_removed": n_raw - sizes["n"], "rows_used": sizes["n"],
            "train_rows": n_train, "test_rows": sizes["test"], "positive_rate_pct": sizes["rate"],
        },
        operating_threshold=t_f1,
        alternative_threshold=t_value,
        metrics=evaluation.metric_suite(chosen, t_f1).first().asDict(),
        metrics_at_default=evaluation.metric_suite(chosen, DEFAULT_THRESHOLD).first().asDict(),
        confusion=cells,
        expected_value=value,
        calibration=calibration_block(tables["calibration_summary"], tables["calibration_curve"]),
        comparison=_as_map(comparison, "model"),
        leakage=_as_map(leakage, "model"),
        top_features=[tuple(r) for r in importance.limit(15).collect()],
    )
    for used in (rows, split, fit_rows):
        used.unpersist()
    return Trained(name, best.model, t_f1, t_value, tables, card)
