"""From scored rows to decisions, summaries and review lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.contract import DEFAULT_THRESHOLD
from clickscore.functions import decisions as D
from clickscore.operators.evaluation import optimal_threshold

# Names of the two decision policies.
BALANCED = "Balanced (max F1)"
PROFIT_FIRST = "Profit-first (max campaign value)"
HISTORY_ROWS = 200
REVIEW_ROWS = 25


def with_decisions(df: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Class, label, band, action and verdict next to every probability."""
    p = F.col("probability")
    yes = D.flagged(p, threshold)
    return df.withColumns(
        {
            "predicted_class": yes.cast("int"),
            "prediction": D.class_label(yes),
            "threshold": F.lit(float(threshold)),
            "confidence_band": D.confidence_band(p),
            "recommendation": D.recommendation(p, threshold),
            "verdict": D.verdict(p, threshold),
        }
    )


def with_lift(df: DataFrame, baseline_pct: float | None = None) -> DataFrame:
    """Lift over the site's conversion rate; measured from ``label`` if not given."""
    if baseline_pct is None:
        base = df.agg(F.round(F.lit(100.0) * F.avg("label"), 2)).scalar()
    else:
        base = F.lit(float(baseline_pct))
    p = F.col("probability")
    return df.withColumn("baseline_pct", base).select(
        "*",
        F.round(D.lift(p, F.col("baseline_pct")), 4).alias("lift"),
        F.round(D.lift_points(p, F.col("baseline_pct")), 4).alias("lift_points"),
    )


def threshold_policies(sweep: DataFrame) -> DataFrame:
    """Best threshold by F1 and, when it differs, by campaign value."""
    best = F.array(
        F.struct(F.lit(BALANCED).alias("policy"), F.col("f1_at").alias("threshold")),
        F.struct(F.lit(PROFIT_FIRST).alias("policy"), F.col("value_at").alias("threshold")),
    )
    f1_at = optimal_threshold(sweep, "f1").select("threshold").scalar()
    return (
        optimal_threshold(sweep, "expected_value")
        .select(F.col("threshold").alias("value_at"), f1_at.alias("f1_at"))
        .select("f1_at", F.inline(best))
        .filter((F.col("policy") == BALANCED) | (F.col("threshold") != F.col("f1_at")))
        .select("policy", "threshold")
    )


def policy_labels(df: DataFrame, policies: DataFrame) -> DataFrame:
    """Label every row under each policy; the two policies ride along as one value."""
    rules = policies.agg(
        F.sort_array(F.collect_list(F.struct("policy", "threshold")))
    ).scalar()  # two rows
    return (
        df.withColumn("_rules", rules)
        .select(*df.columns, F.inline("_rules"))
        .withColumn(
            "prediction", D.class_label(D.flagged(F.col("probability"), F.col("threshold")))
        )
    )


def batch_summary(df: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Rows, flags (by the unrounded probability), flag rate and mean probability.

    Rows without a probability are counted apart and enter neither rate nor mean.
    """
    p = D.scored(F.col("probability"))
    yes = F.count_if(D.flagged(p, threshold))
    n = F.count(p)
    return df.agg(
        F.count(F.lit(1)).alias("n_sessions"),
        F.count_if(p.isNull()).alias("n_unscored"),
        yes.alias("n_flagged"),
        F.round(F.lit(100.0) * yes / F.greatest(n, F.lit(1)), 1).alias("flag_rate_pct"),
        F.round(F.avg(p), 3).alias("mean_probability"),
    )


def top_sessions(df: DataFrame, n: int = REVIEW_ROWS, tie: str = "row_id") -> DataFrame:
    """The n highest probabilities; rows without one are not listed."""
    return df.filter(D.scored(F.col("probability")).isNotNull()).orderBy(F.desc("probability"), F.asc(tie)).limit(n)


def prediction_history(df: DataFrame, n: int = HISTORY_ROWS, tie: str = "row_id") -> DataFrame:
    """The latest n scored rows, newest first."""
    return df.orderBy(F.desc("scored_at"), F.desc(tie)).limit(n)
