"""Evaluation of scored rows.

Input is any frame with a 0/1 ``label`` and a ``probability``; ``by`` adds grouping
columns such as a model name, so several models are evaluated in one job.  A row is
flagged when ``probability >= threshold``.  Rows with a NULL score or label are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscore.contract import (
    DEFAULT_THRESHOLD, INCENTIVE_COST, NEGATIVE_LABEL, ORDER_VALUE, POSITIVE_LABEL, UPLIFT,
)
from clickscore.functions import decisions as D
from clickscore.functions.numbers import double_array, edges_below, ratio, steps_reached
from clickscore.operators.accumulate import running_totals, slice_cuts

# The sweep of 91 thresholds, as clean decimals.
SWEEP_GRID = tuple((5 + i) / 100 for i in range(91))
POINT_METRICS = ("accuracy", "balanced_accuracy", "precision", "recall", "f1", "mcc")
SUITE = (
    "accuracy", "balanced_accuracy", "precision", "recall", "f1",
    "roc_auc", "pr_auc", "mcc", "brier", "threshold",
)
CELLS = ("true_negative", "false_positive", "false_negative", "true_positive")


def _pairs(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.select(
        *by, F.col("probability").cast("double"), F.col("label").cast("int").alias("label")
    ).dropna(subset=["probability", "label"])


def score_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and positives per distinct score; ties collapse before the shuffle."""
    return (
        _pairs(df, by)
        .groupBy(*by, "probability")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("pos"))
    )


def _ranked(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct scores, best first, with running row and positive counts."""
    cuts = slice_cuts(_pairs(df, by), "probability")
    return running_totals(score_counts(df, by), "probability", ["n", "pos"], by=by, cuts=cuts)


def confusion_cells(predicted: Column, label: Column, weight: Column | None = None) -> list[Column]:
    """The four cells as aggregates; ``weight`` counts pre-aggregated rows."""
    actual = label == 1
    tests = (~predicted & ~actual, predicted & ~actual, ~predicted & actual, predicted & actual)
    if weight is None:
        return [F.count_if(t).alias(c) for t, c in zip(tests, CELLS)]
    return [
        F.coalesce(F.sum(F.when(t, weight)), F.lit(0)).cast("bigint").alias(c)
        for t, c in zip(tests, CELLS)
    ]


def confusion(df: DataFrame, threshold: float = DEFAULT_THRESHOLD, by: Sequence[str] = ()) -> DataFrame:
    hit = F.col("probability") >= F.lit(float(threshold))
    return _pairs(df, by).groupBy(*by).agg(*confusion_cells(hit, F.col("label")))


def confusion_normalised(df: DataFrame, threshold: float = DEFAULT_THRESHOLD, by: Sequence[str] = ()) -> DataFrame:
    """One row per true class: the share predicted as each class."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)

    def row(name: str, no: Column, yes: Column) -> Column:
        total = no + yes
        return F.struct(
            F.lit(name).alias("actual"),
            F.round(F.try_divide(no.cast("double"), total), 4).alias("predicted_no"),
            F.round(F.try_divide(yes.cast("double"), total), 4).alias("predicted_yes"),
            total.alias("support"),
        )

    rows = F.array(row(NEGATIVE_LABEL, tn, fp), row(POSITIVE_LABEL, fn, tp))
    return confusion(df, threshold, by).select(*by, F.inline(rows))


def point_metric_columns() -> dict[str, Column]:
    """Metrics of one operating point, from the four cells."""
    tn, fp, fn, tp = (f"CAST({c} AS DOUBLE)" for c in CELLS)
    # A class without rows does not take part in the mean of the two recalls.
    recalls = f"array_compact(array(try_divide({tp}, {tp} + {fn}), try_divide({tn}, {tn} + {fp})))"
    spread = f"sqrt(({tp} + {fp}) * ({tp} + {fn}) * ({tn} + {fp}) * ({tn} + {fn}))"
    sql = {
        "accuracy": f"try_divide({tp} + {tn}, {tp} + {tn} + {fp} + {fn})",
        "balanced_accuracy": f"try_divide(aggregate({recalls}, 0D, (a, x) -> a + x), size({recalls}))",
        "precision": f"try_divide({tp}, {tp} + {fp})",
        "recall": f"try_divide({tp}, {tp} + {fn})",
        "f1": f"try_divide(2D * {tp}, 2D * {tp} + {fp} + {fn})",
        "mcc": f"try_divide({tp} * {tn} - {fp} * {fn}, {spread})",
    }
    return {m: F.expr(f"coalesce({v}, 0D)") for m, v in sql.items()}


def point_metrics(df: DataFrame, threshold: float = DEFAULT_THRESHOLD, by: Sequence[str] = ()) -> DataFrame:
    values = point_metric_columns()
    return confusion(df, threshold, by).select(
        *by, *[F.round(values[m], 4).alias(m) for m in POINT_METRICS]
    )


def _ranking_columns() -> dict[str, Column]:
    """Aggregates over the ranked distinct scores."""
    n, pos, cum_n, cum_pos = (f"CAST({c} AS DOUBLE)" for c in ("n", "pos", "cum_n", "cum_pos"))
    neg, p = f"({n} - {pos})", "probability"
    before_n, before_pos = f"({cum_n} - {n})", f"({cum_pos} - {pos})"
    before = f"CASE WHEN {before_n} > 0 THEN try_divide({before_pos}, {before_n}) ELSE 1D END"
    sql = {
        "roc_auc": f"try_divide(sum({neg} * ({before_pos} + {pos} / 2D)), sum({pos}) * sum({neg}))",
        "pr_auc": f"coalesce(try_divide(sum({pos} * {cum_pos} / {cum_n}), sum({pos})), 0D)",
        "pr_area_trapezoid":
            f"coalesce(try_divide(sum({pos} * ({cum_pos} / {cum_n} + {before}) / 2D), sum({pos})), 0D)",
        "brier":
            f"try_divide(sum({pos} * ({p} - 1) * ({p} - 1) + {neg} * {p} * {p}), sum({n}))",
    }
    return {m: F.expr(v) for m, v in sql.items()}


def ranking_metric(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """One of roc_auc, pr_auc (step-wise average precision) or pr_area_trapezoid."""
    value = F.round(_ranking_columns()[name], 6).alias(name)
    return _ranked(df, by).groupBy(*by).agg(value)


def ranking_value(df: DataFrame, name: str) -> float:
    """The unrounded metric as a number, 0 for an empty frame."""
    return float(_ranked(df, ()).agg(_ranking_columns()[name].alias("v")).first()["v"] or 0.0)


def ranking_values(df: DataFrame, name: str, by: str) -> dict:
    """The unrounded metric of every group; the groups are few, such as models."""
    value = F.coalesce(_ranking_columns()[name], F.lit(0.0)).alias("v")
    return {r[by]: float(r["v"]) for r in _ranked(df, [by]).groupBy(by).agg(value).collect()}


def roc_auc(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return ranking_metric(df, "roc_auc", by)


def average_precision(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return ranking_metric(df, "pr_auc", by)


def pr_area_trapezoid(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return ranking_metric(df, "pr_area_trapezoid", by)


def brier(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    gap = F.col("probability") - F.col("label")
    return _pairs(df, by).groupBy(*by).agg(F.round(F.avg(gap * gap), 6).alias("brier"))


def metric_suite(df: DataFrame, threshold: float = DEFAULT_THRESHOLD, by: Sequence[str] = ()) -> DataFrame:
    """Every metric from one frame of distinct scores, 4 decimals."""
    t = F.lit(float(threshold))
    rank = _ranking_columns()
    yes = F.col("probability") >= t
    neg = F.col("n") - F.col("pos")

    def total(test: Column, what: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(test, what)), F.lit(0)).alias(name)

    got = _ranked(df, by).groupBy(*by).agg(
        total(~yes, neg, "true_negative"),
        total(yes, neg, "false_positive"),
        total(~yes, F.col("pos"), "false_negative"),
        total(yes, F.col("pos"), "true_positive"),
        *[rank[m].alias(m) for m in ("roc_auc", "pr_auc", "brier")],
    )
    values = {
        **point_metric_columns(),
        **{m: F.col(m) for m in ("roc_auc", "pr_auc", "brier")},
        "threshold": t,
    }
    return got.select(*by, *[F.round(values[m], 4).alias(m) for m in SUITE])


def campaign_value(df: DataFrame, threshold: float = DEFAULT_THRESHOLD, by: Sequence[str] = (), **cost: float) -> DataFrame:
    value = D.campaign_value(F.col("true_positive"), F.col("false_positive"), **cost)
    return confusion(df, threshold, by).select(
        *by, "true_positive", "false_positive", F.round(value, 2).alias("expected_value")
    )


def threshold_sweep(
    df: DataFrame,
    grid: Sequence[float] = SWEEP_GRID,
    by: Sequence[str] = (),
    uplift: float = UPLIFT,
    order_value: float = ORDER_VALUE,
    cost: float = INCENTIVE_COST,
) -> DataFrame:
    """Metrics and campaign value at every threshold, from a single pass.

    Rows are first counted by how many thresholds they reach (at most len(grid) + 1
    buckets); only those buckets meet the grid.
    """
    grid = [float(g) for g in grid]
    bucket = steps_reached(F.col("probability"), grid)
    buckets = (
        _pairs(df, by)
        .groupBy(*by, bucket.alias("reached"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("pos"))
    )
    rungs = F.posexplode(double_array([round(g, 4) for g in grid])).alias("rung", "threshold")
    neg = F.col("n") - F.col("pos")
    yes = F.col("reached") > F.col("rung")

    def total(test: Column, what: Column, name: str) -> Column:
        return F.sum(F.when(test, what).otherwise(F.lit(0))).alias(name)

    cells = (
        buckets.select("*", rungs)
        .groupBy(*by, "threshold")
        .agg(
            total(~yes, neg, "true_negative"),
            total(yes, neg, "false_positive"),
            total(~yes, F.col("pos"), "false_negative"),
            total(yes, F.col("pos"), "true_positive"),
        )
    )
    m = point_metric_columns()
    tp, fp = F.col("true_positive"), F.col("false_positive")
    return cells.select(
        *by,
        "threshold",
        *[F.round(m[c], 4).alias(c) for c in ("precision", "recall", "f1")],
        (tp + fp).alias("n_flagged"),
        *CELLS,
        F.round(D.campaign_value(tp, fp, uplift, order_value, cost), 2).alias("expected_value"),
    )


def optimal_threshold(sweep: DataFrame, objective: str = "f1", by: Sequence[str] = ()) -> DataFrame:
    """The threshold with the best objective, the lowest one on ties."""
    if objective not in sweep.columns:
        raise KeyError(f"no column '{objective}' in the sweep; it has {sweep.columns}")
    best = F.struct(F.col(objective).cast("double"), -F.col("threshold"))
    return sweep.groupBy(*by).agg(
        F.max_by("threshold", best).alias("threshold"),
        F.max(F.col(objective).cast("double")).alias("best"),
    )


def calibration_curve(df: DataFrame, n_bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean prediction and observed rate per equal-width bin (lo, hi]; the first holds 0."""
    edges = [i * (1.0 / n_bins) for i in range(n_bins)] + [1.0]
    bin_no = edges_below(F.col("probability"), edges[1:-1])
    bounds = double_array([round(e, 4) for e in edges])
    return (
        _pairs(df, by)
        .groupBy(*by, bin_no.alias("bin"))
        .agg(
            F.round(F.avg("probability"), 4).alias("mean_predicted"),
            F.round(F.avg("label"), 4).alias("observed_rate"),
            F.count(F.lit(1)).alias("count"),
        )
        .select(
            *by,
            F.get(bounds, F.col("bin")).alias("bin_lower"),
            F.get(bounds, F.col("bin") + 1).alias("bin_upper"),
            "mean_predicted", "observed_rate", "count",
        )
    )


def calibration_summary(df: DataFrame, n_bins: int = 10) -> DataFrame:
    """Count-weighted gap between prediction and outcome, with the Brier score."""
    curve = calibration_curve(df, n_bins)
    gap = (F.col("mean_predicted") - F.col("observed_rate")) * F.col("count")
    mean_gap = F.try_divide(F.sum(gap), F.sum("count").cast("double"))
    score = brier(df).select(F.round("brier", 4)).scalar()
    return curve.agg(
        F.count(F.lit(1)).alias("n_bins_used"),
        F.sum("count").alias("n_sessions"),
        mean_gap.alias("gap"),
    ).select(
        "n_bins_used",
        "n_sessions",
        score.alias("brier_score"),
        F.round("gap", 4).alias("mean_gap"),
        F.when(F.col("gap") > 0, "overconfident").otherwise("underconfident").alias("direction"),
    )


def with_outcome(df: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    yes = D.flagged(F.col("probability"), threshold)
    return df.withColumns(
        {"predicted": yes.cast("int"), "outcome": D.outcome(F.col("label"), yes)}
    )


def top_errors(df: DataFrame, kind: str, threshold: float = DEFAULT_THRESHOLD, n: int = 10, tie: str = "row_id") -> DataFrame:
    """The n most confident mistakes: kind is false_positive or false_negative."""
    if kind not in ("false_positive", "false_negative"):
        raise ValueError(f"kind must be false_positive or false_negative, not '{kind}'")
    p = F.col("probability")
    wrong = with_outcome(df, threshold).filter(F.col("outcome") == kind)
    order = F.desc("probability") if kind == "false_positive" else p.asc()
    return wrong.orderBy(order, F.asc(tie)).limit(n)


def outcome_profile(df: DataFrame, columns: Sequence[str], threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    return (
        with_outcome(df, threshold)
        .groupBy("outcome")
        .agg(*[F.round(F.avg(c), 3).alias(c) for c in (*columns, "probability")])
    )


def classification_report(df: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Per-class precision, recall, F1 and support, accuracy and the two averages."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in CELLS)

    def side(hit: Column, false_alarm: Column, miss: Column) -> dict[str, Column]:
        return {
            "precision": ratio(hit, hit + false_alarm),
            "recall": ratio(hit, hit + miss),
            "f1": ratio(F.lit(2.0) * hit, F.lit(2.0) * hit + false_alarm + miss),
            "support": hit + miss,
        }

    no, yes = side(tn, fn, fp), side(tp, fp, fn)
    total = tn + fp + fn + tp
    stats = ("precision", "recall", "f1")
    nothing = F.lit(None).cast("double")
    lines = [
        (NEGATIVE_LABEL, no),
        (POSITIVE_LABEL, yes),
        ("accuracy", {"precision": nothing, "recall": nothing, "f1": ratio(tp + tn, total)}),
        ("macro avg", {s: (no[s] + yes[s]) / F.lit(2.0) for s in stats}),
        (
            "weighted avg",
            {s: ratio(no[s] * no["support"] + yes[s] * yes["support"], total) for s in stats},
        ),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"),
                *[F.round(v[s], 4).alias(s) for s in stats],
                v.get("support", total).cast("bigint").alias("support"),
            )
            for name, v in lines
        ]
    )
    return confusion(df, threshold).select(F.inline(rows))


def roc_points(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(fpr, tpr, threshold) at every distinct score, all points kept."""
    return _curve(
        df,
        by,
        {
            "fpr": F.try_divide((F.col("cum_n") - F.col("cum_pos")).cast("double"), F.col("negatives")),
            "tpr": F.try_divide(F.col("cum_pos").cast("double"), F.col("positives")),
        },
    )


def pr_points(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(recall, precision, threshold) at every distinct score."""
    return _curve(
        df,
        by,
        {
            "recall": F.try_divide(F.col("cum_pos").cast("double"), F.col("positives")),
            "precision": F.try_divide(F.col("cum_pos").cast("double"), F.col("cum_n")),
        },
    )


def _curve(df: DataFrame, by: Sequence[str], values: dict[str, Column]) -> DataFrame:
    # From the same counts that are ranked: their exchange is reused, the rows are read once.
    totals = score_counts(df, by).groupBy(*by).agg(
        F.sum("pos").alias("positives"), (F.sum("n") - F.sum("pos")).alias("negatives")
    )
    ranked = _ranked(df, by)
    if by:  # one row per model
        ranked = ranked.join(totals, list(by))
    else:
        ranked = ranked.withColumns(
            {c: totals.select(c).scalar() for c in ("positives", "negatives")}
        )
    return ranked.select(
        *by,
        *[F.round(v, 6).alias(c) for c, v in values.items()],
        F.col("probability").alias("threshold"),
    )


def prevalence(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _pairs(df, by).groupBy(*by).agg(F.round(F.avg("label"), 6).alias("prevalence"))


def metric_drift(
    baseline: DataFrame,
    candidate: DataFrame,
    tolerance: float = 0.01,
    metrics: Sequence[str] = ("pr_auc", "roc_auc", "f1", "recall", "precision"),
) -> DataFrame:
    """Compare two one-row metric suites; one row per metric with a pass flag."""

    def tall(df: DataFrame, name: str) -> DataFrame:
        cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias(name)) for m in metrics]
        return df.select(F.inline(F.array(*cells)))

    delta = F.col("candidate") - F.col("baseline")
    return (
        tall(baseline, "baseline")
        .join(tall(candidate, "candidate"), "metric")
        .select(
            "metric",
            "baseline",
            "candidate",
            F.round(delta, 4).alias("delta"),
            (F.round(F.abs(delta), 9) <= F.lit(float(tolerance))).alias("within_tolerance"),
        )
    )


def compare_models(df: DataFrame, threshold: float = DEFAULT_THRESHOLD, by: str = "model") -> DataFrame:
    """One metrics row per model, all models in one job."""
    return metric_suite(df, threshold, by=[by])


def select_model(comparison: DataFrame, metric: str = "pr_auc", by: str = "model") -> DataFrame:
    """The model with the highest metric, the first by name on ties."""
    return comparison.orderBy(F.desc(metric), F.asc(by)).limit(1).select(by, metric)


def stack_models(scored: dict[str, DataFrame]) -> DataFrame:
    """Bring the scored frames of several models into the long form used by ``by``."""
    parts = [df.withColumn("model", F.lit(name)) for name, df in scored.items()]
    return reduce(DataFrame.unionByName, parts)
