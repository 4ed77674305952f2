"""Row-wise decision rules on a probability, all native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickscore.contract import (
    INCENTIVE_COST, NEGATIVE_LABEL, ORDER_VALUE, POSITIVE_LABEL, UPLIFT,
)
from clickscore.functions.numbers import clean_number

# Band cut-offs and texts of the recommended actions.
BANDS = ((0.80, "Very high"), (0.60, "High"), (0.40, "Moderate"), (0.20, "Low"))
LOWEST_BAND = "Very low"
SURE_MARGIN = 0.25
NEAR_MARGIN = 0.15
LOW_INTENT_FLOOR = 0.05
ACTIONS = {
    "sure": "High intent - let the session run; avoid discounting a sale you already have.",
    "likely": "Likely to convert - light-touch nudge such as free-shipping messaging.",
    "margin": "On the margin - highest-value intervention target; fire the incentive.",
    "low": "Low intent - retarget later rather than spending on this live session.",
    "none": "Very low intent - no intervention; the spend will not be recovered.",
}
VERDICTS = ("Likely to purchase", "On the margin", "Unlikely to purchase")


def _col(x: Column | float) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def scored(p: Column) -> Column:
    """The probability, NULL where a row has none (NULL or NaN): such rows get no decision."""
    return clean_number(p)


def flagged(p: Column, threshold: Column | float) -> Column:
    return scored(p) >= _col(threshold)


def class_label(positive: Column) -> Column:
    yes = positive.cast("int")
    return F.when(yes == 1, POSITIVE_LABEL).when(yes.isNotNull(), NEGATIVE_LABEL)


def confidence_band(p: Column) -> Column:
    p = scored(p)
    chain = F
    for floor, name in BANDS:
        chain = chain.when(p >= F.lit(floor), name)
    return chain.when(p.isNotNull(), LOWEST_BAND)


def recommendation(p: Column, threshold: Column | float) -> Column:
    p, t = scored(p), _col(threshold)
    return (
        F.when(p >= t + F.lit(SURE_MARGIN), ACTIONS["sure"])
        .when(p >= t, ACTIONS["likely"])
        .when(p >= t - F.lit(NEAR_MARGIN), ACTIONS["margin"])
        .when(p >= F.lit(LOW_INTENT_FLOOR), ACTIONS["low"])
        .when(p.isNotNull(), ACTIONS["none"])
    )


def verdict(p: Column, threshold: Column | float) -> Column:
    p, t = scored(p), _col(threshold)
    return (
        F.when(p >= t, VERDICTS[0])
        .when(F.abs(p - t) <= F.lit(NEAR_MARGIN), VERDICTS[1])
        .when(p.isNotNull(), VERDICTS[2])
    )


def lift(p: Column, baseline_pct: Column) -> Column:
    return F.coalesce(F.try_divide(F.lit(100.0) * p, baseline_pct), F.lit(0.0))


def lift_points(p: Column, baseline_pct: Column) -> Column:
    return F.lit(100.0) * p - baseline_pct


def outcome(label: Column, predicted: Column) -> Column:
    """Kind of hit or error; NULL where the label or the prediction is missing."""
    hit = label.cast("int") == predicted.cast("int")
    said_yes = predicted.cast("int") == 1
    return (
        F.when(hit & said_yes, "true_positive")
        .when(hit, "true_negative")
        .when(~hit & said_yes, "false_positive")
        .when(~hit, "false_negative")
    )


def campaign_value(
    tp: Column,
    fp: Column,
    uplift: float = UPLIFT,
    order_value: float = ORDER_VALUE,
    cost: float = INCENTIVE_COST,
) -> Column:
    """Net value of contacting every flagged row."""
    gain = uplift * order_value - cost
    return tp.cast("double") * F.lit(gain) - fp.cast("double") * F.lit(cost)
