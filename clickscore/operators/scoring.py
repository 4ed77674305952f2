"""Apply a fitted pipeline to sessions, one row or billions on the same plan."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscore.contract import DEFAULT_THRESHOLD, SESSION, Contract
from clickscore.functions import decisions as D
from clickscore.operators.alignment import align, require_columns, restore_source
from clickscore.operators.deciding import with_decisions
from clickscore.operators.learning import fitted_levels, probability_of

SCORE_COLUMNS = ("purchase_probability", "prediction", "recommendation")
PROBABILITY = "unrounded_probability"


def score_columns(p: Column, threshold: float) -> dict[str, Column]:
    """Shown probability, label and action; both follow the unrounded probability."""
    return {
        "purchase_probability": F.round(p, 4),
        "prediction": D.class_label(D.flagged(p, threshold)),
        "recommendation": D.recommendation(p, threshold),
    }


def score(
    df: DataFrame,
    model: PipelineModel,
    threshold: float = DEFAULT_THRESHOLD,
    contract: Contract = SESSION,
) -> DataFrame:
    """Append probability (4 decimals), label and action.

    Label and action follow the unrounded probability.  A single stage: no shuffle.
    """
    require_columns(df, contract)
    scored = probability_of(df, model, PROBABILITY)
    return scored.withColumns(score_columns(F.col(PROBABILITY), threshold)).drop(PROBABILITY)


def predict_sessions(
    df: DataFrame,
    model: PipelineModel,
    threshold: float = DEFAULT_THRESHOLD,
    contract: Contract = SESSION,
) -> DataFrame:
    """The full answer per session: class, label, band, action and verdict."""
    require_columns(df, contract)
    return with_decisions(probability_of(df, model), threshold)


def score_upload(
    df: DataFrame,
    model: PipelineModel,
    threshold: float = DEFAULT_THRESHOLD,
    contract: Contract = SESSION,
    allow_positional: bool = False,
):
    """Align an upload, score it, and give back the caller's own columns plus three.

    Returns (scored frame, alignment).  Matching by position is opt-in.
    """
    got = align(df, contract, allow_positional, fitted_levels(model))
    scored = score(got.tracked, model, threshold, contract)
    return restore_source(scored, got.source_names, *SCORE_COLUMNS), got
