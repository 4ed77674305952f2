"""Duplicates, projections, derived features and behavioural segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.contract import SESSION, Contract
from clickscore.functions.features import FEATURE_SQL, feature_exprs
from clickscore.functions.numbers import literal_sql, number_sql
from clickscore.operators.quantiles import exact_percentiles

# Names and limits of the four behavioural segments.
BUYER, RESEARCHER = "High-intent buyer", "Engaged researcher"
BOUNCER, WINDOW_SHOPPER = "Quick bouncer", "Returning window shopper"
SEGMENTS = (BUYER, RESEARCHER, BOUNCER, WINDOW_SHOPPER)
BOUNCE_FLOOR = 0.15
BROWSED_PAGES = (5, 30)


def dedupe(df: DataFrame, contract: Contract = SESSION, row_id: str | None = None) -> DataFrame:
    """One row per distinct set of contract columns; repeats combine before the shuffle.

    With ``row_id`` the smallest id of each group is kept, so the result is stable.
    """
    if row_id is None:
        return df.select(*contract.columns).distinct()
    return df.groupBy(*contract.columns).agg(F.min(row_id).alias(row_id))


def duplicate_stats(df: DataFrame, contract: Contract = SESSION) -> DataFrame:
    groups = df.groupBy(*contract.columns).agg(F.count(F.lit(1)).alias("n"))
    rows, distinct = F.sum("n"), F.count(F.lit(1))
    return groups.agg(
        rows.alias("n_rows"),
        (rows - distinct).alias("n_duplicates"),
        F.round(F.try_divide(F.lit(100.0) * (rows - distinct), rows), 3).alias("duplicate_pct"),
    )


def features_target(df: DataFrame, contract: Contract = SESSION) -> DataFrame:
    return df.select(*contract.features, F.col(contract.target).cast("int").alias(contract.target))


def add_session_features(df: DataFrame) -> DataFrame:
    """Five derived columns; a session without pages gives 0, not an error."""
    return df.drop(*FEATURE_SQL).selectExpr(*feature_exprs())


def drop_features(contract: Contract, *names: str) -> Contract:
    return contract.without(*names)


def segment_rules(df: DataFrame, contract: Contract = SESSION) -> dict[str, str]:
    """SQL rule per segment; two of them use percentiles of the whole table."""
    cut = exact_percentiles(
        df,
        {"value": (number_sql("PageValues"), [0.5]), "pages": (number_sql("ProductRelated"), [0.75])},
    )
    bought = f"CAST(`{contract.target}` AS BOOLEAN)"
    low, high = BROWSED_PAGES
    return {
        BUYER: f"{bought} AND PageValues > {literal_sql(cut['value'][0])}",
        RESEARCHER:
            f"NOT {bought} AND ProductRelated > {literal_sql(cut['pages'][0])} AND PageValues = 0",
        BOUNCER: f"NOT {bought} AND BounceRates > {BOUNCE_FLOOR}D",
        WINDOW_SHOPPER:
            f"NOT {bought} AND VisitorType = 'Returning_Visitor' AND ProductRelated BETWEEN {low} AND {high}",
    }


def with_segments(df: DataFrame, contract: Contract = SESSION) -> DataFrame:
    """Names of the segments a row belongs to (they can overlap)."""
    rules = segment_rules(df, contract)
    names = F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in rules.items()])
    return df.withColumn("segments", F.array_compact(names))


def segment(df: DataFrame, name: str, contract: Contract = SESSION) -> DataFrame:
    if name not in SEGMENTS:
        raise KeyError(f"no segment '{name}'; there are {list(SEGMENTS)}")
    return df.filter(segment_rules(df, contract)[name])
