"""The table report and the input profile, each table one or two jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.contract import SESSION, Contract
from clickscore.operators import cleaning, profiling, relevance
from clickscore.sources.writers import write_table


def profile_tables(df: DataFrame, contract: Contract = SESSION) -> dict[str, DataFrame]:
    """Every report table of a session table.

    Quality, duplicates and balance describe the raw rows; everything from outliers on
    describes the de-duplicated rows with derived features, which are kept once.
    """
    raw = df.select(*contract.columns)
    # Rows that stay differ, so a hash of the row tells them apart where values are equal.
    clean = cleaning.add_session_features(cleaning.dedupe(raw, contract)).withColumn(
        "row_id", F.xxhash64(*contract.columns)
    ).persist()
    return {
        "quality": profiling.quality(raw),
        "null_total": profiling.null_total(raw),
        "duplicates": cleaning.duplicate_stats(raw, contract),
        "code_catalog": profiling.code_catalog(raw, contract),
        "zero_inflation": profiling.zero_inflation(raw, contract),
        "target_balance": profiling.target_balance(raw, contract),
        "outliers": profiling.outliers(clean, contract.all_numeric),
        "correlation_matrix": relevance.correlation_matrix(clean, contract.all_numeric),
        "high_correlation_pairs": relevance.high_correlation_pairs(clean, contract.all_numeric),
        "target_correlation": relevance.target_correlation(clean, contract),
        **{
            f"conversion_by_{c.lower()}": profiling.conversion_by(clean, c, contract)
            for c in contract.native_categorical
        },
        "calendar_coverage": profiling.calendar_coverage(clean, contract),
        "mutual_information": relevance.mutual_information(clean, contract),
        "histogram": profiling.histogram(clean, contract.all_numeric),
        "standardised_box": profiling.standardised_box(clean, contract.all_numeric),
    }


def profile_summary(tables: dict[str, DataFrame], *names: str) -> DataFrame:
    """The named small report tables as one nested row, ready for JSON."""
    names = names or ("null_total", "duplicates", "target_balance", "outliers", "calendar_coverage")
    out = None
    for name in names:
        part = tables[name]
        rows = F.collect_list(F.struct(*part.columns)).alias(name)  # report rows, a few dozen
        value = part.agg(rows).scalar().alias(name)
        out = part.sparkSession.range(1).select(value) if out is None else out.withColumn(name, value)
    return out


def input_profile(df: DataFrame, contract: Contract = SESSION) -> dict[str, DataFrame]:
    """What an input form needs: ranges, levels, typical sessions and the overall rate."""
    clean = cleaning.dedupe(df, contract).persist()
    return {
        "numeric_ranges": profiling.numeric_ranges(clean, contract),
        "category_levels": profiling.category_levels(clean, contract),
        "segment_presets": profiling.segment_presets(clean, contract),
        "baseline_rate": profiling.baseline_rate(clean, contract),
    }


def write_input_profile(df: DataFrame, folder: str, contract: Contract = SESSION) -> None:
    for name, table in input_profile(df, contract).items():
        write_table(table, folder, name, one_file=True)
