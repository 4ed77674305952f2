"""Row rules for sessions and gates for whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscore.contract import SESSION, Contract
from clickscore.functions.coercion import raw_number


def _problem(rule: str, field: str, test: Column) -> Column:
    return F.when(
        F.coalesce(test, F.lit(False)),
        F.struct(F.lit(rule).alias("rule"), F.lit(field).alias("field")),
    )


def validate_sessions(df: DataFrame, contract: Contract = SESSION) -> DataFrame:
    """Add ``problems``, an array of (rule, field); empty means the row is valid.

    Works on typed and on all-text frames.  NULL fields are skipped, absent columns
    are a problem of every row.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    value = {c: raw_number(F.col(c), types[c]) for c in contract.numeric if c in types}
    found = [
        _problem("missing", c, F.lit(True)) for c in sorted(contract.features) if c not in types
    ]
    for c, v in value.items():
        found.append(_problem("not_numeric", c, F.col(c).isNotNull() & v.isNull()))
        found.append(_problem("negative", c, (v < 0) & ~F.isnan(v)))
    for c in contract.rates:
        if c in value:
            v = value[c]
            found.append(_problem("rate_out_of_range", c, F.isnan(v) | (v < 0) | (v > 1)))
    for count, seconds in contract.visits:
        if count in value and seconds in value:
            idle = (value[count] == 0) & (value[seconds] > 0) & ~F.isnan(value[seconds])
            found.append(_problem("time_without_pages", seconds, idle))
    return df.withColumn("problems", F.array_compact(F.array(*found)))


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("problems") == 0).drop("problems")


def quarantined_rows(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("problems") > 0)


def problem_counts(validated: DataFrame) -> DataFrame:
    return (
        validated.select(F.inline("problems"))
        .groupBy("rule", "field")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def table_contract(
    df: DataFrame,
    contract: Contract = SESSION,
    rows: int | None = None,
    rate_pct: float | None = None,
    tolerance: float = 0.01,
    checksum: str | None = None,
) -> DataFrame:
    """Data gate: one row per check with what was expected, what was found, and the verdict.

    The checksum adds up row hashes, so it does not depend on row order or layout.
    """
    missing = sorted(set(contract.columns) - set(df.columns))
    shown = F.lit(",".join(missing)).alias("missing")
    present = [c for c in contract.columns if c in df.columns]
    content = F.sum(F.xxhash64(*present).cast("decimal(38,0)"))
    if contract.target in df.columns:
        rate = F.round(F.lit(100.0) * F.avg(F.col(contract.target).cast("int")), 3)
    else:
        rate = F.lit(None).cast("double")
    facts = df.agg(
        F.count(F.lit(1)).alias("n"), rate.alias("rate"), content.cast("string").alias("sum")
    ).select("*", shown)

    def check(name: str, expected, found: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check"),
            F.lit(None if expected is None else str(expected)).cast("string").alias("expected"),
            found.cast("string").alias("actual"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    always = F.lit(True)
    return facts.select(
        F.inline(
            F.array(
                check("columns_present", "", F.col("missing"), F.col("missing") == ""),
                check("row_count", rows, F.col("n"), always if rows is None else F.col("n") == rows),
                check(
                    "target_rate_pct",
                    rate_pct,
                    F.col("rate"),
                    always
                    if rate_pct is None
                    else F.abs(F.col("rate") - F.lit(float(rate_pct))) <= F.lit(tolerance),
                ),
                check(
                    "checksum",
                    checksum,
                    F.col("sum"),
                    always if checksum is None else F.col("sum") == checksum,
                ),
            )
        )
    )
