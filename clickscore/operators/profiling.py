"""Table profile: quality, distributions, levels and conversion.

Reports over many columns are one job, never one job per column: either a wide
aggregate turned into rows, or counts per (column, value) that combine on the map
side and spread over all tasks however skewed a value is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscore.contract import CALENDAR, SESSION, Contract
from clickscore.functions.numbers import (
    array_sql, clean_number, literal_sql, number_sql,
)
from clickscore.operators.accumulate import numbered
from clickscore.operators.cleaning import segment_rules
from clickscore.operators.quantiles import exact_percentiles

# Outlier fence, input steps and shown decimals, catalogue length.
FENCE = 1.5
RATE_STEP, COUNT_STEP, OTHER_STEP = (0.001, 3), (1.0, 0), (1.0, 1)

CATALOG_CODES = 30

_VALUE = ("whole", "real", "text")


# --- counts per (column, value) ---------------------------------------------------


def _typed(c: Column, dtype: T.DataType) -> list[Column]:
    """The value in the one of three typed slots that fits it."""
    nothing = {"whole": "bigint", "real": "double", "text": "string"}
    slot = "text"
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        slot, c = "whole", c.cast("bigint")
    elif isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        slot, c = "real", clean_number(c)
    else:
        c = c.cast("string")
    return [
        (c if s == slot else F.lit(None).cast(t)).alias(s) for s, t in nothing.items()
    ]


def value_counts(df: DataFrame, columns: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """(column, whole, real, text, n): how often each value of each column occurs."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), *_typed(F.col(c), types[c])) for c in columns]
    )
    return (
        df.select(*extra, F.inline(cells))
        .groupBy(*extra, "column", *_VALUE)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _is_null() -> Column:
    return F.coalesce(*[F.col(v).cast("string") for v in _VALUE]).isNull()


def _literal_map(pairs: dict[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def quality(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type, NULLs, distinct values and share of zeros per column."""
    columns = list(columns or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name in columns}
    numeric = [
        f.name
        for f in df.schema.fields
        if f.name in columns and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]
    null = _is_null()
    zero = (F.col("whole") == 0) | (F.col("real") == 0)
    n = F.sum("n")
    share = lambda test: F.lit(100.0) * F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)) / n
    return (
        value_counts(df, columns)
        .groupBy("column")
        .agg(
            F.coalesce(F.sum(F.when(null, F.col("n"))), F.lit(0)).alias("n_null"),
            F.round(share(null), 3).alias("pct_null"),
            F.count_if(~null).alias("n_unique"),
            F.round(share(zero), 2).alias("pct_zero"),
        )
        .select(
            "column",
            F.try_element_at(_literal_map(types), F.col("column")).alias("dtype"),
            "n_null",
            "pct_null",
            "n_unique",
            F.when(F.col("column").isin(numeric), F.col("pct_zero")).alias("pct_zero"),
        )
        .orderBy(F.desc("pct_null"), "column")
    )


def null_total(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    total = F.lit(0)
    for c in columns or df.columns:
        x = F.col(c)
        missing = x.isNull()
        if isinstance(types[c], (T.FloatType, T.DoubleType)):
            missing = missing | F.isnan(x)
        total = total + F.count_if(missing)
    return df.agg(total.alias("n_null"))


def code_catalog(df: DataFrame, contract: Contract = SESSION, keep: int = CATALOG_CODES) -> DataFrame:
    """Type, number of codes and the first ``keep`` codes of every integer-coded category.

    Codes beyond the first are counted, never gathered; ``category_levels`` lists them all.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    codes = value_counts(df, contract.coded_categorical).filter(~_is_null())
    shown = F.coalesce(F.col("whole").cast("string"), F.col("text"))
    # Spark keeps as many rows per column before the shuffle already.
    place = F.row_number().over(Window.partitionBy("column").orderBy("whole", "text"))
    first = codes.withColumn("place", place).filter(F.col("place") <= keep).groupBy("column").agg(
        F.sort_array(F.collect_list(F.struct("place", shown.alias("code")))).alias("codes")
    )
    found = codes.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique")).join(first, "column")
    return found.select(
        "column",
        F.try_element_at(_literal_map(types), F.col("column")).alias("dtype"),
        "n_unique",
        F.col("codes.code").alias("values"),
    )


# --- wide aggregates turned into rows ---------------------------------------------


def _rows(df: DataFrame, aggs: Sequence[str], lines: Sequence[dict[str, str]]) -> DataFrame:
    """One aggregate over the table, then one output row per entry of ``lines``."""
    structs = ", ".join(
        "struct(" + ", ".join(f"{sql} AS `{name}`" for name, sql in line.items()) + ")"
        for line in lines
    )
    return df.selectExpr(*aggs).selectExpr(f"inline(array({structs}))")


def zero_inflation(df: DataFrame, contract: Contract = SESSION) -> DataFrame:
    aggs = [f"avg(CASE WHEN `{c}` = 0 THEN 1D ELSE 0D END) AS z{i}" for i, c in enumerate(contract.numeric)]
    lines = [
        {"column": f"'{c}'", "pct_zero": f"round(100D * z{i}, 2)"} for i, c in enumerate(contract.numeric)
    ]
    return _rows(df, aggs, lines)


def target_balance(df: DataFrame, contract: Contract = SESSION) -> DataFrame:
    y = F.col(contract.target).cast("int")
    n, pos, neg = F.count(y), F.count_if(y == 1), F.count_if(y == 0)
    pct = lambda part: F.round(F.try_divide(F.lit(100.0) * part, n), 3)
    return df.agg(
        neg.alias("no_purchase"),
        pos.alias("purchase"),
        pct(pos).alias("positive_rate_pct"),
        F.round(neg.cast("double") / F.greatest(pos, F.lit(1)), 2).alias("imbalance_ratio"),
        pct(neg).alias("majority_accuracy_pct"),
    )


def baseline_rate(df: DataFrame, contract: Contract = SESSION) -> DataFrame:
    y = F.col(contract.target).cast("int")
    return df.agg(
        F.round(F.lit(100.0) * F.avg(y), 2).alias("baseline_pct"),
        F.count(F.lit(1)).alias("n_sessions"),
    )


def outliers(df: DataFrame, columns: Sequence[str] = SESSION.all_numeric) -> DataFrame:
    """Quartiles, fences, rows outside them, maximum and bias-corrected skew."""
    quart = exact_percentiles(df, {c: (number_sql(c), [0.25, 0.75]) for c in columns})
    aggs, lines = ["count(1) AS n_rows"], []
    for i, c in enumerate(columns):
        q1, q3 = quart[c]
        lo, hi = _fences(q1, q3)
        x = number_sql(c)
        aggs += [
            f"count_if({x} < {literal_sql(lo)} OR {x} > {literal_sql(hi)}) AS o{i}",
            f"max({x}) AS m{i}", f"min({x}) AS l{i}",
            f"CAST(count({x}) AS DOUBLE) AS n{i}", f"skewness({x}) AS s{i}",
        ]
        skew = (
            f"CASE WHEN n{i} < 3 THEN NULL WHEN m{i} = l{i} THEN 0D "
            f"ELSE s{i} * sqrt(n{i} * (n{i} - 1)) / (n{i} - 2) END"
        )
        lines.append(
            {
                "column": f"'{c}'",
                **{k: f"round({literal_sql(v)}, 4)" for k, v in
                   (("q1", q1), ("q3", q3), ("lower_bound", lo), ("upper_bound", hi))},
                "n_outliers": f"o{i}",
                "pct_outliers": f"round(try_divide(100D * o{i}, n_rows), 2)",
                "max": f"round(m{i}, 4)",
                "skew": f"round({skew}, 3)",
            }
        )
    return _rows(df, aggs, lines).orderBy(F.desc("pct_outliers"), "column")


def _fences(q1: float | None, q3: float | None) -> tuple[float | None, float | None]:
    if q1 is None:
        return None, None
    return q1 - FENCE * (q3 - q1), q3 + FENCE * (q3 - q1)


def numeric_ranges(
    df: DataFrame, contract: Contract = SESSION, columns: Sequence[str] | None = None
) -> DataFrame:
    """Range, centre, 99th percentile and input step of every numeric column (or of ``columns``)."""
    columns = columns or contract.numeric
    mid = exact_percentiles(df, {c: (number_sql(c), [0.5, 0.99]) for c in columns})
    aggs, lines = [], []
    for i, c in enumerate(columns):
        x = number_sql(c)
        aggs += [f"min({x}) AS a{i}", f"max({x}) AS b{i}", f"avg({x}) AS c{i}"]
        step, decimals = OTHER_STEP
        if c in contract.unit_scaled:
            step, decimals = RATE_STEP
        elif c in contract.counts:
            step, decimals = COUNT_STEP
        lines.append(
            {
                "column": f"'{c}'", "min": f"a{i}", "max": f"b{i}",
                "median": literal_sql(mid[c][0]), "mean": f"round(c{i}, 4)",
                "p99": literal_sql(mid[c][1]), "step": literal_sql(step), "decimals": str(decimals),
            }
        )
    return _rows(df, aggs, lines)


def standardised_box(df: DataFrame, columns: Sequence[str] = SESSION.all_numeric) -> DataFrame:
    """Box plot of the z-scores: quartiles and the whiskers inside the fences."""
    quart = exact_percentiles(df, {c: (number_sql(c), [0.25, 0.5, 0.75]) for c in columns})
    aggs, lines = [], []
    for i, c in enumerate(columns):
        q1, q2, q3 = quart[c]
        lo, hi = _fences(q1, q3)
        x = number_sql(c)
        aggs += [
            f"avg({x}) AS a{i}", f"stddev_samp({x}) AS s{i}",
            f"min(CASE WHEN {x} >= {literal_sql(lo)} THEN {x} END) AS l{i}",
            f"max(CASE WHEN {x} <= {literal_sql(hi)} THEN {x} END) AS h{i}",
        ]
        z = lambda v, i=i: f"round(({v} - a{i}) / CASE WHEN s{i} > 0 THEN s{i} ELSE 1D END, 4)"
        lines.append(
            {
                "column": f"'{c}'", "whisker_low": z(f"l{i}"), "q1": z(literal_sql(q1)),
                "median": z(literal_sql(q2)), "q3": z(literal_sql(q3)), "whisker_high": z(f"h{i}"),
            }
        )
    return _rows(df, aggs, lines)


def histogram(df: DataFrame, columns: Sequence[str] = SESSION.numeric, bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum; a constant column is one bin."""
    ends = df.selectExpr(
        *[f"{f}({number_sql(c)}) AS {f}{i}" for i, c in enumerate(columns) for f in ("min", "max")]
    ).first()
    cells, edges = [], {}
    for i, c in enumerate(columns):
        lo, hi = ends[f"min{i}"], ends[f"max{i}"]
        if lo is None:
            continue
        width = (hi - lo) / bins
        edges[c] = [*(lo + j * width for j in range(bins)), hi] if hi > lo else [lo, hi]
        cells.append(f"struct('{c}' AS `column`, {_bin_sql(number_sql(c), lo, width, bins)} AS spot)")
    if not cells:
        raise ValueError("no values to bin")
    counted = (
        df.selectExpr(f"inline(array({', '.join(cells)}))")
        .filter("spot IS NOT NULL")
        .groupBy("column", "spot")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = "map(" + ", ".join(f"'{c}', {array_sql(v)}" for c, v in edges.items()) + ")[`column`]"
    return (
        counted.selectExpr("*", f"explode(sequence(0, size({frame}) - 2)) AS bin")
        .groupBy("column", "bin")
        .agg(F.sum(F.when(F.col("spot") == F.col("bin"), F.col("n")).otherwise(0)).alias("count"))
        .selectExpr(
            "column", "bin", f"get({frame}, bin) AS lower", f"get({frame}, bin + 1) AS upper", "count"
        )
    )


def _bin_sql(x: str, lo: float, width: float, bins: int) -> str:
    """Bin of x by arithmetic, corrected against the exact edges ``lo + j * width``."""
    if width == 0:
        return f"CASE WHEN {x} IS NOT NULL THEN 0 END"
    start, step = literal_sql(lo), literal_sql(width)
    guess = f"floor(({x} - {start}) / {step})"
    shift = (
        f"CASE WHEN {start} + ({guess} + 1) * {step} <= {x} THEN 1 "
        f"WHEN {start} + {guess} * {step} > {x} THEN -1 ELSE 0 END"
    )
    return f"CASE WHEN {x} IS NOT NULL THEN CAST(least({bins - 1}, greatest(0, {guess} + {shift})) AS INT) END"


# --- categories -----------------------------------------------------------------------


def _month_rank(c: Column) -> Column:
    return F.array_position(F.lit(list(CALENDAR)), c).cast("int")


def conversion_by(df: DataFrame, column: str, contract: Contract = SESSION) -> DataFrame:
    """Sessions and conversion per level, next to the overall rate; NULL levels are left out.

    Months of another spelling follow December, with a NULL rank.
    """
    y = F.col(contract.target).cast("int")
    overall = df.agg(F.round(F.lit(100.0) * F.avg(y), 2)).scalar()
    out = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("level"))
        .agg(
            F.count(y).alias("sessions"),
            F.round(F.lit(100.0) * F.avg(y), 2).alias("conversion_pct"),
        )
        .withColumn("baseline_pct", overall)
    )
    if column == contract.calendar:
        rank = F.nullif(_month_rank(F.col("level")), F.lit(0))
        return out.withColumn("calendar_rank", rank).orderBy(F.asc_nulls_last("calendar_rank"), "level")
    return out.orderBy("level")


def calendar_coverage(df: DataFrame, contract: Contract = SESSION) -> DataFrame:
    """The twelve months and whether the table has them."""
    seen = df.groupBy(F.col(contract.calendar).alias("month")).agg(F.count(F.lit(1)).alias("n"))
    months = df.sparkSession.createDataFrame(
        [(i + 1, m) for i, m in enumerate(CALENDAR)], "calendar_rank int, month string"
    )
    return months.join(seen, "month", "left").select(
        "calendar_rank", "month", F.col("n").isNotNull().alias("present")
    )


def category_levels(df: DataFrame, contract: Contract = SESSION) -> DataFrame:
    """(column, position, level): levels in natural order, months in calendar order.

    Months of another spelling follow December.
    """
    scanned = [c for c in contract.categorical if c not in contract.flags]
    seen = value_counts(df, scanned).filter(~_is_null())
    level = F.coalesce(F.col("whole").cast("string"), F.col("real").cast("string"), F.col("text"))
    rank = F.when(F.col("column") == contract.calendar, F.nullif(_month_rank(F.col("text")), F.lit(0)))
    natural = [F.asc_nulls_last("rank"), F.col("whole"), F.col("real"), F.col("text")]
    found = numbered(seen.withColumn("rank", rank), "column", natural).select(
        "column", F.col("position").cast("int").alias("position"), level.alias("level")
    )
    flags = df.sparkSession.createDataFrame(
        [(c, i + 1, v) for c in contract.flags for i, v in enumerate(("false", "true"))],
        "column string, position int, level string",
    )
    return found.unionByName(flags)


def segment_presets(df: DataFrame, contract: Contract = SESSION) -> DataFrame:
    """One typical session per segment: medians, modes (smallest on ties), share of rows.

    Medians are percentiles of conditional expressions, so all segments and columns
    share the same passes.  Segments without rows are left out.
    """
    rules = segment_rules(df, contract)
    names = list(rules)
    medians = exact_percentiles(
        df,
        {
            f"{i}.{c}": (f"CASE WHEN {rules[s]} THEN {number_sql(c)} END", [0.5])
            for i, s in enumerate(names)
            for c in contract.numeric
        },
    )
    tags = F.expr(
        "array_compact(array(" + ", ".join(f"CASE WHEN {rules[s]} THEN '{s}' END" for s in names) + "))"
    )
    tagged = df.select(*contract.categorical, F.explode(tags).alias("segment"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), *_VALUE))
    modes = (
        value_counts(tagged, contract.categorical, ["segment"])
        .filter(~_is_null())
        .groupBy("segment", "column")
        .agg(best.alias("best"))
        .groupBy("segment")
        .pivot("column", list(contract.categorical))
        .agg(F.first("best"))
    )
    types = dict(contract.types)

    def mode(c: str) -> Column:
        slot = "text" if isinstance(types[c], T.StringType) else "whole"
        return F.col(f"{c}.{slot}").cast(types[c]).alias(c)

    def median(c: str) -> Column:
        cases = " ".join(
            f"WHEN '{s}' THEN {literal_sql(medians[f'{i}.{c}'][0])}" for i, s in enumerate(names)
        )
        return F.expr(f"round(CASE segment {cases} END, 4) AS {c}")

    counts = _rows(
        df,
        ["count(1) AS n_rows", *[f"count_if({rules[s]}) AS n{i}" for i, s in enumerate(names)]],
        [
            {
                "segment": f"'{s}'", "n_sessions": f"n{i}",
                "share_pct": f"round(try_divide(100D * n{i}, n_rows), 1)",
            }
            for i, s in enumerate(names)
        ],
    ).filter("n_sessions > 0")
    return counts.join(modes, "segment", "left").select(
        "segment",
        "n_sessions",
        "share_pct",
        *[median(c) for c in contract.numeric],
        *[mode(c) for c in contract.categorical],
    )
