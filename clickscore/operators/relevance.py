"""How numeric columns relate to each other and all columns to the target."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscore.contract import SESSION, Contract
from clickscore.functions.numbers import literal_sql, number_sql
from clickscore.operators.neighbours import NEIGHBOURS, neighbour_information

HIGH_CORRELATION = 0.80


def _correlations(
    df: DataFrame, columns: dict[str, str], pairs: Sequence[tuple[str, str]]
) -> dict[tuple[str, str], float | None]:
    """Pearson correlation of the wanted pairs from two narrow passes.

    The first pass finds the means, the second sums products of centred values, which
    stays precise for large means.  A pair uses the rows where both values are present;
    a constant column gives None.  ``columns`` maps names to SQL expressions.
    """
    names = list(columns)
    ends = df.selectExpr(
        "count(1) AS n_rows",
        *[
            f"{f}({columns[c]}) AS {k}{i}"
            for i, c in enumerate(names)
            for k, f in (("n", "count"), ("m", "avg"), ("a", "min"), ("b", "max"))
        ],
    ).first()
    at = {c: i for i, c in enumerate(names)}
    varies = {c: ends[f"n{i}"] > 0 and ends[f"a{i}"] < ends[f"b{i}"] for c, i in at.items()}
    full = {c: ends[f"n{i}"] == ends["n_rows"] for c, i in at.items()}
    centred = df.selectExpr(
        *[f"{columns[c]} - {literal_sql(ends[f'm{i}'] or 0.0)} AS d{i}" for c, i in at.items()]
    )

    sums: dict[str, str] = {}

    def total(key: str, value: str) -> str:
        sums[key] = f"sum({value}) AS {key}"
        return key

    plan = {}
    for a, b in pairs:
        if not (varies[a] and varies[b]):
            continue
        i, j = at[a], at[b]
        x, y = f"d{i}", f"d{j}"
        if full[a] and full[b]:
            plan[a, b] = [
                total(f"p{i}_{j}", f"{x} * {y}"), total(f"x{i}", x), total(f"x{j}", y),
                total(f"q{i}", f"{x} * {x}"), total(f"q{j}", f"{y} * {y}"), total("c", "1"),
            ]
        else:
            both = lambda v, x=x, y=y: f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {v} END"
            plan[a, b] = [
                total(f"p{i}_{j}", f"{x} * {y}"),
                total(f"x{i}_{j}", both(x)), total(f"x{j}_{i}", both(y)),
                total(f"q{i}_{j}", both(f"{x} * {x}")), total(f"q{j}_{i}", both(f"{y} * {y}")),
                total(f"c{i}_{j}", both("1")),
            ]
    got = centred.selectExpr(*sums.values()).first() if sums else None

    out: dict[tuple[str, str], float | None] = {p: None for p in pairs}
    for pair, keys in plan.items():
        xy, sx, sy, xx, yy, n = (got[k] for k in keys)
        if not n:
            continue
        vx, vy = xx - sx * sx / n, yy - sy * sy / n
        if vx > 0 and vy > 0:
            out[pair] = max(-1.0, min(1.0, (xy - sx * sy / n) / (vx**0.5 * vy**0.5)))
    return out


def _numbers(columns: Sequence[str]) -> dict[str, str]:
    return {c: number_sql(c) for c in columns}


def correlation_pairs(df: DataFrame, columns: Sequence[str] = SESSION.all_numeric) -> DataFrame:
    """Long form over the upper triangle, diagonal included."""
    pairs = list(combinations_with_replacement(columns, 2))
    got = _correlations(df, _numbers(columns), pairs)
    rows = [(a, b, got[a, b]) for a, b in pairs]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double")


def correlation_matrix(df: DataFrame, columns: Sequence[str] = SESSION.all_numeric) -> DataFrame:
    """Square form, one row per feature, 4 decimals."""
    got = _correlations(df, _numbers(columns), list(combinations_with_replacement(columns, 2)))
    cell = lambda a, b: got[a, b] if (a, b) in got else got[b, a]
    rows = [(a, *[cell(a, b) for b in columns]) for a in columns]
    schema = "feature string, " + ", ".join(f"`{c}` double" for c in columns)
    return df.sparkSession.createDataFrame(rows, schema).selectExpr(
        "feature", *[f"round(`{c}`, 4) AS `{c}`" for c in columns]
    )


def high_correlation_pairs(
    df: DataFrame,
    columns: Sequence[str] = SESSION.all_numeric,
    at_least: float = HIGH_CORRELATION,
) -> DataFrame:
    return (
        correlation_pairs(df, columns)
        .filter("feature_a <> feature_b")
        .select("feature_a", "feature_b", F.abs("corr").alias("abs_corr"))
        .filter(F.col("abs_corr") >= F.lit(at_least))
        .orderBy(F.desc("abs_corr"), "feature_a", "feature_b")
    )


def target_correlation(
    df: DataFrame, contract: Contract = SESSION, columns: Sequence[str] | None = None
) -> DataFrame:
    columns = list(columns or contract.all_numeric)
    y = contract.target
    exprs = {**_numbers(columns), y: f"CAST(CAST(`{y}` AS INT) AS DOUBLE)"}
    got = _correlations(df, exprs, [(c, y) for c in columns])
    rows = [(c, got[c, y]) for c in columns]
    return (
        df.sparkSession.createDataFrame(rows, "feature string, corr double")
        .select("feature", F.round("corr", 4).alias("correlation_with_target"))
        .orderBy(F.desc("correlation_with_target"), "feature")
    )


def mutual_information(
    df: DataFrame,
    contract: Contract = SESSION,
    numeric: Sequence[str] | None = None,
    row_id: str = "row_id",
    neighbours: int = NEIGHBOURS,
    top: int | None = None,
) -> DataFrame:
    """Mutual information (nats) of every feature with the target.

    Categories are exact plug-in values from counts; numeric columns are estimated from
    nearest neighbours (``neighbours.neighbour_information``).
    """
    numeric = list(contract.all_numeric if numeric is None else numeric)
    cells = [f"struct('{c}' AS feature, CAST(`{c}` AS STRING) AS level)" for c in contract.categorical]
    y = F.col(contract.target).cast("int")
    levels = (
        df.select(y.alias("y"), F.expr(f"inline(array({', '.join(cells)}))"))
        .filter("y IS NOT NULL")
        .groupBy("feature", "level")
        .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").cast("double").alias("n1"))
    )

    def x_log(part: Column, whole: Column) -> Column:
        return F.when(part > 0, part * F.log(part / whole)).otherwise(F.lit(0.0))

    n, n1 = F.col("n"), F.col("n1")
    n0 = n - n1
    sums = levels.groupBy("feature").agg(
        F.sum(x_log(n1, n) + x_log(n0, n)).alias("known"), F.sum(n).alias("n"), F.sum(n1).alias("n1")
    )
    score = (F.col("known") - x_log(n1, n) - x_log(n0, n)) / n
    exact = sums.select("feature", F.greatest(score, F.lit(0.0)).alias("score"))
    if numeric:
        exact = exact.unionByName(neighbour_information(df, numeric, contract.target, row_id, neighbours))
    out = exact.select("feature", F.round("score", 5).alias("mutual_information"))
    out = out.orderBy(F.desc("mutual_information"), "feature")
    return out.limit(top) if top else out
