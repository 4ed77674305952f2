"""Small numeric column expressions shared by the operators."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_number(c: Column) -> Column:
    """A double with NaN and the infinities turned into NULL and -0.0 into 0.0."""
    v = c.cast("double")
    return F.when(F.abs(v) < F.lit(float("inf")), v + F.lit(0.0))


def number_sql(name: str) -> str:
    """``clean_number`` of a column as SQL text, for wide aggregates."""
    x = f"CAST(`{name}` AS DOUBLE)"
    return f"(CASE WHEN abs({x}) < CAST('Infinity' AS DOUBLE) THEN {x} + 0D END)"


def literal_sql(v: float | None) -> str:
    if v is None:
        return "CAST(NULL AS DOUBLE)"
    return f"{float(v)!r}D" if math.isfinite(v) else f"CAST('{float(v)!r}' AS DOUBLE)"


def array_sql(values: Sequence[float]) -> str:
    return "array(" + ", ".join(literal_sql(v) for v in values) + ")"


def ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num / den as double, with a default where the denominator is zero."""
    q = F.try_divide(num.cast("double"), den.cast("double"))
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def double_array(values: Sequence[float]) -> Column:
    """A constant array; one SQL literal instead of one call per element."""
    return F.expr(array_sql(values))


def steps_reached(c: Column, grid: Sequence[float]) -> Column:
    """How many values of an ascending, nearly uniform grid are <= c.

    The position is guessed by arithmetic and then corrected against the exact
    neighbouring grid values, so the cost does not depend on the grid's length.
    """
    n = len(grid)
    if n == 1:
        return F.when(c >= F.lit(grid[0]), 1).otherwise(0)
    step = (grid[-1] - grid[0]) / (n - 1)
    values = double_array(grid)
    raw = F.floor((c - F.lit(grid[0])) / F.lit(step))
    guess = F.greatest(F.lit(0), F.least(F.lit(n), raw)).cast("int")
    hits = [
        F.when(
            (guess + d >= 1) & (guess + d <= n)
            & (c >= F.try_element_at(values, guess + F.lit(d))),
            1,
        ).otherwise(0)
        for d in range(0, 3)
    ]
    base = F.greatest(guess - 1, F.lit(0))
    reached = base + hits[1] + hits[2] + F.when(guess >= 1, hits[0]).otherwise(0)
    return F.when(c.isNotNull(), reached)


def edges_below(c: Column, edges: Sequence[float]) -> Column:
    """How many of a few ascending edges are strictly below c (bins are (lo, hi])."""
    total = F.lit(0)
    for e in edges:
        total = total + F.when(c > F.lit(float(e)), 1).otherwise(0)
    return total
