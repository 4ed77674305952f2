"""Exact percentiles (linear interpolation) that never hold a column in one task.

The built-in exact ``percentile`` merges a value -> count map of the whole column
in a single task.  Here a mergeable sketch first brackets every wanted order
statistic, and only the rows inside the brackets (a fraction of a percent) are
looked at exactly.  Brackets are verified by counting, so the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.functions.numbers import array_sql, literal_sql
from clickscore.operators.accumulate import ROWS_PER_SLICE, running_totals, slice_cuts

Targets = Mapping[str, tuple[str, Sequence[float]]]

SKETCH_ACCURACY = 10_000


def exact_percentiles(df: DataFrame, targets: Targets, accuracy: int = SKETCH_ACCURACY) -> dict[str, list[float | None]]:
    """Percentiles of several numeric expressions at once.

    ``targets`` maps a name to (SQL expression, probabilities); NULLs are ignored.
    Conditional expressions give grouped percentiles.  Returns plain floats: their
    number depends on the request, never on the data.
    """
    names = list(targets)
    if not names:
        return {}
    expr = {k: f"CAST({targets[k][0]} AS DOUBLE)" for k in names}
    margin = 2.0 / accuracy

    head = []
    for i, k in enumerate(names):
        marks = []
        for p in targets[k][1]:
            marks += [max(0.0, p - margin), min(1.0, p + margin)]
        spots = array_sql([0.0, *marks, 1.0])
        head.append(f"count(_e{i}) AS n{i}")
        head.append(f"percentile_approx(_e{i}, {spots}, {accuracy}) AS b{i}")
    # Each expression is a column of its own, computed once per row and pass.
    df = df.selectExpr(*[f"{expr[k]} AS _e{i}" for i, k in enumerate(names)])
    expr = {k: f"_e{i}" for i, k in enumerate(names)}
    seen = df.selectExpr(*head).first()

    # One bracket per (name, probability): [lo, hi] holding ranks k and k + 1.
    brackets: list[dict] = []
    for i, k in enumerate(names):
        n = seen[f"n{i}"]
        for j, p in enumerate(targets[k][1]):
            spot = p * (n - 1) if n else 0.0
            rank = int(math.floor(spot))
            b = {"name": k, "at": j, "n": n, "rank": rank, "frac": spot - rank, "below": 0}
            if n:
                marks = seen[f"b{i}"]
                b["lo"], b["hi"] = marks[1 + 2 * j], marks[2 + 2 * j]
            brackets.append(b)
    live = [b for b in brackets if b["n"]]

    if live:
        counts = []
        for t, b in enumerate(live):
            x = expr[b["name"]]
            counts.append(f"count_if({x} < {literal_sql(b['lo'])}) AS u{t}")
            counts.append(f"count_if({_inside(x, b)}) AS i{t}")
        got = df.selectExpr(*counts).first()
        for t, b in enumerate(live):
            below, inside = got[f"u{t}"], got[f"i{t}"]
            last = min(b["rank"] + 1, b["n"] - 1)
            b["inside"] = inside
            if below <= b["rank"] and last < below + inside:
                b["below"] = below
            else:  # the sketch missed: fall back to the full range
                i = names.index(b["name"])
                b["lo"], b["hi"], b["inside"] = seen[f"b{i}"][0], seen[f"b{i}"][-1], b["n"]

    for b in live:
        if b["lo"] == b["hi"]:
            b["pair"] = (b["lo"], b["lo"])
    _rank_inside(df, expr, [b for b in live if "pair" not in b])

    out: dict[str, list[float | None]] = {k: [None] * len(targets[k][1]) for k in names}
    for b in live:
        a, c = b["pair"]
        out[b["name"]][b["at"]] = a + (c - a) * b["frac"]
    return out


def _inside(x: str, b: dict) -> str:
    return f"({x} BETWEEN {literal_sql(b['lo'])} AND {literal_sql(b['hi'])})"


def _wanted(b: dict) -> tuple[int, int]:
    first = b["rank"] - b["below"]
    return first, min(first + 1, b["n"] - 1 - b["below"])


def _rank_inside(df: DataFrame, expr: dict[str, str], group: list[dict]) -> None:
    """Count the distinct values of all brackets and accumulate them in slices."""
    if not group:
        return
    cells = ", ".join(
        f"CASE WHEN {_inside(expr[b['name']], b)} THEN struct({t} AS t, {expr[b['name']]} AS x) END"
        for t, b in enumerate(group)
    )
    values = df.selectExpr(f"inline(array_compact(array({cells})))")
    counted = values.groupBy("t", "x").agg(F.count(F.lit(1)).alias("n"))
    # How many values there are is known from the count before; few need no cuts.
    cuts = slice_cuts(values, "x") if sum(b["inside"] for b in group) > ROWS_PER_SLICE else ()
    ranked = running_totals(counted, "x", ["n"], by=["t"], descending=False, cuts=cuts)
    hit = None
    for t, b in enumerate(group):
        first, second = _wanted(b)
        start = F.col("cum_n") - F.col("n")
        here = (F.col("t") == t) & (start <= second) & (F.col("cum_n") > first)
        hit = here if hit is None else hit | here
    rows = ranked.filter(hit).select("t", "x").collect()  # at most two per bracket
    for t, b in enumerate(group):
        xs = sorted(r["x"] for r in rows if r["t"] == t)
        b["pair"] = (xs[0], xs[-1])
