"""Why a session scored what it scored, and what would change it."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscore.contract import SESSION, Contract
from clickscore.functions.features import FEATURE_SQL
from clickscore.functions.numbers import array_sql, double_array, number_sql
from clickscore.operators.learning import (
    Z, feature_names, mode_levels, model_inputs, positive_probability, probability_of, transform_rows,
)
from clickscore.operators.quantiles import exact_percentiles
from clickscore.operators.trees import PROBABILITY, TreeTable, rows_of, tree_table

# Smallest contribution shown, sweep length.
NEGLIGIBLE = 1e-9
SWEEP_POINTS = 40


def log_odds(p: Column) -> Column:
    safe = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), p))
    return F.log(safe / (F.lit(1.0) - safe))


def _sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


# --- attribution -----------------------------------------------------------------------


def attribute(
    df: DataFrame,
    model: PipelineModel,
    background: DataFrame,
    top_n: int | None = None,
    row_id: str = "row_id",
    contract: Contract = SESSION,
    smallest: float = NEGLIGIBLE,
) -> DataFrame:
    """Contributions to the log-odds of every session, largest first.

    All of them unless ``top_n`` is given; those up to ``smallest`` are not listed.

    Linear models: coefficient times distance from the background mean.  Trees: how far every
    split on the row's path moved the mean, under the split's feature; the base is the mean
    before any split.  Both are additive and exact; a forest adds up in probability, the others
    in log-odds.  Other models: the change when one field is set to its typical background
    value, which is not additive.  ``residual`` says how much is left unexplained.
    Columns: row_id, base_probability, probability, residual, contributions.
    """
    if isinstance(model.stages[-1], LogisticRegressionModel):
        return _attribute_linear(df, model, background, top_n, row_id, smallest)
    table = tree_table(model.stages[-1], df.sparkSession)
    if table is not None:
        return _attribute_trees(df, model, table, top_n, row_id, smallest)
    return _attribute_by_ablation(df, model, background, top_n, row_id, contract, smallest)


def _largest(entries: Column, top_n: int | None, smallest: float) -> Column:
    """Biggest absolute values first, inside the row: no window, no shuffle."""
    kept = F.filter(entries, lambda e: F.abs(e["value"]) > F.lit(smallest)) if smallest >= 0 else entries
    keyed = F.transform(
        kept,
        lambda e: F.struct((-F.abs(e["value"])).alias("key"), e["feature"].alias("feature"), e["value"].alias("value")),
    )
    ordered = F.transform(
        F.array_sort(keyed), lambda e: F.struct(e["feature"].alias("feature"), e["value"].alias("value"))
    )
    return F.slice(ordered, 1, top_n) if top_n else ordered


def _attribute_linear(df, model, background, top_n, row_id, smallest) -> DataFrame:
    last = model.stages[-1]
    names = feature_names(model)
    coefs = [float(v) for v in last.coefficients.toArray()]
    mean = transform_rows(background, model).select(Summarizer.mean(F.col("features"))).first()[0].toArray()
    base = float(last.intercept) + sum(c * float(m) for c, m in zip(coefs, mean))
    x = vector_to_array(F.col("features"))
    scaled = F.zip_with(
        F.zip_with(x, double_array(mean), lambda a, b: a - b), double_array(coefs), lambda a, b: a * b
    )
    labels = F.array(*[F.lit(n) for n in names])
    entries = F.zip_with(labels, scaled, lambda n, v: F.struct(n.alias("feature"), v.alias("value")))
    p = positive_probability(model)
    total = F.aggregate(scaled, F.lit(0.0), lambda a, v: a + v)
    return transform_rows(df, model).select(
        F.col(f"_row.{row_id}").alias(row_id),
        _sigmoid(F.lit(base)).alias("base_probability"),
        p.alias("probability"),
        (log_odds(p) - F.lit(base) - total).alias("residual"),
        _largest(entries, top_n, smallest).alias("contributions"),
    )


def _attribute_trees(df, model, table: TreeTable, top_n, row_id, smallest) -> DataFrame:
    rows = transform_rows(df, model).select(
        F.col(f"_row.{row_id}").alias("id"), vector_to_array(F.col("features")).alias("x"), positive_probability(model).alias("p")
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moved = table.contributions(rows_of(batch.column(1)))
            offsets = np.arange(0, moved.size + 1, moved.shape[1] or 1, dtype=np.int32)[: len(moved) + 1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(moved.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists], names=["id", "p", "moved"])

    kind = rows.schema["id"].dataType.simpleString()
    walked = rows.mapInArrow(walk, f"id {kind}, p double, moved array<double>")
    labels = F.array(*[F.lit(n) for n in feature_names(model)])
    entries = F.zip_with(labels, F.col("moved"), lambda n, v: F.struct(n.alias("feature"), v.alias("value")))
    total = F.lit(table.start) + F.aggregate("moved", F.lit(0.0), lambda a, v: a + v)
    # Compared as log-odds of probabilities, so that certainty beyond doubles counts alike.
    left = F.col("p") - total if table.link == PROBABILITY else log_odds(F.col("p")) - log_odds(_sigmoid(total))
    return walked.select(
        F.col("id").alias(row_id),
        F.lit(float(table.probability(np.array([table.start]))[0])).alias("base_probability"),
        F.col("p").alias("probability"),
        left.alias("residual"),
        _largest(entries, top_n, smallest).alias("contributions"),
    )


def typical_values(df: DataFrame, contract: Contract = SESSION) -> dict[str, Column]:
    """Median of every numeric field, most frequent level of every category."""
    mid = exact_percentiles(df, {c: (number_sql(c), [0.5]) for c in contract.numeric})
    modes = mode_levels(df, contract.categorical)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {c: F.lit(mid[c][0]).cast("double") for c in contract.numeric}
    for c in contract.categorical:
        if types[c].typeName() == "boolean":
            out[c] = F.lit(modes.get(c) == "1")
        else:
            out[c] = F.lit(modes.get(c)).cast(types[c])
    return out


def _attribute_by_ablation(df, model, background, top_n, row_id, contract, smallest) -> DataFrame:
    typical = typical_values(background, contract)
    whole, none = "*", ""
    # A fixed number of variants per row: the session, the typical one, one per field.
    variants = F.explode(F.array(*[F.lit(v) for v in (whole, none, *contract.features)]))
    own = df.select(row_id, *contract.features).withColumn("variant", variants)
    swapped = own.select(
        row_id,
        "variant",
        *[
            F.when(F.col("variant").isin(c, none), typical[c]).otherwise(F.col(c)).alias(c)
            for c in contract.features
        ],
    )
    scored = probability_of(swapped, model).select(
        row_id, "variant", "probability", log_odds(F.col("probability")).alias("score")
    )
    at = lambda v, c: F.max(F.when(F.col("variant") == v, F.col(c)))
    fields = F.collect_list(
        F.when(
            ~F.col("variant").isin(whole, none),
            F.struct(F.col("variant").alias("feature"), F.col("score").alias("value")),
        )
    )
    rows = scored.groupBy(row_id).agg(
        at(none, "probability").alias("base_probability"),
        at(whole, "probability").alias("probability"),
        at(whole, "score").alias("_whole"),
        at(none, "score").alias("_none"),
        fields.alias("_fields"),
    )
    entries = F.transform(
        F.col("_fields"),
        lambda e: F.struct(e["feature"].alias("feature"), (F.col("_whole") - e["value"]).alias("value")),
    )
    total = F.aggregate(entries, F.lit(0.0), lambda a, e: a + e["value"])
    return rows.select(
        row_id,
        "base_probability",
        "probability",
        (F.col("_whole") - F.col("_none") - total).alias("residual"),
        _largest(entries, top_n, smallest).alias("contributions"),
    )


def global_contribution(
    df: DataFrame,
    model: PipelineModel,
    background: DataFrame,
    row_id: str = "row_id",
    contract: Contract = SESSION,
) -> DataFrame:
    """Mean absolute contribution of every feature over all rows; 0 for one without effect."""
    told = attribute(df, model, background, None, row_id, contract, smallest=-1.0)
    n = df.agg(F.count(F.lit(1))).scalar()
    return (
        told.select(F.inline("contributions"))
        .groupBy("feature")
        .agg(F.sum(F.abs("value")).alias("total"))
        .select("feature", (F.col("total") / n).alias("mean_abs_contribution"))
        .orderBy(F.desc("mean_abs_contribution"), "feature")
    )


# --- readable origin of a contribution ---------------------------------------------------


def _product_less(a: Column, b: Column, c: Column) -> Column:
    """a * b - c to full precision, for a product near c: the rounding error is added back."""

    def halves(v: Column) -> tuple[Column, Column]:
        wide = v * F.lit(134217729.0)  # 2**27 + 1 splits a double into two halves
        high = wide - (wide - v)
        return high, v - high

    p = a * b
    (ah, al), (bh, bl) = halves(a), halves(b)
    return (p - c) + (((ah * bh - p) + ah * bl + al * bh) + al * bl)


def short_number(c: Column) -> Column:
    """At most four significant digits, the way ``%.4g`` prints them."""
    x = c.cast("double")
    five = F.format_string("%.4e", x)
    # Five digits that end in 5 look like a tie, but the double may lie on either side of it: below
    # it, or exactly on it after an even digit, the fifth digit is dropped, not rounded up.
    digits = F.abs(F.regexp_replace(F.split_part(five, F.lit("e"), F.lit(1)), r"\.", "").try_cast("double"))
    places = F.lit(4) - F.split_part(five, F.lit("e"), F.lit(2)).try_cast("int")
    tens = F.try_element_at(double_array([10.0**k for k in range(16)]), places + 1)
    past = F.when(places.between(0, 15), _product_less(F.abs(x), tens, digits)).otherwise(F.lit(0.0))
    looks = (five.try_cast("double") == x) & five.rlike("5e")
    stays = looks & ((past < 0) | ((past == 0) & five.rlike("[02468]5e")))
    text = F.when(stays, F.regexp_replace(five, "5e", "e")).otherwise(F.format_string("%.3e", x))
    power = F.split_part(text, F.lit("e"), F.lit(2))
    plain = power.try_cast("int").between(-4, 3)
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(x == 0, "0")
        .when(plain, _trim_zeros(text.try_cast("double").try_cast("decimal(24,8)").cast("string")))
        .otherwise(F.concat(_trim_zeros(F.split_part(text, F.lit("e"), F.lit(1))), F.lit("e"), power))
    )


def _trim_zeros(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")


def with_contribution_source(
    df: DataFrame, feature: str = "feature", name: str = "shown", contract: Contract = SESSION
) -> DataFrame:
    """Add what the transformed feature named in ``feature`` means for its row.

    A field shows its value; a one-hot slot reads "Month = Nov" when active and
    "Month is Nov, not May" when not.
    """
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    asked = F.col(feature)

    def shown(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.initcap(text) if types[c] == "boolean" else text

    named = [c for c in (*contract.features, *contract.engineered) if c in types]
    real = [c for c in named if types[c] in ("double", "float")]
    # The number is picked first and printed once, which keeps the expression small.
    number = F.coalesce(*[F.when(asked == F.lit(c), F.col(c)) for c in real], F.lit(None).cast("double"))
    out = F.when(asked.isin(real), short_number(F.col("_number")))
    for c in named:
        if c not in real:
            out = out.when(asked == F.lit(c), shown(c))
    for c in contract.categorical:
        level = F.substr(asked, F.lit(len(c) + 2))
        text = F.when(shown(c) == level, F.concat(F.lit(f"{c} = "), shown(c))).otherwise(
            F.concat(F.lit(f"{c} is "), shown(c), F.lit(", not "), level)
        )
        out = out.when(asked.startswith(f"{c}_"), text)
    return df.withColumn("_number", number).withColumn(name, out.otherwise("")).drop("_number")


# --- what-if ------------------------------------------------------------------------------


def sweep_values(p99: float | None, maximum: float | None, n: int = SWEEP_POINTS) -> list[float]:
    upper = float(p99 or 0.0) or float(maximum or 0.0) or 1.0
    step = upper / max(n - 1, 1)
    return [round(i * step, 6) for i in range(n)]


def sensitivity_grid(ranges: DataFrame, n: int = SWEEP_POINTS) -> DataFrame:
    """(column, point, value): the sweep of every numeric column, from its stored range."""
    upper = F.coalesce(F.nullif("p99", F.lit(0.0)), F.nullif("max", F.lit(0.0)), F.lit(1.0))
    return (
        ranges.select("column", upper.alias("upper"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("point"))
        .select(
            "column",
            "point",
            F.round(F.col("point") * (F.col("upper") / F.lit(float(max(n - 1, 1)))), 6).alias("value"),
        )
    )


def _inlined(sql: str) -> str:
    """A derived feature's SQL with the derived features that it uses written out."""
    for name, inner in FEATURE_SQL.items():
        if re.search(rf"\b{name}\b", sql):
            sql = re.sub(rf"`?\b{name}\b`?", f"(CAST({_inlined(inner)} AS DOUBLE))", sql)
    return sql


def swept_slots(model: PipelineModel, feature: str) -> dict[str, str]:
    """Scaled numeric columns that depend on the field, as SQL over the input columns."""
    out = {}
    for stage in model.stages:
        if not isinstance(stage, SQLTransformer) or f"{Z}`" not in stage.getStatement():
            continue
        body = stage.getStatement().removeprefix("SELECT *, ").removesuffix(" FROM __THIS__")
        for sql, name in re.findall(rf"(.+?) AS `([^`]+){Z}`(?:, |$)", body):
            whole = _inlined(sql)
            if re.search(rf"\b{feature}\b", whole):
                out[name] = whole
    return out


def _curve_function(model: PipelineModel, slots: list[int], spark):
    """(x, swept values [row, point, slot]) to probabilities [row, point]; None for other models.

    Trees that no swept slot takes part in are walked once per row.  Where only the field's own
    slot is swept, points between two break points of the trees are one step, walked once.
    """
    last = model.stages[-1]
    if isinstance(last, LogisticRegressionModel):
        coefs, intercept = last.coefficients.toArray(), float(last.intercept)

        def linear(x: np.ndarray, swept: np.ndarray) -> np.ndarray:
            still = x @ coefs + intercept - x[:, slots] @ coefs[slots]
            return 1 / (1 + np.exp(-(still[:, None] + swept @ coefs[slots])))

        return linear
    table = tree_table(last, spark)
    if table is None:
        return None
    moving, still = table.splitting_on(slots)

    def trees(x: np.ndarray, swept: np.ndarray) -> np.ndarray:
        fixed = table.base + table.totals(x, still)
        n = swept.shape[1]
        step = np.arange(n)
        if len(slots) == 1:
            cuts = np.unique(table.cut[table.slot == slots[0]])
            step = np.unique(np.searchsorted(cuts, swept[0, :, 0], side="left"), return_inverse=True)[1] if len(x) else step
        out = np.zeros((len(x), n))
        for s in np.unique(step):
            points = np.flatnonzero(step == s)
            own = x.copy()
            own[:, slots] = swept[:, points[0], :]
            out[:, points] = table.probability(fixed + table.totals(own, moving))[:, None]
        return out

    return trees


def curves(
    df: DataFrame, model: PipelineModel, feature: str, grid: Sequence[float], row_id: str = "row_id", contract: Contract = SESSION
) -> DataFrame | None:
    """(row_id, probabilities): one row per session, its probability at every value of the field.

    Rows are neither copied nor moved: the scaled columns that depend on the field are computed
    for all points inside the row, the rest of the vector once.  None where the model is neither
    linear nor made of trees, or where the field's dependents are not in its pipeline.
    """
    names = feature_names(model)
    own = swept_slots(model, feature)
    slots = [names.index(c) for c in own]
    score = _curve_function(model, slots, df.sparkSession) if own else None
    if score is None:
        return None
    # The lambda's variable has the field's name, so it stands for the field inside.
    point = f"transform({array_sql(grid)}, `{feature}` -> array({', '.join(own.values())}))"
    inputs = sorted(model_inputs(model))
    kept = df.select(F.struct(row_id).alias("_row"), *inputs)
    moved = kept.withColumn("_swept", F.expr(f"flatten({point})"))
    rows = model.transform(moved).select(
        F.col(f"_row.`{row_id}`").alias("id"), vector_to_array(F.col("features")).alias("x"), F.col("_swept").alias("swept")
    )
    width = (len(grid), len(slots))

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            p = score(rows_of(batch.column(1)), rows_of(batch.column(2)).reshape(-1, *width))
            offsets = np.arange(0, p.size + 1, p.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "probabilities"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(evaluate, f"id {kind}, probabilities array<double>")
    return out.select(F.col("id").alias(row_id), "probabilities")


def _grid(feature: str, ranges: DataFrame, n: int, contract: Contract) -> list[float]:
    if feature not in contract.numeric:
        raise ValueError(f"'{feature}' is not a numeric field; choose one of {list(contract.numeric)}")
    spec = ranges.filter(F.col("column") == feature).select("p99", "max").first()
    return sweep_values(spec["p99"], spec["max"], n)


def sensitivity(
    df: DataFrame,
    model: PipelineModel,
    feature: str,
    ranges: DataFrame,
    n: int = SWEEP_POINTS,
    row_id: str = "row_id",
    contract: Contract = SESSION,
) -> DataFrame:
    """Score every session with one numeric field swept, the others as they are.

    One row per session and point; they are made from the finished curves.
    """
    grid = _grid(feature, ranges, n, contract)
    found = curves(df, model, feature, grid, row_id, contract)
    if found is None:
        return _sensitivity_by_copies(df, model, feature, grid, row_id, contract)
    points = F.zip_with(
        double_array(grid), F.col("probabilities"), lambda v, p: F.struct(v.alias("value"), p.alias("probability"))
    )
    return found.select(row_id, F.inline(points))


def _sensitivity_by_copies(df, model, feature, grid, row_id, contract) -> DataFrame:
    swept = df.select(
        row_id,
        *[c for c in contract.features if c != feature],
        F.explode(double_array(grid)).alias(feature),
    )
    return probability_of(swept, model).select(row_id, F.col(feature).alias("value"), "probability")


def sensitivity_spans(
    df: DataFrame,
    model: PipelineModel,
    feature: str,
    ranges: DataFrame,
    n: int = SWEEP_POINTS,
    row_id: str = "row_id",
    contract: Contract = SESSION,
) -> DataFrame:
    """``sensitivity_span`` of every session from its curve, inside the row: no shuffle."""
    grid = _grid(feature, ranges, n, contract)
    found = curves(df, model, feature, grid, row_id, contract)
    if found is None:
        return sensitivity_span(_sensitivity_by_copies(df, model, feature, grid, row_id, contract), row_id)
    p, at = F.col("probabilities"), double_array(grid)
    low, high = F.array_min(p), F.array_max(p)
    return found.select(
        row_id,
        low.alias("min_probability"), F.element_at(at, F.array_position(p, low).cast("int")).alias("min_at"),
        high.alias("max_probability"), F.element_at(at, F.array_position(p, high).cast("int")).alias("max_at"),
    )


def sensitivity_span(curve: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Lowest and highest probability on each curve and where they occur (first on ties)."""
    low = F.struct("probability", "value")
    high = F.struct("probability", -F.col("value"))
    return curve.groupBy(row_id).agg(
        F.min("probability").alias("min_probability"),
        F.min_by("value", low).alias("min_at"),
        F.max("probability").alias("max_probability"),
        F.max_by("value", high).alias("max_at"),
    )
