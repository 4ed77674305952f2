"""Fitted trees as one table of nodes, and second-order boosting that grows such a table.

A table holds for every node its split, children and mean value.  Rows walk it block by block
inside their task, so scores, attributions and what-if curves need neither copies of a row nor a
shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasProbabilityCol, HasSeed, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.operators.batched import total_sums
from clickscore.session import forget, work_folder, written

LOG_ODDS, PROBABILITY = "log_odds", "probability"
#: Margins are written anew after so many trees; until then they are walked again.
TREES_PER_WRITE = 10


@dataclass(frozen=True)
class TreeTable:
    """Nodes of all trees on end: a row goes left where ``x[slot] <= cut``; leaves have slot -1.

    ``value`` is a node's mean in the unit that the trees add up in, tree weights included:
    log-odds for boosted trees, probability for forests.
    """

    slot: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    link: str

    @property
    def start(self) -> float:
        """What a row gets before any split: the base and the roots' means."""
        return self.base + float(self.value[self.roots].sum())

    def steps(self, x: np.ndarray, roots: Sequence[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, nodes they leave, nodes they reach) for every step of every tree."""
        for root in self.roots if roots is None else roots:
            rows, node = np.arange(len(x)), np.full(len(x), root)
            while len(rows):
                inner = self.slot[node] >= 0
                rows, node = rows[inner], node[inner]
                if len(rows):
                    to = np.where(x[rows, self.slot[node]] <= self.cut[node], self.left[node], self.right[node])
                    yield rows, node, to
                    node = to

    def totals(self, x: np.ndarray, roots: Sequence[int] | None = None) -> np.ndarray:
        """Sum of the reached leaves, with the base unless only some trees are asked for."""
        out = np.full(len(x), self.base if roots is None else 0.0)
        for root in self.roots if roots is None else roots:
            reached = np.full(len(x), root)
            for rows, _, to in self.steps(x, [root]):
                reached[rows] = to
            out += self.value[reached]
        return out

    def splitting_on(self, slots: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """Roots of the trees that split on any of the slots, and of the others."""
        hit = []
        for root in self.roots:
            below, found = [root], False
            while below and not found:
                node = below.pop()
                if self.slot[node] >= 0:
                    found = self.slot[node] in slots
                    below += [self.left[node], self.right[node]]
            hit.append(found)
        return self.roots[np.array(hit, bool)], self.roots[~np.array(hit, bool)]

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """Per row and slot how far its splits moved the row's mean; the row's total less ``start``."""
        out = np.zeros(x.shape)
        for rows, node, to in self.steps(x):
            out[rows, self.slot[node]] += self.value[to] - self.value[node]
        return out

    def probability(self, total: np.ndarray) -> np.ndarray:
        if self.link == PROBABILITY:
            return total
        return 1 / (1 + np.exp(-total))

    def to_json(self) -> str:
        return json.dumps({k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in vars(self).items()})

    @staticmethod
    def from_json(text: str) -> TreeTable:
        got = json.loads(text)
        kinds = {"slot": np.int64, "left": np.int64, "right": np.int64, "roots": np.int64, "cut": np.float64, "value": np.float64}
        return TreeTable(**{k: np.array(v, kinds[k]) if k in kinds else v for k, v in got.items()})


def tree_table(model, spark) -> TreeTable | None:
    """The nodes of a fitted tree model, None for models of another kind.

    They are read from the model's saved form, whose size does not depend on any data.
    """
    if isinstance(model, SecondOrderTreesModel):
        return model.table
    boosted = isinstance(model, GBTClassificationModel)
    if not boosted and not isinstance(model, RandomForestClassificationModel):
        return None
    path = work_folder(spark, "nodes")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    saved._written_to = path
    rows = saved.select("treeID", "nodeData.*").collect()
    forget(saved)
    rows.sort(key=lambda r: (r["treeID"], r["id"]))
    at = {(r["treeID"], r["id"]): i for i, r in enumerate(rows)}
    weights = model.treeWeights
    whole = sum(weights)
    n = len(rows)
    slot, cut = np.full(n, -1, np.int64), np.zeros(n)
    left, right, value = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    for i, r in enumerate(rows):
        t = r["treeID"]
        if boosted:  # a margin, of which the model takes the sigmoid of the double
            value[i] = 2 * weights[t] * r["prediction"]
        else:
            stats = r["impurityStats"]
            value[i] = weights[t] / whole * (stats[1] / sum(stats) if sum(stats) else 0.0)
        if r["leftChild"] < 0:
            continue
        split = r["split"]
        slot[i], left[i], right[i] = split["featureIndex"], at[t, r["leftChild"]], at[t, r["rightChild"]]
        if split["numCategories"] < 0:
            cut[i] = split["leftCategoriesOrThreshold"][0]
        elif split["numCategories"] == 2:  # an indicator; the listed value goes left
            cut[i] = 0.5
            if list(split["leftCategoriesOrThreshold"]) == [1.0]:
                left[i], right[i] = right[i], left[i]
        else:
            raise ValueError("splits over category codes are not supported; encode categories as indicators")
    roots = np.array([at[t, 0] for t in range(len(weights))], np.int64)
    return TreeTable(slot, cut, left, right, value, roots, 0.0, LOG_ODDS if boosted else PROBABILITY)


def rows_of(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


# --- second-order boosting ------------------------------------------------------------------


@dataclass(frozen=True)
class Growth:
    """How trees are grown.  ``least_weight`` bounds the curvature of a child from below."""

    rounds: int = 100
    depth: int = 6
    rate: float = 0.3
    rows_share: float = 1.0
    slots_share: float = 1.0
    least_weight: float = 1.0
    penalty: float = 1.0
    bins: int = 64
    seed: int = 42


BINNED = "grp int, block bigint, bins binary, y binary, w binary, margin binary"
SUMS = "problem int, sums binary"


def bin_edges(rows: DataFrame, slots: int, bins: int) -> list[np.ndarray]:
    """Cuts of every slot between its sketch quantiles; one pass, sketches merge."""
    marks = ", ".join(repr(i / bins) for i in range(bins + 1))
    x = rows.select(vector_to_array("features").alias("x"))
    got = x.selectExpr(*[f"percentile_approx(x[{j}], array({marks}), {20 * bins}) AS q{j}" for j in range(slots)]).first()
    out = []
    for j in range(slots):
        values = np.unique(np.array(got[j] or [], float))
        out.append((values[1:] + values[:-1]) / 2)
    return out


def binned(rows: DataFrame, edges: Sequence[np.ndarray], start: dict[int, float]) -> DataFrame:
    """(grp, features, label, weight) as blocks of bin numbers with the first margin of their group."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, number = np.asarray(batch.column(0)), batch.column(4)
            x, y, w = rows_of(batch.column(1)), np.asarray(batch.column(2)), np.asarray(batch.column(3))
            codes = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1).astype(np.uint8)
            for g in np.unique(group):
                own = np.flatnonzero(group == g)
                margin = np.full(len(own), start[int(g)])
                cells = [int(g), number[int(own[0])].as_py(), codes[own].tobytes(), y[own].tobytes(), w[own].tobytes(), margin.tobytes()]
                yield _record(cells)

    return rows.select(
        F.col("grp").cast("int"), vector_to_array("features").alias("x"), F.col("label").cast("double"),
        F.col("weight").cast("double"), F.monotonically_increasing_id().alias("number"),
    ).mapInArrow(blocks, BINNED)


def _record(cells: list) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array([c], t) for c, t in zip(cells, kinds)], names=["grp", "block", "bins", "y", "w", "margin"]
    )


@dataclass
class Growing:
    """One model while it grows: its trees over bin numbers, and the open level."""

    grp: int
    growth: Growth
    start: float
    slot: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)
    written: int = 0  # trees that the written margins hold already
    open: list[int] = field(default_factory=list)
    slots: np.ndarray | None = None

    def node(self) -> int:
        for own, new in ((self.slot, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            own.append(new)
        return len(self.slot) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(a) for a in (self.slot, self.bin, self.left, self.right, self.value))


def _reach(codes: np.ndarray, arrays: tuple[np.ndarray, ...], root: int) -> np.ndarray:
    """The deepest node of a tree that every row reaches."""
    slot, cut, left, right, _ = arrays
    node = np.full(len(codes), root)
    rows = np.arange(len(codes))
    while len(rows):
        rows = rows[slot[node[rows]] >= 0]
        own = node[rows]
        node[rows] = np.where(codes[rows, slot[own]] <= cut[own], left[own], right[own])
    return node


def _margins(codes: np.ndarray, margin: np.ndarray, arrays: tuple[np.ndarray, ...], roots: Sequence[int]) -> np.ndarray:
    out = margin.copy()
    for root in roots:
        out += arrays[4][_reach(codes, arrays, root)]
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for g, number, codes, y, w, margin in zip(*(batch.column(i) for i in range(6))):
            target = np.frombuffer(y.as_buffer())
            yield (
                g.as_py(), number.as_py(), np.frombuffer(codes.as_buffer(), np.uint8).reshape(len(target), -1),
                target, np.frombuffer(w.as_buffer()), np.frombuffer(margin.as_buffer()),
            )


def _histograms(batches: Iterator[pa.RecordBatch], plan: list[dict], sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of gradient and curvature per open node, slot and bin, of every model in ``plan``."""
    begin = np.concatenate(([0], np.cumsum(sizes)))
    width = int(begin[-1])
    sums: dict[int, np.ndarray] = {}
    for g, number, codes, y, w, margin in _rows(batches):
        for m in plan:
            if m["grp"] != g:
                continue
            now = _margins(codes, margin, m["arrays"], m["done"])
            p = 1 / (1 + np.exp(-now))
            slope, bend = w * (p - y), w * np.maximum(p * (1 - p), 1e-16)
            if m["rows_share"] < 1:
                kept = np.random.default_rng([m["seed"], m["tree"], number & 0x7FFFFFFF, number >> 31]).random(len(y)) < m["rows_share"]
                slope, bend = slope * kept, bend * kept
            node = _reach(codes, m["arrays"], m["root"])
            place = np.full(len(m["arrays"][0]), -1)
            place[m["open"]] = np.arange(len(m["open"]))
            at = place[node]
            use = np.flatnonzero(at >= 0)
            total = sums.setdefault(m["id"], np.zeros((2, len(m["open"]), width)))
            n = len(m["open"])
            for j in m["slots"]:
                size = int(sizes[j])
                spot = at[use] * size + codes[use, j]
                for k, what in enumerate((slope, bend)):
                    total[k, :, begin[j] : begin[j + 1]] += np.bincount(spot, what[use], n * size).reshape(n, size)
    for i, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["problem", "sums"])


def _with_margins(batches: Iterator[pa.RecordBatch], done: dict[int, tuple]) -> Iterator[pa.RecordBatch]:
    for g, number, codes, y, w, margin in _rows(batches):
        now = _margins(codes, margin, *done[g]) if g in done else margin
        yield _record([g, number, codes.tobytes(), y.tobytes(), w.tobytes(), now.tobytes()])


def _split(model: Growing, sums: np.ndarray, sizes: np.ndarray, last: bool) -> None:
    """Choose the best cut of every open node, or close it; children of the last level are leaves."""
    g = model.growth
    begin = np.concatenate(([0], np.cumsum(sizes)))
    slope, bend = sums
    opened: list[int] = []
    first = model.slots[0]
    for k, node in enumerate(model.open):
        all_s = slope[k, begin[first] : begin[first + 1]].sum()
        all_b = bend[k, begin[first] : begin[first + 1]].sum()
        model.value[node] = -g.rate * all_s / (all_b + g.penalty)
        best = (1e-9, -1, -1)
        for j in model.slots:
            left_s = np.cumsum(slope[k, begin[j] : begin[j + 1]])[:-1]
            left_b = np.cumsum(bend[k, begin[j] : begin[j + 1]])[:-1]
            if not len(left_s):
                continue
            right_s, right_b = all_s - left_s, all_b - left_b
            gain = left_s**2 / (left_b + g.penalty) + right_s**2 / (right_b + g.penalty) - all_s**2 / (all_b + g.penalty)
            gain[(left_b < g.least_weight) | (right_b < g.least_weight)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (float(gain[at]), int(j), at)
                sides = ((left_s[at], left_b[at]), (right_s[at], right_b[at]))
        if best[1] < 0:
            continue
        children = [model.node(), model.node()]
        for child, (s, b) in zip(children, sides):
            model.value[child] = -g.rate * s / (b + g.penalty)
        model.slot[node], model.bin[node] = best[1], best[2]
        model.left[node], model.right[node] = children
        opened += children
    model.open = [] if last else opened


def boost_many(rows: DataFrame, settings: Sequence[tuple[int, Growth]], slots: int) -> list[TreeTable]:
    """Boosted trees for every (group, growth): one job per level for all of them.

    ``rows`` holds ``grp, features, label, weight``; models of one group share its rows.  A
    model's margins are written into its group's blocks only where it is the group's only one;
    otherwise its trees are walked anew in every job.
    """
    bins = max((g.bins for _, g in settings), default=2)
    edges = bin_edges(rows, slots, min(bins, 255))
    sizes = np.array([len(e) + 1 for e in edges])
    priors = {
        r["grp"]: r["p"]
        for r in rows.groupBy("grp").agg((F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).alias("p")).collect()
    }
    odds = {g: float(np.log(np.clip(p, 1e-9, 1 - 1e-9) / (1 - np.clip(p, 1e-9, 1 - 1e-9)))) for g, p in priors.items()}
    models = [Growing(grp, growth, odds.get(grp, 0.0)) for grp, growth in settings]
    alone = {m.grp for m in models if sum(o.grp == m.grp for o in models) == 1}
    blocks = written(binned(rows, edges, odds), "binned")
    tasks = blocks.rdd.getNumPartitions()
    for tree in range(max((g.rounds for _, g in settings), default=0)):
        live = [(i, m) for i, m in enumerate(models) if tree < m.growth.rounds and m.grp in odds]
        for _, m in live:
            m.roots.append(m.node())
            m.open = [m.roots[-1]]
            n = max(1, round(m.growth.slots_share * slots))
            m.slots = np.sort(np.random.default_rng([m.growth.seed, tree]).choice(slots, n, replace=False))
        for level in range(max(m.growth.depth for _, m in live)):
            plan = [
                {
                    "id": i, "grp": m.grp, "arrays": m.arrays(), "done": m.roots[m.written : -1], "root": m.roots[-1],
                    "open": m.open, "slots": m.slots, "tree": tree, "seed": m.growth.seed, "rows_share": m.growth.rows_share,
                }
                for i, m in live if m.open and level < m.growth.depth
            ]
            if not plan:
                break
            sums = blocks.mapInArrow(lambda it, plan=plan: _histograms(it, plan, sizes), SUMS)
            size = sum(16 * len(p["open"]) * int(sizes.sum()) for p in plan)
            for i, own in total_sums(sums, tasks, size).items():
                m = models[i]
                _split(m, own.reshape(2, len(m.open), -1), sizes, level + 1 == m.growth.depth)
        if (tree + 1) % TREES_PER_WRITE == 0 and alone:
            done = {m.grp: (m.arrays(), m.roots[m.written :]) for _, m in live if m.grp in alone}
            fresh = written(blocks.mapInArrow(lambda it, done=done: _with_margins(it, done), BINNED), "binned")
            forget(blocks)
            blocks = fresh
            for _, m in live:
                m.written = len(m.roots) if m.grp in alone else 0
    forget(blocks)
    return [_table(m, edges) for m in models]


def _table(m: Growing, edges: Sequence[np.ndarray]) -> TreeTable:
    slot, cut, left, right, value = m.arrays() if m.slot else (np.zeros(0),) * 5
    cuts = np.array([edges[s][b] if s >= 0 else 0.0 for s, b in zip(slot.astype(int), cut.astype(int))], float)
    whole = lambda a: a.astype(np.int64)
    return TreeTable(whole(slot), cuts, whole(left), whole(right), value.astype(float), np.array(m.roots, np.int64), m.start, LOG_ODDS)


class _TreeParams(HasFeaturesCol, HasLabelCol, HasWeightCol, HasProbabilityCol, HasSeed):
    maxIter = Param(Params._dummy(), "maxIter", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits of a tree", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of a tree's values that is added", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows a tree sees", TypeConverters.toFloat)
    slotShare = Param(Params._dummy(), "slotShare", "share of the slots a tree may split on", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least curvature of a child", TypeConverters.toFloat)
    penalty = Param(Params._dummy(), "penalty", "added to the curvature of a node", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a slot, 255 at most", TypeConverters.toInt)


class SecondOrderTrees(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees with second-order gains, child weights, row and slot sampling.

    The rows are binned once; every level of a tree is one job that adds up histograms.
    """

    @keyword_only
    def __init__(
        self, featuresCol="features", labelCol="label", weightCol="weight", probabilityCol="probability", seed=42, maxIter=100,
        maxDepth=6, stepSize=0.3, subsamplingRate=1.0, slotShare=1.0, minChildWeight=1.0, penalty=1.0, maxBins=64,
    ):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(
            featuresCol=featuresCol, labelCol=labelCol, weightCol=weightCol, probabilityCol=probabilityCol, seed=seed,
            maxIter=maxIter, maxDepth=maxDepth, stepSize=stepSize, subsamplingRate=subsamplingRate, slotShare=slotShare,
            minChildWeight=minChildWeight, penalty=penalty, maxBins=maxBins,
        )

    def growth(self) -> Growth:
        get = lambda name: self.getOrDefault(name)
        return Growth(
            get("maxIter"), get("maxDepth"), get("stepSize"), get("subsamplingRate"), get("slotShare"),
            get("minChildWeight"), get("penalty"), get("maxBins"), get("seed"),
        )

    def _fit(self, dataset: DataFrame) -> SecondOrderTreesModel:
        rows = dataset.select(
            F.lit(0).alias("grp"), F.col(self.getFeaturesCol()).alias("features"),
            F.col(self.getLabelCol()).cast("double").alias("label"), F.col(self.getWeightCol()).cast("double").alias("weight"),
        )
        first = rows.select(F.size(vector_to_array("features")).alias("n")).first()
        table = boost_many(rows, [(0, self.growth())], first["n"] if first else 0)[0]
        model = SecondOrderTreesModel(nodes=table.to_json(), slots=first["n"] if first else 0)
        return model._set(featuresCol=self.getFeaturesCol(), probabilityCol=self.getProbabilityCol())


class SecondOrderTreesModel(Model, HasFeaturesCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable):
    nodes = Param(Params._dummy(), "nodes", "the table of nodes as JSON", TypeConverters.toString)
    slots = Param(Params._dummy(), "slots", "length of the feature vector", TypeConverters.toInt)

    @keyword_only
    def __init__(self, nodes=None, slots=None, featuresCol="features", probabilityCol="probability"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def table(self) -> TreeTable:
        return TreeTable.from_json(self.getOrDefault("nodes"))

    @property
    def featureImportances(self):
        """Share of every slot in the movement of means along the splits."""
        t = self.table
        inner = np.flatnonzero(t.slot >= 0)
        moved = np.abs(t.value[t.left[inner]] - t.value[inner]) + np.abs(t.value[t.right[inner]] - t.value[inner])
        total = np.bincount(t.slot[inner], moved, minlength=self.getOrDefault("slots"))
        return Vectors.dense(total / (total.sum() or 1.0))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        table = self.table
        @F.pandas_udf("double")
        def probability(x: pd.Series) -> pd.Series:
            return pd.Series(table.probability(table.totals(np.stack(x.to_numpy())) if len(x) else np.zeros(0)))

        p = probability(vector_to_array(F.col(self.getFeaturesCol())))
        return dataset.withColumn("__p", p).withColumn(
            self.getProbabilityCol(), array_to_vector(F.array(1 - F.col("__p"), F.col("__p")))
        ).drop("__p")
