"""Many logistic regressions at once: every fold and candidate takes its step in the same job.

A fit needs, per step, only sums over the rows: loss, gradient and curvature.  One pass over the
blocks of all folds collects these sums for every open problem, and the driver, which holds a
few thousand numbers per problem, takes a Newton step for each.  So sixty fits cost as many jobs
as the slowest one has steps, about ten, and not as many as all of them together.

The objective is that of the single fit without standardisation: weighted mean loss plus
``reg * (elastic * |b| + (1 - elastic) / 2 * b**2)`` over the coefficients, the intercept free.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The curvature has the square of the slots: beyond this, fit one by one with a gradient method.
MOST_SLOTS = 512
MOST_STEPS = 100
#: Sums of one step that the driver adds up itself.
DRIVER_BYTES = 64 << 20
TOLERANCE = 1e-9
SWEEPS = 60
#: Rows whose products of slots are taken at once, so that they fit a core's cache.
ROWS_AT_ONCE = 1000

PACKED = "grp int, n int, x binary, y binary, w binary"


def packed(rows: DataFrame) -> DataFrame:
    """(grp, features, label, weight) as blocks of numbers, one per Arrow batch and group."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = np.asarray(batch.column(0))
            x = batch.column(1)
            width = np.asarray(x.value_lengths())
            start = np.concatenate(([0], np.cumsum(width)))
            values = x.flatten().to_numpy(zero_copy_only=False)
            y, w = np.asarray(batch.column(2)), np.asarray(batch.column(3))
            for g in np.unique(group):
                at = np.flatnonzero(group == g)
                own = np.stack([values[start[i] : start[i + 1]] for i in at])
                cells = [[int(g)], [len(at)], [own.tobytes()], [y[at].tobytes()], [w[at].tobytes()]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cells, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                    names=["grp", "n", "x", "y", "w"],
                )

    return rows.select(
        F.col("grp").cast("int"), vector_to_array("features").alias("x"),
        F.col("label").cast("double"), F.col("weight").cast("double"),
    ).mapInArrow(blocks, PACKED)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for g, n, x, y, w in zip(*(batch.column(i) for i in range(5))):
            own = np.frombuffer(x.as_buffer(), np.float64).reshape(n.as_py(), -1)
            yield g.as_py(), own, np.frombuffer(y.as_buffer()), np.frombuffer(w.as_buffer())


@dataclass
class Problem:
    """One fit: where it is, where it tries next, and what is known of both."""

    grp: int
    reg: float
    elastic: float
    at: np.ndarray = field(default=None, repr=False)
    trial: np.ndarray = field(default=None, repr=False)
    step: np.ndarray = field(default=None, repr=False)
    value: float = np.inf
    share: float = 1.0
    steps: int = 0
    done: bool = False

    @property
    def l1(self) -> float:
        return self.reg * self.elastic

    @property
    def l2(self) -> float:
        return self.reg * (1 - self.elastic)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, weight and weighted positives of every group, with its number of slots."""
    for g, x, y, w in _blocks(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array([g], pa.int32()), pa.array([x.shape[1]], pa.int32()), pa.array([float(w.sum())]), pa.array([float((w * y).sum())])],
            names=["grp", "d", "w", "p"],
        )


def _curvature(ones: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted products of all pairs of slots, for every column of weights; none is negative.

    A matrix times its own transpose takes half the work, and is symmetric to the last bit.
    """
    root = np.sqrt(weight)
    total = np.zeros((weight.shape[1], ones.shape[1], ones.shape[1]))
    for at in range(0, len(ones), ROWS_AT_ONCE):
        some, share = ones[at : at + ROWS_AT_ONCE], root[at : at + ROWS_AT_ONCE]
        for k in range(weight.shape[1]):
            half = some * share[:, k : k + 1]
            total[k] += half.T @ half
    return total


def _sums(batches: Iterator[pa.RecordBatch], points: dict[int, dict[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Loss, gradient and curvature of every problem over the rows of one task, on end."""
    total: dict[int, np.ndarray] = {}
    for g, x, y, w in _blocks(batches):
        if g not in points:
            continue
        ids = list(points[g])
        ones = np.column_stack((x, np.ones(len(x))))
        z = ones @ np.stack([points[g][i] for i in ids], 1)
        p = 1 / (1 + np.exp(-z))
        loss = w @ (np.logaddexp(0, z) - y[:, None] * z)
        slope = ones.T @ (w[:, None] * (p - y[:, None]))
        bend = _curvature(ones, w[:, None] * p * (1 - p))
        for k, i in enumerate(ids):
            own = np.concatenate(([loss[k]], slope[:, k], bend[k].ravel()))
            total[i] = total[i] + own if i in total else own
    for i, own in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([own.tobytes()], pa.binary())], names=["problem", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, own in zip(batch.column(0).to_pylist(), batch.column(1)):
            values = np.frombuffer(own.as_buffer())
            total[i] = total[i] + values if i in total else values
    for i, own in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([own.tobytes()], pa.binary())], names=["problem", "sums"])


def total_sums(sums: DataFrame, tasks: int, task_bytes: int) -> dict[int, np.ndarray]:
    """``(problem, sums)`` of all tasks added up by problem.

    The driver adds them where what all ``tasks`` send has a small bound; beyond it Spark does,
    by problem, and the driver sees one row for each.
    """
    if tasks * task_bytes > DRIVER_BYTES:
        sums = sums.repartition("problem").mapInArrow(_added, "problem int, sums binary")
    total: dict[int, np.ndarray] = {}
    for r in sums.collect():
        values = np.frombuffer(bytes(r["sums"]))
        total[r["problem"]] = total[r["problem"]] + values if r["problem"] in total else values
    return total


def _newton(slope: np.ndarray, bend: np.ndarray, at: np.ndarray, l1: float) -> np.ndarray:
    """The step to the lowest point of the local parabola plus the absolute penalty.

    A sweep over the coordinates proposes which coefficients are not zero and their signs, and
    a linear system solves for those; both repeat until no coefficient wants to change sides.
    """
    n = len(at)
    bend = bend + np.eye(n) * 1e-12 * max(np.trace(bend), 1e-300)
    if l1 == 0:
        return -np.linalg.lstsq(bend, slope, rcond=None)[0]
    cost = np.append(np.full(n - 1, l1), 0.0)  # the intercept is free
    x, pull = at.copy(), slope.copy()  # pull: gradient of the parabola at x

    def height(v: np.ndarray) -> float:
        return float(slope @ (v - at) + (v - at) @ bend @ (v - at) / 2 + cost @ np.abs(v))

    for _ in range(SWEEPS):
        for j in range(n):
            goal = x[j] - pull[j] / bend[j, j]
            goal = np.sign(goal) * max(abs(goal) - cost[j] / bend[j, j], 0.0)
            if goal != x[j]:
                pull += (goal - x[j]) * bend[:, j]
                x[j] = goal
        own = np.flatnonzero((x != 0) | (cost == 0))
        while len(own):
            sign = np.sign(x[own])
            move = -np.linalg.solve(bend[np.ix_(own, own)], pull[own] + cost[own] * sign)
            crosses = (cost[own] > 0) & (sign * (x[own] + move) < 0)
            trial = x.copy()
            trial[own] = np.where(crosses, 0.0, x[own] + move)
            if crosses.any() and height(trial) > height(x):  # no further than the first that reaches zero
                share = np.min(-x[own][crosses] / move[crosses])
                trial[own] = x[own] + share * move
                trial[own[crosses][np.argmin(np.abs(trial[own][crosses]))]] = 0.0
            x = trial
            pull = slope + bend @ (x - at)
            if not crosses.any():
                break
            own = np.flatnonzero((x != 0) | (cost == 0))
        off = np.where((x != 0) | (cost == 0), np.abs(pull + cost * np.sign(x)), np.maximum(np.abs(pull) - cost, 0.0))
        if off.max() <= 1e-13 + 1e-10 * np.abs(slope).max():
            break
    return x - at


def fit_many(blocks: DataFrame, settings: Sequence[tuple[int, float, float]], max_steps: int = MOST_STEPS) -> list[np.ndarray]:
    """Coefficients, the intercept last, for every (group, reg, elastic); one job per step.

    ``blocks`` comes from ``packed``.  A group without rows gets an empty array.
    """
    known = {
        r["grp"]: r
        for r in blocks.mapInArrow(_totals, "grp int, d int, w double, p double")
        .groupBy("grp").agg(F.max("d").alias("d"), F.sum("w").alias("w"), F.sum("p").alias("p")).collect()
    }
    if any(r["d"] > MOST_SLOTS for r in known.values()):
        raise ValueError(f"more than {MOST_SLOTS} slots: fit these candidates one by one")
    problems = [Problem(*s) for s in settings]
    for q in problems:
        if q.grp not in known:
            q.at, q.done = np.zeros(0), True
            continue
        size, pos = known[q.grp]["w"], known[q.grp]["p"]
        q.at = np.zeros(known[q.grp]["d"] + 1)
        if 0 < pos < size:
            q.at[-1] = np.log(pos / (size - pos))
            q.trial = q.at
        else:  # one class only: the prior, as far as doubles tell it
            q.at[-1], q.done = (np.inf if pos > 0 else -np.inf), True
    tasks = blocks.rdd.getNumPartitions()
    while any(not q.done for q in problems):
        points: dict[int, dict[int, np.ndarray]] = {}
        for i, q in enumerate(problems):
            if not q.done:
                points.setdefault(q.grp, {})[i] = q.trial
        sums = blocks.mapInArrow(lambda it, points=points: _sums(it, points), "problem int, sums binary")
        size = sum(8 * (len(q.trial) + 1) ** 2 for q in problems if not q.done)
        for i, own in total_sums(sums, tasks, size).items():
            _advance(problems[i], own, known[problems[i].grp]["w"], max_steps)
    return [q.at for q in problems]


def _advance(q: Problem, sums: np.ndarray, size: float, max_steps: int) -> None:
    """Accept the trial point or halve the step; then choose the next trial."""
    n = len(q.trial)
    own = np.append(np.ones(n - 1), 0.0)
    value = sums[0] / size + q.l1 * np.abs(q.trial * own).sum() + q.l2 / 2 * ((q.trial * own) ** 2).sum()
    q.steps += 1
    if value > q.value * (1 + 1e-13) + 1e-15:
        q.share /= 2
        q.trial = q.at + q.share * q.step
        q.done = q.share < 1e-8 or q.steps >= max_steps
        return
    # Steps shrink fast once they are whole, so one that gains next to nothing is the last.
    settled = q.share == 1.0 and q.value - value <= 1e-13 * abs(value)
    q.at, q.value, q.share = q.trial, value, 1.0
    slope = sums[1 : n + 1] / size + q.l2 * own * q.at
    bend = sums[n + 1 :].reshape(n, n) / size + np.diag(q.l2 * own)
    q.step = _newton(slope, bend, q.at, q.l1)
    q.trial = q.at + q.step
    small = np.abs(q.step).max() <= TOLERANCE * max(1.0, np.abs(q.at).max())
    q.done = bool(small) or settled or q.steps >= max_steps


def scores_many(blocks: DataFrame, fits: dict[int, tuple[int, np.ndarray]]) -> DataFrame:
    """(problem, label, probability) of every row of ``blocks`` under the problems of its group."""
    by_group: dict[int, list[tuple[int, np.ndarray]]] = {}
    for i, (g, at) in fits.items():
        by_group.setdefault(g, []).append((i, at))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, x, y, _ in _blocks(batches):
            for i, at in by_group.get(g, []):
                z = x @ at[:-1] + at[-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), i, np.int32)), pa.array(y.astype(np.int32)), pa.array(1 / (1 + np.exp(-z)))],
                    names=["problem", "label", "probability"],
                )

    return blocks.mapInArrow(run, "problem int, label int, probability double")
