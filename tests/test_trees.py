"""Node tables and second-order boosting."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickscore.operators import evaluation as G
from clickscore.operators import learning as L
from clickscore.operators import trees as T


def matrix(df, model):
    rows = L.transform_rows(df, model).select(
        F.col("_row.row_id").alias("row_id"), vector_to_array("features").alias("x"), L.positive_probability(model).alias("p")
    ).orderBy("row_id").collect()
    return np.array([r["x"] for r in rows]), np.array([r["p"] for r in rows])


@pytest.fixture(scope="module")
def forest(spark):
    from catalog import queries
    from conftest import SMALL

    return queries.fitted(spark, SMALL, "forest")


@pytest.mark.parametrize("family", ["trees", "forest"])
def test_walks_give_the_models_probability(spark, unique, family, request):
    model = request.getfixturevalue(family)
    table = T.tree_table(model.stages[-1], spark)
    x, p = matrix(unique, model)
    assert np.abs(table.probability(table.totals(x)) - p).max() < 1e-9
    moved = table.contributions(x)
    assert np.abs(table.start + moved.sum(axis=1) - table.totals(x)).max() < 1e-9
    # A slot that no split on the row's path uses has no part in it.
    assert (moved[:, [j for j in range(x.shape[1]) if j not in set(table.slot)]] == 0).all()
    some = table.totals(x, table.roots[:2]) + table.totals(x, table.roots[2:]) + table.base
    assert np.abs(some - table.totals(x)).max() < 1e-9
    again = T.TreeTable.from_json(table.to_json())
    assert (again.totals(x) == table.totals(x)).all()


def data(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = np.column_stack((rng.normal(size=(n, 3)), rng.integers(0, 2, n)))
    z = np.where(x[:, 0] * x[:, 1] > 0, 1.5, -1.5) + 2 * (x[:, 3] > 0) * (x[:, 2] > 0.3) - 0.5
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(float)
    rows = [(0, Vectors.dense(a), float(b), 1.0) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, ["grp", "features", "label", "weight"]).repartition(4).persist()


def plain_tree(x, y, w, edges, g, start):
    """One round by looking at every cut of every node."""
    p = 1 / (1 + np.exp(-start))
    s, b = w * (p - y), w * p * (1 - p)

    def grow(rows, depth):
        value = -g.rate * s[rows].sum() / (b[rows].sum() + g.penalty)
        best, score = None, lambda r: s[r].sum() ** 2 / (b[r].sum() + g.penalty)
        if depth < g.depth:
            for j, cuts in enumerate(edges):
                for c in cuts:
                    l, r = rows[x[rows, j] <= c], rows[x[rows, j] > c]
                    if b[l].sum() >= g.least_weight and b[r].sum() >= g.least_weight:
                        gain = score(l) + score(r) - score(rows)
                        if gain > (best[0] if best else 1e-9) + 1e-12:
                            best = (gain, l, r)
        if best is None:
            return {int(i): value for i in rows}
        return grow(best[1], depth + 1) | grow(best[2], depth + 1)

    return grow(np.arange(len(x)), 0)


def test_a_round_is_the_best_tree_by_brute_force(spark):
    df = data(spark, 300, 1)
    g = T.Growth(rounds=1, depth=3, rate=0.5, least_weight=3.0, bins=16)
    table = T.boost_many(df, [(0, g)], 4)[0]
    rows = df.collect()
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([r["label"] for r in rows])
    edges = T.bin_edges(df, 4, 16)
    want = plain_tree(x, y, np.ones(len(y)), edges, g, np.full(len(y), table.base))
    got = table.totals(x) - table.base
    assert np.abs(got - [want[i] for i in range(len(y))]).max() < 1e-9


def test_margins_written_or_walked_give_the_same_trees(spark, monkeypatch):
    df = data(spark, 400, 2)
    g = T.Growth(rounds=5, depth=2, rows_share=0.8, slots_share=0.75, bins=8)
    whole = T.boost_many(df, [(0, g)], 4)[0]
    monkeypatch.setattr(T, "TREES_PER_WRITE", 2)
    often = T.boost_many(df, [(0, g)], 4)[0]
    both = T.boost_many(df, [(0, g), (0, T.Growth(rounds=3, depth=1, bins=8))], 4)
    for other in (often, both[0]):
        assert (other.slot == whole.slot).all() and np.abs(other.value - whole.value).max() < 1e-9
    assert len(both[1].roots) == 3 and len(whole.roots) == 5


def test_held_out_precision_at_least_that_of_the_librarys_trees(spark):
    fit, held = data(spark, 1500, 3), data(spark, 1500, 4)
    mine = T.SecondOrderTrees(maxIter=20, maxDepth=4, stepSize=0.3).fit(fit)
    other = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.3, weightCol="weight", seed=1).fit(fit)

    def precision(model):
        scored = model.transform(held).select("label", vector_to_array("probability")[1].alias("probability"))
        return G.ranking_value(scored, "pr_auc")

    assert precision(mine) >= precision(other)
    weights = mine.featureImportances.toArray()
    assert weights.sum() == pytest.approx(1) and weights.min() > 0


def test_boosted_pipeline_is_saved_and_scores(spark, training, tmp_path):
    model = L.fit_model(T.SecondOrderTrees(labelCol=L.LABEL, weightCol=L.WEIGHT, maxIter=3, maxDepth=3), training)
    path = str(tmp_path / "boosted")
    model.write().save(path)
    rows = training.limit(100)
    a, b = (L.probability_of(rows, m).orderBy("row_id").collect() for m in (model, PipelineModel.load(path)))
    assert [r["probability"] for r in a] == [r["probability"] for r in b]
    assert len({r["probability"] for r in a}) > 2
