"""Batched logistic regression against single fits."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickscore.operators import batched as B
from clickscore.operators import learning as L


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    out = []
    for g, d in ((0, 4), (1, 6)):
        true = rng.normal(size=d)
        x = rng.normal(size=(300, d)) * np.linspace(0.5, 3, d)
        x[:, 1] = rng.integers(0, 2, 300)
        p = 1 / (1 + np.exp(-(x @ true) * 0.5 + 0.3))
        y = (rng.random(300) < p).astype(float)
        out += [(g, Vectors.dense(a), float(b), float(1.0 + 0.5 * b)) for a, b in zip(x, y)]
    return spark.createDataFrame(out, ["grp", "features", "label", "weight"]).repartition(5).persist()


SETTINGS = [(g, reg, elastic) for g in (0, 1) for reg in (1e-4, 1e-2, 0.2) for elastic in (0.0, 0.5, 1.0)]


def test_same_coefficients_as_single_fits(rows):
    got = B.fit_many(B.packed(rows), SETTINGS)
    for (g, reg, elastic), at in zip(SETTINGS, got):
        single = LogisticRegression(
            labelCol="label", weightCol="weight", regParam=reg, elasticNetParam=elastic, maxIter=2000, tol=1e-12, standardization=False
        ).fit(rows.filter(f"grp = {g}"))
        want = [*single.coefficients.toArray(), single.intercept]
        assert np.abs(at - want).max() < 1e-4, (g, reg, elastic)


def test_scores_of_the_fits(rows):
    blocks = B.packed(rows)
    fits = B.fit_many(blocks, SETTINGS[:2])
    got = B.scores_many(blocks, {0: (0, fits[0]), 1: (0, fits[1])}).groupBy("problem").count().collect()
    assert {tuple(r) for r in got} == {(0, 300), (1, 300)}
    model = LogisticRegression(labelCol="label", weightCol="weight", regParam=1e-4, maxIter=2000, tol=1e-12, standardization=False)
    scored = model.fit(rows.filter("grp = 0")).transform(rows.filter("grp = 0"))
    want = sorted(float(r["probability"][1]) for r in scored.collect())
    mine = sorted(r["probability"] for r in B.scores_many(blocks, {0: (0, fits[0])}).collect())
    assert np.abs(np.array(want) - mine).max() < 1e-4


def test_one_class_and_no_rows(spark, rows):
    blocks = B.packed(rows.filter("grp = 1 AND label = 1"))
    empty, prior = B.fit_many(blocks, [(0, 0.1, 0.0), (1, 0.1, 0.0)])
    assert len(empty) == 0 and prior[-1] == np.inf and not prior[:-1].any()


def test_search_means_equal_fits_one_by_one(spark, training):
    folds = L.fold_vectors(training.withColumn("fold", F.col("fold") % 2))
    base = dict(labelCol=L.LABEL, weightCol=L.WEIGHT, maxIter=500, tol=1e-9)
    together = LogisticRegression(standardization=False, **base)
    maps = [{together.regParam: r, together.elasticNetParam: e} for r, e in ((1e-2, 0.0), (1e-2, 1.0))]
    got = L.cross_validate(together, maps, folds)
    score = L.AveragePrecisionEvaluator()
    for m, value in zip(maps, got):
        single = [score.evaluate(together.fit(a, m).transform(b)) for a, b in folds.pairs()]
        assert value == pytest.approx(np.mean(single), abs=1e-3)
    folds.release()


def test_converged_model_is_a_plain_model(spark, training, tmp_path):
    base = dict(labelCol=L.LABEL, weightCol=L.WEIGHT, regParam=1e-2, standardization=False)
    model = L.fit_converged(LogisticRegression(**base), training)
    want = L.fit_model(LogisticRegression(maxIter=500, tol=1e-10, **base), training)
    a, b = model.stages[-1], want.stages[-1]
    assert np.abs(a.coefficients.toArray() - b.coefficients.toArray()).max() < 1e-4
    assert a.intercept == pytest.approx(b.intercept, abs=1e-4)
    path = str(tmp_path / "model")
    model.write().save(path)
    again = PipelineModel.load(path)
    rows = training.limit(50)
    first, second = (L.probability_of(rows, m).orderBy("row_id").collect() for m in (model, again))
    assert [r["probability"] for r in first] == [r["probability"] for r in second]


def test_curvature_is_the_weighted_product_of_slots(monkeypatch):
    monkeypatch.setattr(B, "ROWS_AT_ONCE", 7)
    rng = np.random.default_rng(1)
    ones, weight = rng.normal(size=(23, 5)), rng.random((23, 3))
    weight[::4] = 0
    got = B._curvature(ones, weight)
    assert np.array_equal(got, got.transpose(0, 2, 1))
    assert np.allclose(got, [(ones * weight[:, k : k + 1]).T @ ones for k in range(3)], rtol=1e-13, atol=1e-13)
    assert not B._curvature(ones[:0], weight[:0]).any()
