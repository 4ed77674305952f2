"""Feature pipeline, classifiers, search and model inspection on Spark ML.

Every fitted statistic lives inside the pipeline, so cross-validation refits it on
each training fold.  Fitted stages are plain Spark ML stages: a saved model loads
without this package.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasInputCols, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscore.contract import FOLDS, SEARCH_DRAWS, SEED, SESSION, Contract
from clickscore.functions.features import DERIVED_FROM, FEATURE_SQL, feature_exprs
from clickscore.functions.numbers import clean_number, number_sql
from clickscore.operators import batched
from clickscore.operators import evaluation as G
from clickscore.operators.profiling import value_counts
from clickscore.operators.quantiles import exact_percentiles
from clickscore.operators.trees import SecondOrderTrees
from clickscore.operators.splitting import balanced_weight, sample_params, stratified_folds
from clickscore.session import forget, written

Z, S, I, V = "__z", "__s", "__i", "__v"  # suffixes of intermediate columns
LABEL, WEIGHT, FOLD = "label", "weight", "fold"


def _literal(v: float | None) -> str:
    return f"{float(v or 0.0)!r}D"


def _text(v: str) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


class NumericBranch(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Median imputation, then scaling by mean and population deviation."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        cols = self.getInputCols()
        mid = {c: v[0] for c, v in exact_percentiles(dataset, {c: (number_sql(c), [0.5]) for c in cols}).items()}
        filled = {c: f"coalesce({number_sql(c)}, {_literal(mid[c])})" for c in cols}
        got = dataset.selectExpr(
            *[f"{f}({filled[c]}) AS {k}{i}" for i, c in enumerate(cols)
              for k, f in (("m", "avg"), ("s", "stddev_pop"))]
        ).first()
        items = ["*"]
        for i, c in enumerate(cols):
            scale = got[f"s{i}"] or 1.0
            items.append(
                f"({filled[c]} - {_literal(got[f'm{i}'])}) / {_literal(scale)} AS `{c}{Z}`"
            )
        return SQLTransformer(statement=f"SELECT {', '.join(items)} FROM __THIS__")


class CategoryBranch(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Categories as text, NULL replaced by the most frequent (smallest on ties)."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        cols = self.getInputCols()
        flags = {f.name for f in dataset.schema.fields if f.dataType.typeName() == "boolean"}
        modes = mode_levels(dataset, cols)
        items = ["*"]
        for c in cols:
            text = f"CAST(`{c}` AS STRING)"
            fill = modes.get(c, "")
            if c in flags:
                text, fill = f"initcap({text})", {"1": "True", "0": "False"}.get(fill, "False")
            items.append(f"coalesce({text}, {_text(fill)}) AS `{c}{S}`")
        return SQLTransformer(statement=f"SELECT {', '.join(items)} FROM __THIS__")


def mode_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column as text, smallest on ties."""
    slots = ("whole", "real", "text")
    rows = (
        value_counts(df, columns)
        .filter(F.coalesce(*[F.col(s).cast("string") for s in slots]).isNotNull())
        .groupBy("column")
        .agg(F.min(F.struct((-F.col("n")).alias("rank"), *slots)).alias("best"))
        .select(
            "column",
            F.coalesce(*[F.col(f"best.{s}").cast("string") for s in slots]).alias("level"),
        )
        .collect()  # one row per column
    )
    return {r["column"]: r["level"] for r in rows}


def median_impute(df: DataFrame, columns: Sequence[str] = SESSION.numeric) -> DataFrame:
    clean = {c: clean_number(F.col(c)) for c in columns}
    mid = exact_percentiles(df, {c: (number_sql(c), [0.5]) for c in columns})
    return df.withColumns(
        {c: F.coalesce(clean[c], F.lit(mid[c][0]).cast("double")) for c in columns}
    )


def mode_impute(df: DataFrame, columns: Sequence[str] = SESSION.categorical) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    modes = mode_levels(df, columns)
    fill = {
        c: F.coalesce(F.col(c), _mode_value(modes[c], types[c])) for c in columns if c in modes
    }
    return df.withColumns(fill) if fill else df


def _mode_value(level: str, dtype):
    if dtype.typeName() == "boolean":
        return F.lit(level == "1")
    return F.lit(level).cast(dtype)


def standard_scale(df: DataFrame, columns: Sequence[str] = SESSION.numeric) -> DataFrame:
    """(x - mean) / population deviation; a constant column is only centred.

    Cells that are not finite are missing, in the statistics and in the result.
    """
    got = df.selectExpr(
        *[f"{f}({number_sql(c)}) AS {k}{i}" for i, c in enumerate(columns) for k, f in (("m", "avg"), ("s", "stddev_pop"))]
    ).first()
    return df.withColumns(
        {
            c: (clean_number(F.col(c)) - F.lit(got[f"m{i}"])) / F.lit(got[f"s{i}"] or 1.0)
            for i, c in enumerate(columns)
        }
    )


def feature_stages(contract: Contract = SESSION) -> list:
    """Derived features, both branches, one-hot vectors and the assembled vector."""
    cats = list(contract.categorical)
    stages = [
        SQLTransformer(statement=f"SELECT {', '.join(feature_exprs())} FROM __THIS__"),
        NumericBranch(inputCols=list(contract.all_numeric)),
    ]
    inputs = [f"{c}{Z}" for c in contract.all_numeric]
    if cats:
        stages += [
            CategoryBranch(inputCols=cats),
            # Unknown levels get the extra index, which the encoder drops: all zeros.
            StringIndexer(
                inputCols=[f"{c}{S}" for c in cats],
                outputCols=[f"{c}{I}" for c in cats],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(
                inputCols=[f"{c}{I}" for c in cats],
                outputCols=[f"{c}{V}" for c in cats],
                dropLast=True,
            ),
        ]
        inputs += [f"{c}{V}" for c in cats]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return stages


def build_pipeline(classifier, contract: Contract = SESSION, drop: Sequence[str] = ()) -> Pipeline:
    kept = contract.without(*drop) if drop else contract
    return Pipeline(stages=[*feature_stages(kept), classifier])


def training_frame(
    df: DataFrame, contract: Contract = SESSION, row_id: str = "row_id", k: int | None = FOLDS
) -> DataFrame:
    """Features, 0/1 label, balanced row weight and a stratified fold number."""
    out = df.select(
        row_id, *contract.features, F.col(contract.target).cast("int").cast("double").alias(LABEL)
    ).filter(F.col(LABEL).isNotNull())
    out = out.withColumn(WEIGHT, balanced_weight(out, LABEL))
    return stratified_folds(out, LABEL, row_id, k) if k else out


def fitted_levels(model: PipelineModel) -> dict[str, list[str]]:
    """Levels the encoder knows, per categorical column."""
    out: dict[str, list[str]] = {}
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            for c, labels in zip(stage.getInputCols(), stage.labelsArray):
                out[c.removesuffix(S)] = list(labels)
    return out


def fitted_levels_table(model: PipelineModel, spark) -> DataFrame:
    rows = [(c, i, v) for c, vs in fitted_levels(model).items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "column string, position int, level string")


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the vector slots, in model order: columns first, then column_level."""
    levels = fitted_levels(model)
    names: list[str] = []
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            for c in stage.getInputCols():
                if c.endswith(Z):
                    names.append(c.removesuffix(Z))
                else:
                    source = c.removesuffix(V)
                    names += [f"{source}_{level}" for level in levels[source]]
    return names


def model_inputs(model: PipelineModel) -> set[str]:
    """Columns the model reads."""
    used: set[str] = set(DERIVED_FROM)
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            used |= {c.removesuffix(Z).removesuffix(V) for c in stage.getInputCols()}
    return used - set(FEATURE_SQL)


def transform_rows(df: DataFrame, model: PipelineModel, row: str = "_row") -> DataFrame:
    """Run the model on its own inputs; the caller's row travels along as one struct.

    Whatever else the caller's columns are called, they cannot collide with the
    model's.  Catalyst folds the struct away again where a field is read.
    """
    needed = model_inputs(model)
    inputs = [c for c in df.columns if c in needed]
    return model.transform(df.select(F.struct("*").alias(row), *inputs))


def positive_probability(model: PipelineModel):
    return vector_to_array(F.col(model.stages[-1].getProbabilityCol())).getItem(1)


def probability_of(df: DataFrame, model: PipelineModel, name: str = "probability") -> DataFrame:
    """The caller's columns plus the positive-class probability."""
    kept = [F.col(f"_row.`{c}`").alias(c) for c in df.columns if c != name]
    return transform_rows(df, model).select(*kept, positive_probability(model).alias(name))


def feature_importance(model: PipelineModel, spark, top: int | None = None) -> DataFrame:
    last = model.stages[-1]
    if isinstance(last, LogisticRegressionModel):
        values = [abs(float(v)) for v in last.coefficients.toArray()]
    elif hasattr(last, "featureImportances"):
        values = [float(v) for v in last.featureImportances.toArray()]
    else:
        values = []
    rows = list(zip(feature_names(model), values)) if values else []
    out = spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
    return out.limit(top) if top else out


class AveragePrecisionEvaluator(Evaluator, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Step-wise average precision, exact over distinct scores."""

    @keyword_only
    def __init__(self, labelCol=LABEL):
        super().__init__()
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        pairs = dataset.select(
            vector_to_array(F.col("probability")).getItem(1).alias("probability"),
            F.col(self.getLabelCol()).cast("int").alias("label"),
        )
        return G.ranking_value(pairs, "pr_auc")

    def isLargerBetter(self) -> bool:
        return True


# --- candidates and search ---------------------------------------------------------------


@dataclass(frozen=True)
class Candidate:
    estimator: Any
    grid: Mapping[str, Sequence[Any]]
    rationale: str


def candidates(n_rows: int, seed: int = SEED) -> dict[str, Candidate]:
    """The three families and their search grids.

    The inverse regularisation strength C of a sum-of-losses objective corresponds to
    ``regParam = 1 / (C * n)`` here.  Options without a counterpart are left out.
    """
    # The search grids.
    strengths = [0.01, 0.1, 0.5, 1.0, 5.0, 10.0]
    return {
        "Logistic Regression": Candidate(
            LogisticRegression(
                labelCol=LABEL, weightCol=WEIGHT, maxIter=2000, standardization=False,
                regParam=1.0 / max(n_rows, 1), elasticNetParam=0.0,
            ),
            {
                "regParam": [1.0 / (c * max(n_rows, 1)) for c in strengths],
                "elasticNetParam": [1.0, 0.0],
            },
            "Interpretable linear baseline: every coefficient is a change in log-odds.",
        ),
        "Random Forest": Candidate(
            RandomForestClassifier(
                labelCol=LABEL, weightCol=WEIGHT, seed=seed, numTrees=100, maxDepth=30,
            ),
            {
                "numTrees": [200, 300, 400, 500],
                "maxDepth": [8, 12, 16, 20, 30],
                "minInstancesPerNode": [1, 2, 4, 8],
                "featureSubsetStrategy": ["sqrt", "log2", "0.5"],
            },
            "Bagged trees: interactions without tuning, robust to skewed durations.",
        ),
        "Gradient Boosted Trees": Candidate(
            SecondOrderTrees(
                labelCol=LABEL, weightCol=WEIGHT, seed=seed, maxIter=100, maxDepth=6, stepSize=0.3,
            ),
            {
                "maxIter": [200, 300, 400, 600],
                "maxDepth": [3, 4, 5, 6, 8],
                "stepSize": [0.01, 0.05, 0.1, 0.2],
                "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
                "slotShare": [0.6, 0.8, 1.0],
                "minChildWeight": [1.0, 3.0, 5.0],
            },
            "Boosted trees: usually the strongest family on tables of this kind.",
        ),
    }


def fit_model(
    classifier, train: DataFrame, contract: Contract = SESSION, drop: Sequence[str] = ()
) -> PipelineModel:
    """Fit features, then the classifier on the written vectors.

    Iterative solvers launch a job per step; starting each from files instead of the
    whole feature plan keeps those jobs small and cheap to recover.
    """
    kept = contract.without(*drop) if drop else contract
    prepared = Pipeline(stages=feature_stages(kept)).fit(train)
    vectors = written(prepared.transform(train).select("features", LABEL, WEIGHT), "vectors")
    try:
        return PipelineModel(stages=[*prepared.stages, classifier.fit(vectors)])
    finally:
        forget(vectors)


def _objective_shared(classifier) -> bool:
    """Whether the batched solver has this classifier's objective."""
    return (
        isinstance(classifier, LogisticRegression)
        and classifier.getFamily() in ("auto", "binomial")
        and classifier.getFitIntercept() and not classifier.getStandardization()
    )


def fit_converged(classifier: LogisticRegression, train: DataFrame, contract: Contract = SESSION) -> PipelineModel:
    """``fit_model`` for a logistic regression without standardisation, by the batched solver.

    It runs until it has converged, whatever ``maxIter`` is, in a job per Newton step.
    """
    prepared = Pipeline(stages=feature_stages(contract)).fit(train)
    rows = prepared.transform(train).select(F.lit(0).alias("grp"), "features", LABEL, WEIGHT)
    blocks = written(batched.packed(rows), "blocks")
    try:
        at = batched.fit_many(blocks, [(0, classifier.getRegParam(), classifier.getElasticNetParam())])[0]
    finally:
        forget(blocks)
    context = train.sparkSession.sparkContext
    made = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        classifier.uid, _py2java(context, Vectors.dense(at[:-1])), float(at[-1])
    )
    model = classifier._copyValues(LogisticRegressionModel(made))
    model._transfer_params_to_java()
    return PipelineModel(stages=[*prepared.stages, model])


class FoldVectors:
    """What every candidate is fitted and checked on, one pair of frames per fold.

    All feature statistics are refitted on each fold's own training part, once for every
    candidate that is tried on it.  Vectors are written when first asked for: as rows for
    Spark ML's fits, as blocks of all folds for the batched solver.  ``release`` removes them.
    """

    def __init__(self, parts: Sequence[tuple[PipelineModel, DataFrame, DataFrame]]):
        self._parts = list(parts)
        self._pairs: list[tuple[DataFrame, DataFrame]] = []
        self._blocks: tuple[DataFrame, DataFrame] | None = None
        self.slots = max((len(feature_names(p)) for p, _, _ in self._parts), default=0)

    def __len__(self) -> int:
        return len(self._parts)

    def pairs(self) -> list[tuple[DataFrame, DataFrame]]:
        if not self._pairs:
            self._pairs = [
                (
                    written(p.transform(inside).select("features", LABEL, WEIGHT), "fold"),
                    written(p.transform(held).select("features", LABEL), "fold"),
                )
                for p, inside, held in self._parts
            ]
        return self._pairs

    def blocks(self) -> tuple[DataFrame, DataFrame]:
        if self._blocks is None:
            sides = []
            for side in (1, 2):
                rows = [
                    part[0].transform(part[side]).select(F.lit(f).alias("grp"), "features", LABEL, WEIGHT)
                    for f, part in enumerate(self._parts)
                ]
                sides.append(written(batched.packed(reduce(DataFrame.unionAll, rows)), "blocks"))
            self._blocks = tuple(sides)
        return self._blocks

    def release(self) -> None:
        forget(*[df for pair in self._pairs for df in pair], *(self._blocks or ()))
        self._pairs, self._blocks = [], None


def fold_vectors(train: DataFrame, contract: Contract = SESSION, parallelism: int = 2) -> FoldVectors:
    """Feature stages fitted on the training part of every fold."""

    def prepare(fold: int) -> tuple[PipelineModel, DataFrame, DataFrame]:
        inside, held = train.filter(F.col(FOLD) != fold), train.filter(F.col(FOLD) == fold)
        return Pipeline(stages=feature_stages(contract)).fit(inside), inside, held

    k = train.agg(F.max(FOLD)).first()[0] + 1
    return FoldVectors(_in_threads(train, prepare, range(k), parallelism))


def _in_threads(df: DataFrame, run, items, parallelism: int) -> list:
    """Submit independent jobs side by side, as a tuning run does."""
    # Wrapped one by one: a wrapped function carries its own job properties.
    wrap = inheritable_thread_target(df.sparkSession)
    tasks = [wrap(partial(run, item)) for item in items]
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return pool.map(lambda task: task(), tasks, chunksize=1)


def _solved_together(classifier, maps: Sequence[dict], folds: FoldVectors) -> bool:
    regular = {p.name for m in maps for p in m} <= {"regParam", "elasticNetParam"}
    return _objective_shared(classifier) and regular and folds.slots <= batched.MOST_SLOTS


def cross_validate(
    classifier, maps: Sequence[dict], folds: FoldVectors, parallelism: int = 2
) -> list[float]:
    """Mean average precision of every parameter map over the folds.

    Logistic regressions without standardisation are fitted all at once, to convergence;
    other classifiers one by one.
    """
    n = len(folds)
    tasks = [(i, f) for i in range(len(maps)) for f in range(n)]
    if _solved_together(classifier, maps, folds):
        asked = [classifier.copy(m) for m in maps]
        settings = [(f, asked[i].getRegParam(), asked[i].getElasticNetParam()) for i, f in tasks]
        fit_on, check_on = folds.blocks()
        fits = batched.fit_many(fit_on, settings)
        scores = batched.scores_many(check_on, {t: (settings[t][0], at) for t, at in enumerate(fits) if len(at)})
        found = G.ranking_values(scores, "pr_auc", "problem")
        values = [found.get(t, 0.0) for t in range(len(tasks))]
    else:
        score, pairs = AveragePrecisionEvaluator(), folds.pairs()

        def run(task: tuple[int, int]) -> float:
            i, fold = task
            fit_on, check_on = pairs[fold]
            return score.evaluate(classifier.fit(fit_on, maps[i]).transform(check_on))

        values = _in_threads(pairs[0][0], run, tasks, parallelism)
    return [float(sum(values[i * n : (i + 1) * n]) / n) for i in range(len(maps))]


def cv_baseline(
    classifier, train: DataFrame, contract: Contract = SESSION, parallelism: int = 2
) -> float:
    """Cross-validated average precision with the parameters as they are."""
    folds = fold_vectors(train, contract, parallelism)
    try:
        return cross_validate(classifier, [{}], folds, parallelism)[0]
    finally:
        folds.release()


@dataclass(frozen=True)
class Tuned:
    name: str
    model: PipelineModel
    best_params: dict[str, str]
    baseline_pr_auc: float
    tuned_pr_auc: float
    baseline_seconds: float
    search_seconds: float
    rationale: str = ""

    @property
    def improvement(self) -> float:
        return round(self.tuned_pr_auc - self.baseline_pr_auc, 4)


def tune(
    name: str,
    candidate: Candidate,
    train: DataFrame,
    contract: Contract = SESSION,
    draws: int = SEARCH_DRAWS,
    seed: int = SEED,
    parallelism: int = 2,
    folds: FoldVectors | None = None,
) -> Tuned:
    """Randomised search over whole pipelines; the best one is refitted on all of ``train``.

    ``folds`` from ``fold_vectors`` can be shared by several families; its tables, and a cache
    that the caller holds on ``train``, are left alone.
    """
    classifier = candidate.estimator
    held, shared = train.is_cached, folds is not None
    train = train if held else train.persist()
    try:
        folds = folds if shared else fold_vectors(train, contract, parallelism)
        t0 = time.perf_counter()
        base = cross_validate(classifier, [{}], folds, parallelism)[0]
        t1 = time.perf_counter()
        settings = sample_params(candidate.grid, draws, seed)
        maps = [{classifier.getParam(k): v for k, v in s.items()} for s in settings]
        means = cross_validate(classifier, maps, folds, parallelism)
        best = max(range(len(settings)), key=lambda i: means[i])
        together = _solved_together(classifier, maps, folds)
        model = (fit_converged if together else fit_model)(classifier.copy(maps[best]), train, contract)
        t2 = time.perf_counter()
    finally:
        if not shared and folds is not None:
            folds.release()
        if not held:
            train.unpersist()
    return Tuned(
        name=name,
        model=model,
        best_params={k: str(v) for k, v in settings[best].items()},
        baseline_pr_auc=round(base, 4),
        tuned_pr_auc=round(means[best], 4),
        baseline_seconds=round(t1 - t0, 2),
        search_seconds=round(t2 - t1, 2),
        rationale=candidate.rationale,
    )


def tuning_table(results: Sequence[Tuned], spark) -> DataFrame:
    rows = [
        (t.name, t.baseline_pr_auc, t.tuned_pr_auc, t.improvement, t.search_seconds) for t in results
    ]
    return spark.createDataFrame(
        rows,
        "model string, baseline_pr_auc double, tuned_pr_auc double, improvement double, search_seconds double",
    )


def leakage_experiment(
    estimator, train: DataFrame, test: DataFrame, contract: Contract = SESSION
) -> DataFrame:
    """The same estimator with and without the leakage columns, and the difference."""
    dropped = "_".join(contract.leakage)
    arms = {f"with_{dropped}": (), f"without_{dropped}": contract.leakage}
    scored = {}
    for name, drop in arms.items():
        model = fit_model(estimator, train, contract, drop)
        scored[name] = probability_of(test, model).select("label", "probability")
    both = G.metric_suite(G.stack_models(scored), by=["model"])
    kept, left_out = arms
    sign = F.when(F.col("model") == left_out, 1.0).otherwise(-1.0)
    delta = both.agg(*[F.round(F.sum(F.col(m) * sign), 4).alias(m) for m in G.SUITE])
    return both.unionByName(delta.withColumn("model", F.lit("delta")))
