"""Pipelines, param maps, grids and model search.

Folds come from a key hash (``spindle.operators.split.fold_column``), so a
search is repeatable on any cluster layout.  ``search_cv`` fits the stages
before the learner once per fold (not once per fold and setting).  A grid of
binary logistic regressions is then fitted in one pass for all folds and
settings (``spindle.operators.batched``); other learners' fits share one pool
of driver threads, each a distributed Spark job of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField, StructType)

from spindle.operators import batched
from spindle.operators.columns import q
from spindle.operators.layout import fit_input, fit_partitions, only_read


def pipeline(stages: Sequence) -> Pipeline:
    return Pipeline(stages=list(stages))


def merge_params(*maps: Mapping) -> dict:
    """Param maps combined left to right; a later map wins (``++``)."""
    out: dict = {}
    for m in maps:
        out.update(m)
    return out


def grid(axes: Sequence[tuple[Param, Sequence | None]]) -> list[dict]:
    """Cross product of param values; a boolean param with ``None`` values
    means {True, False}."""
    b = ParamGridBuilder()
    for p, vals in axes:
        b = b.addGrid(p, [True, False] if vals is None else list(vals))
    return b.build()


def grid_table(spark: SparkSession, maps: Sequence[Mapping]) -> DataFrame:
    """One row per setting: (setting, param, value)."""
    rows = [(i, p.name, str(v)) for i, m in enumerate(maps) for p, v in
            sorted(m.items(), key=lambda kv: kv[0].name)]
    schema = StructType([StructField("setting", IntegerType(), False),
                         StructField("param", StringType(), False),
                         StructField("value", StringType(), False)])
    return spark.createDataFrame(rows, schema)


#: Fits that run at once; each is a distributed job of its own.
PARALLEL_FITS = 8


def cross_validator(estimator, maps: Sequence[Mapping], evaluator, num_folds: int = 3,
                    fold_col: str | None = None, parallelism: int = PARALLEL_FITS,
                    seed: int = 42, keep_sub_models: bool = False) -> CrossValidator:
    """The built-in search; with ``fold_col`` the folds are the given ones.
    ``keep_sub_models`` keeps every fold's models for ``cv_fold_metrics``."""
    kw = {"foldCol": fold_col} if fold_col else {}
    if keep_sub_models:
        kw["collectSubModels"] = True
    return CrossValidator(estimator=estimator, estimatorParamMaps=list(maps), evaluator=evaluator,
                          numFolds=num_folds, parallelism=parallelism, seed=seed, **kw)


def train_validation_split(estimator, maps: Sequence[Mapping], evaluator, train_ratio: float = 0.75,
                           parallelism: int = PARALLEL_FITS, seed: int = 42) -> TrainValidationSplit:
    return TrainValidationSplit(estimator=estimator, estimatorParamMaps=list(maps),
                                evaluator=evaluator, trainRatio=train_ratio,
                                parallelism=parallelism, seed=seed)


def cv_metrics(spark: SparkSession, cv_model) -> DataFrame:
    """(setting, avg_metric, std_metric) of a fitted ``CrossValidatorModel``."""
    stds = list(getattr(cv_model, "stdMetrics", []) or [])
    rows = [(i, float(m), float(stds[i]) if i < len(stds) else None)
            for i, m in enumerate(cv_model.avgMetrics)]
    schema = StructType([StructField("setting", IntegerType(), False),
                         StructField("avg_metric", DoubleType(), False),
                         StructField("std_metric", DoubleType(), True)])
    return spark.createDataFrame(rows, schema)


def _metric_expr(evaluator):
    """The evaluator's metric as an aggregate over (label, prediction), for
    the metrics that have one; None otherwise."""
    name = evaluator.getMetricName()
    lab = F.col(evaluator.getLabelCol()).cast("double")
    pred = F.col(evaluator.getPredictionCol()).cast("double")
    err = lab - pred
    return {"rmse": F.sqrt(F.avg(err * err)), "mse": F.avg(err * err), "mae": F.avg(F.abs(err)),
            "accuracy": F.avg((lab == pred).cast("double"))}.get(name)


def cv_fold_metrics(spark: SparkSession, cv_model, df: DataFrame, fold_col: str,
                    evaluator=None) -> DataFrame:
    """(setting, fold, metric) from a ``CrossValidatorModel`` fitted with
    ``foldCol`` and ``collectSubModels=True``: each sub-model is scored on
    the rows of its own fold.  For RMSE, MSE, MAE and accuracy all folds and
    settings are one union and one aggregate (a single job); other metrics
    run the evaluator per fold model."""
    subs = cv_model.subModels
    if not subs:
        raise ValueError("fit the CrossValidator with collectSubModels=True")
    ev = evaluator or cv_model.getEvaluator()
    schema = StructType([StructField("setting", IntegerType(), False),
                         StructField("fold", IntegerType(), False),
                         StructField("metric", DoubleType(), False)])
    expr = _metric_expr(ev)
    if expr is None:
        rows = [(i, k, float(ev.evaluate(m.transform(df.filter(F.col(fold_col) == k)))))
                for k, fold_models in enumerate(subs) for i, m in enumerate(fold_models)]
        return spark.createDataFrame(rows, schema)
    parts = None
    for k, fold_models in enumerate(subs):
        valid = df.filter(F.col(fold_col) == k)
        for i, m in enumerate(fold_models):
            scored = m.transform(valid).select(
                F.lit(i).alias("setting"), F.lit(k).alias("fold"),
                F.col(ev.getLabelCol()), F.col(ev.getPredictionCol()))
            parts = scored if parts is None else parts.unionByName(scored)
    out = parts.groupBy("setting", "fold").agg(expr.alias("metric"))
    return out.select(F.col("setting").cast("int"), F.col("fold").cast("int"), "metric")


_METRICS = StructType([StructField("setting", IntegerType(), False),
                       StructField("fold", IntegerType(), False),
                       StructField("metric", DoubleType(), False)])


def search_cv(spark: SparkSession, df: DataFrame, pre_stages: Sequence, learner,
              maps: Sequence[Mapping], evaluator, fold_col: str, num_folds: int,
              parallelism: int = PARALLEL_FITS, partitions: int | None = None, together: bool = True):
    """k-fold search with fold-wise reuse of the stages before the learner.

    Returns (best PipelineModel refitted on all rows, metrics DataFrame of
    (setting, fold, metric), index of the best setting).  Every fold's
    prepared rows are kept.  Grids that ``fits_together`` allows are fitted
    in one pass (unless ``together`` is false, or there are more than
    ``batched.MAX_TERMS`` features); others from one pool of ``parallelism``
    fits, so no fold waits for another one's slowest fit.  Both give the
    optimum of the same objective.
    """
    partitions = partitions or fit_partitions(only_read(df, [*pre_stages, learner, evaluator], [fold_col]))
    # many fits read this input: it is written to the shared folder first
    with fit_input(df, [*pre_stages, learner, evaluator], partitions, reliable=True, also=[fold_col]) as read:
        data = read.persist(StorageLevel.MEMORY_AND_DISK)
        kept = [data]
        try:
            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                def prepare(k: int):
                    return Pipeline(stages=list(pre_stages)).fit(data.filter(F.col(q(fold_col)) != k)) if pre_stages else None

                preps = list(pool.map(prepare, range(num_folds)))
                folds = [data if prep is None else prep.transform(data) for prep in preps]
                sizes = [_features(f, learner) for f in folds] if together and fits_together(learner, maps, evaluator) else []
                if sizes and all(0 < d <= batched.MAX_TERMS for d in sizes):
                    results = _together(folds, sizes, learner, maps, fold_col, kept, partitions)
                else:
                    results = _one_by_one(pool, folds, learner, maps, evaluator, fold_col, kept)
                best = _best(results, evaluator)
                final = Pipeline(stages=[*pre_stages, learner.copy(dict(maps[best]))]).fit(data)
        finally:
            for p in kept:
                p.unpersist()
    return final, spark.createDataFrame(sorted(results), _METRICS), best


#: Params that the settings of one pass may differ in.
_TOGETHER = ("regParam", "elasticNetParam", "fitIntercept", "standardization", "threshold")


def fits_together(learner, maps: Sequence[Mapping], evaluator) -> bool:
    """Whether all settings can be fitted in one pass: unweighted, unbounded
    binary logistic regressions, measured by their accuracy."""
    if not isinstance(learner, LogisticRegression) or not isinstance(evaluator, MulticlassClassificationEvaluator):
        return False
    plain = not any(learner.isSet(p) for p in learner.params if p.name == "weightCol" or p.name == "thresholds" or "Bounds" in p.name)
    binary = learner.getFamily() in ("auto", "binomial") and evaluator.getMetricName() == "accuracy"
    return plain and binary and all(p.name in _TOGETHER for m in maps for p in m)


def _features(df: DataFrame, learner) -> int:
    """Length of the vectors that the learner reads (0 without rows)."""
    row = df.select(F.size(vector_to_array(q(learner.getFeaturesCol()))).alias("n")).first()
    return row["n"] if row else 0


def _together(folds, sizes, learner, maps, fold_col, kept, partitions) -> list[tuple[int, int, float]]:
    rows = None
    for k, f in enumerate(folds):
        part = f.select(F.lit(k).alias("_set"), (F.col(q(fold_col)) == k).alias("_valid"), F.col(q(learner.getLabelCol())).cast("double").alias("label"),
                        vector_to_array(q(learner.getFeaturesCol())).alias("features"))
        rows = part if rows is None else rows.unionByName(part)
    # a task takes one partition of every fold
    rows = batched.blocks(rows.coalesce(partitions)).persist(StorageLevel.MEMORY_AND_DISK)
    kept.append(rows)
    settings = []
    for m in maps:
        one = learner.copy(dict(m))
        settings.append(batched.Setting(one.getRegParam(), one.getElasticNetParam(), one.getFitIntercept(), one.getStandardization(), one.getThreshold()))
    models = batched.fit_logistic(rows, sizes, settings, max(learner.getMaxIter(), 1))
    return [(i, k, a) for k, found in enumerate(batched.accuracies(rows, models)) for i, a in enumerate(found)]


def _one_by_one(pool, folds, learner, maps, evaluator, fold_col, kept) -> list[tuple[int, int, float]]:
    parts = []
    for k, f in enumerate(folds):
        parts.append([f.filter(rule).persist(StorageLevel.MEMORY_AND_DISK) for rule in (F.col(q(fold_col)) != k, F.col(q(fold_col)) == k)])
        kept += parts[-1]

    def run(job: tuple[int, int]) -> tuple[int, int, float]:
        k, i = job
        model = learner.fit(parts[k][0], dict(maps[i]))
        return i, k, float(evaluator.evaluate(model.transform(parts[k][1])))

    return list(pool.map(run, [(k, i) for k in range(len(folds)) for i in range(len(maps))]))


def _best(results: Sequence[tuple[int, int, float]], evaluator) -> int:
    """The setting with the best mean over its folds; the first of equals."""
    means: dict[int, list[float]] = {}
    for i, _, m in results:
        means.setdefault(i, []).append(m)
    avg = {i: sum(v) / len(v) for i, v in means.items()}
    return (max if evaluator.isLargerBetter() else min)(sorted(avg), key=lambda i: avg[i])


def search_holdout(spark: SparkSession, train: DataFrame, valid: DataFrame, learner,
                   maps: Sequence[Mapping], evaluator, parallelism: int = PARALLEL_FITS, partitions: int | None = None):
    """One fit of each setting on ``train``, measured on ``valid``: (models,
    metrics DataFrame of (setting, metric), index of the best).  Both parts
    are kept while all settings read them."""
    with fit_input(train, [learner, evaluator], partitions) as tr, fit_input(valid, [learner, evaluator], partitions) as va:
        def run(i: int):
            model = learner.fit(tr, dict(maps[i]))
            return model, float(evaluator.evaluate(model.transform(va)))

        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            found = list(pool.map(run, range(len(maps))))
    results = [(i, 0, m) for i, (_, m) in enumerate(found)]
    table = spark.createDataFrame(results, _METRICS).select("setting", "metric")
    return [m for m, _ in found], table, _best(results, evaluator)


def fit_pipeline(stages: Sequence, df: DataFrame, partitions: int | None = None) -> PipelineModel:
    """Fit stages in order on a laid-out, persisted copy of the input."""
    with fit_input(df, stages, partitions) as data:
        return Pipeline(stages=list(stages)).fit(data)
