"""Whole-script jobs: the reference's end-to-end scripts as functions that
take DataFrames and return the fitted model, scored rows and metrics.

The faults listed in SURVEY §3.5 are not carried over: imputers and
indexers are fitted on training rows only, label order is read from the
fitted inner indexer, scored labels are never overwritten, only the columns
a model uses decide which rows are dropped, splits and folds are keyed.

Every job takes ``partitions``, the number of partitions of its fits' inputs
(see ``spindle.operators.layout``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.functions import scalar
from spindle.operators import clean, evaluate, features, learners, profile, reports, split, tune
from spindle.operators.indexer import LabelsBack, TableIndexer, TableIndexerModel
from spindle.operators.layout import fit_input


@dataclass
class JobResult:
    model: object
    scored: DataFrame
    metrics: dict = field(default_factory=dict)
    reports: dict = field(default_factory=dict)


def tree_pipeline(pre_stages: list, tree_learner, train: DataFrame, partitions: int | None = None) -> PipelineModel:
    """Fit the stages before a tree learner, check that no categorical
    feature has more values than the learner's maxBins (the fit would fail
    late otherwise), then fit the learner on the same persisted input."""
    with fit_input(train, [*pre_stages, tree_learner], partitions) as data:
        prep = Pipeline(stages=list(pre_stages)).fit(data)
        ready = prep.transform(data)
        learners.check_categories_fit_bins(ready, tree_learner.getFeaturesCol(),
                                           tree_learner.getMaxBins())
        fitted = tree_learner.fit(ready)
    return PipelineModel(stages=list(prep.stages) + [fitted])


def _label_stages(model: PipelineModel) -> list[TableIndexerModel]:
    return [s for s in model.stages if isinstance(s, TableIndexerModel) and s.getOutputCol() == "indexedLabel"]


def _label_converter(model: PipelineModel, label_out: str = "predictedLabel") -> LabelsBack:
    """Predictions to labels, by the table of the fitted inner label indexer."""
    return _label_stages(model)[0].back("prediction", label_out)


def score_unlabelled(model: PipelineModel, df: DataFrame,
                     label_out: str = "predictedLabel") -> DataFrame:
    """Score rows that have no label (a separate call, no evaluation): the
    label indexer is skipped and predictions are mapped back to label
    values with the fitted index."""
    label_idx = _label_stages(model)
    scored = PipelineModel(stages=[s for s in model.stages if s not in label_idx]).transform(df)
    if label_idx:
        scored = _label_converter(model, label_out).transform(scored)
    return scored


def multiclass_forest(train: DataFrame, test: DataFrame, label: str, feature_cols: list[str],
                      num_trees: int = learners.FOREST_TREES, max_categories: int = 4,
                      seed: int = 42, partitions: int | None = None) -> JobResult:
    """assemble -> index label -> index features -> forest -> labels back."""
    learners.check_label_not_feature(label, feature_cols)
    pre = [features.assembler(feature_cols, "features"),
           TableIndexer(inputCol=label, outputCol="indexedLabel"),
           features.vector_indexer("features", "indexedFeatures", max_categories)]
    forest = learners.random_forest_classifier("indexedLabel", "indexedFeatures",
                                               num_trees=num_trees, seed=seed)
    model = tree_pipeline(pre, forest, train, partitions)
    scored = _label_converter(model).transform(model.transform(test))
    acc = evaluate.accuracy_value(scored, "indexedLabel", "prediction")
    return JobResult(model, scored, {"accuracy": acc, "test_error": 1 - acc})


def _binary_stages(label: str, numeric: list[str], categorical: list[str],
                   max_categories: int, learner):
    idx = [TableIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in categorical]
    cols = numeric + [f"{c}_idx" for c in categorical]
    pre = idx + [TableIndexer(inputCol=label, outputCol="indexedLabel"),
                 features.assembler(cols, "features"),
                 features.vector_indexer("features", "indexedFeatures", max_categories)]
    return pre, learner


def binary_logistic(train: DataFrame, test: DataFrame, label: str, numeric: list[str],
                    categorical: list[str], max_categories: int = 8, partitions: int | None = None) -> JobResult:
    """The credit-card script: logistic regression with ROC and loss history."""
    learners.check_label_not_feature(label, numeric + categorical)
    lr = learners.logistic_regression("indexedLabel", "indexedFeatures", max_iter=100, reg=0.0)
    pre, lr = _binary_stages(label, numeric, categorical, max_categories, lr)
    model = tune.fit_pipeline(pre + [lr], train, partitions)
    scored = _label_converter(model).transform(model.transform(test))
    acc = evaluate.accuracy_value(scored, "indexedLabel", "prediction")
    lrm = model.stages[-1]
    spark = train.sparkSession
    return JobResult(model, scored, {"accuracy": acc, "test_error": 1 - acc,
                                     "train_auc": float(lrm.summary.areaUnderROC)},
                     {"roc": reports.summary_roc(lrm), "loss": reports.loss_history(spark, lrm)})


def binary_logistic_cv(spark: SparkSession, train: DataFrame, test: DataFrame, label: str,
                       numeric: list[str], categorical: list[str], fold_keys: list[str],
                       reg_values=(0.1, 0.01), elastic_values=(0.0, 0.5, 1.0),
                       num_folds: int = 3, max_categories: int = 4,
                       parallelism: int = tune.PARALLEL_FITS, partitions: int | None = None) -> JobResult:
    """3-fold search over regParam x fitIntercept x elasticNet (12 settings
    by default), folds from a key hash, then refit on all training rows."""
    lr = learners.logistic_regression("indexedLabel", "indexedFeatures", max_iter=100)
    pre, lr = _binary_stages(label, numeric, categorical, max_categories, lr)
    maps = tune.grid([(lr.regParam, reg_values), (lr.fitIntercept, None),
                      (lr.elasticNetParam, elastic_values)])
    ev = MulticlassClassificationEvaluator(labelCol="indexedLabel", predictionCol="prediction",
                                           metricName="accuracy")
    folded = train.withColumn("_fold", split.fold_column(fold_keys, num_folds))
    best, metrics, best_i = tune.search_cv(spark, folded, pre, lr, maps, ev, "_fold", num_folds,
                                           parallelism, partitions)
    scored = _label_converter(best).transform(best.transform(test))
    acc = evaluate.accuracy_value(scored, "indexedLabel", "prediction")
    return JobResult(best, scored, {"accuracy": acc, "test_error": 1 - acc, "best": best_i},
                     {"cv": metrics, "grid": tune.grid_table(spark, maps)})


def clean_parts(table: DataFrame, key: str, label: str, age: str, sex: str, sib: str, par: str,
                embarked: str, numeric: list[str]) -> tuple[DataFrame, DataFrame, dict]:
    """The cleaning half of the titanic script: missing and value profiles,
    fills learnt on train, derived columns.  Returns the cleaned train and
    test parts and the reports, among them the counts by ``embarked`` after
    the fill."""
    reports_ = {"missing": profile.profile_missing(table), "values": profile.profile_values(table)}
    train, test = split.keyed_split(table, key)
    imp = clean.fit_mean_imputer(train, [age])            # learnt on train only
    modes = clean.mode_values(train, [embarked]).collect()

    def prep(df: DataFrame) -> DataFrame:
        df = clean.apply_imputer(imp, df)
        if modes:
            df = clean.fill_values(df, {embarked: modes[0]["value"]})
        return df.withColumns({
            "who": scalar.child_or_sex(sex, age, 15.0),
            "family": scalar.sum_flag(sib, par, 3),
        })

    tr, te = prep(train), prep(test)
    used = numeric + [age, "family", "who", embarked]
    tr = clean.drop_missing(tr, used + [label])
    te = clean.drop_missing(te, used)
    reports_["after_fill"] = profile.group_count(tr.unionByName(te), embarked)
    return tr, te, reports_


def clean_and_classify(spark: SparkSession, table: DataFrame, key: str, label: str,
                       age: str, sex: str, sib: str, par: str, embarked: str,
                       numeric: list[str], parallelism: int = tune.PARALLEL_FITS, partitions: int | None = None) -> JobResult:
    """The titanic script: profile, impute on train, derive, index,
    assemble, 18-setting 3-fold search, score the held-out rows."""
    tr, te, reports_ = clean_parts(table, key, label, age, sex, sib, par, embarked, numeric)
    lr = learners.logistic_regression("indexedLabel", "indexedFeatures", max_iter=100)
    pre = [TableIndexer(inputCol="who", outputCol="who_idx", handleInvalid="keep"),
           TableIndexer(inputCol=embarked, outputCol="emb_idx", handleInvalid="keep"),
           TableIndexer(inputCol=label, outputCol="indexedLabel"),
           features.assembler(numeric + [age, "family", "who_idx", "emb_idx"], "features"),
           features.vector_indexer("features", "indexedFeatures", 8)]
    maps = tune.grid([(lr.regParam, [0.5, 0.1, 0.01]), (lr.fitIntercept, None),
                      (lr.elasticNetParam, [0.0, 0.5, 1.0])])
    ev = MulticlassClassificationEvaluator(labelCol="indexedLabel", predictionCol="prediction",
                                           metricName="accuracy")
    folded = tr.withColumn("_fold", split.fold_column(key, 3))
    best, metrics, best_i = tune.search_cv(spark, folded, pre, lr, maps, ev, "_fold", 3, parallelism, partitions)
    scored = _label_converter(best).transform(best.transform(te))
    acc = evaluate.accuracy_value(scored, "indexedLabel", "prediction")
    reports_["cv"] = metrics
    return JobResult(best, scored, {"accuracy": acc, "test_error": 1 - acc, "best": best_i}, reports_)


def gbt_regression(train: DataFrame, test: DataFrame, label: str, feature_cols: list[str],
                   max_categories: int = 24, rounds: int = learners.GBT_REGRESSOR_ROUNDS,
                   seed: int = 42, partitions: int | None = None) -> JobResult:
    """The bike-hours script: assemble -> index features -> GBT -> RMSE."""
    learners.check_label_not_feature(label, feature_cols)
    cast = lambda df: df.withColumn(label, F.col(label).cast("double"))
    pre = [features.assembler(feature_cols, "features"),
           features.vector_indexer("features", "indexedFeatures", max_categories)]
    gbt = learners.gbt_regressor(label, "indexedFeatures", max_iter=rounds, seed=seed)
    model = tree_pipeline(pre, gbt, cast(train), partitions)
    scored = model.transform(cast(test))
    rm = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse").evaluate(scored)
    return JobResult(model, scored, {"rmse": rm})


def text_classify(train: DataFrame, test: DataFrame, text: str, label: str,
                  num_features: int = 1000, partitions: int | None = None) -> JobResult:
    """Tokenize -> hash (1000) -> logistic regression (10 iterations, 0.01)."""
    from pyspark.ml.feature import HashingTF, Tokenizer

    stages = [Tokenizer(inputCol=text, outputCol="words"),
              HashingTF(inputCol="words", outputCol="features", numFeatures=num_features),
              learners.logistic_regression(label, "features")]
    cast = lambda df: df.withColumn(label, F.col(label).cast("double"))
    model = tune.fit_pipeline(stages, cast(train), partitions)
    scored = model.transform(cast(test))
    acc = evaluate.accuracy_value(scored, label, "prediction")
    return JobResult(model, scored, {"accuracy": acc})
