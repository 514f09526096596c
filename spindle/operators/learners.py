"""Learners with the reference's settings as defaults, plus the checks the
scripts lacked (label among features, third class for GBT, negative
features for naive Bayes, too many categories for the tree bins).

Every learner is a ``pyspark.ml`` estimator: fitting is distributed by
Spark (tree-aggregated gradients for linear models, level-wise histogram
aggregation for trees); nothing here loops over rows on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, MultilayerPerceptronClassifier,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.operators import batched
from spindle.operators.columns import q
from spindle.operators.layout import WEIGHT, by_content, fit_input, kept, weighted_input

# --- fixed values: the reference's settings ---------------------------------
SVM_ITERATIONS = 100
SVM_REG = 1.0
SVM_L1_ITERATIONS = 200
SVM_L1_REG = 0.1
LOGREG_ITERATIONS = 10
LOGREG_REG = 0.01
LINREG_ITERATIONS = 10
LINREG_REG = 0.3
LINREG_ELASTIC = 0.8
FOREST_TREES = 10
GBT_CLASSIFIER_ROUNDS = 10
GBT_REGRESSOR_ROUNDS = 30
KMEANS_K = 2
KMEANS_SEED = 1


def logistic_regression(label: str = "label", features: str = "features",
                        max_iter: int = LOGREG_ITERATIONS, reg: float = LOGREG_REG,
                        elastic: float = 0.0, threshold: float = 0.5, family: str = "auto",
                        probability_col: str = "probability", tol: float = 1e-6,
                        fit_intercept: bool = True, aggregation_depth: int = 2,
                        **kw) -> LogisticRegression:
    """Binary or multinomial logistic regression, elastic net."""
    return LogisticRegression(labelCol=label, featuresCol=features, maxIter=max_iter,
                              regParam=reg, elasticNetParam=elastic, threshold=threshold,
                              family=family, probabilityCol=probability_col, tol=tol,
                              fitIntercept=fit_intercept, aggregationDepth=aggregation_depth, **kw)


def linear_svc(label: str = "label", features: str = "features", max_iter: int = SVM_ITERATIONS,
               reg: float = SVM_REG, **kw) -> LinearSVC:
    """Linear SVM (hinge loss, L2 penalty, OWL-QN); ``fit_linear_svc_l1`` has
    the L1 penalty."""
    return LinearSVC(labelCol=label, featuresCol=features, maxIter=max_iter, regParam=reg, **kw)


def fit_linear_svc_l1(df: DataFrame, label: str = "label", features: str = "features", reg: float = SVM_L1_REG,
                      steps: int = SVM_L1_ITERATIONS, partitions: int | None = None) -> batched.HingeModel:
    """Linear SVM with an L1 penalty: hinge loss, proximal sub-gradient steps,
    one aggregate each (``spindle.operators.batched``).  Labels are 0 and 1."""
    rows = df.select(F.lit(0).alias("_set"), F.lit(False).alias("_valid"), F.col(q(label)).cast("double").alias("label"),
                     vector_to_array(q(features)).alias("features"))
    first = rows.select(F.size("features").alias("n")).first()
    if first is None:
        raise ValueError("no rows to fit")
    with kept(batched.blocks(by_content(rows, partitions))) as packed:
        return batched.fit_hinge_l1(packed, first["n"], [reg], steps)[0]


def score_linear_svc(model: batched.HingeModel, df: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
    """``df`` with the class (0 or 1) on whose side of the plane a row is."""
    weights = F.array(*[F.lit(c) for c in model.coefficients])
    margin = F.aggregate(F.zip_with(vector_to_array(q(features)), weights, lambda a, b: a * b), F.lit(model.intercept), lambda a, b: a + b)
    return df.withColumn(prediction, (margin > 0).cast("double"))


def decision_tree_classifier(label: str = "label", features: str = "features",
                             max_depth: int = 5, max_bins: int = 32, impurity: str = "gini",
                             seed: int | None = None, **kw) -> DecisionTreeClassifier:
    kw = {**kw, **({"seed": seed} if seed is not None else {})}
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, maxDepth=max_depth,
                                  maxBins=max_bins, impurity=impurity, **kw)


def random_forest_classifier(label: str = "label", features: str = "features",
                             num_trees: int = FOREST_TREES, max_depth: int = 5,
                             max_bins: int = 32, seed: int = 42, **kw) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=num_trees,
                                  maxDepth=max_depth, maxBins=max_bins, seed=seed, **kw)


def gbt_classifier(label: str = "label", features: str = "features",
                   max_iter: int = GBT_CLASSIFIER_ROUNDS, max_depth: int = 5,
                   max_bins: int = 32, seed: int = 42, **kw) -> GBTClassifier:
    """Gradient-boosted trees for two classes (0/1) only."""
    return GBTClassifier(labelCol=label, featuresCol=features, maxIter=max_iter,
                         maxDepth=max_depth, maxBins=max_bins, seed=seed, **kw)


def naive_bayes(label: str = "label", features: str = "features", smoothing: float = 1.0,
                model_type: str = "multinomial", **kw) -> NaiveBayes:
    """Multinomial naive Bayes; features must be non-negative."""
    return NaiveBayes(labelCol=label, featuresCol=features, smoothing=smoothing,
                      modelType=model_type, **kw)


def mlp_classifier(layers: Sequence[int], label: str = "label", features: str = "features",
                   max_iter: int = 100, seed: int = 42, block_size: int = 128,
                   **kw) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features,
                                          layers=list(layers), maxIter=max_iter, seed=seed,
                                          blockSize=block_size, **kw)


def linear_regression(label: str = "label", features: str = "features",
                      max_iter: int = LINREG_ITERATIONS, reg: float = LINREG_REG,
                      elastic: float = LINREG_ELASTIC, solver: str = "auto",
                      fit_intercept: bool = True, **kw) -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol=features, maxIter=max_iter,
                            regParam=reg, elasticNetParam=elastic, solver=solver,
                            fitIntercept=fit_intercept, **kw)


def decision_tree_regressor(label: str = "label", features: str = "features",
                            max_depth: int = 5, max_bins: int = 32, **kw) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(labelCol=label, featuresCol=features, maxDepth=max_depth,
                                 maxBins=max_bins, **kw)


def random_forest_regressor(label: str = "label", features: str = "features",
                            num_trees: int = 20, max_depth: int = 5, max_bins: int = 32,
                            seed: int = 42, **kw) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, featuresCol=features, numTrees=num_trees,
                                 maxDepth=max_depth, maxBins=max_bins, seed=seed, **kw)


def gbt_regressor(label: str = "label", features: str = "features",
                  max_iter: int = GBT_REGRESSOR_ROUNDS, max_depth: int = 5, max_bins: int = 32,
                  seed: int = 42, **kw) -> GBTRegressor:
    return GBTRegressor(labelCol=label, featuresCol=features, maxIter=max_iter,
                        maxDepth=max_depth, maxBins=max_bins, seed=seed, **kw)


def kmeans(k: int = KMEANS_K, seed: int = KMEANS_SEED, features: str = "features",
           max_iter: int = 20, **kw) -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol=features, maxIter=max_iter, **kw)


# --- checks before a fit ----------------------------------------------------

def check_label_not_feature(label: str, feature_cols: Sequence[str]) -> None:
    if label in set(feature_cols):
        raise ValueError(f"label column {label!r} is among the features")


def check_binary_label(df: DataFrame, label: str) -> None:
    """GBT classification takes labels 0 and 1 only."""
    row = df.agg(F.min(q(label)).alias("lo"), F.max(q(label)).alias("hi"),
                 F.count_if(F.coalesce(~F.col(q(label)).isin(0.0, 1.0), F.lit(True))).alias("bad")).first()
    if row["bad"]:
        raise ValueError(f"{label}: {row['bad']} rows outside {{0, 1}} "
                         f"(range {row['lo']}..{row['hi']}); GBT takes two classes")


def check_nonnegative(df: DataFrame, features: str) -> None:
    """Multinomial naive Bayes needs non-negative features."""
    neg = df.agg(F.count_if(F.exists(vector_to_array(features), lambda x: x < 0)).alias("n")).first()["n"]
    if neg:
        raise ValueError(f"{neg} rows have negative features; multinomial naive Bayes needs >= 0")


def check_categories_fit_bins(df: DataFrame, features: str, max_bins: int) -> None:
    """A categorical feature (from vector indexer metadata) with more values
    than maxBins makes tree fitting fail; say so before the fit."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    for group in meta.get("attrs", {}).get("nominal", []):
        n = len(group.get("vals", [])) or group.get("num_vals", 0)
        if n > max_bins:
            raise ValueError(f"feature {group.get('idx')} has {n} categories > maxBins {max_bins}")


def _weighs_copies(estimator) -> bool:
    """Whether a fit on distinct rows, weighted by how often they come, is a fit
    on all rows.  Boosted trees add up weights wherever they add up rows, unless
    they draw rows or ask for a number of them in a leaf."""
    return (isinstance(estimator, (GBTClassifier, GBTRegressor)) and estimator.getSubsamplingRate() == 1.0 and estimator.getMinInstancesPerNode() == 1
            and not any(estimator.isDefined(p) and estimator.getOrDefault(p) for p in (estimator.weightCol, estimator.validationIndicatorCol)))


def fit(estimator, df: DataFrame, params: Mapping | None = None, partitions: int | None = None):
    """``estimator.fit(df, params)``: a param map overrides the setters.

    The input is cut to the columns the estimator reads, laid out by content
    and kept for the fit (see ``spindle.operators.layout``), since iterative
    learners read it once per iteration.  Boosted trees, whose rounds read it
    many times, get the copies of a row together, with their weight."""
    chosen = estimator.copy(dict(params)) if params else estimator
    if _weighs_copies(chosen):
        with weighted_input(df, [chosen], partitions) as data:
            model = chosen.copy({chosen.weightCol: WEIGHT}).fit(data)
        model.clear(model.weightCol)
        return model
    with fit_input(df, [chosen], partitions) as data:
        return estimator.fit(data, dict(params)) if params else estimator.fit(data)
