"""Evaluation as DataFrame aggregates.

Accuracy, confusion counts and RMSE are single aggregations with
map-side partial sums.  ROC and AUC group rows by score first and take
running sums with ``running_totals``, so an unbounded number of distinct
scores never lands in one task.  WSSSE takes centres as a bounded literal
(k x d numbers) and computes nearest-centre distances inside the JVM.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.operators.columns import q
from spindle.operators.ranking import running_totals


def _score(df: DataFrame, col: str) -> Column:
    """A double score: a vector's positive-class entry, or the column."""
    dt = df.schema[col].dataType
    if dt.typeName() == "vector" or type(dt).__name__ == "VectorUDT":
        return vector_to_array(F.col(q(col))).getItem(1)
    return F.col(q(col)).cast("double")


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and test_error (= 1 - accuracy).  A row without a
    label or a prediction is a miss."""
    hit = F.col(q(prediction)).cast("double") == F.col(q(label)).cast("double")
    acc = df.agg(F.avg(F.coalesce(hit, F.lit(False)).cast("double")).alias("accuracy"))
    return acc.withColumn("test_error", 1.0 - F.col("accuracy"))


def accuracy_value(df: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName="accuracy").evaluate(df)


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: tp, fp, fn, precision, recall (one aggregation pass and a
    self-contained per-class roll-up; the class count is small)."""
    pairs = df.groupBy(F.col(q(label)).cast("double").alias("l"),
                       F.col(q(prediction)).cast("double").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    by_label = pairs.groupBy(F.col("l").alias("cls")).agg(
        F.sum(F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum("n").alias("actual"))
    by_pred = pairs.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    out = by_label.join(by_pred, "cls", "full_outer").fillna(0, ["tp", "actual", "predicted"])
    return out.select(
        "cls",
        F.col("tp").cast("bigint").alias("tp"),
        (F.col("predicted") - F.col("tp")).cast("bigint").alias("fp"),
        (F.col("actual") - F.col("tp")).cast("bigint").alias("fn"),
        F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0).alias("precision"),
        F.when(F.col("actual") > 0, F.col("tp") / F.col("actual")).otherwise(0.0).alias("recall"),
    )


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    err = F.col(q(label)).cast("double") - F.col(q(prediction)).cast("double")
    return df.agg(F.sqrt(F.avg(err * err)).alias("rmse"))


def rmse_value(df: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction,
                               metricName="rmse").evaluate(df)


def _score_groups(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score: positives and negatives at that score.  A
    null label is negative; a null score ranks last and NaN first, as
    ``running_totals`` orders them."""
    pos = F.coalesce(F.col(q(label)).cast("double") > 0.5, F.lit(False)).cast("long")
    return (df.select(_score(df, score).alias("score"), pos.alias("_p"))
              .groupBy("score").agg(F.sum("_p").alias("pos"),
                                    F.sum(1 - F.col("_p")).alias("neg")))


def _both_classes(tot: dict) -> None:
    if not tot["pos"] or not tot["neg"]:
        raise ValueError(f"ROC/AUC needs both classes: {tot['pos']} positive and "
                         f"{tot['neg']} negative rows")


def roc(df: DataFrame, score: str = "probability", label: str = "label",
        num_bins: int = 0) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, thresholds falling:
    predicting positive for score >= threshold.

    A whole table has one point per distinct score.  With ``num_bins`` > 0
    and more distinct scores than that, only the last point of every run of
    about count / num_bins consecutive thresholds is kept (as Spark's
    ``numBins`` does), plus the final point; the filter runs on the
    distributed running sums, so nothing is collected.
    """
    groups = _score_groups(df, score, label).withColumn("_one", F.lit(1))
    cum, tot = running_totals(groups, "score", ["pos", "neg", "_one"], descending=True,
                              with_totals=True)
    _both_classes(tot)
    n = int(tot["_one"])
    if num_bins and n > num_bins:
        step = n // num_bins
        if step > 1:
            cum = cum.filter((F.col("cum__one") % step == 0) | (F.col("cum__one") == n))
    return cum.select(
        F.col("score").alias("threshold"),
        (F.col("cum_neg") / F.lit(float(tot["neg"]))).alias("fpr"),
        (F.col("cum_pos") / F.lit(float(tot["pos"]))).alias("tpr"))


def auc(df: DataFrame, score: str = "probability", label: str = "label") -> DataFrame:
    """Area under the ROC curve by the trapezoid rule over score groups
    (ties form one step, like ``BinaryClassificationMetrics``)."""
    groups = _score_groups(df, score, label)
    cum, tot = running_totals(groups, "score", ["pos", "neg"], descending=True, with_totals=True)
    _both_classes(tot)
    # segment i runs from (cum_neg - neg, cum_pos - pos) to (cum_neg, cum_pos)
    # doubles: neg * cum_pos overflows a long at 10^10 rows per class
    neg, cpos, pos = (F.col(c).cast("double") for c in ("neg", "cum_pos", "pos"))
    denom = 2.0 * float(tot["pos"]) * float(tot["neg"])
    return cum.agg((F.sum(neg * (2 * cpos - pos)) / F.lit(denom)).alias("auc"))


def auc_value(df: DataFrame, score: str = "rawPrediction", label: str = "label") -> float:
    """Built-in evaluator, exact (no down-sampling)."""
    return BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label,
                                         metricName="areaUnderROC", numBins=0).evaluate(df)


def hard_auc(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """AUC of hard 0/1 predictions, = (TPR + TNR) / 2 (what the RDD scripts
    computed by feeding predictions as scores)."""
    return auc(df, prediction, label)


def wssse(df: DataFrame, centers: Sequence[Sequence[float]], features: str = "features") -> DataFrame:
    """Sum over rows of the squared distance to the nearest centre.

    The centres are one literal (a constant array), so the distance is a JVM
    expression with no join and no Python.
    """
    lit = F.from_json(F.lit(json.dumps([[float(x) for x in c] for c in centers])), "array<array<double>>")
    col = df.schema[features].dataType
    x = vector_to_array(F.col(q(features))) if type(col).__name__ == "VectorUDT" else F.col(
        q(features)).cast("array<double>")
    dists = F.transform(lit, lambda c: F.aggregate(
        F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
    nearest = F.array_min(dists)
    return df.agg(F.sum(nearest).alias("wssse"))
