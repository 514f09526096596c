"""Fitted trees as native expressions.

``score_expression`` turns the node table of a tree, a forest or boosted
trees into one column expression over the feature vector: nested conditions
for the splits (a threshold, or a set of categories), combined over the trees
as the model combines them.  It runs inside code generation, needs no model
at scoring time and can be stored as SQL.  The node table has the size of the
model; the rows are never collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from spindle.operators import reports
from spindle.operators.columns import q


def goes_left(node: Row, vector: Column) -> Column:
    """The rule of a split: at most the threshold, or one of the categories."""
    value = F.get(vector, F.lit(node["feature"]))
    if node["left_categories"] is not None:
        return value.isin(*node["left_categories"]) if node["left_categories"] else F.lit(False)
    return value <= node["threshold"]


def tree_expression(nodes: dict[int, Row], vector: Column, leaf: Callable[[Row], Column], at: int = 0) -> Column:
    """Nested conditions from node ``at`` down; ``leaf`` gives a leaf's value."""
    node = nodes[at]
    if node["left_child"] < 0:
        return leaf(node)
    left, right = (tree_expression(nodes, vector, leaf, node[side]) for side in ("left_child", "right_child"))
    return F.when(goes_left(node, vector), left).otherwise(right)


def _shares(node: Row) -> Column:
    total = sum(node["stats"])
    return F.array(*[F.lit(s / total if total else 0.0) for s in node["stats"]])


def score_expression(spark: SparkSession, model, features: str = "features") -> Column:
    """The model's prediction: the leaf's (one tree), the mean (regression
    forest), the weighted sum (boosted regression), or the class with the
    largest sum of leaf shares, the first of equals (classification forest)."""
    by_tree: dict[int, dict[int, Row]] = {}
    for row in reports.tree_nodes(spark, model).collect():
        by_tree.setdefault(row["tree"], {})[row["id"]] = row
    trees = [by_tree[t] for t in sorted(by_tree)]
    vector = vector_to_array(q(features))
    if isinstance(model, RandomForestClassificationModel):
        votes = None
        for t in trees:
            one = tree_expression(t, vector, _shares)
            votes = one if votes is None else F.zip_with(votes, one, lambda a, b: a + b)
        return (F.array_position(votes, F.array_max(votes)) - 1).cast("double")
    parts = [tree_expression(t, vector, lambda n: F.lit(n["prediction"])) for t in trees]
    if isinstance(model, (DecisionTreeClassificationModel, DecisionTreeRegressionModel)):
        return parts[0]
    if isinstance(model, GBTRegressionModel):
        parts = [p * w for p, w in zip(parts, model.treeWeights, strict=True)]
    elif not isinstance(model, RandomForestRegressionModel):
        raise TypeError(f"no rules for {type(model).__name__}")
    total = sum(parts[1:], parts[0])
    return total / len(parts) if isinstance(model, RandomForestRegressionModel) else total


def score_by_rules(model, df: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
    """``df`` with the model's prediction, by its rules."""
    return df.withColumn(prediction, score_expression(df.sparkSession, model, features))
