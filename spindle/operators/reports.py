"""Model reports as DataFrames: coefficients with feature names, loss
history, iterations, residuals, fit statistics, ROC and AUC of the training
summary, tree node tables, cluster centres, params, labels, pipeline stages.

Reports built from a fitted model's fields are small by construction
(coefficients, centres, nodes, history), so they are made on the driver and
returned as tables; anything per row stays a distributed DataFrame.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from spindle.session import scratch_path


def feature_names(df: DataFrame, features: str = "features") -> list[str] | None:
    """Names from the vector column's ml_attr metadata (the assembler's)."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    if not attrs:
        return None
    pairs = [(a["idx"], a.get("name", f"f{a['idx']}")) for grp in attrs.values() for a in grp]
    return [n for _, n in sorted(pairs)]


def coefficients(spark: SparkSession, model, names: list[str] | None = None) -> DataFrame:
    """(term, class, value): intercept(s) and coefficients of a linear
    model; multinomial models give one block per class."""
    rows = []
    if hasattr(model, "coefficientMatrix") and getattr(model, "numClasses", 2) > 2:
        mat = model.coefficientMatrix.toArray()
        for c in range(mat.shape[0]):
            rows.append(("(intercept)", c, float(model.interceptVector[c])))
            for j, v in enumerate(mat[c]):
                rows.append((names[j] if names else f"f{j}", c, float(v)))
    else:
        coef = model.coefficients.toArray()
        rows.append(("(intercept)", 0, float(model.intercept)))
        for j, v in enumerate(coef):
            rows.append((names[j] if names else f"f{j}", 0, float(v)))
    schema = StructType([StructField("term", StringType(), False),
                         StructField("class", IntegerType(), False),
                         StructField("value", DoubleType(), False)])
    return spark.createDataFrame(rows, schema)


def loss_history(spark: SparkSession, model) -> DataFrame:
    """(iteration, loss) of the training summary's objective history."""
    hist = list(model.summary.objectiveHistory)
    schema = StructType([StructField("iteration", IntegerType(), False),
                         StructField("loss", DoubleType(), False)])
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)], schema)


def iterations(spark: SparkSession, model) -> DataFrame:
    schema = StructType([StructField("total_iterations", IntegerType(), False)])
    return spark.createDataFrame([(int(model.summary.totalIterations),)], schema)


def residuals(model, df: DataFrame, label: str = "label", keep: list[str] | None = None) -> DataFrame:
    """label - prediction per row (distributed, any table)."""
    pred = model.transform(df)
    return pred.select(*(keep or []), (F.col(label) - F.col(model.getPredictionCol())).alias("residual"))


def fit_stats(spark: SparkSession, model) -> DataFrame:
    """Training RMSE, r2, MAE and row count of a linear regression."""
    s = model.summary
    schema = StructType([StructField("rmse", DoubleType(), False),
                         StructField("r2", DoubleType(), False),
                         StructField("mae", DoubleType(), False),
                         StructField("n", LongType(), False)])
    return spark.createDataFrame([(float(s.rootMeanSquaredError), float(s.r2),
                                   float(s.meanAbsoluteError), int(s.numInstances))], schema)


def summary_roc(model) -> DataFrame:
    """(FPR, TPR) of a binary logistic model's training summary, from (0,0)
    to (1,1); the summary computes it on the cluster."""
    return model.summary.roc


def summary_auc(spark: SparkSession, model) -> DataFrame:
    schema = StructType([StructField("auc", DoubleType(), False)])
    return spark.createDataFrame([(float(model.summary.areaUnderROC),)], schema)


def tree_nodes(spark: SparkSession, model) -> DataFrame:
    """Node table of a fitted tree model, in the layout of the model's own
    writer: saved to the shared scratch folder and read back as parquet
    (the model itself, and so its nodes, is driver-sized).  A split is a
    ``threshold`` (left: at most that) or, for a categorical feature, the
    ``left_categories``."""
    path = scratch_path(spark, "tree_model")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:            # ensembles: (treeID, nodeData)
        nodes = nodes.select("treeID", "nodeData.*")
    else:
        nodes = nodes.withColumn("treeID", F.lit(0))
    return nodes.select(
        F.col("treeID").cast("int").alias("tree"), F.col("id").cast("int").alias("id"),
        "prediction", "impurity", "gain", F.col("impurityStats").alias("stats"),
        F.col("leftChild").cast("int").alias("left_child"),
        F.col("rightChild").cast("int").alias("right_child"),
        F.col("split.featureIndex").cast("int").alias("feature"),
        F.when(F.col("split.numCategories") < 0,
               F.try_element_at(F.col("split.leftCategoriesOrThreshold"), F.lit(1))).alias("threshold"),
        F.when(F.col("split.numCategories") >= 0,
               F.col("split.leftCategoriesOrThreshold")).alias("left_categories"))


def tree_places(nodes: DataFrame, max_depth: int) -> DataFrame:
    """``nodes`` (as of :func:`tree_nodes`) with ``place``: the root of a tree
    is 1, the children of i are 2i and 2i + 1.  Unlike the ids, places do not
    depend on what the other branches hold, so trees can be compared."""
    level = nodes.filter(F.col("id") == 0).select("tree", "id", F.lit(1).cast("long").alias("place"))
    places = level
    for _ in range(max_depth):
        inner = level.join(nodes.select("tree", "id", "left_child", "right_child"), ["tree", "id"]).filter(F.col("left_child") >= 0)
        level = inner.select("tree", F.posexplode(F.array("left_child", "right_child")).alias("_side", "id"), "place").select(
            "tree", "id", (2 * F.col("place") + F.col("_side")).alias("place"))
        places = places.unionByName(level)
    return nodes.join(places, ["tree", "id"])


def tree_text(model) -> str:
    return model.toDebugString


def centers(spark: SparkSession, model) -> DataFrame:
    """(cluster, dim, value) of fitted cluster centres."""
    rows = [(i, j, float(v)) for i, c in enumerate(model.clusterCenters()) for j, v in enumerate(c)]
    schema = StructType([StructField("cluster", IntegerType(), False),
                         StructField("dim", IntegerType(), False),
                         StructField("value", DoubleType(), False)])
    return spark.createDataFrame(rows, schema)


def params(spark: SparkSession, stage, name: str | None = None) -> DataFrame:
    """(stage, param, value, is_set, doc) for every param of a stage."""
    rows = []
    for p in stage.params:
        has = stage.isDefined(p)
        val = stage.getOrDefault(p) if has else None
        rows.append((name or type(stage).__name__, p.name, None if val is None else str(val),
                     bool(stage.isSet(p)), p.doc))
    schema = StructType([StructField("stage", StringType(), False),
                         StructField("param", StringType(), False),
                         StructField("value", StringType(), True),
                         StructField("is_set", BooleanType(), False),
                         StructField("doc", StringType(), True)])
    return spark.createDataFrame(rows, schema)


def explain_params(stage) -> str:
    """The params of a stage with docs, defaults and set values, as text."""
    return stage.explainParams()


def stages(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(position, stage, uid) of a fitted pipeline."""
    rows = [(i, type(s).__name__, s.uid) for i, s in enumerate(model.stages)]
    schema = StructType([StructField("position", IntegerType(), False),
                         StructField("stage", StringType(), False),
                         StructField("uid", StringType(), False)])
    return spark.createDataFrame(rows, schema)


def stage_of(model: PipelineModel, kind: type | int):
    """Stage by position or by (first) type."""
    if isinstance(kind, int):
        return model.stages[kind]
    for s in model.stages:
        if isinstance(s, kind):
            return s
    raise KeyError(f"no stage of type {kind.__name__}")
