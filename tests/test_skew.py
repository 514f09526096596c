"""A value holding a third of all rows: results stay exact and whole, and
the hot value is pre-aggregated before any shuffle."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from spindle.operators import evaluate, features, profile
from spindle.plans.tables import table
from tests.conftest import SF_MID


def _hot(spark):
    li = table(spark, SF_MID, "lineitem")
    hot = F.when(F.col("l_returnflag") == "A", F.lit("HOT")).otherwise(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    score = F.when(F.col("l_returnflag") == "A", F.lit(1000.0)).otherwise(F.col("l_extendedprice"))
    return li.select(hot.alias("k"), score.alias("score"),
                     (F.col("l_linestatus") == "O").cast("double").alias("label"))


def test_hot_value_profile_is_exact(spark):
    df = _hot(spark)
    n_hot = df.filter(F.col("k") == "HOT").count()
    assert n_hot > df.count() / 4
    top = profile.profile_values(df.select("k"), top_n=3).orderBy("rank").collect()
    assert (top[0]["value"], top[0]["count"]) == ("HOT", n_hot)
    counts = df.groupBy(F.col("k").alias("value")).agg(F.count(F.lit(1)).alias("count"))
    w = Window.orderBy(F.desc("count"), F.asc("value"))
    brute = counts.withColumn("rank", F.row_number().over(w)).filter("rank <= 3").orderBy("rank").collect()
    assert [(r["value"], r["count"]) for r in top] == [(r["value"], r["count"]) for r in brute]


def test_hot_value_group_count_aggregates_map_side(spark):
    g = profile.group_count(_hot(spark), "k")
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert g.filter(F.col("k") == "HOT").first()["count"] == _hot(spark).filter(F.col("k") == "HOT").count()
    assert g.agg(F.sum("count")).first()[0] == _hot(spark).count()


def test_hot_score_auc_is_exact(spark):
    df = _hot(spark)
    mine = evaluate.auc(df, "score", "label").first()["auc"]
    ref = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(df)
    assert abs(mine - ref) < 1e-12


def test_hot_value_quantiles(spark):
    df = _hot(spark)
    splits = features.quantile_splits(df, "score", 4, exact=True)
    vals = sorted(r["score"] for r in df.select("score").collect())
    import math
    want = sorted({vals[math.ceil(p * len(vals)) - 1] for p in (0.25, 0.5, 0.75)})
    assert splits[1:-1] == want
