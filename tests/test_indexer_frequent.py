"""String index stages whose labels stay on the cluster, frequent values in
two passes, hashed slots."""

from collections import Counter

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from spindle.operators import features, frequent, learners
from spindle.operators.indexer import TableIndexer
from spindle.session import scratch_path


@pytest.fixture(scope="module")
def values(spark):
    return spark.range(500).select("id", F.concat(F.lit("v"), (F.col("id") * F.col("id") % 37).cast("string")).alias("a.v"), F.lit(1).alias("index"))


def test_stage_equals_the_built_in_one_after_two_round_trips(spark, values):
    want = features.string_indexer("v", "i").fit(values.withColumnRenamed("a.v", "v")).transform(values.withColumnRenamed("a.v", "v"))
    paths = [scratch_path(spark, "index") for _ in range(2)]
    Pipeline(stages=[TableIndexer(inputCol="a.v", outputCol="i")]).write().overwrite().save(paths[0])
    model = Pipeline.load(paths[0]).fit(values)
    for _ in range(2):
        model.write().overwrite().save(paths[1])
    loaded = PipelineModel.load(paths[1])
    got = loaded.transform(values)
    assert got.columns == ["id", "a.v", "index", "i"]
    assert got.exceptAll(want).isEmpty() and got.count() == 500
    assert loaded.stages[0].uid == model.stages[0].uid
    back = loaded.stages[0].back("i", "label").transform(got)
    assert back.filter(~F.col("label").eqNullSafe(F.col("`a.v`"))).isEmpty()
    with pytest.raises(ValueError):
        stage = loaded.stages[0]
        stage.write().overwrite().save(stage.getOrDefault("table").removesuffix("/labels"))


def test_stage_on_null_unseen_and_empty(spark):
    train = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "c string")
    test = spark.createDataFrame([("z",), ("a",), (None,)], "c string")
    rows = lambda how: {(r["c"], r["i"]) for r in TableIndexer(inputCol="c", outputCol="i", handleInvalid=how).fit(train).transform(test).collect()}
    assert rows("keep") == {("z", 2.0), ("a", 1.0), (None, 2.0)}
    assert rows("skip") == {("a", 1.0)}
    with pytest.raises(Exception, match="no index for c value"):
        rows("error")
    nothing = TableIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(train.limit(0))
    assert nothing.labels.count() == 0 and {r["i"] for r in nothing.transform(test).collect()} == {0.0}
    assert nothing.back("i", "l").transform(nothing.transform(test)).filter("l IS NOT NULL").isEmpty()


def test_tree_learns_from_an_index_without_metadata(spark):
    df = spark.range(300).select((F.col("id") % 3).cast("double").alias("x"), F.concat(F.lit("class "), (F.col("id") % 3).cast("string")).alias("y"))
    stages = [TableIndexer(inputCol="y", outputCol="label"), features.assembler(["x"], "features"), learners.decision_tree_classifier()]
    model = Pipeline(stages=stages).fit(df)
    scored = model.stages[0].back("prediction", "said").transform(model.transform(df))
    assert scored.filter("said <> y").isEmpty()


def test_frequent_values_on_hot_unique_and_null_columns(spark):
    df = spark.range(30_000).select(
        F.col("id").alias("key"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("x.y"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 4).alias("count")).repartition(7)
    got = frequent.frequent_values(df, share=0.01)
    assert [tuple(r) for r in got.orderBy("column", "rank").collect()] == [
        ("count", None, 15_000, 1), ("count", "0", 7_500, 2), ("count", "2", 7_500, 3), ("x.y", "hot", 10_000, 1)]
    assert all(len(c) <= 101 for c in frequent.candidates(df, df.columns, 0.01))
    assert frequent.frequent_values(df, share=0.3, top_n=1).count() == 2
    assert frequent.frequent_values(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        frequent.frequent_values(df, share=0.0)


def test_frequent_values_miss_none_at_the_limit(spark):
    # 40 values just above a fortieth less one of the rows, dealt unevenly
    rows = [f"v{i % 39}" for i in range(39 * 100)] + [f"rare{i}" for i in range(90)]
    df = spark.createDataFrame([(r,) for r in rows], "v string").repartition(5)
    want = {(v, n) for v, n in Counter(rows).items() if n > 0.025 * len(rows)}
    assert len(want) == 39
    assert {(r["value"], r["count"]) for r in frequent.frequent_values(df, share=0.025).collect()} == want


def test_unique_column_shuffles_no_distinct_value(spark):
    df = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).repartition(4)
    found = frequent.candidates(df, ["k"], 0.01)[0]
    kept = df.filter(F.xxhash64("k").isin(found)) if found else df.limit(0)
    assert kept.count() <= 101


def test_collisions_of_few_slots(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c"],), ([],), (None,), (["d"] * 5,)], "w array<string>")
    rows = features.hash_collisions(df, "w", 1).collect()
    assert [tuple(r) for r in rows] == [(0, 4, 9, "a")]
    assert features.hash_collisions(df, "w", 1 << 18).count() == 0
