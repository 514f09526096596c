"""Streaming scoring with a fitted pipeline, and plan-shape checks
(SURVEY §5.2 item 5)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from spindle.operators import features, learners, profile, tune
from spindle.plans import setups
from spindle.plans.tables import gappy_customer, table
from spindle.session import scratch_path
from spindle.streaming import score_stream, windowed_accuracy, write_scores
from tests.conftest import SF_SMALL

QUERIES = entry.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stream_scores_equal_batch_scores(spark):
    li = table(spark, SF_SMALL, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_extendedprice").alias("label"))
    model = tune.fit_pipeline([features.assembler(["l_quantity"], "features"), setups.exact_linreg()], li)
    src = scratch_path(spark, "stream_in")
    li.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(li.schema).option("maxFilesPerTrigger", 1).parquet(src)
    scored = score_stream(model, stream, ["l_orderkey", "l_linenumber", "prediction"])
    out = scratch_path(spark, "stream_out")
    kept = scratch_path(spark, "stream_ckpt")
    for _ in range(2):  # the second run finds nothing new
        q = write_scores(scored, out, kept)
        q.awaitTermination(120)
    got = spark.read.parquet(out)
    want = model.transform(li).select("l_orderkey", "l_linenumber", "prediction")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_windowed_accuracy_stream(spark):
    ev = table(spark, SF_SMALL, "events").select(
        "ts", (F.col("value") > 10).cast("double").alias("label"),
        (F.col("event_type") == "click").cast("double").alias("prediction"))
    src = scratch_path(spark, "events_in")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    acc = windowed_accuracy(stream, "ts", "label", window="1 day", watermark="1 hour")
    q = (acc.writeStream.format("memory").queryName("win_acc").outputMode("append")
         .option("checkpointLocation", scratch_path(spark, "win_ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    rows = spark.sql("SELECT * FROM win_acc").collect()
    # append mode emits a window once the watermark passes it: all but the last day
    assert len(rows) >= 1 and all(0.0 <= r["accuracy"] <= 1.0 for r in rows)
    batch = ev.groupBy(F.window("ts", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    want = {r["w"]["start"]: r["n"] for r in batch.collect()}
    assert all(want[r["window_start"]] == r["n"] for r in rows)


NATIVE = ["fn_default_if_null", "fn_bucket_override", "fn_sum_flag", "fn_split_words", "col_relabel",
          "prof_nulls", "prof_values", "na_fill", "na_drop", "split_random", "ft_tokenize",
          "ft_assemble", "eval_auc", "eval_roc"]


@pytest.mark.parametrize("name", NATIVE)
def test_native_paths_have_no_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_udf_path_is_vectorized(spark):
    plan = _plan(QUERIES["udf_register"](spark, SF_SMALL))
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_filter_and_projection_reach_the_scan(spark):
    plan = _plan(QUERIES["flt_compare"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,250000.0)]" in plan
    plan = _plan(QUERIES["col_select"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_group_count_aggregates_before_shuffle(spark):
    plan = _plan(QUERIES["agg_group_count"](spark, SF_SMALL))
    assert "partial_count" in plan


def test_limit_is_top_k(spark):
    plan = _plan(QUERIES["limit_n"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan


def test_profiles_scan_once(spark):
    g = gappy_customer(spark, SF_SMALL)
    for df in (profile.profile_missing(g), profile.profile_values(g)):
        assert _plan(df).count("FileScan parquet") == 1


def test_top_values_never_window_over_whole_table(spark):
    plan = _plan(profile.profile_values(gappy_customer(spark, SF_SMALL)))
    assert "SinglePartition" not in plan
