"""Properties of rows-only operators and of the distributed building blocks
(SURVEY §5.2 item 3), on the driver's tables."""

import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import QuantileDiscretizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from spindle.operators import (clean, columns, evaluate, features, layout, learners, profile, ranking, reports,
                               split, tune)
from spindle.plans import q_jobs, setups
from spindle.plans.tables import embedding_features, table
from spindle.session import scratch_path
from spindle.sources import models
from tests.conftest import SF_MID, SF_SMALL


def test_keyed_split_disjoint_complete_and_stable(spark):
    o = table(spark, SF_MID, "orders").select("o_orderkey")
    train, test = split.keyed_split(o, "o_orderkey")
    n, a, b = o.count(), train.count(), test.count()
    assert a + b == n and train.join(test, "o_orderkey").count() == 0
    assert 0.65 < a / n < 0.75
    # layout does not matter: same parts after a repartition
    train2, _ = split.keyed_split(o.repartition(7), "o_orderkey")
    assert train2.exceptAll(train).count() == 0 and train.exceptAll(train2).count() == 0


def test_native_split_disjoint_complete(spark):
    o = table(spark, SF_SMALL, "orders").select("o_orderkey")
    a, b = split.native_split(o, (0.7, 0.3), 11)
    assert a.count() + b.count() == o.count()
    assert a.join(b, "o_orderkey").count() == 0


def test_folds_cover_all_rows(spark):
    o = table(spark, SF_SMALL, "orders").select("o_orderkey", split.fold_column("o_orderkey", 3).alias("f"))
    counts = {r["f"]: r["count"] for r in o.groupBy("f").count().collect()}
    assert set(counts) == {0, 1, 2} and sum(counts.values()) == o.count()


def test_top_per_group_matches_brute_force(spark):
    c = table(spark, SF_MID, "customer")
    long = c.select(F.col("c_nationkey").cast("string").alias("column"),
                    F.col("c_mktsegment").alias("value"))
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    fast = ranking.top_per_group(counts, "column", 2, salt_buckets=3)
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    brute = counts.withColumn("rank", F.row_number().over(w)).filter("rank <= 2")
    assert sorted(fast.collect()) == sorted(brute.collect())


def test_running_totals_many_buckets_equal_one_window(spark):
    li = table(spark, SF_MID, "lineitem").groupBy("l_extendedprice").agg(F.count(F.lit(1)).alias("n"))
    bucketed = ranking.running_totals(li, "l_extendedprice", ["n"], descending=True, ranges=7)
    w = Window.orderBy(F.desc("l_extendedprice")).rowsBetween(Window.unboundedPreceding, 0)
    plain = li.withColumn("cum_n", F.sum("n").over(w))
    assert bucketed.exceptAll(plain).count() == 0 and bucketed.count() == plain.count()


def test_auc_equals_builtin_exact(spark):
    li = table(spark, SF_MID, "lineitem").select(
        F.col("l_extendedprice").alias("score"), (F.col("l_returnflag") == "R").cast("double").alias("label"))
    mine = evaluate.auc(li, "score", "label").first()["auc"]
    ref = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(li)
    assert mine == pytest.approx(ref, abs=1e-12)


def test_roc_starts_and_ends(spark):
    li = table(spark, SF_SMALL, "lineitem").select(
        F.col("l_discount").alias("score"), (F.col("l_returnflag") == "R").cast("double").alias("label"))
    r = evaluate.roc(li, "score", "label").orderBy(F.desc("threshold")).collect()
    assert r[-1]["fpr"] == 1.0 and r[-1]["tpr"] == 1.0
    assert all(a["fpr"] <= b["fpr"] and a["tpr"] <= b["tpr"] for a, b in zip(r, r[1:]))


def test_exact_quantiles_equal_exact_discretizer(spark):
    li = table(spark, SF_MID, "lineitem").select("l_extendedprice")
    ours = features.quantile_splits(li, "l_extendedprice", 4, exact=True)
    ref = QuantileDiscretizer(numBuckets=4, inputCol="l_extendedprice", outputCol="b",
                              relativeError=0.0).fit(li).getSplits()
    assert ours == list(ref)


def test_loss_history_never_rises(spark):
    from spindle.plans.q_learners import _binary_lineitem

    data = _binary_lineitem(spark, SF_SMALL)
    model = learners.fit(learners.logistic_regression(max_iter=10, reg=0.3, elastic=0.8), data)
    losses = [r["loss"] for r in reports.loss_history(spark, model).orderBy("iteration").collect()]
    assert all(b <= a + 1e-12 for a, b in zip(losses, losses[1:]))


def test_same_seed_same_predictions(spark):
    data = embedding_features(spark, SF_SMALL)
    a = learners.fit(learners.random_forest_classifier(num_trees=3, seed=5), data).transform(data)
    b = learners.fit(learners.random_forest_classifier(num_trees=3, seed=5), data).transform(data)
    key = ["vec_id", "prediction"]
    assert a.select(*key).exceptAll(b.select(*key)).count() == 0


def test_saved_model_predicts_the_same(spark):
    data = setups.ols_lineitem(spark, SF_SMALL)
    model = tune.fit_pipeline([setups.exact_linreg()], data)
    path = models.save_stage(model, scratch_path(spark, "t_model"))
    again = models.load_pipeline_model(path)
    a = model.transform(data).select("l_orderkey", "l_linenumber", "prediction")
    b = again.transform(data).select("l_orderkey", "l_linenumber", "prediction")
    assert a.exceptAll(b).count() == 0


def test_forest_of_one_unbagged_tree_is_the_tree(spark):
    data = setups.stump_class_data(spark, SF_SMALL)
    tree = learners.fit(learners.decision_tree_classifier(max_depth=3, max_bins=64), data)
    forest = learners.fit(learners.random_forest_classifier(num_trees=1, max_depth=3, max_bins=64,
                                                            bootstrap=False,
                                                            featureSubsetStrategy="all"), data)
    a = tree.transform(data).select("prediction").collect()
    b = forest.transform(data).select("prediction").collect()
    assert a == b


def test_softmax_rows_sum_to_one(spark):
    data = embedding_features(spark, SF_SMALL)
    model = learners.fit(learners.logistic_regression(max_iter=20, reg=0.01), data)
    s = model.transform(data).select(F.aggregate(vector_to_array("probability"), F.lit(0.0),
                                                 lambda a, x: a + x).alias("s"))
    assert all(abs(r["s"] - 1) < 1e-9 for r in s.collect())


def test_wssse_equals_kmeans_training_cost(spark):
    data = embedding_features(spark, SF_SMALL)
    model = learners.fit(learners.kmeans(k=3, seed=1), data)
    centers = [c.tolist() for c in model.clusterCenters()]
    ours = evaluate.wssse(data, centers).first()["wssse"]
    assert ours == pytest.approx(model.summary.trainingCost, rel=1e-9)


def test_multiclass_job_beats_majority(spark):
    res = q_jobs.run_multiclass(spark, SF_MID)
    major = (res.scored.groupBy("species").count().agg(F.max("count")).first()[0]
             / res.scored.count())
    assert res.metrics["accuracy"] > major


def test_regression_job_beats_mean(spark):
    res = q_jobs.run_regression(spark, SF_MID)
    assert q_jobs.beats_mean(res.scored, "total")
    assert res.metrics["rmse"] < math.sqrt(res.scored.agg(F.var_pop("total")).first()[0])


def test_binary_job_reports(spark):
    res = q_jobs.run_binary(spark, SF_SMALL)
    roc = res.reports["roc"].collect()
    assert (roc[0]["FPR"], roc[0]["TPR"]) == (0.0, 0.0) and (roc[-1]["FPR"], roc[-1]["TPR"]) == (1.0, 1.0)
    assert q_jobs.beats_majority(res.scored, "quality", "predictedLabel") and res.metrics["train_auc"] > 0.9


def test_binary_search_job_beats_majority(spark):
    res = q_jobs.run_binary_cv(spark, SF_SMALL)
    assert q_jobs.beats_majority(res.scored, "quality", "predictedLabel")
    assert res.reports["cv"].count() == 36


def test_text_job_beats_majority(spark):
    assert q_jobs.beats_majority(q_jobs.run_text(spark, SF_MID).scored, "label", "prediction")


def test_tree_nodes_name_the_categories_on_the_left(spark):
    rows = [(float(c), float(c in (1, 3))) for c in range(5) for _ in range(20)]
    df = features.assemble(spark.createDataFrame(rows, "c double, label double"), ["c"], "raw")
    indexed = features.vector_indexer("raw", "features", 8).fit(df).transform(df)
    model = learners.fit(learners.decision_tree_classifier(max_depth=1), indexed)
    root = reports.tree_nodes(spark, model).filter("id = 0").first()
    assert root["threshold"] is None and sorted(root["left_categories"]) in ([0.0, 2.0, 4.0], [1.0, 3.0])


def test_hashed_terms_are_murmur_slots(spark):
    """Slots by an own murmur3 (x86, 32 bit, seed 42), vector by vector."""
    def murmur(data: bytes, h: int = 42) -> int:
        mask = 0xFFFFFFFF
        rot = lambda x, r: ((x << r) | (x >> (32 - r))) & mask
        words = [int.from_bytes(data[i:i + 4], "little") for i in range(0, len(data) // 4 * 4, 4)]
        for k in words:
            h = (rot(h ^ (rot(k * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask), 13) * 5 + 0xE6546B64) & mask
        tail = int.from_bytes(data[len(words) * 4:], "little")
        h ^= rot(tail * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
        h ^= len(data)
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            h = (h ^ (h >> shift)) * factor & mask
        h ^= h >> 16
        return h - (1 << 32) if h >> 31 else h

    docs = features.tokenize(table(spark, SF_SMALL, "documents").select("doc_id", "text").limit(40), "text", "words")
    for r in features.hashing_tf(docs, "words", "tf", 1000).collect():
        want = {}
        for w in r["words"]:
            slot = murmur(w.encode()) % 1000
            want[slot] = want.get(slot, 0.0) + 1.0
        assert dict(zip(r["tf"].indices.tolist(), r["tf"].values.tolist())) == want


def test_profile_is_one_scan(spark):
    from spindle.plans.tables import gappy_customer

    plan = profile.profile_missing(gappy_customer(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 or plan.count("Scan parquet") == 1


def _split_input(spark):
    li = table(spark, SF_SMALL, "lineitem")
    label = (F.col("l_quantity") + 200 * F.col("l_discount") > 30).cast("double")
    return features.assemble(li.withColumn("label", label), ["l_quantity", "l_discount", "l_tax"], "features")


def test_seeded_fits_do_not_depend_on_the_input_layout(spark):
    df = _split_input(spark)
    seen = set()
    for made in (df, df.repartition(2), df.repartition(13, "l_tax"), df.orderBy(F.desc("l_extendedprice")).coalesce(1)):
        seen.add(learners.fit(learners.random_forest_classifier(num_trees=10), made).toDebugString.split("\n", 1)[1])
    assert len(seen) == 1


def test_fit_input_runs_no_job_and_keeps_read_columns_only(spark):
    df = _split_input(spark)
    est = learners.random_forest_classifier()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("layout-probe", "layout")
    with layout.fit_input(df, [est], partitions=5) as data:
        assert len(tracker.getJobIdsForGroup("layout-probe")) == 0
        assert data.columns == ["label", "features"] and data.rdd.getNumPartitions() == 5
    spark.sparkContext.setJobGroup("", "")


def test_gbt_classifier_ten_rounds_beats_majority(spark):
    from spindle.plans.q_learners import _binary_lineitem

    data = _binary_lineitem(spark, SF_MID)
    train, test = split.keyed_split(data, ["l_orderkey", "l_linenumber"])
    learners.check_binary_label(train, "label")
    model = learners.fit(learners.gbt_classifier(max_iter=learners.GBT_CLASSIFIER_ROUNDS), train)
    acc = evaluate.accuracy(model.transform(test)).first()["accuracy"]
    share = test.agg(F.avg("label")).first()[0]
    assert acc > max(share, 1 - share)


def test_roc_down_sampling_keeps_a_subset_and_the_end(spark):
    li = table(spark, SF_MID, "lineitem").select(
        F.col("l_extendedprice").alias("score"), (F.col("l_returnflag") == "R").cast("double").alias("label"))
    full = evaluate.roc(li, "score", "label")
    few = evaluate.roc(li, "score", "label", num_bins=100)
    n = few.count()
    assert 90 <= n <= 102
    assert few.exceptAll(full).count() == 0
    last = few.orderBy("threshold").first()
    assert (last["fpr"], last["tpr"]) == (1.0, 1.0)


def test_unlabelled_scoring_needs_no_label(spark):
    from spindle.plans import jobs

    res = q_jobs.run_multiclass(spark, SF_SMALL)
    rows = q_jobs.multiclass_input(spark, SF_SMALL).drop("species")
    scored = jobs.score_unlabelled(res.model, rows)
    assert scored.count() == rows.count()
    assert {r["predictedLabel"] for r in scored.select("predictedLabel").distinct().collect()} <= {
        "small", "medium", "large"}


def test_multinomial_coefficients_table(spark):
    from spindle.plans.q_jobs import multiclass_input

    df = multiclass_input(spark, SF_SMALL)
    idx = features.string_indexer("species", "label").fit(df).transform(df)
    data = features.assemble(idx, ["l_quantity", "l_discount"], "features")
    model = learners.fit(learners.logistic_regression(max_iter=50, reg=0.01), data)
    t = reports.coefficients(spark, model, reports.feature_names(data)).collect()
    assert {r["class"] for r in t} == {0, 1, 2}
    assert {r["term"] for r in t} == {"(intercept)", "l_quantity", "l_discount"}
    assert len(t) == 9


def test_cv_metrics_table(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    data = setups.ols_lineitem(spark, SF_SMALL).withColumn(
        "fold", split.fold_column(["l_orderkey", "l_linenumber"], 3))
    est = setups.exact_linreg()
    maps = tune.grid([(est.fitIntercept, None)])
    cvm = learners.fit(tune.cross_validator(est, maps, RegressionEvaluator(), 3, fold_col="fold"), data)
    rows = tune.cv_metrics(spark, cvm).orderBy("setting").collect()
    assert [r["setting"] for r in rows] == [0, 1]
    assert rows[0]["avg_metric"] == pytest.approx(cvm.avgMetrics[0])


def test_reliable_fit_input_cuts_lineage_and_cleans_up(spark):
    df = table(spark, SF_SMALL, "orders").groupBy("o_custkey").count()
    with layout.fit_input(df, reliable=True) as data:
        assert "Aggregate" not in data._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(data.collect()) == sorted(df.collect())
        folder = data.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").removeprefix("//")
    import os
    assert not os.path.exists(folder)


def test_iris_style_script_on_a_headerless_csv(spark):
    """The multiclass script as a user would run it: a CSV without header,
    features picked by position, label in the last column."""
    from spindle.plans import jobs
    from spindle.sources import files

    src = q_jobs.multiclass_input(spark, SF_SMALL).drop("l_orderkey", "l_linenumber")
    path = files.write_csv(src, scratch_path(spark, "iris_like"), header=False)
    df = files.read_csv(spark, path, header=False)               # _c0 … _c4, types inferred
    feats = columns.names_slice(df, 0, 4, exclude=["_c4"])
    train, test = split.keyed_split(df, df.columns)              # no key column: hash the row
    res = jobs.multiclass_forest(train, test, "_c4", feats)
    assert 0.0 <= res.metrics["accuracy"] <= 1.0
    assert set(res.scored.columns) >= {"prediction", "predictedLabel", "_c4"}


def test_cv_fold_metrics_average_to_cv_metrics(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    data = setups.ols_lineitem(spark, SF_SMALL).withColumn(
        "fold", split.fold_column(["l_orderkey", "l_linenumber"], 3))
    est = setups.exact_linreg()
    maps = tune.grid([(est.fitIntercept, None)])
    cv = tune.cross_validator(est, maps, RegressionEvaluator(), 3, fold_col="fold", keep_sub_models=True)
    cvm = learners.fit(cv, data)
    folds = tune.cv_fold_metrics(spark, cvm, data, "fold")
    assert folds.count() == 6
    means = {r["setting"]: r["m"] for r in folds.groupBy("setting").agg(F.avg("metric").alias("m")).collect()}
    assert means[0] == pytest.approx(cvm.avgMetrics[0], rel=1e-9)
    assert means[1] == pytest.approx(cvm.avgMetrics[1], rel=1e-9)


def test_running_totals_ascending_many_buckets(spark):
    li = table(spark, SF_MID, "lineitem").groupBy("l_extendedprice").agg(F.count(F.lit(1)).alias("n"))
    bucketed, tot = ranking.running_totals(li, "l_extendedprice", ["n"], descending=False,
                                           ranges=5, with_totals=True)
    w = Window.orderBy(F.asc("l_extendedprice")).rowsBetween(Window.unboundedPreceding, 0)
    plain = li.withColumn("cum_n", F.sum("n").over(w))
    assert bucketed.exceptAll(plain).count() == 0 and bucketed.count() == plain.count()
    assert tot["n"] == li.agg(F.sum("n")).first()[0]


def _odd_scores(spark):
    """Null, NaN and infinite scores, and null labels."""
    inf = float("inf")
    rows = [(0.9, 1.0), (0.8, 0.0), (0.8, 1.0), (0.4, 1.0), (0.1, 0.0), (None, 0.0), (None, 1.0), (float("nan"), 1.0),
            (inf, 0.0), (-inf, 1.0), (0.3, None)]
    return spark.createDataFrame(rows, "score double, label double")


def _rank(score):
    return (0, 0.0) if score is None else (2, 0.0) if score != score else (1, score)


def test_running_totals_keep_null_nan_and_infinite_keys(spark):
    groups = _odd_scores(spark).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    rows = sorted(groups.collect(), key=lambda r: _rank(r["score"]))
    for descending in (False, True):
        want, total = {}, 0
        for r in rows[::-1] if descending else rows:
            total += r["n"]
            want[repr(r["score"])] = total
        for ranges in (1, 2, 20):
            out, tot = ranking.running_totals(groups, "score", ["n"], descending, ranges, with_totals=True)
            assert {repr(r["score"]): r["cum_n"] for r in out.collect()} == want and tot["n"] == 11


def test_auc_counts_rows_without_a_score(spark):
    rows = [(_rank(r["score"]), r["label"] == 1.0) for r in _odd_scores(spark).collect()]
    pairs = [(a, b) for a, p in rows if p for b, q in rows if not q]
    want = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)
    assert evaluate.auc(_odd_scores(spark), "score", "label").first()["auc"] == pytest.approx(want)


def test_running_totals_put_no_rows_in_a_single_partition(spark):
    li = table(spark, SF_SMALL, "lineitem").groupBy("l_extendedprice").agg(F.count(F.lit(1)).alias("n"))
    out = ranking.running_totals(li, "l_extendedprice", ["n"])
    out.collect()
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()


def test_null_keys_stay_in_one_part_and_one_fold(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (2, None), (None, None), (None, None)], "k long, s string")
    train, test = split.keyed_split(df, ["k", "s"])
    assert train.count() + test.count() == 5
    marked = split.label_split(df, ["k", "s"])
    assert marked.filter("part = 'train'").count() == train.count()
    assert df.filter(split.fold_column(["k", "s"]).isNull()).isEmpty()


def test_accuracy_counts_missing_predictions_as_misses(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, None), (None, 1.0), (0.0, 1.0)], "label double, prediction double")
    assert evaluate.accuracy(df).first()["accuracy"] == 0.25


def test_drop_and_fill_agree_with_the_built_in_on_nan(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, None), (3.0, None)], "x double, n int")
    for how, thresh in (("any", None), ("all", None), ("any", 1), ("any", 2)):
        mine = clean.drop_missing(df, how=how, thresh=thresh)
        assert mine.count() == df.na.drop(how=how, thresh=thresh).count()
    assert sorted(r["x"] for r in clean.fill_values(df, {"x": 0.5}).collect()) == sorted(r["x"] for r in df.na.fill({"x": 0.5}).collect())


def test_user_function_never_sees_nulls(spark):
    import numpy as np

    from spindle.functions.udf import register_vectorized

    register_vectorized(spark, "band_of", lambda s: np.floor(s / 1000).astype("int64"), "bigint")
    spark.createDataFrame([(1500.0,), (None,), (float("nan"),), (-1.0,)], "x double").createOrReplaceTempView("banded")
    assert [r[0] for r in spark.sql("SELECT band_of(x) FROM banded").collect()] == [1, None, None, -1]
    register_vectorized(spark, "plus_one", lambda s: s + 1, "bigint")
    spark.createDataFrame([(9007199254740993,), (None,)], "n long").createOrReplaceTempView("large")
    big = [r[0] for r in spark.sql("SELECT plus_one(n) FROM large WHERE n IS NOT NULL").collect()]
    assert big == [9007199254740994]


def test_wssse_takes_many_centres(spark):
    df = spark.range(10).select(F.array(F.col("id").cast("double")).alias("features"))
    assert evaluate.wssse(df, [[float(i)] for i in range(3000)]).first()["wssse"] == 0.0


def test_clf_gbt_runs_all_rounds_to_full_depth(spark, monkeypatch):
    """Ten trees, each as deep as the reference's, and a row for each."""
    from spindle.plans import q_learners

    made, fit = [], learners.fit
    monkeypatch.setattr(learners, "fit", lambda *a, **kw: made.append(fit(*a, **kw)) or made[-1])
    rows = q_learners.clf_gbt(spark, SF_SMALL).orderBy("tree").collect()
    assert [r["tree"] for r in rows] == list(range(learners.GBT_CLASSIFIER_ROUNDS))
    assert [t.depth for t in made[0].trees] == [5] * learners.GBT_CLASSIFIER_ROUNDS
