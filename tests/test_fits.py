"""Layout of fit inputs, searches in one pass and the L1 hinge learner."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from spindle.operators import batched, features, layout, learners, reports, rules, split, tune
from spindle.plans import q_jobs, setups
from spindle.plans.tables import table
from tests.conftest import SF_MID, SF_SMALL


def _sizes(df, partitions):
    found = dict(df.groupBy(F.spark_partition_id().alias("p")).count().collect())
    return [found.get(p, 0) for p in range(partitions)]


@pytest.mark.parametrize("setup", [setups.logit_discount, setups.logit_tax])
def test_equal_rows_fill_all_partitions(spark, setup):
    df = features.assemble(setup(spark, SF_MID), ["x"], "features").select("label", "features")   # four distinct rows
    for partitions in (3, 8):
        sizes = _sizes(layout.by_content(df, partitions), partitions)
        assert sum(sizes) == df.count() and max(sizes) <= 1.2 * sum(sizes) / partitions and min(sizes) >= 0.8 * sum(sizes) / partitions


def test_layout_keeps_rows_of_any_kind(spark):
    rows = [(1, "a", None, {"k": 1}), (1, "a", None, {"k": 1}), (2, None, float("nan"), None), (2, None, float("nan"), None), (3, "", 0.5, {})] * 7
    df = spark.createDataFrame(rows, "`a.b` int, s string, d double, m map<string,int>")
    for made in (df, df.repartition(5), df.coalesce(1)):
        with layout.fit_input(made, partitions=4) as data:
            assert data.columns == df.columns
            assert sorted(map(repr, data.collect())) == sorted(map(repr, df.collect()))
            seen = [sorted(map(repr, p)) for p in data.rdd.glom().collect()]
        with layout.fit_input(made, partitions=4, reliable=True) as data:
            assert [sorted(map(repr, p)) for p in data.rdd.glom().collect()] == seen
    assert layout.by_content(df.filter("false")).collect() == []


def test_hot_row_is_expanded_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(layout, "_CHUNK", 7)
    df = spark.range(1000).selectExpr("id % 2 AS x").unionByName(spark.range(3).selectExpr("id + 5 AS x"))
    out = layout.by_content(df, 4)
    assert dict(out.groupBy("x").count().collect()) == {0: 500, 1: 500, 5: 1, 6: 1, 7: 1}
    assert max(_sizes(out, 4)) <= 254


def test_partitions_of_a_fit_grow_with_its_rows(spark, monkeypatch):
    """Without a given number, a partition holds no more as the table grows."""
    rows = lambda n: spark.range(n).selectExpr("CAST(id AS DOUBLE) AS label", "CAST(id % 7 AS DOUBLE) AS x")
    each = layout.ROW_BYTES + 16
    monkeypatch.setattr(layout, "PARTITION_BYTES", 100 * each)
    assert layout.fit_partitions(rows(0)) == layout.fit_partitions(rows(700)) == layout.FIT_PARTITIONS
    for n in (2000, 6000):
        for made in (rows(n), rows(n).coalesce(1)):
            with layout.fit_input(made) as data:
                assert data.rdd.getNumPartitions() == n // 100
                sizes = _sizes(data, n // 100)
                assert sum(sizes) == n and max(sizes) <= 200
    hot = rows(1).crossJoin(spark.range(5000)).select("label", "x")
    assert max(_sizes(layout.by_content(hot), 50)) <= 101


def test_wide_values_count_for_the_partitions_of_a_fit(spark, monkeypatch):
    monkeypatch.setattr(layout, "PARTITION_BYTES", 10_000)
    texts = spark.createDataFrame([("x" * 5000, ["y" * 400, None], None)] * 20 + [(None, None, None)], "text string, words array<string>, gap array<double>")
    least = 20 * 5400 // 10_000
    assert least <= layout.fit_partitions(texts) <= 2 * least
    plain = texts.limit(20).selectExpr("array_repeat(1.0D, 1000) AS x")
    from pyspark.ml.functions import array_to_vector
    vectors = plain.select(array_to_vector("x").alias("features"))
    assert layout.fit_partitions(vectors) >= 20 * 8000 // 10_000
    search = tune.search_cv(spark, _folded(spark), [], learners.logistic_regression(max_iter=3), [{}], MulticlassClassificationEvaluator(metricName="accuracy"), "_fold", 3)
    assert search[2] == 0


def _folded(spark):
    train, _ = split.keyed_split(q_jobs.binary_input(spark, SF_MID), "doc_id")
    rows = train.withColumn("label", F.col("quality").cast("double")).withColumn("_fold", split.fold_column(["doc_id"], 3))
    flat = rows.withColumn("constant", F.lit(2.0))
    return features.assemble(flat, ["n_chars", "symbols", "capitals", "variety", "constant"], "features")


def test_search_in_one_pass_equals_single_fits(spark):
    data = _folded(spark)
    lr = learners.logistic_regression(max_iter=400, tol=1e-12)
    maps = tune.grid([(lr.regParam, [0.1, 0.01]), (lr.fitIntercept, None), (lr.elasticNetParam, [0.0, 0.5, 1.0])])
    maps += [{lr.regParam: 0.02, lr.standardization: False, lr.threshold: 0.6}]
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    assert tune.fits_together(lr, maps, ev)
    _, one, best = tune.search_cv(spark, data, [], lr, maps, ev, "_fold", 3)
    _, many, best_many = tune.search_cv(spark, data, [], lr, maps, ev, "_fold", 3, together=False)
    a, b = (sorted(map(tuple, t.collect())) for t in (one, many))
    assert [r[:2] for r in a] == [r[:2] for r in b] and np.allclose([r[2] for r in a], [r[2] for r in b], atol=1e-6)
    assert best == best_many


def test_batched_coefficients_equal_single_fits(spark):
    data = _folded(spark)
    settings = [batched.Setting(r, e, i, s) for r, e in ((0.0, 0.0), (0.05, 0.0), (0.02, 0.8)) for i in (True, False) for s in (True, False)]
    from pyspark.ml.functions import vector_to_array
    rows = data.select(F.lit(0).alias("_set"), F.lit(False).alias("_valid"), "label", vector_to_array("features").alias("features")).cache()
    found = batched.fit_logistic(batched.blocks(rows), [5], settings)[0]
    x, y = (np.array(c) for c in zip(*[(r.features, r.label) for r in rows.collect()], strict=True))
    for s, m in zip(settings, found, strict=True):
        single = learners.fit(learners.logistic_regression(max_iter=1000, tol=1e-14, reg=s.reg, elastic=s.elastic, fit_intercept=s.fit_intercept,
                                                           standardization=s.standardization), data)
        assert m.done

        def objective(coef, intercept, s=s, m=m):
            margin = x @ coef + intercept
            weight = m.deviation if s.standardization else np.ones(5)
            return (np.logaddexp(0, margin) - y * margin).mean() + s.reg * (s.elastic * np.abs(coef * weight).sum() + (1 - s.elastic) / 2 * ((coef * weight) ** 2).sum())

        mine, theirs = objective(m.coefficients, m.intercept), objective(single.coefficients.toArray(), single.intercept)
        assert mine <= theirs + 1e-9
        if s.reg:
            assert np.allclose(m.coefficients * m.deviation, single.coefficients.toArray() * m.deviation, atol=2e-3)
            assert m.intercept == pytest.approx(single.intercept, abs=5e-2)


def test_one_class_and_bad_labels(spark):
    rows = spark.createDataFrame([(0, False, 1.0, [1.0]), (0, True, 0.0, [2.0]), (1, False, 1.0, [1.0]), (1, False, 0.0, [2.0])], "_set int, _valid boolean, label double, features array<double>")
    packed = batched.blocks(rows).cache()
    models = batched.fit_logistic(packed, [1, 1], [batched.Setting(0.1, 0.5)])
    assert batched.accuracies(packed, models)[0] == [0.0] and math.isnan(batched.accuracies(packed, models)[1][0])
    with pytest.raises(ValueError, match="neither"):
        batched.fit_logistic(batched.blocks(rows.withColumn("label", F.lit(2.0))), [1, 1], [batched.Setting()])


def test_wide_or_weighted_searches_go_one_by_one(spark):
    lr = learners.logistic_regression()
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    assert not tune.fits_together(lr.copy().setWeightCol("w"), [], ev)
    assert not tune.fits_together(lr, [{lr.maxIter: 3}], ev)
    assert not tune.fits_together(lr, [], MulticlassClassificationEvaluator(metricName="f1"))
    assert not tune.fits_together(learners.linear_svc(), [], ev)


def test_l1_hinge_drops_noise_and_scores(spark):
    li = table(spark, SF_SMALL, "lineitem")
    rows = li.select((F.col("l_linestatus") == "O").cast("double").alias("label"),
                     F.when(F.col("l_linestatus") == "O", 1.5).otherwise(-1.5).alias("x"), (F.col("l_tax") * 25 - 1).alias("noise"))
    data = features.assemble(rows, ["x", "noise"], "features")
    model = learners.fit_linear_svc_l1(data, steps=80)
    assert abs(model.coefficients[1]) < 0.02 < model.coefficients[0]
    scored = learners.score_linear_svc(model, data)
    assert scored.filter("label <> prediction").isEmpty()
    with pytest.raises(ValueError, match="no rows"):
        learners.fit_linear_svc_l1(data.filter("false"))


def test_rules_score_as_the_models_do(spark):
    li = table(spark, SF_SMALL, "lineitem")
    mode = F.pmod("l_suppkey", F.lit(7)).cast("double")
    label = (F.col("l_quantity") + 200 * F.col("l_discount") + 5 * F.pmod(mode, F.lit(3)) > 35).cast("double")
    rows = li.select(label.alias("label"), F.col("l_extendedprice").alias("y"), mode.alias("mode"), "l_quantity", "l_discount", "l_tax")
    raw = features.assemble(rows, ["mode", "l_quantity", "l_discount", "l_tax"], "raw")
    data = features.vector_indexer("raw", "features", 7).fit(raw).transform(raw).cache()
    kw = {"max_depth": 5, "max_bins": 32}
    made = [(learners.decision_tree_classifier(**kw), 0), (learners.random_forest_classifier(num_trees=10, **kw), 0),
            (learners.decision_tree_regressor("y", **kw), 0), (learners.random_forest_regressor("y", num_trees=5, **kw), 1e-6),
            (learners.gbt_regressor("y", max_iter=4, **kw), 1e-6)]
    for est, far in made:
        model = learners.fit(est, data)
        both = rules.score_by_rules(model, model.transform(data), prediction="by_rules")
        assert both.filter(F.abs(F.col("by_rules") - F.col("prediction")) > far).isEmpty(), type(model).__name__
        assert both.filter("by_rules IS NULL").isEmpty()
    assert not reports.tree_nodes(spark, learners.fit(made[0][0], data)).filter("left_categories IS NOT NULL").isEmpty()


def _read_by_fits(monkeypatch, kind):
    """The rows that each fit of ``kind`` is given from now on."""
    seen, fit = [], kind._fit
    monkeypatch.setattr(kind, "_fit", lambda self, data: seen.append(data.toPandas()) or fit(self, data))
    return seen


def _repeated(spark):
    """5,000 rows, a fifth of them one row, of 40 distinct ones."""
    rows = spark.range(4000).selectExpr("CAST(id % 8 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b").union(spark.range(1000).selectExpr("3.0D", "1.0D"))
    y = F.when(F.col("a") > 3, 10 * F.col("b")).otherwise(F.col("a") * F.col("b"))
    return features.assemble(rows.select("a", "b", (F.col("a") + F.col("b") > 5).cast("double").alias("label"), y.alias("y")), ["a", "b"], "features")


def _weighs_copies_as_rows(spark, monkeypatch, kind, est):
    data = _repeated(spark)
    plain = est.fit(data)
    monkeypatch.setattr(layout, "WEIGHED_PIECES", 50)
    seen = _read_by_fits(monkeypatch, kind)
    model = learners.fit(est, data)
    assert len(seen[0]) <= 40 + 50 and seen[0][layout.WEIGHT].sum() == 5000 and seen[0][layout.WEIGHT].max() <= 100
    assert model.getNumTrees == plain.getNumTrees and not model.isSet(model.weightCol)
    both = model.transform(data).select("a", "b", "prediction").exceptAll(plain.transform(data).select("a", "b", "prediction"))
    assert both.isEmpty() if kind is learners.GBTClassifier else np.allclose(*[
        [r[0] for r in m.transform(data).orderBy("a", "b").select("prediction").collect()] for m in (model, plain)], atol=1e-9)


def test_boosted_classes_read_copies_of_a_row_once(spark, monkeypatch):
    _weighs_copies_as_rows(spark, monkeypatch, learners.GBTClassifier, learners.gbt_classifier(max_iter=4))


def test_boosted_numbers_read_copies_of_a_row_once(spark, monkeypatch):
    _weighs_copies_as_rows(spark, monkeypatch, learners.GBTRegressor, learners.gbt_regressor("y", max_iter=4))


def test_weights_of_equal_rows_add_up(spark, monkeypatch):
    """Pieces of a bounded weight, evenly dealt; few rows come as they are."""
    data = _repeated(spark).select("label", "features")
    with layout.weighted_input(data, partitions=4) as rows:
        assert rows.count() == 5000 and rows.agg(F.max(layout.WEIGHT)).first()[0] == 1.0
        assert rows.rdd.getNumPartitions() == 4 and max(_sizes(rows, 4)) <= 1700
        assert sorted(map(repr, rows.drop(layout.WEIGHT).collect())) == sorted(map(repr, data.collect()))
    monkeypatch.setattr(layout, "WEIGHED_PIECES", 7)
    with layout.weighted_input(data) as rows:
        assert rows.rdd.getNumPartitions() == layout.FIT_PARTITIONS and rows.count() <= 47
        weighed = rows.groupBy("label", "features").agg(F.sum(layout.WEIGHT).cast("long").alias("n"))
        assert weighed.exceptAll(data.groupBy("label", "features").agg(F.count("*").alias("n"))).isEmpty()
    with layout.weighted_input(data.filter("false")) as rows:
        assert rows.collect() == []


def test_rows_that_a_learner_draws_or_counts_stay_single(spark, monkeypatch):
    monkeypatch.setattr(layout, "WEIGHED_PIECES", 50)
    seen = _read_by_fits(monkeypatch, learners.GBTClassifier)
    data = _repeated(spark).withColumn("w", F.lit(2.0))
    for kw in ({"subsamplingRate": 0.5}, {"minInstancesPerNode": 3}, {"weightCol": "w"}):
        learners.fit(learners.gbt_classifier(max_iter=1, **kw), data)
        assert len(seen[-1]) == 5000 and layout.WEIGHT not in seen[-1]
