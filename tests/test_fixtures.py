"""Golden literals (FIXTURES.md §3) and negative cases."""

import math
import os
import tempfile

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from spindle.functions import scalar
from spindle.operators import clean, columns, evaluate, features, learners, tune
from spindle.sources import files

# --- fixed values: expected results of the worked examples --------------------


def test_logreg_param_map_override(spark):
    train = spark.createDataFrame([
        (1.0, Vectors.dense(0.0, 1.1, 0.1)), (0.0, Vectors.dense(2.0, 1.0, -1.0)),
        (0.0, Vectors.dense(2.0, 1.3, 1.0)), (1.0, Vectors.dense(0.0, 1.2, -0.5))], ["label", "features"])
    test = spark.createDataFrame([
        (1.0, Vectors.dense(-1.0, 1.5, 1.3)), (0.0, Vectors.dense(3.0, 2.0, -0.1)),
        (1.0, Vectors.dense(0.0, 2.2, -1.5))], ["label", "features"])
    lr = learners.logistic_regression(max_iter=10, reg=0.01)
    pm = tune.merge_params({lr.maxIter: 20}, {lr.maxIter: 30}, {lr.regParam: 0.1, lr.threshold: 0.55},
                           {lr.probabilityCol: "myProbability"})
    model = learners.fit(lr, train, pm)
    out = model.transform(test).select(vector_to_array("myProbability")[1].alias("p"), "prediction").collect()
    assert [round(r["p"], 4) for r in out] == [0.9429, 0.0761, 0.8903]
    assert [r["prediction"] for r in out] == [1.0, 0.0, 1.0]
    assert all((r["p"] > 0.55) == (r["prediction"] == 1.0) for r in out)


def test_tokenizer_keeps_commas(spark):
    df = spark.createDataFrame([(0, "Hi I heard about Spark"), (1, "I wish Java could use case classes"),
                                (2, "Logistic,regression,models,are,neat")], ["label", "sentence"])
    rows = features.tokenize(df, "sentence", "words").orderBy("label").collect()
    assert rows[0]["words"] == ["hi", "i", "heard", "about", "spark"]
    assert rows[2]["words"] == ["logistic,regression,models,are,neat"]


def test_tokenizer_edge_cases(spark):
    df = spark.createDataFrame([(0, "a  b"), (1, "a b  "), (2, "")], ["i", "s"])
    rows = {r["i"]: r["words"] for r in features.tokenize(df, "s", "words").collect()}
    assert rows[0] == ["a", "", "b"] and rows[1] == ["a", "b"] and rows[2] == [""]
    rt = {r["i"]: r["words"] for r in features.regex_tokenize(df, "s", "words").collect()}
    assert rt[0] == ["a", "b"] and rt[2] == []


def test_pca_explained_variance(spark):
    df = spark.createDataFrame([(Vectors.sparse(5, [(1, 1.0), (3, 7.0)]),),
                                (Vectors.dense(2.0, 0.0, 3.0, 4.0, 5.0),),
                                (Vectors.dense(4.0, 0.0, 0.0, 6.0, 7.0),)], ["features"])
    model = features.fit_pca(df, "features", 3)
    ev = [round(r["explained_variance"], 5) for r in features.pca_variance(spark, model).collect()]
    assert ev == [0.79439, 0.20561, 0.0]


def test_sparse_literals_and_dense_vectors_are_one(spark):
    sparse = columns.sparse_literal(spark, 5, [{1: 1.0, 3: 7.0}, {}, {0: 2.0}])
    dense = spark.createDataFrame([(Vectors.dense(0.0, 1.0, 0.0, 7.0, 0.0),), (Vectors.dense([0.0] * 5),), (Vectors.dense(2.0, 0.0, 0.0, 0.0, 0.0),)], ["features"])
    items = [columns.vector_items(df, "features", 5).collect() for df in (sparse, dense)]
    assert items[0] == items[1] and sparse.first()["features"] == Vectors.sparse(5, [1, 3], [1.0, 7.0])


def test_sparse_vectors_by_the_value_of_a_column(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, None, 0), (4, "z", 0), (5, "a", 0)], "id long, k string, _other int")
    got = {r["id"]: r["v"] for r in columns.with_sparse(df, "k", 5, {"a": {1: 1.0, 3: 7.0}, "b": {}}, "v").collect()}
    full, empty = Vectors.sparse(5, [1, 3], [1.0, 7.0]), Vectors.sparse(5, [], [])
    assert got == {1: full, 2: empty, 3: None, 4: None, 5: full}
    assert columns.with_sparse(df.filter("false"), "k", 5, {}, "v").collect() == []


def test_string_index_order_and_round_trip(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "a"), (4, "a"), (5, "c")], ["id", "category"])
    built_in = features.string_indexer("category", "idx").fit(df)
    joined = [r["label"] for r in features.label_index(df, "category").orderBy("index").collect()]
    assert list(built_in.labels) == ["a", "c", "b"] == joined
    back = features.index_to_string(built_in.transform(df), "idx", "orig")
    assert all(r["orig"] == r["category"] for r in back.collect())


def test_string_index_unseen_raises_and_keep(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], ["c"])
    test = spark.createDataFrame([("z",), ("b",), (None,)], ["c"])
    labels = features.label_index(train, "c")
    with pytest.raises(Exception):
        features.string_index(test, "c", "i", labels).collect()
    kept = features.string_index(test, "c", "i", labels, handle_invalid="keep").collect()
    assert {(r["c"], r["i"]) for r in kept} == {("z", 2.0), ("b", 1.0), (None, 2.0)}
    assert [r["i"] for r in features.string_index(test, "c", "i", labels, handle_invalid="skip").collect()] == [1.0]


def test_string_index_by_join_equals_the_stage(spark):
    df = spark.range(500).select(F.concat(F.lit("v"), (F.col("id") * F.col("id") % 37).cast("string")).alias("v"))
    stage = features.string_indexer("v", "i").fit(df).transform(df)
    assert features.string_index(df, "v", "i").exceptAll(stage).isEmpty()


def _five(spark):
    data = [Vectors.dense(1.0, 2.0, 3.0, 4.0, 5.0), Vectors.dense(1.0, 1.0, 2.0, 3.0, 4.0),
            Vectors.dense(1.0, 2.0, 1.0, 2.0, 3.0), Vectors.dense(1.0, 1.0, 3.0, 1.0, 2.0),
            Vectors.dense(1.0, 1.0, 2.0, 1.0, 1.0)]
    return spark.createDataFrame([(i, v) for i, v in enumerate(data)], ["i", "features"])


def test_vector_indexer(spark):
    df = _five(spark)
    model = features.vector_indexer("features", "indexed", 3).fit(df)
    assert sorted(model.categoryMaps) == [0, 1, 2]
    first = model.transform(df).orderBy("i").first()["indexed"].toArray().tolist()
    assert first == [0.0, 1.0, 2.0, 4.0, 5.0]
    rep = features.category_report(spark, model).collect()
    assert {r["feature"] for r in rep} == {0, 1, 2}


def test_vector_indexer_zero_first(spark):
    df = spark.createDataFrame([(Vectors.dense(-1.0),), (Vectors.dense(0.0),), (Vectors.dense(2.0),)], ["features"])
    m = features.vector_indexer("features", "ix", 5).fit(df)
    assert m.categoryMaps[0] == {0.0: 0, -1.0: 1, 2.0: 2}


def test_normalizer(spark):
    row = features.normalize(_five(spark), "features", "n", 2.0).orderBy("i").first()["n"].toArray()
    assert [round(x, 5) for x in row] == [0.13484, 0.26968, 0.40452, 0.53936, 0.6742]
    z = spark.createDataFrame([(Vectors.dense(0.0, 0.0),)], ["features"])
    assert features.normalize(z, "features", "n").first()["n"].toArray().tolist() == [0.0, 0.0]


def test_assembler(spark):
    df = spark.createDataFrame([(0, 18, 1.0, Vectors.dense(0.0, 10.0, 0.5), 1.0)],
                               ["id", "hour", "mobile", "userFeatures", "clicked"])
    out = features.assemble(df, ["hour", "mobile", "userFeatures"], "features").first()["features"]
    assert out.toArray().tolist() == [18.0, 1.0, 0.0, 10.0, 0.5]


def test_assembler_null_raises(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception):
        features.assemble(df, ["a", "b"]).collect()
    assert features.assemble(df, ["a", "b"], handle_invalid="skip").count() == 0


def test_quantile_buckets(spark):
    df = spark.createDataFrame([(0, 18.0), (1, 19.0), (2, 8.0), (3, 5.0), (4, 2.2)], ["id", "hour"])
    exact, splits = features.quantile_bucket(df, "hour", "b", 3, exact=True)
    assert splits[1:-1] == [5.0, 18.0]
    assert [r["b"] for r in exact.orderBy("id").collect()] == [2.0, 2.0, 1.0, 1.0, 0.0]
    approx, _ = features.quantile_bucket(df, "hour", "b", 3, exact=False)
    assert [r["b"] for r in approx.orderBy("id").collect()] == [2.0, 2.0, 1.0, 1.0, 0.0]


def test_hashing_tf_indices(spark):
    df = spark.createDataFrame([(0, "a b c d e spark")], ["id", "text"])
    tf = features.hashing_tf(features.tokenize(df, "text", "w"), "w", "tf", 1000).first()["tf"]
    assert list(tf.indices) == [165, 286, 467, 550, 768, 890]


def test_one_hot_drops_last(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], ["c"])
    out = features.one_hot("c", "v").fit(df).transform(df).collect()
    assert all(r["v"].size == 2 for r in out)


def test_word2vec_repeatable(spark):
    df = spark.createDataFrame([("Hi I heard about Spark".split(" "),),
                                ("I wish Java could use case classes".split(" "),),
                                ("Logistic regression models are neat".split(" "),)], ["text"])
    a = features.fit_word2vec(df, "text", "r", 3, 0, seed=7, num_partitions=1).transform(df).collect()
    b = features.fit_word2vec(df, "text", "r", 3, 0, seed=7, num_partitions=1).transform(df).collect()
    assert [r["r"] for r in a] == [r["r"] for r in b]
    assert all(len(r["r"]) == 3 for r in a)


# --- own fixtures -------------------------------------------------------------

def test_csv_quoting_and_blanks(spark):
    d = tempfile.mkdtemp(prefix="spindle-csv-")
    p = os.path.join(d, "t.csv")
    with open(p, "w") as f:
        f.write('id,name,city\n1,"Smith, John",Paris\n2,,""\n\n3,Ann,Rome\n')
    df = files.read_csv(spark, p, header=True, schema="id int, name string, city string")
    rows = df.orderBy("id").collect()
    assert [r["id"] for r in rows] == [1, 2, 3]
    assert rows[0]["name"] == "Smith, John"
    assert rows[1]["name"] is None and rows[1]["city"] is None
    nh = files.read_csv(spark, p, header=False)
    assert nh.columns[:3] == ["_c0", "_c1", "_c2"]


def test_libsvm_indices(spark):
    d = tempfile.mkdtemp(prefix="spindle-svm-")
    p = os.path.join(d, "t.txt")
    with open(p, "w") as f:
        f.write("-1 1:0.5 3:2\n+1 2:1\n")
    rows = files.read_libsvm(spark, p).collect()
    assert [r["features"].size for r in rows] == [3, 3]
    assert list(rows[0]["features"].indices) == [0, 2] and list(rows[1]["features"].indices) == [1]
    assert [r["label"] for r in rows] == [-1.0, 1.0]


def test_accuracy_and_auc_small(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 1.0), (0.0, 0.0)],
                               ["prediction", "label"])
    assert evaluate.accuracy(df).first()["accuracy"] == pytest.approx(0.6)
    assert evaluate.hard_auc(df).first()["auc"] == pytest.approx(0.583333, abs=1e-6)
    assert evaluate.auc_value(df, "prediction", "label") == pytest.approx(0.583333, abs=1e-6)


def test_naive_bayes_priors(spark):
    df = spark.createDataFrame([(0.0, Vectors.dense(1, 0, 2)), (0.0, Vectors.dense(0, 1, 1)),
                                (1.0, Vectors.dense(3, 0, 0))], ["label", "features"])
    m = learners.naive_bayes().fit(df)
    assert m.pi.toArray().tolist() == pytest.approx([math.log(0.6), math.log(0.4)])


def test_split_words_jvm_semantics(spark):
    df = spark.createDataFrame([(0, "a b  "), (1, ""), (2, "  "), (3, " a")], ["i", "s"])
    rows = {r["i"]: r["w"] for r in df.select("i", scalar.split_words("s").alias("w")).collect()}
    assert rows == {0: ["a", "b"], 1: [""], 2: [], 3: ["", "a"]}


def test_relabel_unmapped_raises(spark):
    df = spark.createDataFrame([(2.0,), (4.0,), (3.0,)], ["l"])
    with pytest.raises(Exception, match="unmapped value 3.0"):
        df.select(scalar.relabel("l", {2.0: 0.0, 4.0: 1.0})).collect()
    ok = df.filter("l <> 3").select(scalar.relabel("l", {2.0: 0.0, 4.0: 1.0})).collect()
    assert sorted(r[0] for r in ok) == [0.0, 1.0]


def test_null_rules(spark):
    df = spark.createDataFrame([("f", 10.0, 1, 3), ("m", None, 1, 2), ("m", 40.0, None, 1)],
                               "sex string, age double, sib int, par int")
    rows = df.select(scalar.child_or_sex("sex", "age").alias("w"),
                     scalar.sum_flag("sib", "par").alias("f")).collect()
    assert [r["w"] for r in rows] == ["Child", None, "m"]
    assert [r["f"] for r in rows] == [1.0, 0.0, None]


def test_gbt_third_class_raises(spark):
    df = spark.createDataFrame([(0.0, Vectors.dense(1.0)), (2.0, Vectors.dense(2.0))], ["label", "features"])
    with pytest.raises(ValueError):
        learners.check_binary_label(df, "label")


def test_naive_bayes_negative_raises(spark):
    df = spark.createDataFrame([(0.0, Vectors.dense(-1.0))], ["label", "features"])
    with pytest.raises(ValueError):
        learners.check_nonnegative(df, "features")


def test_label_among_features_raises(spark):
    with pytest.raises(ValueError):
        learners.check_label_not_feature("y", ["a", "y"])
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "y"])
    with pytest.raises(ValueError):
        columns.names_slice(df, 0, 3, exclude=["y"])


def test_fill_refuses_fraction_on_int(spark):
    df = spark.createDataFrame([(None,)], "n int")
    with pytest.raises(ValueError):
        clean.fill_values(df, {"n": 2.7})


def test_too_many_categories_for_bins_raises_before_fit(spark):
    from spindle.plans import jobs

    df = spark.range(0, 350).select((F.col("id") % 35).cast("double").alias("x"),
                                    (F.col("id") % 2).cast("double").alias("label"))
    pre = [features.assembler(["x"], "features"),
           features.vector_indexer("features", "indexed", max_categories=40)]
    with pytest.raises(ValueError, match="maxBins"):
        jobs.tree_pipeline(pre, learners.decision_tree_classifier("label", "indexed", max_bins=32), df)
    model = jobs.tree_pipeline(pre, learners.decision_tree_classifier("label", "indexed", max_bins=40), df)
    assert model.transform(df).count() == 350


def test_legacy_csv_format_name(spark):
    d = tempfile.mkdtemp(prefix="spindle-csv-")
    p = os.path.join(d, "t.csv")
    with open(p, "w") as f:
        f.write("a,b\n1,x\n2,y\n")
    df = files.read_csv(spark, p, fmt=files.LEGACY_CSV_FORMAT)
    assert df.count() == 2 and dict(df.dtypes) == {"a": "int", "b": "string"}


def test_vectorized_udf_null_policy(spark):
    from spindle.functions.udf import register_vectorized

    register_vectorized(spark, "plus_one_strict", lambda s: s + 1, "double")
    register_vectorized(spark, "plus_one_lax", lambda s: s.fillna(-1) + 1, "double", null_in_null_out=False)
    spark.createDataFrame([(1.0,), (None,)], "x double").createOrReplaceTempView("udf_t")
    rows = spark.sql("SELECT x, plus_one_strict(x) AS a, plus_one_lax(x) AS b FROM udf_t ORDER BY x").collect()
    assert [(r["a"], r["b"]) for r in rows] == [(None, 0.0), (2.0, 2.0)]


# --- SURVEY §3.5: faults of the scripts that are not carried over ------------

def test_imputer_learns_training_mean_only(spark):
    from spindle.plans.tables import gappy_customer
    from spindle.operators import split
    from tests.conftest import SF_SMALL

    g = gappy_customer(spark, SF_SMALL)
    train, test = split.keyed_split(g, "c_custkey")
    model = clean.fit_mean_imputer(train, ["c_acctbal"])
    surrogate = model.surrogateDF.first()["c_acctbal"]
    assert surrogate == pytest.approx(train.agg(F.avg("c_acctbal")).first()[0], rel=1e-12)
    assert surrogate != pytest.approx(test.agg(F.avg("c_acctbal")).first()[0], rel=1e-9)
    filled = clean.apply_imputer(model, test).filter(F.col("c_acctbal").isNull()).count()
    assert filled == 0


def test_drop_only_on_used_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "x"), (3, "b", "y")], "id int, used string, cabin string")
    assert clean.drop_missing(df, ["used"]).count() == 2      # the empty cabin does not cost a row
    assert clean.drop_missing(df).count() == 1


def test_feature_indexer_keeps_unseen_category(spark):
    train = spark.createDataFrame([(Vectors.dense(0.0),), (Vectors.dense(1.0),)], ["features"])
    test = spark.createDataFrame([(Vectors.dense(2.0),)], ["features"])
    model = features.vector_indexer("features", "ix", 4).fit(train)          # keep by default
    assert model.transform(test).first()["ix"].toArray().tolist() == [2.0]
    strict = features.vector_indexer("features", "ix", 4, handle_invalid="error").fit(train)
    with pytest.raises(Exception):
        strict.transform(test).collect()


def test_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(0.3, 1.0), (0.7, 1.0)], ["score", "label"])
    with pytest.raises(ValueError, match="both classes"):
        evaluate.auc(df, "score", "label")
    with pytest.raises(ValueError, match="both classes"):
        evaluate.roc(df, "score", "label")


def test_param_reports(spark):
    from spindle.operators import reports

    lr = learners.logistic_regression()
    text = reports.explain_params(lr)
    assert "maxIter" in text and "current: 10" in text
    table = {r["param"]: r for r in reports.params(spark, lr).collect()}
    assert table["regParam"]["value"] == "0.01" and table["regParam"]["is_set"]
