"""Queries for the whole-script jobs; job_relational is in
``q_relational``.  A fitted value has no SQL form, but which rows are held
out, their labels and the cleaned tables have; that a model does better than
the commonest label, or the mean, is a column that the SQL holds to true."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from spindle.operators import columns, split
from spindle.plans import jobs
from spindle.plans.registry import query
from spindle.plans.tables import GAPPY_CUSTOMER_SQL, gappy_customer, hourly_events, labelled_documents, split_sql, table
from spindle.session import scratch_path
from spindle.sources import files


def beats_majority(scored, label: str, prediction: str) -> bool:
    """More hits than always naming the commonest label of these rows."""
    counts = scored.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                                       F.count_if(F.col(label).cast("string") == F.col(prediction).cast("string")).alias("hits"))
    r = counts.agg(F.max("n").alias("most"), F.sum("hits").alias("hits")).first()
    return bool(r["hits"] > r["most"])


def multiclass_input(spark, sf):
    """The iris layout over lineitem: four numeric columns, then a string
    class with three values that depends on the measurements (like the
    species on petal size): band of quantity + 200 * discount."""
    li = table(spark, sf, "lineitem")
    size = F.col("l_quantity") + 200 * F.col("l_discount")
    species = (F.when(size < 20, "small").when(size < 40, "medium").otherwise("large"))
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                     "l_extendedprice", species.alias("species"))


def run_multiclass(spark, sf):
    df = multiclass_input(spark, sf)
    feats = columns.names_slice(df, 2, 6, exclude=["species"])   # the four measurements
    train, test = split.keyed_split(df, ["l_orderkey", "l_linenumber"])
    return jobs.multiclass_forest(train, test, "species", feats)


@query("job_multiclass", f"""
SELECT l_orderkey, l_linenumber, true AS beats_majority,
       CASE WHEN l_quantity + 200 * l_discount < 20 THEN 'small' WHEN l_quantity + 200 * l_discount < 40 THEN 'medium'
            ELSE 'large' END AS species
FROM lineitem WHERE NOT {split_sql(["l_orderkey", "l_linenumber"])}
""")
def job_multiclass(spark, sf):
    scored = run_multiclass(spark, sf).scored
    return scored.select("l_orderkey", "l_linenumber", "species",
                         F.lit(beats_majority(scored, "species", "predictedLabel")).alias("beats_majority"))


def binary_input(spark, sf):
    d = labelled_documents(spark, sf)
    size = F.greatest(F.length("text"), F.lit(1))
    words = F.split("text", " ")
    return d.select("doc_id", F.col("quality").cast("string").alias("quality"),
                    F.col("n_chars").cast("double").alias("n_chars"), "lang", "source",
                    (F.regexp_count("text", F.lit("[#*$%&|!]")) / size).alias("symbols"),
                    (F.regexp_count("text", F.lit("[A-Z]")) / size).alias("capitals"),
                    (F.size(F.array_distinct(words)) / F.size(words)).alias("variety"))


BINARY_NUMERIC = ["n_chars", "symbols", "capitals", "variety"]
HELD_OUT_SQL = f"""
SELECT doc_id, CAST(quality AS VARCHAR) AS quality, true AS beats_majority
FROM labels JOIN documents USING (doc_id) WHERE NOT {split_sql("doc_id")}
"""


def run_binary(spark, sf):
    train, test = split.keyed_split(binary_input(spark, sf), "doc_id")
    return jobs.binary_logistic(train, test, "quality", BINARY_NUMERIC, ["lang", "source"], 8)


def _held_out(scored):
    return scored.select("doc_id", "quality", F.lit(beats_majority(scored, "quality", "predictedLabel")).alias("beats_majority"))


@query("job_binary", HELD_OUT_SQL)
def job_binary(spark, sf):
    return _held_out(run_binary(spark, sf).scored)


@query("job_binary_reports", f"""
WITH tr AS (SELECT avg(quality) AS p FROM labels JOIN documents USING (doc_id) WHERE {split_sql("doc_id")})
SELECT * FROM (VALUES ('roc_first', 0.0::DOUBLE, 0.0::DOUBLE, true), ('roc_last', 1.0::DOUBLE, 1.0::DOUBLE, true)) AS t(point, x, y, monotone)
UNION ALL SELECT 'loss_first', 0.0::DOUBLE, round(-p * ln(p) - (1 - p) * ln(1 - p), 6), true FROM tr
""")
def job_binary_reports(spark, sf):
    """Ends of the ROC curve, which never falls, and the loss before the first
    step (that of the labels' share), which never rises after it."""
    found = run_binary(spark, sf).reports
    roc = [(r["FPR"], r["TPR"]) for r in found["roc"].collect()]      # at most 1000 points, as Spark thins it
    loss = [r["loss"] for r in found["loss"].orderBy("iteration").collect()]
    rising = all(a[0] <= b[0] and a[1] <= b[1] for a, b in zip(roc, roc[1:], strict=False))
    falling = all(b <= a + 1e-12 for a, b in zip(loss, loss[1:], strict=False))
    rows = [("roc_first", *roc[0], rising), ("roc_last", *roc[-1], rising), ("loss_first", 0.0, round(loss[0], 6), falling)]
    return spark.createDataFrame(rows, "point string, x double, y double, monotone boolean")


@query("job_score_unlabelled", f"""
SELECT doc_id, true AS as_with_label FROM labels JOIN documents USING (doc_id) WHERE NOT {split_sql("doc_id")}
""")
def job_score_unlabelled(spark, sf):
    """Rows without a label, scored and written as CSV, read back: the label
    named for each is the one that the labelled row gets."""
    fitted = run_binary(spark, sf)
    unlabelled = split.keyed_split(binary_input(spark, sf), "doc_id")[1].drop("quality")
    scored = jobs.score_unlabelled(fitted.model, unlabelled).select("doc_id", "predictedLabel")
    path = files.write_csv(scored, scratch_path(spark, "scored"), header=True)
    back = files.read_csv(spark, path, header=True).select("doc_id", F.col("predictedLabel").cast("string").alias("read"))
    return back.join(fitted.scored.select("doc_id", "predictedLabel"), "doc_id").select(
        "doc_id", F.col("read").eqNullSafe(F.col("predictedLabel")).alias("as_with_label"))


def run_binary_cv(spark, sf):
    train, test = split.keyed_split(binary_input(spark, sf), "doc_id")
    return jobs.binary_logistic_cv(spark, train, test, "quality", BINARY_NUMERIC, ["lang", "source"],
                                   ["doc_id"])


@query("job_binary_cv", HELD_OUT_SQL)
def job_binary_cv(spark, sf):
    return _held_out(run_binary_cv(spark, sf).scored)


def titanic_input(spark, sf):
    """gappy customer joined to per-customer order facts: label = has an
    urgent order; 'pclass' = region number of the nation; 'fare' = spend;
    'sibsp'/'parch' = order counts."""
    o = table(spark, sf, "orders")
    per = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_done"),
        F.sum("o_totalprice").alias("spend"),
        F.max((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("urgent"))
    # nation is a dimension table; the planner broadcasts it from its measured size
    region = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                               (F.col("n_regionkey") + 1).cast("double").alias("pclass"))
    c = (gappy_customer(spark, sf).join(region, "c_nationkey", "left")
         .join(per, "c_custkey", "left")
         .fillna({"n_orders": 0, "n_done": 0, "spend": 0.0, "urgent": 0}))
    return c.withColumns({"age": F.col("c_acctbal") / 100,
                          "survived": F.col("urgent").cast("string")})


TITANIC = {"key": "c_custkey", "label": "survived", "age": "age", "sex": "c_mktsegment", "sib": "n_orders",
           "par": "n_done", "embarked": "c_mktsegment", "numeric": ["pclass", "spend"]}

CLEANED_SQL = f"""
WITH per AS (SELECT o_custkey AS c_custkey, count(*) AS n_orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_done,
                    max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent FROM orders GROUP BY 1),
t AS (SELECT g.c_custkey, c_acctbal / 100 AS age, c_mktsegment, coalesce(n_orders, 0) + coalesce(n_done, 0) AS kin,
             CAST(coalesce(urgent, 0) AS VARCHAR) AS survived, {split_sql("g.c_custkey")} AS is_train
      FROM {GAPPY_CUSTOMER_SQL} g LEFT JOIN per ON g.c_custkey = per.c_custkey),
m AS (SELECT avg(age) AS mu FROM t WHERE is_train),
o AS (SELECT c_mktsegment AS mode FROM t WHERE is_train AND c_mktsegment <> '' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
f AS (SELECT c_custkey, coalesce(age, mu) AS age, kin, survived, is_train,
             CASE WHEN c_mktsegment IS NULL OR c_mktsegment = '' THEN mode ELSE c_mktsegment END AS c_mktsegment FROM t, m, o),
cleaned AS (SELECT c_custkey, CASE WHEN is_train THEN 'train' ELSE 'test' END AS part, round(age, 6) AS age, c_mktsegment,
                   CASE WHEN age < 15 THEN 'Child' ELSE c_mktsegment END AS who,
                   CAST(CASE WHEN kin > 3 THEN 1 ELSE 0 END AS DOUBLE) AS family, survived FROM f)
"""


def run_clean_and_classify(spark, sf):
    return jobs.clean_and_classify(spark, titanic_input(spark, sf), **TITANIC)


@query("job_clean_and_classify", CLEANED_SQL + """
SELECT c_custkey, age, c_mktsegment, who, family, survived, true AS labelled FROM cleaned WHERE part = 'test'
""")
def job_clean_and_classify(spark, sf):
    """The held-out rows as cleaned; each has got one of the labels."""
    scored = run_clean_and_classify(spark, sf).scored
    return scored.select("c_custkey", F.round("age", 6).alias("age"), "c_mktsegment", "who", "family", "survived",
                         F.coalesce(F.col("predictedLabel").isin("0", "1"), F.lit(False)).alias("labelled"))


@query("job_clean_table", CLEANED_SQL + """
SELECT c_custkey, part, age, c_mktsegment, who, family, survived FROM cleaned
""")
def job_clean_table(spark, sf):
    train, test, _ = jobs.clean_parts(titanic_input(spark, sf), **TITANIC)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select("c_custkey", "part", F.round("age", 6).alias("age"), "c_mktsegment", "who", "family", "survived")


@query("job_clean_profile", CLEANED_SQL + """
SELECT 'missing' AS report, 'age' AS name, count(*) FILTER (WHERE age IS NULL) AS n FROM t
UNION ALL SELECT 'missing', 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment = '') FROM t
UNION ALL (SELECT 'commonest', c_mktsegment, count(*) FROM t WHERE c_mktsegment <> '' GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 1)
UNION ALL SELECT 'after_fill', c_mktsegment, count(*) FROM cleaned GROUP BY 2
""")
def job_clean_profile(spark, sf):
    """Missing values, the commonest value, and counts after the fill."""
    _, _, found = jobs.clean_parts(titanic_input(spark, sf), **TITANIC)
    missing = profile_rows(found["missing"])
    values = found["values"].filter((F.col("column") == "c_mktsegment") & (F.col("value") != ""))
    top = values.orderBy(F.desc("count"), "value").limit(1)
    return (missing.unionByName(top.select(F.lit("commonest").alias("report"), F.col("value").alias("name"), F.col("count").alias("n")))
            .unionByName(found["after_fill"].select(F.lit("after_fill").alias("report"), F.col("c_mktsegment").alias("name"), F.col("count").alias("n"))))


def profile_rows(missing):
    """The two columns with gaps, from the missing profile."""
    kept = missing.filter(F.col("column").isin("age", "c_mktsegment"))
    return kept.select(F.lit("missing").alias("report"), F.col("column").alias("name"), F.col("n_missing").alias("n"))


def run_regression(spark, sf):
    df = hourly_events(spark, sf)
    feats = columns.names_slice(df, 1, 5, exclude=["total"])   # day … n_events, by position
    train, test = split.keyed_split(df, "hour_ts")
    return jobs.gbt_regression(train, test, "total", feats, 24)


def beats_mean(scored, label: str) -> bool:
    """A smaller squared error than always naming the rows' own mean."""
    r = scored.agg(F.avg((F.col(label) - F.col("prediction")) ** 2).alias("mse"), F.var_pop(label).alias("var")).first()
    return bool(r["mse"] < r["var"])


@query("job_regression", f"""
WITH h AS (SELECT date_trunc('hour', ts) AS hour_ts, count(*) AS n_events, round(sum(least(value, 20)), 4) AS total FROM events GROUP BY 1)
SELECT hour_ts, n_events, total, true AS beats_mean FROM h WHERE NOT {split_sql("strftime(hour_ts, '%Y-%m-%d %H:%M:%S')")}
""")
def job_regression(spark, sf):
    scored = run_regression(spark, sf).scored
    return scored.select("hour_ts", "n_events", F.round("total", 4).alias("total"), F.lit(beats_mean(scored, "total")).alias("beats_mean"))


def run_text(spark, sf):
    d = labelled_documents(spark, sf).select("doc_id", "text", F.col("quality").alias("label"))
    train, test = split.keyed_split(d, "doc_id")
    return jobs.text_classify(train, test, "text", "label", 1000)


@query("job_text_classify", f"""
SELECT doc_id, CAST(quality AS DOUBLE) AS label, true AS likelier, true AS beats_majority
FROM labels JOIN documents USING (doc_id) WHERE NOT {split_sql("doc_id")}
""")
def job_text_classify(spark, sf):
    """``likelier``: the probabilities add up, and the class is the likelier one."""
    scored = run_text(spark, sf).scored
    p = vector_to_array("probability")
    likelier = (F.abs(p[0] + p[1] - 1) < 1e-9) & (p[F.col("prediction").cast("int")] >= 0.5)
    return scored.select("doc_id", "label", likelier.alias("likelier"), F.lit(beats_majority(scored, "label", "prediction")).alias("beats_majority"))
