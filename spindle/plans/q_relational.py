"""Queries for sources/sinks, columns, filters, missing data, aggregation,
profiles, sorting, splits and scalar rules (SURVEY §2.1-2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from spindle.functions import scalar
from spindle.functions.udf import register_vectorized
from spindle.operators import clean, columns, features, frequent, layout, profile, split
from spindle.plans.registry import query
from spindle.plans.tables import GAPPY_CUSTOMER_SQL, gappy_customer, split_sql, table
from spindle.session import scratch_path
from spindle.sources import files

G = GAPPY_CUSTOMER_SQL

# --- job_relational: rename -> filter -> group count -> sort ---------------


@query("job_relational", """
SELECT o_orderpriority AS priority, count(*) AS count
FROM orders WHERE o_totalprice > 250000
GROUP BY o_orderpriority
""")
def job_relational(spark, sf):
    o = table(spark, sf, "orders")
    renamed = columns.rename(o, {
        "o_orderkey": "orderkey", "o_custkey": "custkey", "o_orderstatus": "status",
        "o_totalprice": "totalprice", "o_orderdate": "orderdate", "o_orderpriority": "priority"})
    kept = clean.filter_compare(renamed, "totalprice", ">", 250000)
    return profile.sort_by_count(profile.group_count(kept, "priority"), "priority")


@query("job_relational_csv", """
WITH o AS (SELECT o_orderpriority AS priority, o_totalprice AS totalprice,
                  CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_orderstatus END AS status FROM orders)
SELECT priority, count(*) AS count, (SELECT count(*) FROM o WHERE status IS NULL) AS missing_status
FROM o WHERE totalprice > 250000 GROUP BY priority
""")
def job_relational_csv(spark, sf):
    """The whole script: CSV without a header in, types inferred, columns
    renamed by position, missing values counted, rows filtered and grouped."""
    o = table(spark, sf, "orders").withColumn(
        "o_orderstatus", F.when(F.col("o_totalprice") < 50000, F.lit("")).otherwise(F.col("o_orderstatus")))
    path = files.write_csv(o, scratch_path(spark, "orders_csv"), header=False)
    read = files.read_csv(spark, path, header=False,
                          names=["orderkey", "custkey", "status", "totalprice", "orderdate", "priority"])
    missing = clean.filter_missing(read, "status").count()
    kept = clean.filter_compare(read, "totalprice", ">", 250000)
    counts = profile.sort_by_count(profile.group_count(kept, "priority"), "priority")
    return counts.withColumn("missing_status", F.lit(missing))


# --- 2.1 sources and sinks ---------------------------------------------------

@query("src_csv_header", "SELECT * FROM customer")
def src_csv_header(spark, sf):
    c = table(spark, sf, "customer")
    path = files.write_csv(c, scratch_path(spark, "customer_csv"), header=True)
    return files.read_csv(spark, path, header=True)                    # types inferred


@query("src_csv_noheader", """
SELECT c_custkey AS _c0, c_name AS _c1, c_nationkey AS _c2, c_acctbal AS _c3, c_mktsegment AS _c4
FROM customer
""")
def src_csv_noheader(spark, sf):
    c = table(spark, sf, "customer")
    path = files.write_csv(c, scratch_path(spark, "customer_csv_nh"), header=False)
    return files.read_csv(spark, path, header=False)                   # names _c0 …, types inferred


@query("src_json", """
SELECT c_acctbal, c_custkey, c_mktsegment, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey
FROM customer
""")
def src_json(spark, sf):
    c = table(spark, sf, "customer")
    path = files.write_json(c, scratch_path(spark, "customer_json"))
    return files.read_json(spark, path)  # inferred: integers as long, names sorted


@query("src_libsvm", """
SELECT l_quantity AS label, l_extendedprice AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem
""")
def src_libsvm(spark, sf):
    li = table(spark, sf, "lineitem")
    path = files.write_libsvm(li, scratch_path(spark, "lineitem_libsvm"), "l_quantity",
                              ["l_extendedprice", "l_discount", "l_tax"])
    df = files.read_libsvm(spark, path, num_features=3)
    return columns.vector_items(df, "features", 3, keep=["label"])


@query("src_libsvm_rdd", """
SELECT CAST(CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS DOUBLE) AS label,
       l_extendedprice AS f0, l_discount AS f1, l_tax AS f2
FROM lineitem
""")
def src_libsvm_rdd(spark, sf):
    # labels written as 2/4 (like the breast-cancer file), read without a
    # feature count (one pre-scan), then mapped strictly to 0/1
    li = table(spark, sf, "lineitem").withColumn(
        "lab", F.when(F.col("l_linestatus") == "F", 2.0).otherwise(4.0))
    path = files.write_libsvm(li, scratch_path(spark, "lineitem_libsvm24"), "lab",
                              ["l_extendedprice", "l_discount", "l_tax"])
    df = files.read_libsvm(spark, path)
    df = df.withColumn("label", scalar.relabel("label", {2.0: 0.0, 4.0: 1.0}))
    return columns.vector_items(df, "features", 3, keep=["label"])


_FLAG_NAMES = [("A", "accepted"), ("N", "none"), ("R", "returned")]


@query("src_literal", """
WITH names(flag, flag_name) AS (VALUES ('A', 'accepted'), ('N', 'none'), ('R', 'returned'))
SELECT l_returnflag, flag_name, count(*) AS count
FROM lineitem JOIN names ON l_returnflag = flag
GROUP BY l_returnflag, flag_name
""")
def src_literal(spark, sf):
    names = files.literal_table(spark, _FLAG_NAMES, "flag string, flag_name string")
    li = table(spark, sf, "lineitem")
    # a literal lookup has a fixed, known size: broadcasting it is safe
    j = li.join(F.broadcast(names), li.l_returnflag == names.flag)
    return j.groupBy("l_returnflag", "flag_name").agg(F.count(F.lit(1)).alias("count"))


@query("snk_csv", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
""")
def snk_csv(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    path = files.write_csv(o, scratch_path(spark, "orders_out"), header=True)
    return files.read_csv(spark, path, header=True, schema=o.schema)


# --- 2.2 columns -------------------------------------------------------------

@query("col_select", "SELECT o_orderkey, o_orderstatus FROM orders")
def col_select(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")


@query("col_select_slice", "SELECT l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem")
def col_select_slice(spark, sf):
    return columns.select_slice(table(spark, sf, "lineitem"), 1, 5)


@query("col_rename", """
SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus AS status,
       o_totalprice AS totalprice, o_orderpriority AS priority FROM orders
""")
def col_rename(spark, sf):
    o = table(spark, sf, "orders").drop("o_orderdate")
    return columns.rename(o, ["orderkey", "custkey", "status", "totalprice", "priority"])


@query("col_derive", """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem
""")
def col_derive(spark, sf):
    li = table(spark, sf, "lineitem")
    rev = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    out = columns.derive(li, {"revenue": rev, "charge": rev * (1 + F.col("l_tax"))})
    return out.select("l_orderkey", "l_linenumber", "revenue", "charge")


@query("col_cast", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS DOUBLE) AS c_nationkey,
       TRY_CAST(c_mktsegment AS DOUBLE) AS c_mktsegment FROM customer
""")
def col_cast(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    c = columns.cast(c, {"c_custkey": "string", "c_nationkey": "double"})
    return columns.cast(c, {"c_mktsegment": "double"}, strict=False)


@query("col_drop", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def col_drop(spark, sf):
    return table(spark, sf, "customer").drop("c_name")


@query("col_const", "SELECT o_orderkey, 0 AS survived FROM orders")
def col_const(spark, sf):
    return columns.add_constant(table(spark, sf, "orders").select("o_orderkey"), "survived", 0)


@query("col_relabel", """
SELECT l_orderkey, l_linenumber, CAST(CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS DOUBLE) AS label
FROM lineitem
""")
def col_relabel(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", scalar.relabel("l_linestatus", {"F": 0.0, "O": 1.0}))


@query("schema_info", """
SELECT * FROM (VALUES
 (0, 'c_custkey', 'bigint', true), (1, 'c_name', 'string', true), (2, 'c_nationkey', 'int', true),
 (3, 'c_acctbal', 'double', true), (4, 'c_mktsegment', 'string', true)) AS t(position, name, type, nullable)
JOIN (UNPIVOT (SELECT count(c_custkey) AS c_custkey, count(c_name) AS c_name, count(c_nationkey) AS c_nationkey,
                      count(c_acctbal) AS c_acctbal, count(c_mktsegment) AS c_mktsegment FROM """ + G + """ g)
      ON COLUMNS(*) INTO NAME name VALUE n_values) USING (name)
""")
def schema_info(spark, sf):
    return columns.schema_counts(spark, gappy_customer(spark, sf))


@query("vec_literal", """
SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2
FROM lineitem
""")
def vec_literal(spark, sf):
    li = table(spark, sf, "lineitem")
    v = li.select("l_orderkey", "l_linenumber",
                  columns.to_vector(["l_quantity", "l_extendedprice", "l_discount"]).alias("v"))
    return columns.vector_items(v, "v", 3, keep=["l_orderkey", "l_linenumber"])


@query("vec_sparse", """
SELECT l_orderkey, l_linenumber, l_quantity AS f0, CAST(0 AS DOUBLE) AS f1,
       CAST(CASE l_returnflag WHEN 'A' THEN 1 ELSE 0 END AS DOUBLE) AS f2, CAST(0 AS DOUBLE) AS f3,
       CAST(CASE l_returnflag WHEN 'A' THEN 7 WHEN 'R' THEN 2.5 ELSE 0 END AS DOUBLE) AS f4
FROM lineitem
""")
def vec_sparse(spark, sf):
    """Sparse literals by return flag, one of them without an entry, behind a
    plain column in one vector."""
    li = table(spark, sf, "lineitem")
    flagged = columns.with_sparse(li, "l_returnflag", 4, {"A": {1: 1.0, 3: 7.0}, "N": {}, "R": {3: 2.5}}, "flag")
    v = features.assemble(flagged, ["l_quantity", "flag"], "v")
    return columns.vector_items(v, "v", 5, keep=["l_orderkey", "l_linenumber"])


# --- 2.3 filters and missing data -------------------------------------------

@query("flt_compare", "SELECT * FROM orders WHERE o_totalprice > 250000")
def flt_compare(spark, sf):
    return clean.filter_compare(table(spark, sf, "orders"), "o_totalprice", ">", 250000)


@query("flt_null_or_empty", f"""
SELECT * FROM {G} g WHERE c_mktsegment IS NULL OR c_mktsegment = ''
""")
def flt_null_or_empty(spark, sf):
    return clean.filter_missing(gappy_customer(spark, sf), "c_mktsegment")


@query("na_drop", f"""
SELECT * FROM {G} g
WHERE c_acctbal >= 1000 AND c_mktsegment IS NOT NULL AND c_mktsegment <> ''
""")
def na_drop(spark, sf):
    """null, NaN (balances under 1000) and the empty string are missing."""
    return clean.drop_missing(_with_nan(gappy_customer(spark, sf)))


def _with_nan(df):
    nan = F.lit(float("nan"))
    return df.withColumn("c_acctbal", F.when(F.col("c_acctbal") < 1000, nan).otherwise(F.col("c_acctbal")))


@query("na_fill", f"""
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal >= 1000 THEN c_acctbal ELSE 0.0 END AS c_acctbal,
       CASE WHEN c_mktsegment IS NULL OR c_mktsegment = '' THEN 'UNKNOWN' ELSE c_mktsegment END AS c_mktsegment
FROM {G} g
""")
def na_fill(spark, sf):
    return clean.fill_values(_with_nan(gappy_customer(spark, sf)), {"c_acctbal": 0.0, "c_mktsegment": "UNKNOWN"})


@query("na_fill_mean", f"""
WITH g AS {G},
m AS (SELECT avg(c_acctbal) AS mu FROM g WHERE {split_sql('c_custkey')})
SELECT c_custkey, round(coalesce(c_acctbal, mu), 6) AS c_acctbal,
       CASE WHEN {split_sql('c_custkey')} THEN 'train' ELSE 'test' END AS part
FROM g, m
""")
def na_fill_mean(spark, sf):
    g = gappy_customer(spark, sf)
    train, _ = split.keyed_split(g, "c_custkey")
    imp = clean.fit_mean_imputer(train, ["c_acctbal"])       # learnt on train only
    out = split.label_split(clean.apply_imputer(imp, g), "c_custkey")
    return out.select("c_custkey", F.round("c_acctbal", 6).alias("c_acctbal"), "part")


@query("na_fill_mode", f"""
WITH g AS {G},
m AS (SELECT c_mktsegment AS mode FROM g
      WHERE {split_sql('c_custkey')} AND c_mktsegment IS NOT NULL AND c_mktsegment <> ''
      GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1)
SELECT c_custkey,
       CASE WHEN c_mktsegment IS NULL OR c_mktsegment = '' THEN mode ELSE c_mktsegment END AS c_mktsegment
FROM g, m
""")
def na_fill_mode(spark, sf):
    g = gappy_customer(spark, sf)
    train, _ = split.keyed_split(g, "c_custkey")
    return clean.fill_mode(train, g, ["c_mktsegment"]).select("c_custkey", "c_mktsegment")


# --- 2.5 aggregation and profiling ------------------------------------------

@query("agg_count", "SELECT count(*) AS n FROM lineitem")
def agg_count(spark, sf):
    return profile.count_rows(table(spark, sf, "lineitem"))


@query("agg_group_count", "SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY l_returnflag")
def agg_group_count(spark, sf):
    return profile.group_count(table(spark, sf, "lineitem"), "l_returnflag")


@query("agg_mean", f"""
SELECT round(avg(c_acctbal), 6) AS mean_c_acctbal, round(avg(c_nationkey), 6) AS mean_c_nationkey FROM {G} g
""")
def agg_mean(spark, sf):
    m = profile.mean_of(gappy_customer(spark, sf), ["c_acctbal", "c_nationkey"])
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query("prof_nulls", f"""
WITH g AS {G}
SELECT * FROM (VALUES
 (0, 'c_custkey', (SELECT count(*) FILTER (WHERE c_custkey IS NULL) FROM g)),
 (1, 'c_name', (SELECT count(*) FILTER (WHERE c_name IS NULL OR c_name = '') FROM g)),
 (2, 'c_nationkey', (SELECT count(*) FILTER (WHERE c_nationkey IS NULL) FROM g)),
 (3, 'c_acctbal', (SELECT count(*) FILTER (WHERE c_acctbal IS NULL) FROM g)),
 (4, 'c_mktsegment', (SELECT count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment = '') FROM g))
) AS t(position, "column", n_missing), (SELECT count(*) AS n_rows FROM g) r
""")
def prof_nulls(spark, sf):
    return profile.profile_missing(gappy_customer(spark, sf))


@query("prof_values", f"""
WITH g AS {G},
long AS (
  SELECT 'c_custkey' AS "column", CAST(c_custkey AS VARCHAR) AS value FROM g
  UNION ALL SELECT 'c_name', c_name FROM g
  UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM g
  UNION ALL SELECT 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM g
  UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM g),
counts AS (SELECT "column", value, count(*) AS count FROM long GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column"
                  ORDER BY count DESC, value ASC NULLS LAST) AS INTEGER) AS rank FROM counts)
SELECT * FROM ranked WHERE rank <= 5
""")
def prof_values(spark, sf):
    return profile.profile_values(gappy_customer(spark, sf), top_n=5)


@query("prof_frequent", f"""
WITH g AS {G},
long AS (
  SELECT 'c_custkey' AS "column", CAST(c_custkey AS VARCHAR) AS value FROM g
  UNION ALL SELECT 'c_name', c_name FROM g
  UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM g
  UNION ALL SELECT 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM g
  UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM g),
counts AS (SELECT "column", value, count(*) AS count FROM long GROUP BY ALL),
kept AS (SELECT * FROM counts WHERE count > 0.02 * (SELECT count(*) FROM g))
SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value ASC NULLS LAST) AS INTEGER) AS rank FROM kept
""")
def prof_frequent(spark, sf):
    """Values above 2 % of the rows; keys and names shuffle nothing."""
    return frequent.frequent_values(gappy_customer(spark, sf), share=0.02)


# --- 2.7 sorts and limits ---------------------------------------------------

@query("sort_desc", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority")
def sort_desc(spark, sf):
    o = table(spark, sf, "orders")
    return profile.sort_by_count(profile.group_count(o, "o_orderpriority"), "o_orderpriority")


@query("limit_n", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def limit_n(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


# --- 2.8 splits and caching --------------------------------------------------

@query("split_random", f"""
SELECT o_orderkey, CASE WHEN {split_sql('o_orderkey')} THEN 'train' ELSE 'test' END AS part FROM orders
""")
def split_random(spark, sf):
    return split.label_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("split_random_native", """
SELECT o_orderkey, 1 AS n_parts FROM orders
""")
def split_random_native(spark, sf):
    """Which part a row is in depends on the layout; that each row is in
    exactly one does not."""
    o = table(spark, sf, "orders").select("o_orderkey")
    parts = [p.select("o_orderkey", F.lit(k).alias("part")) for k, p in enumerate(split.native_split(o, (0.7, 0.3), 11))]
    return parts[0].unionByName(parts[1]).groupBy("o_orderkey").agg(F.count("part").alias("n_parts"))


@query("cache_table", """
SELECT l_returnflag, l_linestatus, count(*) AS count, round(sum(l_quantity), 2) AS sum_qty,
       (SELECT count(*) FROM lineitem) AS total
FROM lineitem GROUP BY ALL
""")
def cache_table(spark, sf):
    """Kept rows are read twice, then let go; the groups are written before."""
    path = scratch_path(spark, "cached_groups")
    with layout.kept(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")) as li:
        groups = li.groupBy("l_returnflag", "l_linestatus").agg(
            F.count(F.lit(1)).alias("count"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"))
        groups.withColumn("total", F.lit(li.count())).write.parquet(path)
    return spark.read.parquet(path)


# --- 2.9 / 2.10 scalar rules and user functions ------------------------------

@query("fn_default_if_null", f"""
SELECT c_custkey, coalesce(c_acctbal, 0.0) AS c_acctbal, coalesce(c_mktsegment, 'S') AS c_mktsegment FROM {G} g
""")
def fn_default_if_null(spark, sf):
    g = gappy_customer(spark, sf)
    return g.select("c_custkey", scalar.default_if_null("c_acctbal", 0.0).alias("c_acctbal"),
                    scalar.default_if_null("c_mktsegment", "S").alias("c_mktsegment"))


@query("fn_bucket_override", f"""
SELECT c_custkey,
       CASE WHEN c_acctbal IS NULL THEN NULL WHEN c_acctbal < 1500 THEN 'Child' ELSE c_mktsegment END AS who
FROM {G} g
""")
def fn_bucket_override(spark, sf):
    g = gappy_customer(spark, sf)
    return g.select("c_custkey", scalar.child_or_sex("c_mktsegment", "c_acctbal", 1500.0).alias("who"))


@query("fn_sum_flag", """
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_linenumber + l_quantity > 40 THEN 1 ELSE 0 END AS DOUBLE) AS family
FROM lineitem
""")
def fn_sum_flag(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     scalar.sum_flag("l_linenumber", "l_quantity", 40).alias("family"))


@query("fn_split_words", """
WITH w AS (SELECT doc_id, text,
                  CASE WHEN text = '' THEN [''] ELSE string_split(rtrim(text, ' '), ' ') END AS words
           FROM documents)
SELECT doc_id, CAST(CASE WHEN rtrim(text, ' ') = '' AND text <> '' THEN 0 ELSE len(words) END AS INTEGER) AS n_words,
       CASE WHEN rtrim(text, ' ') = '' AND text <> '' THEN NULL ELSE words[-1] END AS last_word
FROM w
""")
def fn_split_words(spark, sf):
    d = table(spark, sf, "documents")
    words = scalar.split_words("text")
    return d.select("doc_id", F.size(words).alias("n_words"), F.try_element_at(words, F.lit(-1)).alias("last_word"))


@query("udf_register", f"""
SELECT c_custkey, CAST(floor(c_acctbal / 1000) AS BIGINT) AS balance_band FROM {G} g
""")
def udf_register(spark, sf):
    import numpy as np

    register_vectorized(spark, "balance_band", lambda s: np.floor(s / 1000).astype("int64"), "bigint")
    gappy_customer(spark, sf).createOrReplaceTempView("customer_v")    # null balances give null
    return spark.sql("SELECT c_custkey, balance_band(c_acctbal) AS balance_band FROM customer_v")
