"""Queries for the feature operators."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from spindle.operators import columns, features
from spindle.operators.indexer import TableIndexer
from spindle.plans.registry import query
from spindle.plans.tables import table
from spindle.session import scratch_path
from spindle.sources import models

# Tokenizer rule in SQL: lower-case, split on single whitespace characters,
# trailing empty tokens dropped; '' gives one empty token.
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_TOKENS_SQL = rf"""
WITH t AS (SELECT doc_id, lower(text) AS s FROM documents),
w AS (SELECT doc_id, s, rtrim(s, {_WS}) AS r FROM t),
k AS (SELECT doc_id, CASE WHEN s = '' THEN [''] WHEN r = '' THEN []::VARCHAR[]
                          ELSE string_split_regex(r, '\s') END AS toks FROM w)
"""


@query("ft_tokenize", _TOKENS_SQL + """
SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, toks[1] AS first_token, toks[-1] AS last_token FROM k
""")
def ft_tokenize(spark, sf):
    d = features.tokenize(table(spark, sf, "documents").select("doc_id", "text"), "text", "words")
    w = F.col("words")
    return d.select("doc_id", F.size(w).alias("n_tokens"),
                    F.try_element_at(w, F.lit(1)).alias("first_token"),
                    F.try_element_at(w, F.lit(-1)).alias("last_token"))


@query("ft_regex_tokenize", r"""
WITH k AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'), lambda x: len(x) >= 1) AS toks
           FROM documents)
SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, toks[1] AS first_token, toks[-1] AS last_token FROM k
""")
def ft_regex_tokenize(spark, sf):
    d = features.regex_tokenize(table(spark, sf, "documents").select("doc_id", "text"), "text", "words")
    w = F.col("words")
    return d.select("doc_id", F.size(w).alias("n_tokens"),
                    F.try_element_at(w, F.lit(1)).alias("first_token"),
                    F.try_element_at(w, F.lit(-1)).alias("last_token"))


@query("ft_hash_tf", _TOKENS_SQL + """
SELECT doc_id, CAST(len(toks) AS DOUBLE) AS tf_sum FROM k
""")
def ft_hash_tf(spark, sf):
    d = features.tokenize(table(spark, sf, "documents").select("doc_id", "text"), "text", "words")
    tf = features.hashing_tf(d, "words", "tf", 1000)
    total = F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda a, x: a + x)
    return tf.select("doc_id", total.alias("tf_sum"))


# MurmurHash3 (x86, 32 bits) of a token's UTF-8 bytes with seed 42.  Fixed
# values: its public constants.
_M = 4294967295


def _rotl(x: str, by: int) -> str:
    return f"((({x}) << {by}) | (({x}) >> {32 - by})) & {_M}"


def _word(at: str) -> str:
    """Little-endian number of the four bytes from byte ``at`` of hex ``h`` (bytes past the end: 0)."""
    part = " || ".join(f"rpad(substr(h, CAST(2 * ({at} + {i}) + 1 AS BIGINT), 2), 2, '0')" for i in (3, 2, 1, 0))
    return f"CAST('0x' || {part} AS UBIGINT)"


def _mixed(k: str) -> str:
    return f"(({_rotl(f'(({k}) * 3432918353) & {_M}', 15)}) * 461845907) & {_M}"


_SLOTS_SQL = _TOKENS_SQL + f""",
o AS (SELECT doc_id, unnest(toks) AS w FROM k),
d AS (SELECT w, lower(hex(encode(w))) AS h, octet_length(encode(w)) AS n FROM (SELECT DISTINCT w FROM o)),
b AS (SELECT w, n, list_transform(range(n // 4), lambda i: {_mixed(_word('4 * i'))}) AS ks,
             CASE WHEN n % 4 = 0 THEN 0 ELSE {_mixed(_word('4 * (n // 4)'))} END AS tail FROM d),
m0 AS (SELECT w, xor(xor(CAST(list_reduce(list_prepend(42::UBIGINT, ks),
              lambda a, x: (({_rotl('xor(a, x)', 13)}) * 5 + 3864292196) & {_M}) AS UBIGINT), CAST(tail AS UBIGINT)), CAST(n AS UBIGINT)) AS x FROM b),
m1 AS (SELECT w, (xor(x, x >> 16) * 2246822507) & {_M} AS x FROM m0),
m2 AS (SELECT w, (xor(x, x >> 13) * 3266489909) & {_M} AS x FROM m1),
m3 AS (SELECT w, CAST(xor(x, x >> 16) AS BIGINT) AS x FROM m2),
s AS (SELECT w, CAST(((CASE WHEN x >= 2147483648 THEN x - 4294967296 ELSE x END) % 1000 + 1000) % 1000 AS INTEGER) AS slot FROM m3)
"""


@query("ft_hash_slots", _SLOTS_SQL + """
SELECT doc_id, slot, CAST(count(*) AS DOUBLE) AS n FROM o JOIN s USING (w) GROUP BY doc_id, slot
""")
def ft_hash_slots(spark, sf):
    """Every filled slot of every document."""
    d = features.tokenize(table(spark, sf, "documents").select("doc_id", "text"), "text", "words")
    slots = features.hash_slots(features.hashing_tf(d, "words", "tf", 1000), "tf", ["doc_id"])
    return slots.select("doc_id", "slot", F.col("value").alias("n"))


@query("ft_hash_collisions", _SLOTS_SQL + """
SELECT slot, count(DISTINCT w) AS n_words, count(*) AS n_tokens, min(w) AS first_word
FROM o JOIN s USING (w) GROUP BY slot HAVING count(DISTINCT w) > 1
""")
def ft_hash_collisions(spark, sf):
    d = features.tokenize(table(spark, sf, "documents").select("text"), "text", "words")
    return features.hash_collisions(d, "words", 1000)


@query("ft_word2vec", _TOKENS_SQL.replace("doc_id", "conv_id, turn").replace("documents", "conversations") + """
SELECT conv_id, turn, CAST(len(toks) AS INTEGER) AS n_tokens, true AS is_mean FROM k
""")
def ft_word2vec(spark, sf):
    """The vectors depend on the training run; that a text's vector is the
    mean of its words' vectors (the zero vector without words) does not."""
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    toks = features.tokenize(conv, "text", "words")
    model = features.fit_word2vec(toks, "words", "w2v", vector_size=3, min_count=0, seed=42)
    words = columns.vector_items(features.word_vectors(model), "vector", 3, prefix="x", keep=["word"])
    given = columns.vector_items(model.transform(toks), "w2v", 3, prefix="v", keep=["conv_id", "turn", "words"])
    each = given.select("conv_id", "turn", F.size("words").alias("n_tokens"), "v0", "v1", "v2", F.explode_outer("words").alias("word"))
    sums = (each.join(words, "word", "left").groupBy("conv_id", "turn", "n_tokens", "v0", "v1", "v2")
            .agg(*[F.coalesce(F.sum(f"x{i}"), F.lit(0.0)).alias(f"s{i}") for i in range(3)]))
    n = F.greatest("n_tokens", F.lit(1))
    near = [F.abs(F.col(f"s{i}") / n - F.col(f"v{i}")) < 1e-5 for i in range(3)]
    return sums.select("conv_id", "turn", "n_tokens", (near[0] & near[1] & near[2]).alias("is_mean"))


@query("ft_pca", """
WITH s AS (SELECT var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c
           FROM (SELECT l_quantity AS x, l_extendedprice / 2000 AS y FROM lineitem)),
e AS (SELECT (a + c) / 2 + sqrt(((a - c) / 2) ^ 2 + b * b) AS l1,
             (a + c) / 2 - sqrt(((a - c) / 2) ^ 2 + b * b) AS l2 FROM s)
SELECT 0 AS component, round(l1 / (l1 + l2), 8) AS explained_variance FROM e
UNION ALL SELECT 1, round(l2 / (l1 + l2), 8) FROM e
""")
def ft_pca(spark, sf):
    li = table(spark, sf, "lineitem")
    v = li.select("l_quantity", (F.col("l_extendedprice") / 2000).alias("p"))
    v = v.select(columns.to_vector(["l_quantity", "p"]).alias("features"))
    model = features.fit_pca(v, "features", 2)
    ev = features.pca_variance(spark, model)
    return ev.select("component", F.round("explained_variance", 8).alias("explained_variance"))


@query("ft_pca_project", """
WITH d AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_extendedprice / 2000 AS y FROM lineitem),
s AS (SELECT var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c FROM d),
e AS (SELECT a, b, (a + c) / 2 + sqrt(((a - c) / 2) ^ 2 + b * b) AS l1 FROM s),
u AS (SELECT b / sqrt(b * b + (l1 - a) ^ 2) AS ux, (l1 - a) / sqrt(b * b + (l1 - a) ^ 2) AS uy FROM e)
SELECT l_orderkey, l_linenumber, round(abs(x * ux + y * uy), 4) AS p0, round(abs(y * ux - x * uy), 4) AS p1 FROM d, u
""")
def ft_pca_project(spark, sf):
    """Each row on the two axes, up to the axes' signs."""
    li = table(spark, sf, "lineitem").withColumn("p", F.col("l_extendedprice") / 2000)
    v = li.select("l_orderkey", "l_linenumber", columns.to_vector(["l_quantity", "p"]).alias("features"))
    out = columns.vector_items(features.fit_pca(v, "features", 2).transform(v), "pca", 2, prefix="p", keep=["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", *[F.round(F.abs(f"p{i}"), 4).alias(f"p{i}") for i in (0, 1)])


_PRIORITY_INDEX_SQL = """
WITH c AS (SELECT o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1),
r AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS idx FROM c)
"""


@query("ft_string_index", _PRIORITY_INDEX_SQL + """
SELECT o_orderkey, idx AS priority_index FROM orders JOIN r ON o_orderpriority = v
""")
def ft_string_index(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return features.string_index(o, "o_orderpriority", "priority_index").select("o_orderkey", "priority_index")


@query("ft_table_index", _PRIORITY_INDEX_SQL + """
SELECT o_orderkey, idx AS priority_index, o_orderpriority AS original FROM orders JOIN r ON o_orderpriority = v
""")
def ft_table_index(spark, sf):
    """The index as a stage: saved unfitted, loaded, fitted, saved, loaded
    and applied, then back to labels by the loaded stage's table."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    unfitted = models.save_stage(Pipeline(stages=[TableIndexer(inputCol="o_orderpriority", outputCol="priority_index")]), scratch_path(spark, "unfitted_index"))
    fitted = models.save_stage(models.load_pipeline(unfitted).fit(o), scratch_path(spark, "fitted_index"))
    stage = models.load_pipeline_model(fitted).stages[0]
    return stage.back("priority_index", "original").transform(stage.transform(o)).select("o_orderkey", "priority_index", "original")


@query("ft_index_to_string", "SELECT o_orderkey, o_orderpriority AS original FROM orders")
def ft_index_to_string(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    idx = features.string_indexer("o_orderpriority", "pidx").fit(o).transform(o)
    back = features.index_to_string(idx, "pidx", "original")  # labels from column metadata
    return back.select("o_orderkey", "original")


# VectorIndexer rule in SQL for l_tax (9 distinct values <= 10 categories):
# 0.0 gets 0 when present, other values ascending after it.
_TAX_INDEX_SQL = """
WITH tv AS (SELECT DISTINCT l_tax AS v FROM lineitem),
z AS (SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS has0 FROM tv WHERE v = 0),
ti AS (SELECT v, CAST(CASE WHEN v = 0 THEN 0
                      ELSE (SELECT count(*) FROM tv t2 WHERE t2.v < tv.v AND t2.v <> 0) + (SELECT has0 FROM z)
                      END AS INTEGER) AS idx FROM tv)
"""


def _indexed_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    v = li.select("l_orderkey", "l_linenumber",
                  columns.to_vector(["l_discount", "l_tax", "l_quantity"]).alias("features"))
    model = features.vector_indexer("features", "indexed", max_categories=10).fit(v)
    return v, model


@query("ft_vector_index", _TAX_INDEX_SQL + """
SELECT l_orderkey, l_linenumber, l_discount AS f0, CAST(idx AS DOUBLE) AS f1, l_quantity AS f2
FROM lineitem JOIN ti ON l_tax = ti.v
""")
def ft_vector_index(spark, sf):
    v, model = _indexed_lineitem(spark, sf)
    return columns.vector_items(model.transform(v), "indexed", 3, keep=["l_orderkey", "l_linenumber"])


@query("ft_category_report", _TAX_INDEX_SQL + """
SELECT 1 AS feature, v AS value, idx AS index FROM ti
""")
def ft_category_report(spark, sf):
    _, model = _indexed_lineitem(spark, sf)
    return features.category_report(spark, model)


@query("ft_normalize", """
WITH n AS (SELECT *, sqrt(l_quantity * l_quantity + l_discount * l_discount + l_tax * l_tax) AS nrm FROM lineitem)
SELECT l_orderkey, l_linenumber,
       CASE WHEN nrm = 0 THEN 0 ELSE l_quantity / nrm END AS f0,
       CASE WHEN nrm = 0 THEN 0 ELSE l_discount / nrm END AS f1,
       CASE WHEN nrm = 0 THEN 0 ELSE l_tax / nrm END AS f2
FROM n
""")
def ft_normalize(spark, sf):
    li = table(spark, sf, "lineitem")
    v = li.select("l_orderkey", "l_linenumber",
                  columns.to_vector(["l_quantity", "l_discount", "l_tax"]).alias("features"))
    n = features.normalize(v, "features", "norm", p=2.0)
    return columns.vector_items(n, "norm", 3, keep=["l_orderkey", "l_linenumber"])


@query("ft_assemble", """
SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_discount AS f1, l_tax AS f2, l_extendedprice AS f3
FROM lineitem
""")
def ft_assemble(spark, sf):
    li = table(spark, sf, "lineitem").withColumn(
        "dt", columns.to_vector(["l_discount", "l_tax"]))
    a = features.assemble(li, ["l_quantity", "dt", "l_extendedprice"], "features")
    return columns.vector_items(a, "features", 4, keep=["l_orderkey", "l_linenumber"])


@query("ft_quantile_bucket", """
WITH c AS (SELECT l_quantity AS v, count(*) AS n FROM lineitem GROUP BY 1),
cum AS (SELECT v, sum(n) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS cn, sum(n) OVER () AS tot FROM c),
q AS (SELECT min(v) FILTER (WHERE cn >= ceil(tot * (1 / 3))) AS q1,
             min(v) FILTER (WHERE cn >= ceil(tot * (2 / 3))) AS q2 FROM cum)
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN l_quantity < q1 THEN 0 WHEN l_quantity < q2 THEN 1 ELSE 2 END AS DOUBLE) AS bucket
FROM lineitem, q
""")
def ft_quantile_bucket(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    out, _ = features.quantile_bucket(li, "l_quantity", "bucket", 3, exact=True)
    return out.select("l_orderkey", "l_linenumber", "bucket")


@query("ft_one_hot", _PRIORITY_INDEX_SQL + """
SELECT o_orderkey, CAST(CASE WHEN idx < 4 THEN idx ELSE -1 END AS INTEGER) AS hot, 4 AS size
FROM orders JOIN r ON o_orderpriority = v
""")
def ft_one_hot(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    idx = features.string_indexer("o_orderpriority", "pidx").fit(o).transform(o)
    hot = features.one_hot("pidx", "onehot").fit(idx).transform(idx)
    arr = vector_to_array("onehot")
    return hot.select("o_orderkey", (F.array_position(arr, 1.0) - 1).cast("int").alias("hot"),
                      F.size(arr).alias("size"))
