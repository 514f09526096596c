"""Stand-in tables derived from the driver's parquet tables.

The reference's own inputs (titanic, credit card default, bike hours, iris,
LIBSVM samples) are absent; each stand-in is a Spark plan over the given
tables, so its work grows with them, and each has a SQL twin for the
oracle.  The test tables hold no nulls, so missing values are made by
value rules (never by dropping or sampling rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.session import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# --- customer with gaps (titanic-like cleaning input) -----------------------

def gappy_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer with c_acctbal null where negative, c_mktsegment '' for
    nation 0 and null for nation 1."""
    c = table(spark, sf_dir, "customer")
    seg = (F.when(F.col("c_nationkey") == 0, F.lit(""))
            .when(F.col("c_nationkey") == 1, F.lit(None).cast("string"))
            .otherwise(F.col("c_mktsegment")))
    return c.withColumns({
        "c_acctbal": F.when(F.col("c_acctbal") < 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")),
        "c_mktsegment": seg,
    })


GAPPY_CUSTOMER_SQL = """
(SELECT c_custkey, c_name, c_nationkey,
        CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
        CASE WHEN c_nationkey = 0 THEN '' WHEN c_nationkey = 1 THEN NULL ELSE c_mktsegment END AS c_mktsegment
 FROM customer)
"""


def _key_text(keys) -> str:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '<null>')" for k in keys)


def split_sql(keys, pct: int = 70) -> str:
    """SQL twin of ``spindle.operators.split.split_flag`` (keys joined by '|')."""
    return f"((('0x' || substr(md5({_key_text(keys)}), 1, 8))::BIGINT % 100) < {pct})"


def fold_sql(keys, k: int = 3) -> str:
    """SQL twin of ``spindle.operators.split.fold_column``."""
    return f"CAST((('0x' || substr(md5({_key_text(keys)}), 9, 8))::BIGINT % {k}) AS INTEGER)"


# --- documents with quality labels (credit-card-like binary input) ----------

def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels joined to documents: quality label with numeric and
    categorical document features.  ``labels`` is the smaller side but
    grows with the data, so the join is left to the planner (AQE turns it
    into a broadcast only when its measured size allows)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    lab = table(spark, sf_dir, "labels")
    return lab.join(docs, "doc_id")


# --- events per hour (bike-hours-like regression input) ---------------------

def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per hour: calendar fields and the number of events; label
    ``total`` = what the hour's events are worth together, 20 each at most."""
    ev = table(spark, sf_dir, "events")
    hour = F.date_trunc("hour", F.col("ts"))
    per = ev.groupBy(hour.alias("hour_ts")).agg(F.count(F.lit(1)).alias("n_events"), F.sum(F.least("value", F.lit(20.0))).alias("total"))
    return per.select(
        "hour_ts",
        F.dayofmonth("hour_ts").alias("day"),
        F.hour("hour_ts").alias("hr"),
        F.dayofweek("hour_ts").alias("weekday"),
        "n_events", "total",
    )


# --- embeddings (iris-like multiclass input) --------------------------------

def embedding_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label (as string, like iris' species), features vector."""
    from pyspark.ml.functions import array_to_vector
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        "vec_id",
        F.concat(F.lit("class_"), F.col("label").cast("string")).alias("species"),
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
    )
