"""Counts, group counts, means and one-pass column profiles.

The reference profiles a table with one job per column; here each profile is
a single scan: ``prof_nulls`` is one aggregate with a conditional count per
column, ``prof_values`` unpivots every column into (column, value) rows,
counts them with partial (map-side) aggregation and keeps the top n per
column with a salted two-stage rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from spindle.operators.columns import q
from spindle.operators.ranking import top_per_group


def count_rows(df: DataFrame) -> DataFrame:
    """Row count as a one-row table (column ``n``)."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def group_count(df: DataFrame, by: Sequence[str] | str) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*[q(c) for c in by]).agg(F.count(F.lit(1)).alias("count"))


def sort_by_count(counts: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Most frequent first; ties by key ascending so the order is total."""
    key = [key] if isinstance(key, str) else list(key)
    return counts.orderBy(F.col("count").desc(), *[F.col(q(k)).asc_nulls_last() for k in key])


def mean_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Means with nulls skipped, one row, ``mean_<c>`` columns."""
    return df.agg(*[F.avg(q(c)).alias(f"mean_{c}") for c in columns])


def first_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First n rows by an explicit key (TakeOrderedAndProject)."""
    return df.orderBy(*[q(c) for c in order]).limit(n)


def profile_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(position, column, n_missing, n_rows) for every column, in one pass.

    Missing is null, and for strings also ''.
    """
    cols = list(columns) if columns is not None else df.columns
    exprs = []
    for c in cols:
        col = F.col(q(c))
        miss = col.isNull()
        if isinstance(df.schema[c].dataType, StringType):
            miss = miss | (col == F.lit(""))
        exprs.append(F.count_if(miss).cast("bigint").alias(f"m{len(exprs)}"))
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *exprs)
    pairs = ", ".join(f"{i}, '{c.replace(chr(39), chr(39) * 2)}', m{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {pairs}) as (position, column, n_missing)", "n_rows"
    ).select(F.col("position").cast("int").alias("position"), "column", "n_missing", "n_rows")


def profile_values(df: DataFrame, columns: Sequence[str] | None = None, top_n: int = 20,
                   salt_buckets: int = 64) -> DataFrame:
    """(column, value, count, rank): the top n values of every column by
    frequency (count desc, value asc), values rendered as strings, nulls
    counted as a value of their own.  One scan of the input.
    """
    cols = list(columns) if columns is not None else df.columns
    strs = df.select(*[F.col(q(c)).cast("string").alias(c) for c in cols])
    long = strs.unpivot([], cols, "column", "value")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    ranked = top_per_group(counts, "column", top_n, salt_buckets)
    return ranked.select("column", "value", "count", F.col("rank").cast("int").alias("rank"))
