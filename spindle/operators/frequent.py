"""Frequent values of key-like columns without shuffling their distinct values.

Two passes.  The first builds a mergeable frequent-items summary of every
column, over 64-bit hashes of the values: ``1 / share`` counters a column and
task, whatever the column holds, and no value above ``share`` of the rows is
missed.  The second counts the values with those hashes exactly, keeping only
them before its aggregation, so that a unique column of any length shuffles at
most ``columns / share`` rows from a task.  Hash collisions can only let some
more values through to the exact count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.operators.columns import q
from spindle.operators.ranking import top_per_group

#: Smallest share that the summary's size allows for.
LEAST_SHARE = 1e-4


def candidates(df: DataFrame, columns: Sequence[str], share: float) -> list[list[int]]:
    """Hashes of each column that may hold more than ``share`` of the rows, at
    most ``1 / share + 1`` a column; nulls have a hash too."""
    hashed = df.select(*[F.xxhash64(F.col(q(c)).cast("string")).alias(f"h{i}") for i, c in enumerate(columns)])
    found = hashed.stat.freqItems(hashed.columns, share).first()
    return [sorted(found[f"h{i}_freqItems"] or []) for i in range(len(columns))]


def frequent_values(df: DataFrame, columns: Sequence[str] | None = None, share: float = 0.01,
                    top_n: int | None = None) -> DataFrame:
    """(column, value, count, rank): every value that holds more than ``share``
    of the rows, with its exact count, most frequent first, ties by value.

    Values are rendered as strings; null is a value of its own.  ``top_n``
    keeps the first n of each column.  An empty table, or a column in which no
    value is that frequent, gives no rows.
    """
    if not LEAST_SHARE <= share < 1:
        raise ValueError(f"share must be from {LEAST_SHARE} to 1, not {share}")
    cols = list(columns) if columns is not None else df.columns
    texts = df.select(*[F.col(q(c)).cast("string").alias(f"v{i}") for i, c in enumerate(cols)])
    maybe = candidates(df, cols, share)
    n_rows = texts.count()
    pairs = F.array(*[F.when(F.xxhash64(f"v{i}").isin(hashes), F.struct(F.lit(i).alias("at"), F.col(f"v{i}").alias("value")))
                      for i, hashes in enumerate(maybe)])
    counts = (texts.select(F.explode(F.filter(pairs, lambda p: p.isNotNull())).alias("p")).groupBy("p.at", "p.value")
              .agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > share * n_rows))
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("at") + 1)
    ranked = top_per_group(counts.select(name.alias("column"), "value", "count"), "column", top_n or int(1 / share) + 1)
    return ranked.select("column", "value", "count", F.col("rank").cast("int").alias("rank"))
