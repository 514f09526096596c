"""Train/test splits and folds.

``randomSplit`` depends on how the input happens to be partitioned, so the
same seed gives different parts on a different cluster.  The keyed split
hashes a key with md5 instead: the part of a row depends only on its key,
needs no shuffle, and the same rule can be written in plain SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.operators.columns import q

#: What a null key is hashed as.
NULL_KEY = "<null>"


def key_bucket(keys: Sequence[str] | str, modulus: int = 100, offset: int = 1) -> Column:
    """pmod(int(hex md5(key)[offset : offset+8]), modulus).

    Several keys are joined with '|' before hashing; a null key counts as the
    text ``NULL_KEY``, so every row is in exactly one part and one fold.
    ``offset`` picks which 8 hex digits are used, so the split and the folds
    are independent.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    text = F.concat_ws("|", *[F.coalesce(F.col(q(k)).cast("string"), F.lit(NULL_KEY)) for k in keys])
    hexpart = F.substring(F.md5(text), offset, 8)
    return F.pmod(F.conv(hexpart, 16, 10).cast("bigint"), F.lit(modulus))


def split_flag(keys: Sequence[str] | str, train_pct: int = 70) -> Column:
    """True for training rows."""
    return key_bucket(keys, 100, 1) < F.lit(train_pct)


def keyed_split(df: DataFrame, keys: Sequence[str] | str, train_pct: int = 70):
    """(train, test) by a hash of the key; disjoint and complete."""
    flag = split_flag(keys, train_pct)
    return df.filter(flag), df.filter(~flag)


def label_split(df: DataFrame, keys: Sequence[str] | str, train_pct: int = 70,
                name: str = "part") -> DataFrame:
    """The whole table with a ``part`` column ('train' / 'test')."""
    return df.withColumn(name, F.when(split_flag(keys, train_pct), F.lit("train")).otherwise(F.lit("test")))


def fold_column(keys: Sequence[str] | str, num_folds: int = 3) -> Column:
    """Fold number in [0, num_folds) from md5 digits 9-16 of the key."""
    return key_bucket(keys, num_folds, 9).cast("int")


def native_split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 11):
    """The built-in sampler, kept for parity; depends on partitioning."""
    return df.randomSplit(list(weights), seed)


def cache(df: DataFrame) -> DataFrame:
    """Keep a table that several fits read; spills to disk rather than
    recomputing when memory is short."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
