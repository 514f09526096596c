"""Distributed ranking building blocks.

Two things the scripts need that a naive plan would do in one task:

* top-n values per group (profiles, modes): ``top_per_group`` ranks inside
  salted sub-groups first, so no task ever holds a whole group;
* running sums and positions over an ordered key (ROC curves, exact
  quantiles, label indices): ``running_totals`` range-partitions the rows by
  the key, sums inside each range with a partitioned window, and adds the
  totals of the ranges before it.  The ranges' totals are one row each,
  which is all that the driver sees.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindle.session import scratch_path

#: Ranges of an ordered key, unless the caller asks for another number.
RANGES = 32


def top_per_group(counts: DataFrame, group: str, n: int, salt_buckets: int = 64,
                  count_col: str = "count", value_col: str = "value") -> DataFrame:
    """Exact top-n rows per group, ordered by count desc, value asc.

    Rank within (group, hash(value) mod B) and keep n per bucket, then rank
    the at most n*B survivors per group.  The global top n of a group is
    always among the survivors, so the result is exact.
    """
    order = [F.col(count_col).desc(), F.col(value_col).asc_nulls_last()]
    salted = counts.withColumn("_salt", F.pmod(F.xxhash64(F.col(value_col)), F.lit(salt_buckets)))
    w1 = Window.partitionBy(group, "_salt").orderBy(*order)
    pre = salted.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= n)
    w2 = Window.partitionBy(group).orderBy(*order)
    return (pre.withColumn("rank", F.row_number().over(w2))
               .filter(F.col("rank") <= n)
               .drop("_salt", "_r"))


def running_totals(df: DataFrame, order_col: str | Sequence[Column], sum_cols: Sequence[str],
                   descending: bool = True, ranges: int = RANGES, prefix: str = "cum_",
                   with_totals: bool = False):
    """Add ``cum_<c>``: the sum of ``c`` over all rows at or before this row
    in ``order_col`` order (a column, or sort expressions).  Expects one row
    per distinct key (group first), which makes the order total.

    One path at every size: the rows are range-partitioned once into
    ``ranges`` parts and written below ``spark.checkpoint.dir``, so the
    grouped input is worked out once and a range is a stored column.  Spark's
    order holds for all keys: null is below every number, NaN above every
    number and infinity; neither loses a row.  With ``with_totals`` the column
    totals are returned too: ``(df, {c: total})``.
    """
    if isinstance(order_col, str):
        keys = [F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_first()]
    else:
        keys = list(order_col)
    spark = df.sparkSession
    ranged = df.repartitionByRange(ranges, *keys).withColumn("_range", F.spark_partition_id())
    path = scratch_path(spark, "ranges")
    ranged.write.parquet(path)
    staged = spark.read.schema(ranged.schema).parquet(path)
    per_range = staged.groupBy("_range").agg(*[F.sum(c).alias(c) for c in sum_cols]).orderBy("_range").collect()
    offsets, so_far = [], dict.fromkeys(sum_cols, 0)
    for r in per_range:  # at most ``ranges`` rows
        offsets.append((r["_range"], *so_far.values()))
        so_far = {c: v + (r[c] or 0) for c, v in so_far.items()}
    types = [(f"_off_{c}", staged.groupBy().agg(F.sum(c)).schema[0].dataType.simpleString()) for c in sum_cols]
    before = spark.createDataFrame(offsets, ", ".join(["_range int", *(f"`{n}` {t}" for n, t in types)]))
    within = (Window.partitionBy("_range").orderBy(*keys)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = staged.withColumns({f"_in_{c}": F.coalesce(F.sum(c).over(within), F.lit(0)) for c in sum_cols})
    out = summed.join(F.broadcast(before), "_range").select(
        *df.columns,
        *[(F.col(f"_in_{c}") + F.col(f"_off_{c}")).alias(f"{prefix}{c}") for c in sum_cols])
    return (out, so_far) if with_totals else out
