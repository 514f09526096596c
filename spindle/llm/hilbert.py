"""Shards along a Hilbert curve through several metadata columns.

Each dimension is quantised to 2**bits cells of equal depth: the cell of a
value is ``cells * (rows with a smaller value) div (rows with a value)``, so
all rows of one value share a cell and a hot value takes its share of the
axis.  A cell is a point of a grid; rows are ordered by the index of their
point on the Hilbert curve, and the order is cut into runs, one for each
shard.  Rows near each other on the curve are near each other in every
dimension, so each shard (and each file in it) covers a small box, and a
filter on any of the dimensions skips most of them (``shard_bounds``).

Laws: ``rows`` cuts into runs whose row counts differ by one at most;
``bytes`` cuts where the running size passes a multiple of the mean (a row
belongs to the run that holds its middle), so a shard is off the mean by one
row's size at most.

Scale: per dimension one count of values and its running totals, of which at
most 2**bits cut points reach the driver; the rows are range-partitioned once
by (curve index, ties, row number), so a cell with a third of all rows is
split over many tasks; only offsets of ranges and shards, whose number is a
parameter, are broadcast.

Edge cases: null counts as the lowest value of a dimension, NaN as infinity;
rows of one point follow the tie columns, nulls first, then stored order;
repeated rows each get a slot; an empty table gives no rows; input columns
named like the new ones are replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm.common import cut, documents
from spindle.llm.registry import query
from spindle.operators.columns import q
from spindle.operators.ranking import running_totals

#: Cells of a dimension: 2**BITS.
BITS = 6
SHARDS = 24


def _ordered(df: DataFrame, name: str):
    """The column in a form whose Python order is Spark's order."""
    kind, c = df.schema[name].dataType, F.col(q(name))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(c), F.lit(float("inf"))).otherwise(c.cast("double"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, (T.IntegralType, T.DecimalType, T.StringType, T.BooleanType, T.DateType)):
        return c
    raise TypeError(f"{name}: no dimension of type {kind.simpleString()}")


def cut_points(df: DataFrame, dim: str, cells: int) -> list[tuple]:
    """(smallest value, cell) of each cell that has values, in order."""
    counts = df.select(_ordered(df, dim).alias("v")).filter("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("c"))
    summed, totals = running_totals(counts, "v", ["c"], descending=False, with_totals=True)
    if not totals["c"]:
        return []
    cell = F.expr(f"(cum_c - c) * {cells} div {totals['c']}")
    firsts = summed.groupBy(cell.cast("int").alias("cell")).agg(F.min("v").alias("v")).collect()
    return sorted(((r["v"], r["cell"]) for r in firsts), key=lambda x: x[1])


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``cells`` (points by dimensions) on the curve.

    From the top bit down, the orthant of a point decides how the part of the
    curve inside it is turned (an exchange with the first axis) or mirrored;
    a Gray code over the axes then gives the order of the orthants.
    """
    x = [cells[:, k].astype(np.int64) for k in range(cells.shape[1])]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for k in range(n):
            upper = (x[k] >> level) & 1 == 1
            swap = np.where(upper, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            if k:
                x[k] = x[k] ^ swap
    for k in range(1, n):
        x[k] = x[k] ^ x[k - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> level) & 1 == 1, turn ^ ((1 << level) - 1), turn)
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for k in range(n):
            index = index << 1 | ((x[k] ^ turn) >> level) & 1
    return index


def with_curve_index(df: DataFrame, dims: Sequence[str], bits: int = BITS, column: str = "curve") -> DataFrame:
    """``df`` and the curve index of each row (long)."""
    if not dims or bits < 1 or len(dims) * bits > 62:
        raise ValueError("at least one dimension and bit, 62 bits at most in all")
    cuts = [cut_points(df, d, 1 << bits) for d in dims]
    kept = [c for c in df.columns if c != column]
    keys = [f"_dim{k}" for k in range(len(dims))]
    wide = df.select(*[F.col(q(c)) for c in kept], *[_ordered(df, d).alias(k) for d, k in zip(dims, keys, strict=True)])
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(column, T.LongType(), False)])

    def place(batches):
        for b in batches:
            cells = np.zeros((b.num_rows, len(keys)), np.int64)
            for k, name in enumerate(keys):
                coded = b.column(b.schema.get_field_index(name)).dictionary_encode()
                firsts, numbers = [v for v, _ in cuts[k]], [c for _, c in cuts[k]]
                found = [numbers[max(bisect_right(firsts, v) - 1, 0)] if v is not None else 0 for v in coded.dictionary.to_pylist()]
                codes = coded.indices.fill_null(len(found)).to_numpy(zero_copy_only=False)
                cells[:, k] = np.array([*found, 0], np.int64)[codes]
            cols = [b.column(b.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(curve_index(cells, bits))], names=schema.fieldNames())

    return wide.mapInArrow(place, schema)


def hilbert_shards(df: DataFrame, dims: Sequence[str], shards: int = SHARDS, law: str = "rows", size: str | None = None,
                   ties: Sequence[str] = (), bits: int = BITS, ranges: int | None = None) -> DataFrame:
    """The columns of ``df``, ``curve`` (long), ``shard`` (int, from 0) and
    ``slot`` (long, gapless from 0 in each shard).  ``law="bytes"`` needs the
    column ``size``.  ``ranges``: tasks of the ordering, by default four for
    each shuffle partition."""
    if law not in ("rows", "bytes") or (law == "bytes" and size is None):
        raise ValueError("law is rows, or bytes with a size column")
    spark = df.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = [c for c in df.columns if c not in ("curve", "shard", "slot")]
    placed = with_curve_index(df, dims, bits).withColumns({
        "_row": F.monotonically_increasing_id(), "_one": F.lit(1).cast("long"),
        "_size": F.coalesce(F.col(q(size)), F.lit(0)).cast("long") if size else F.lit(0).cast("long")})
    placed = cut(placed, "curve")
    order = [F.col("curve").asc(), *[F.col(q(c)).asc_nulls_first() for c in ties], F.col("_row").asc()]
    summed, totals = running_totals(placed, order, ["_one", "_size"], ranges=ranges, with_totals=True)
    n, whole = totals["_one"] or 1, totals["_size"] or 1
    rank = F.col("cum__one") - 1
    if law == "rows":
        shard = F.floor(F.expr(f"(cum__one - 1) * {shards} div {n}"))
        out = summed.withColumn("shard", shard.cast("int")).withColumn(
            "slot", rank - F.expr(f"(shard * {n}L + {shards - 1}) div {shards}"))
    else:
        middle = F.expr(f"least((2 * (cum__size - _size) + _size) * {shards} div {2 * whole}, {shards - 1})")
        cutting = summed.withColumn("shard", middle.cast("int")).withColumn("_rank", rank)
        first = cutting.groupBy("shard").agg(F.min("_rank").alias("_first"))  # one row for each shard
        out = cutting.join(F.broadcast(first), "shard").withColumn("slot", F.col("_rank") - F.col("_first"))
    return out.select(*[F.col(q(c)) for c in kept], "curve", "shard", F.col("slot").cast("long").alias("slot"))


def shard_bounds(sharded: DataFrame, dims: Sequence[str]) -> DataFrame:
    """One row for each shard: its rows, and the least and greatest value of
    each dimension, by which a reader skips shards."""
    bounds = [f(F.col(q(d))).alias(f"{name}_{d}") for d in dims for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count("*").alias("n_rows"), *bounds)


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Parquet below ``path``, one folder for each shard.  A file holds a run
    of ``rows_per_file`` slots, so files too cover small boxes."""
    run = F.expr(f"slot div {rows_per_file}")
    parts = int(sharded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (sharded.withColumn("_run", run).repartition(parts, "shard", "_run").sortWithinPartitions("shard", "slot")
     .drop("_run").write.partitionBy("shard").parquet(path))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text and 8), crc32 of the text, and
    the metadata: what the ordering needs, without the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), "lang", "source")


@query("op11_hilbert_sharding")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal row counts (one more at most), by
    language, source and size; equal texts of a point lie side by side."""
    rows = hilbert_shards(measured(documents(spark, sf_dir)), ["lang", "source", "size"], ties=["text_crc32", "doc_id"])
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "curve")
