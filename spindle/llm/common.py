"""Shared helpers of the text operators: Arrow batches in bounded slices,
hash-ordered bounded samples, and tables that cut the lineage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.session import read_table, scratch_path

#: UTF-8 bytes of text that one numpy step of a task looks at.
SLICE_BYTES = 4 << 20

#: Rows of whole texts in an Arrow batch.  A batch stands several times, outside the heap and in Python, for each running task.
BATCH_ROWS = 2000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back, so that
    a lost executor costs one stage and nothing is computed twice."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each starts (and the end).
    Null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    off = np.frombuffer(texts.buffers()[1], width)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` whose texts hold about ``limit`` bytes together;
    a longer text comes alone and whole."""
    _, off = utf8(batch.column(batch.schema.get_field_index(column)))
    at, n = 0, batch.num_rows
    while at < n:
        end = int(np.searchsorted(off, off[at] + limit, "right")) - 1
        end = min(n, max(end, at + 1))
        yield batch.slice(at, end - at)
        at = end


def small_batches(spark: SparkSession) -> None:
    """Lower the session's rows in an Arrow batch to ``BATCH_ROWS``; a smaller
    setting stays.  Batches have no part in any result."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def map_text(df: DataFrame, fields: list[T.StructField], make: Callable[[], Callable], column: str = "text",
             keep: tuple[str, ...] = ("doc_id",), limit: int = SLICE_BYTES) -> DataFrame:
    """Run ``make()(texts)`` over slices of ``df[column]`` in Arrow batches,
    of about ``limit`` bytes of text.

    ``make`` is called once in each task.  Its result takes a string array
    and returns one array for each of ``fields``; the columns ``keep`` go
    through as they are.  No shuffle.
    """
    small_batches(df.sparkSession)
    schema = T.StructType([df.schema[k] for k in keep] + fields)

    def run(batches):
        fn = make()
        for whole in batches:
            for part in slices(whole, column, limit):
                texts = part.column(part.schema.get_field_index(column))
                cols = [part.column(part.schema.get_field_index(k)) for k in keep]
                cols += [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in fn(texts)]
                yield pa.RecordBatch.from_arrays(cols, names=schema.fieldNames())

    columns = list(dict.fromkeys([*keep, column]))
    return df.select(*columns).mapInArrow(run, schema)


def filter_text(df: DataFrame, make: Callable[[], Callable], column: str = "text") -> DataFrame:
    """The rows of ``df``, with all their columns, for which ``make()(texts)``
    (an array of booleans) is true.  No shuffle, and no column is added."""
    small_batches(df.sparkSession)

    def run(batches):
        fn = make()
        for whole in batches:
            for part in slices(whole, column):
                yield part.filter(pa.array(fn(part.column(part.schema.get_field_index(column))), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def remainder(key: str, parts: int):
    """crc32 of the key as text, modulo ``parts``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(parts)


def sample_rows(df: DataFrame, strata: str, per_stratum: int, *salt: str) -> DataFrame:
    """About ``per_stratum`` rows of each value of ``strata``, at most
    ``2 * per_stratum * strata`` in all, picked by a hash of ``salt``.

    The share of each stratum follows from one count, so nothing is ranked
    in a window: the hot value of a column costs no more than the others.
    """
    counts = {r[0]: r[1] for r in df.groupBy(strata).count().collect()}
    if not counts:
        return df.limit(0)
    share = F.lit(None).cast("double")
    for value, n in sorted(counts.items(), key=lambda x: str(x[0])):
        share = F.when(F.col(strata).eqNullSafe(F.lit(value)), F.lit(min(1.0, per_stratum / n))).otherwise(share)
    draw = F.pmod(F.xxhash64(*[F.col(c) for c in salt], F.lit(7)), F.lit(1 << 30))
    picked = df.withColumn("_draw", draw).filter(F.col("_draw") < share * float(1 << 30))
    return picked.orderBy("_draw", *salt).limit(2 * per_stratum * len(counts)).drop("_draw")


#: Bits of a hashed set (8 MB).
FILTER_BITS = 1 << 26


def bit_set(hashes: DataFrame, bits: int = FILTER_BITS, probes: int = 1) -> np.ndarray:
    """The set of ``h`` modulo ``bits`` (a power of 2) as words of 64 bits, at
    most ``bits / 64`` of which reach the driver: a filter of a fixed size,
    whatever the data, that lets some more through as it fills.  With more
    ``probes`` each hash has so many bits, and fewer others have all of theirs
    set by chance, up to about ``bits / probes`` hashes."""
    mask = F.lit(bits - 1)
    at = F.col("h").bitwiseAND(mask)
    if probes > 1:
        step = F.shiftrightunsigned("h", 32).bitwiseAND(mask).bitwiseOR(F.lit(1))
        at = F.explode(F.array(at, *[(at + k * step).bitwiseAND(mask) for k in range(1, probes)]))
    words = (hashes.select(at.alias("b")).groupBy(F.shiftright("b", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("v")).toArrow())
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy().view(np.uint64)
    return out


def in_set(bits: np.ndarray, hashes: np.ndarray, probes: int = 1) -> np.ndarray:
    """Which of the 64-bit ``hashes`` may be in the set of so many ``probes``."""
    mask = np.uint64(64 * len(bits) - 1)
    hashes = hashes.view(np.uint64)
    at = hashes & mask
    found = (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    for k in range(1, probes):
        left = np.flatnonzero(found)
        step = (hashes[left] >> np.uint64(32)) & mask | np.uint64(1)
        at = (hashes[left] + np.uint64(k) * step) & mask
        found[left] = (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found
