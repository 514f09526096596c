"""Input layout for iterative fits.

Learners read their input once per iteration (gradients, tree levels,
boosting rounds, folds), and seeded learners (bagging, initial centres)
draw by partition and position.  So before a fit the input is

* cut to the columns that the estimator reads;
* dealt to a number of partitions that is a parameter, or else follows from
  the size of the rows, by content alone: the same rows give the same fit on
  any cluster, whatever made them.  Equal rows
  are counted first, and the copies of one row go round the partitions from
  the one that its hash names, so a row that holds a third of the table is a
  third of every partition;
* kept for the duration of the fit (memory, spilling to disk) or, for inputs
  that many fits read, written below ``spark.checkpoint.dir`` and deleted
  afterwards (``reliable=True``).

If the number of partitions is given, no job is run to find the layout.  Else
one pass without a shuffle adds up the rows' sizes (``fit_partitions``); it
reads only columns of no fixed width.  Only distinct rows are shuffled, with
their counts.

A learner that takes weights, and draws no rows, need not read copies one by
one: ``weighted_input`` gives it each distinct row in a few pieces that weigh
as much as its copies together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField

from spindle.operators.columns import q
from spindle.session import remove_path, scratch_path

#: Least partitions of a fit's input, unless the caller asks for a number
#: (``partitions`` of every fit, search and job).
FIT_PARTITIONS = 8
#: Bytes of a partition, as ``fit_partitions`` counts them, at most.  It is no
#: function of the cluster, so that fits do not depend on that.
PARTITION_BYTES = 256 << 20
#: What a row takes in a learner beside its values (objects, weights, residuals).
ROW_BYTES = 200

_READS = ("labelCol", "featuresCol", "weightCol", "inputCol", "inputCols", "foldCol")


def read_columns(stages: Sequence, columns: Sequence[str]) -> list[str]:
    """Those of ``columns`` that the stages read, in table order; all of them
    if the stages do not say."""
    names: set[str] = set()
    todo = list(stages)
    while todo:
        s = todo.pop()
        if hasattr(s, "getStages"):
            todo += s.getStages()
        if hasattr(s, "getEstimator"):
            todo.append(s.getEstimator())
        for p in _READS:
            if s.hasParam(p) and s.isDefined(p):
                value = s.getOrDefault(p)
                names.update([value] if isinstance(value, str) else value)
    kept = [c for c in columns if c in names]
    return kept or list(columns)


def _width(field: StructField) -> Column:
    """Bytes of a column's value in a learner's row, roughly."""
    c, kind = F.col(q(field.name)), field.dataType
    if isinstance(kind, (StringType, BinaryType)):
        size = F.octet_length(c)
    elif isinstance(kind, VectorUDT):
        known = (field.metadata or {}).get("ml_attr", {}).get("num_attrs")
        size = F.lit(8 * known) if known else 8 * F.size(vector_to_array(c))
    elif isinstance(kind, ArrayType) and isinstance(kind.elementType, StringType):
        size = F.aggregate(c, F.lit(0).cast("long"), lambda total, x: total + 8 + F.coalesce(F.octet_length(x), F.lit(0)))
    elif isinstance(kind, (ArrayType, MapType)):
        size = 16 * F.size(c)
    else:
        size = F.lit(8)
    return F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long")


def _row_bytes(fields: Sequence[StructField]) -> Column:
    return sum((_width(f) for f in fields), F.lit(ROW_BYTES).cast("long"))


def _partitions_of(size: Column, df: DataFrame) -> int:
    total = df.agg(F.sum(size)).first()[0] or 0
    return max(FIT_PARTITIONS, -(-int(total) // PARTITION_BYTES))


def fit_partitions(df: DataFrame) -> int:
    """How many partitions a fit on ``df`` takes: more for more or wider rows,
    so that no task of the fit reads more as the data grows."""
    return _partitions_of(_row_bytes(df.schema.fields), df)


def only_read(df: DataFrame, stages: Sequence, also: Sequence[str] = ()) -> DataFrame:
    """``df`` with the columns that ``stages`` read, and ``also``; with all if
    no stage is given."""
    if not stages:
        return df
    read = set(read_columns(stages, df.columns)) | set(also)
    return df.select(*[F.col(q(c)) for c in df.columns if c in read])


#: Copies of a row that one array of its expansion holds.
_CHUNK = 10_000


def _counted(df: DataFrame) -> DataFrame:
    """Distinct rows with how many there are of each, ``_n``."""
    return df.groupBy(*[F.col(q(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))


def _dealt(counted: DataFrame, partitions: int, pieces: Column | None = None) -> DataFrame:
    """Distinct rows of each partition with ``_part``, the hash ``_row`` and
    the number of copies there, ``_copies``.  The copies of a row are in
    ``pieces`` (default: one for each partition, if there are as many copies)
    of about one size, which go round the partitions."""
    comparable = lambda f: F.array_sort(F.map_entries(q(f.name))) if isinstance(f.dataType, MapType) else F.col(q(f.name))
    row = F.xxhash64(*[comparable(f) for f in counted.schema.fields if f.name != "_n"])
    pieces = F.least(F.col("_n"), F.lit(partitions)) if pieces is None else pieces
    turns = counted.withColumns({"_row": row, "_pieces": pieces.cast("long")}).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pieces") - 1)).alias("_turn"))
    return turns.withColumns({
        "_part": F.pmod(F.pmod("_row", F.lit(partitions)) + F.col("_turn"), F.lit(partitions)).cast("int"),
        "_copies": F.expr("_n div _pieces") + (F.col("_turn") < F.col("_n") % F.col("_pieces")).cast("long"),
    }).drop("_turn", "_pieces", "_n")


def _placed(dealt: DataFrame, partitions: int) -> DataFrame:
    """``dealt`` in its partitions, ordered by hash."""
    return dealt.repartitionById(partitions, "_part").sortWithinPartitions("_row")


def _expanded(dealt: DataFrame, partitions: int) -> DataFrame:
    """The rows themselves, in their partitions, ordered by hash."""
    start = _placed(dealt, partitions).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(_CHUNK).cast("long"))).alias("_at"))
    size = F.least(F.col("_copies") - F.col("_at"), F.lit(_CHUNK)).cast("int")
    return start.select("*", F.explode(F.sequence(F.lit(1), size)).alias("_copy")).drop("_row", "_part", "_copies", "_at", "_copy")


def by_content(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df`` dealt evenly to ``partitions`` by content, copies included, and
    sorted by a hash of the row in each."""
    partitions = partitions or fit_partitions(df)
    return _expanded(_dealt(_counted(df), partitions), partitions)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` in memory (spilling to disk) for the duration of the block."""
    data = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield data
    finally:
        data.unpersist()


@contextmanager
def fit_input(df: DataFrame, stages: Sequence = (), partitions: int | None = None,
              reliable: bool = False, also: Sequence[str] = ()) -> Iterator[DataFrame]:
    """``with fit_input(df, [est]) as data: model = est.fit(data)``.

    Only the columns that ``stages`` read, and ``also``, are kept (all, if no
    stage is given).  ``reliable`` writes the input to the shared folder, so a
    lost executor costs a re-read and not a re-run of the plan that made it.
    """
    df = only_read(df, stages, also)
    partitions = partitions or fit_partitions(df)
    if reliable:
        path = scratch_path(df.sparkSession, "fit_input")
        dealt = _dealt(_counted(df), partitions)
        dealt.write.parquet(path)
        try:
            # the partition is a stored column, so files may be packed into tasks in any way
            yield _expanded(df.sparkSession.read.schema(dealt.schema).parquet(path), partitions)
        finally:
            remove_path(df.sparkSession, path)
        return
    with kept(by_content(df, partitions)) as data:
        yield data


#: Pieces of equal weight that ``weighted_input`` cuts a table's rows into, at
#: most, beside one for each distinct row.  Ten times what Spark's trees draw
#: to find their thresholds, so that a draw of pieces is as good as one of rows.
WEIGHED_PIECES = 100_000
#: The column of weights that ``weighted_input`` adds.
WEIGHT = "_weight"


@contextmanager
def weighted_input(df: DataFrame, stages: Sequence = (), partitions: int | None = None) -> Iterator[DataFrame]:
    """As ``fit_input``, but copies of a row come together, ``WEIGHT`` of them
    in a piece.  A piece weighs a ``WEIGHED_PIECES``-th of the table at most
    (one row, if that is less), so a table of that many rows comes as it is,
    each row with weight 1."""
    df = only_read(df, stages)
    with kept(_counted(df)) as counted:
        total = counted.agg(F.sum("_n")).first()[0] or 0
        most = max(1, -(-total // WEIGHED_PIECES))
        pieces = F.expr(f"(_n + {most - 1}L) div {most}L")
        partitions = partitions or _partitions_of(_row_bytes(df.schema.fields) * pieces, counted)
        placed = _placed(_dealt(counted, partitions, pieces), partitions)
        data = placed.withColumn(WEIGHT, F.col("_copies").cast("double")).drop("_row", "_part", "_copies").persist(StorageLevel.MEMORY_AND_DISK)
        data.count()                                                        # now the counts can go
    try:
        yield data
    finally:
        data.unpersist()
