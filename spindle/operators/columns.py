"""Projections, renames, casts, schema report and vector columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField,
                               StructType, BooleanType)


def q(name: str) -> str:
    """Back-quote a column name that may hold '-' or '.'."""
    return "`" + name.replace("`", "``") + "`"


def select_slice(df: DataFrame, start: int, end: int) -> DataFrame:
    """Columns ``start … end-1`` by position (the scripts' ``slice(a, b)``)."""
    return df.select(*[q(c) for c in df.columns[start:end]])


def names_slice(df: DataFrame, start: int, end: int, exclude: Sequence[str] = ()) -> list[str]:
    """Column names by position; raises if a name in ``exclude`` (the label)
    falls inside the slice."""
    names = df.columns[start:end]
    bad = [c for c in names if c in set(exclude)]
    if bad:
        raise ValueError(f"label column(s) {bad} fall inside the feature slice {start}:{end}")
    return names


def rename(df: DataFrame, mapping: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Many renames as one projection: a dict old -> new, or all new names
    by position."""
    if isinstance(mapping, Mapping):
        missing = [k for k in mapping if k not in df.columns]
        if missing:
            raise ValueError(f"rename: no such column(s) {missing}")
        return df.withColumnsRenamed(dict(mapping))
    return df.toDF(*mapping)


def cast(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast columns in place; ``strict=False`` gives null for bad values
    (``try_cast``) instead of failing under ANSI mode."""
    cols = {}
    for name, typ in types.items():
        c = F.col(q(name))
        cols[name] = c.cast(typ) if strict else c.try_cast(typ)
    return df.withColumns(cols)


def derive(df: DataFrame, exprs: Mapping[str, object]) -> DataFrame:
    """Add or replace columns in one projection."""
    return df.withColumns(dict(exprs))


def add_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


_SCHEMA_INFO = StructType([
    StructField("position", IntegerType(), False),
    StructField("name", StringType(), False),
    StructField("type", StringType(), False),
    StructField("nullable", BooleanType(), False),
])


def schema_info(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema as rows (position, name, type, nullable)."""
    rows = [(i, f.name, f.dataType.simpleString(), bool(f.nullable))
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, _SCHEMA_INFO)


def schema_counts(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema as rows, with the number of values (not null) of each
    column, from one aggregate over the table."""
    counts = df.agg(*[F.count(F.col(q(f.name))).alias(f"n{i}") for i, f in enumerate(df.schema.fields)]).first()
    n = spark.createDataFrame([(i, int(v)) for i, v in enumerate(counts)], "position int, n_values long")
    return schema_info(spark, df).join(F.broadcast(n), "position")


def sparse_literal(spark: SparkSession, size: int, entries: Iterable[Mapping[int, float]], name: str = "features") -> DataFrame:
    """A small table of sparse vectors from {place: value} literals."""
    return spark.createDataFrame([(Vectors.sparse(size, dict(e)),) for e in entries], [name])


def with_sparse(df: DataFrame, col: str, size: int, entries: Mapping[object, Mapping[int, float]], name: str = "features") -> DataFrame:
    """``df`` with the sparse vector that ``entries`` gives for the value of
    ``col``; null where it gives none.  The literals are broadcast."""
    rows = [(k, Vectors.sparse(size, dict(e))) for k, e in entries.items()]
    lookup = df.sparkSession.createDataFrame(rows, StructType([StructField("_key", df.schema[col].dataType), StructField(name, VectorUDT())]))
    return df.join(F.broadcast(lookup), F.col(q(col)) == F.col("_key"), "left").drop("_key")


def to_vector(cols: Sequence[str]):
    """Dense vector column from numeric columns (no assembler metadata)."""
    return array_to_vector(F.array(*[F.col(q(c)).cast("double") for c in cols]))


def vector_items(df: DataFrame, vec_col: str, size: int, prefix: str = "f",
                 keep: Sequence[str] = ()) -> DataFrame:
    """A fixed-size vector column as plain double columns ``f0 … f{n-1}``,
    so that SQL engines without a vector type can see it."""
    arr = vector_to_array(F.col(vec_col))
    return df.select(*[q(k) for k in keep],
                     *[arr.getItem(i).alias(f"{prefix}{i}") for i in range(size)])


def vector_long(df: DataFrame, vec_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """A vector column as one row per (keys…, dim, value)."""
    return (df.select(*[q(k) for k in keep],
                      F.posexplode(vector_to_array(F.col(vec_col))).alias("dim", "value"))
              .withColumn("dim", F.col("dim").cast(LongType())))
