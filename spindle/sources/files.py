"""Readers and writers: CSV (with and without header), JSON lines, LIBSVM,
parquet and literal tables.

Schema inference costs one more pass over the input, so every reader takes
an explicit schema and only infers when none is given.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# fixed value: the format name the scripts use, which Spark still maps to csv
LEGACY_CSV_FORMAT = "com.databricks.spark.csv"


def read_csv(spark: SparkSession, path: str, header: bool = True,
             schema: StructType | str | None = None, names: Sequence[str] | None = None,
             sep: str = ",", fmt: str = "csv") -> DataFrame:
    """CSV with a header row (types inferred unless ``schema``) or without one.

    Without a header Spark names the columns ``_c0 … _cN``; ``names`` renames
    them by position in one projection.  Empty fields, quoted or not, read as
    null and blank lines are skipped.
    """
    if fmt not in ("csv", LEGACY_CSV_FORMAT):
        raise ValueError(f"not a CSV format name: {fmt}")
    reader = spark.read.format(fmt).option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    df = reader.load(path)
    if names is not None:
        df = df.toDF(*names)
    return df


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines, one object per line; schema inferred unless given."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LIBSVM text as (label double, features vector).

    File indices are 1-based, vector indices 0-based.  Giving
    ``num_features`` skips the extra pass that finds the largest index.
    """
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", int(num_features))
    return reader.load(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def literal_table(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """A small table from driver literals (lookup maps, examples)."""
    return spark.createDataFrame(list(rows), schema)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    """Write the given columns as CSV, one file per partition."""
    df.write.mode(mode).option("header", header).csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def write_libsvm(df: DataFrame, path: str, label: str, features: Sequence[str] | str,
                 mode: str = "overwrite") -> str:
    """Write (label, numeric columns or a vector column) in LIBSVM format."""
    if isinstance(features, str):
        vec = F.col(features)
    else:
        vec = array_to_vector(F.array(*[F.col(c).cast("double") for c in features]))
    (df.select(F.col(label).cast("double").alias("label"), vec.alias("features"))
       .write.mode(mode).format("libsvm").save(path))
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path
