"""String index as pipeline stages whose labels stay on the cluster.

``TableIndexer`` is an estimator like Spark's ``StringIndexer`` (most frequent
first, ties alphabetical, the same ``handleInvalid``), but its model keeps
(label, index) as a table below ``spark.checkpoint.dir`` and attaches it by a
join.  ``LabelsBack`` maps indices to labels by the same table.  Any number of
labels is fitted, saved, loaded and applied without one of them reaching the
driver; the planner broadcasts a table by its file size, or shuffles.

The table is numbered by ``features.label_index`` and written once in ``fit``;
a saved stage holds a copy of its own (so a loaded one cannot be saved over
the path it was loaded from).  Rows with a null value are invalid
('keep' gives them the extra index), as are values unseen in ``fit``.  An
empty input fits an empty table.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.operators.columns import q
from spindle.operators.features import label_index, string_index
from spindle.session import scratch_path

_SCHEMA = "label string, index int"


class _TableWriter(MLWriter):
    """Params as metadata, the labels as Parquet beside them."""

    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def save(self, path: str) -> None:
        if self.stage.getOrDefault(self.stage.table).startswith(f"{path.rstrip('/')}/"):
            raise ValueError(f"{path} holds the labels of the stage that is to be saved there")
        super().save(path)

    def saveImpl(self, path: str) -> None:  # noqa: N802 (Spark's name)
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.labels.write.parquet(f"{path}/labels")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls(table=f"{path}/labels")
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage.set(stage.table, f"{path}/labels")
        return stage


class _HasTable(Params, MLReadable, MLWritable):
    """A stage whose state is the table (label, index) at the path ``table``."""

    table = Param(Params._dummy(), "table", "path of the (label, index) table", typeConverter=TypeConverters.toString)

    @property
    def labels(self) -> DataFrame:
        """The (label, index) table."""
        return SparkSession.builder.getOrCreate().read.schema(_SCHEMA).parquet(self.getOrDefault(self.table))

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class TableIndexer(Estimator, HasInputCol, HasOutputCol, HasHandleInvalid, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the index of ``inputCol``'s values.  ``handleInvalid`` is
    'error', 'skip' or 'keep'."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, handleInvalid: str = "error"):
        super().__init__()
        self._setDefault(handleInvalid="error")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TableIndexerModel:
        path = scratch_path(dataset.sparkSession, "labels")
        label_index(dataset, self.getInputCol()).write.parquet(path)
        return self._copyValues(TableIndexerModel(table=path))


class TableIndexerModel(Model, HasInputCol, HasOutputCol, HasHandleInvalid, _HasTable):
    """Attaches the index of ``inputCol`` as a double."""

    def __init__(self, table: str | None = None):
        super().__init__()
        self._setDefault(handleInvalid="error")
        if table is not None:
            self.set(self.table, table)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return string_index(dataset, self.getInputCol(), self.getOutputCol(), self.labels, self.getHandleInvalid())

    def back(self, input_col: str, output_col: str) -> LabelsBack:
        """The stage that maps ``input_col``'s indices to this model's labels."""
        stage = LabelsBack(table=self.getOrDefault(self.table))
        stage._set(inputCol=input_col, outputCol=output_col)
        return stage


class LabelsBack(Transformer, HasInputCol, HasOutputCol, _HasTable):
    """The label of ``inputCol``'s index; null for an index that has none."""

    def __init__(self, table: str | None = None):
        super().__init__()
        if table is not None:
            self.set(self.table, table)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        at = self.labels.select(F.col("index").cast("double").alias("_index"), F.col("label").alias(self.getOutputCol()))
        return dataset.join(at, F.col(q(self.getInputCol())).cast("double") == F.col("_index"), "left").drop("_index")
