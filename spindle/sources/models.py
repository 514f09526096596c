"""Persistence of fitted and unfitted pipelines.

Models are written below the shared checkpoint folder (or any shared path
the caller gives), never to a machine-local folder.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.util import MLWritable


def save_stage(stage: MLWritable, path: str) -> str:
    """``stage.write().overwrite().save(path)`` for a model or a pipeline."""
    stage.write().overwrite().save(path)
    return path


def load_pipeline_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_pipeline(path: str) -> Pipeline:
    return Pipeline.load(path)
