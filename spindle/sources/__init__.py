"""Sources and sinks: CSV, JSON, LIBSVM, parquet, literals, saved models."""

from spindle.sources.files import (  # noqa: F401
    literal_table, read_csv, read_json, read_libsvm, read_parquet,
    write_csv, write_json, write_libsvm, write_parquet,
)
from spindle.sources.models import load_pipeline, load_pipeline_model, save_stage  # noqa: F401
