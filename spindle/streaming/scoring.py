"""Apply fitted pipelines to streams.

A fitted ``PipelineModel`` whose stages are row-wise transformers works on
a streaming DataFrame as it is.  These helpers add what a long-running
scorer needs: a file sink with a checkpoint of the caller's, and an event-time
windowed accuracy with a watermark so late rows are bounded.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def score_stream(model: PipelineModel, stream: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``model.transform`` on a streaming DataFrame (no state, no shuffle)."""
    out = model.transform(stream)
    return out.select(*keep) if keep else out


def write_scores(scored: DataFrame, path: str, checkpoint: str,
                 fmt: str = "parquet", trigger_once: bool = True) -> StreamingQuery:
    """Start a file sink.  ``checkpoint`` is a shared folder that the caller
    keeps for this query: a restart with the same one goes on where the
    last run ended, so each input row is scored once."""
    w = (scored.writeStream.format(fmt).outputMode("append")
         .option("path", path)
         .option("checkpointLocation", checkpoint))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()


def windowed_accuracy(scored: DataFrame, ts: str, label: str, prediction: str = "prediction",
                      window: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """Accuracy per event-time window; the watermark bounds the state kept
    for late rows."""
    hit = (F.col(prediction).cast("double") == F.col(label).cast("double")).cast("double")
    if scored.schema[ts].dataType.typeName() != "timestamp":   # watermarks need TIMESTAMP
        scored = scored.withColumn(ts, F.col(ts).cast("timestamp"))
    return (scored.withWatermark(ts, watermark)
                  .groupBy(F.window(ts, window).alias("w"))
                  .agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))
                  .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          "n", "accuracy"))
