"""The incremental behaviours as Structured Streaming entry points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.derive import resampled
from ..registry import Dataset
from ..sources import versions


def merge_stream(spark: SparkSession, batches: DataFrame, dataset: Dataset, root: str, checkpoint: str) -> StreamingQuery:
    """Merge each micro-batch into a versioned dataset; only the periods that it touches are read and written.

    A commit carries its batch's number as a tag, the first one's too: a batch that is replayed after its version was
    published is left out, so a restart repeats nothing. Late rows are settled by the canonical order.
    """

    def publish(batch: DataFrame, number: int) -> None:
        tag = f"{checkpoint}#{number}"
        if not versions.committed(spark, root, dataset, tag):
            versions.commit_merge(root, dataset, batch, tag)

    return batches.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def resample_stream(bars: DataFrame, minutes: int, late: str = "10 minutes") -> DataFrame:
    """Streaming bars of more minutes. A bar is named by its closing minute and lies in the window of the minute before."""
    at = F.col("bar_time") - F.expr("INTERVAL 1 MINUTE")
    rows = bars.withColumn("at", at.cast("timestamp")).withWatermark("at", late)
    agg = rows.groupBy("symbol", F.window("at", f"{minutes} minutes").alias("w")).agg(*resampled())
    return agg.select("symbol", F.col("w.end").alias("bar_time"), "open", "high", "low", "close", "volume", "amount", "n")
