"""Structured Streaming versions of the batch increments.

Event time must be a timestamp with zone: zone-free columns are cast under the session's zone
before a watermark and cast back on output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.incremental import upsert
from tidemark.sources.versioned import VersionedTable


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                files_per_trigger: int = 1000, name_filter: str | None = None) -> DataFrame:
    """New files of a directory as they arrive."""
    reader = (spark.readStream.schema(schema).format(fmt)
              .option("maxFilesPerTrigger", files_per_trigger))
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    return reader.load(path)


def stream_upsert(source: DataFrame, build, target: str, checkpoint: str, key: str,
                  partition: str, latest: list[str]) -> StreamingQuery:
    """Clean and upsert every micro-batch by key.

    The stream's own checkpoint knows which files were handled, so there is no high-water mark
    and late rows are not lost. A micro-batch that is retried upserts the same keys again.
    """
    def apply(batch: DataFrame, _: int) -> None:
        upsert(batch.sparkSession, target, build(batch), key, partition, latest)

    return (source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_merge(source: DataFrame, build, table: VersionedTable, checkpoint: str) -> StreamingQuery:
    """Merge every micro-batch into a versioned table: readers see whole micro-batches only.

    A micro-batch that is run again, after a crash or with a new checkpoint, brings keys that the table has already
    and changes nothing.
    """
    def apply(batch: DataFrame, _: int) -> None:
        VersionedTable(batch.sparkSession, table.path, table.key, table.ts, table.partition).merge(build(batch))

    return (source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def drop_redelivered(source: DataFrame, key: str, ts: str, within: str) -> DataFrame:
    """First delivery of every key; keys are remembered for ``within`` of event time."""
    timed = source.withColumn("_event_time", F.col(ts).cast("timestamp"))
    once = timed.withWatermark("_event_time", within).dropDuplicatesWithinWatermark([key])
    return once.drop("_event_time")


def stream_dedup(source: DataFrame, key: str, ts: str, within: str, out: str,
                 checkpoint: str) -> StreamingQuery:
    return (drop_redelivered(source, key, ts, within).writeStream.format("parquet")
            .outputMode("append").option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def daily_windows(source: DataFrame, ts: str, kind: str, amount: str, fraud: Column,
                  late: str) -> DataFrame:
    """Volume and frauds per day and type. Rows later than ``late`` behind the newest event are
    dropped by the watermark (``numRowsDroppedByWatermark`` in the query's progress)."""
    timed = source.withColumn("_event_time", F.col(ts).cast("timestamp"))
    return (timed.withWatermark("_event_time", late)
            .groupBy(F.window("_event_time", "1 day").alias("w"), F.col(kind))
            .agg(F.count(F.lit(1)).alias("tx_count"),
                 F.sum(F.col(amount).cast("decimal(18,2)")).alias("total_volume"),
                 F.sum(F.when(fraud, 1).otherwise(0)).alias("fraud_count"))
            .select(F.col("w.start").cast("date").alias("date"), kind, "tx_count",
                    "total_volume", "fraud_count"))


def stream_daily_volume(windows: DataFrame, out: str, checkpoint: str,
                        kind: str) -> StreamingQuery:
    """Keep a table of the windows, including those still open.

    Update mode hands over the windows a micro-batch changed; they replace the stored ones.
    Append mode instead would write a window only once the watermark has passed its end.
    """
    def apply(batch: DataFrame, _: int) -> None:
        keyed = batch.withColumn("window_key", F.concat_ws("|", F.col("date").cast("string"), kind))
        upsert(batch.sparkSession, out, keyed, "window_key", "date", ["tx_count"],
               partition_fixed=True)

    return (windows.writeStream.foreachBatch(apply).outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stream_closed_windows(windows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append mode: closed windows only, each written once."""
    return (windows.writeStream.format("parquet").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
