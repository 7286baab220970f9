"""Windowed aggregates, delivery guarantees and the strict late rule on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tidemark.operators.arrival import is_late, running_watermark
from tidemark.streaming.runs import (
    BatchWriter, batch_path, is_complete, write_batch,
)


def watermarked_windows(
    stream: DataFrame, wait: str, size: str, keys: Sequence[str], amount: str
) -> DataFrame:
    """Count and sum per key and window, emitted once the watermark passes its end.

    This is Spark's own watermark: it drops by window and moves per micro-batch.
    """
    return (
        stream.withWatermark("event_time", wait)
        .groupBy(F.window("event_time", size).alias("w"), *keys)
        .agg(F.count("*").alias("count"), F.sum(amount).alias("sum"))
        .select(
            *keys,
            F.unix_millis("w.start").alias("window_start_ms"),
            F.unix_millis("w.end").alias("window_end_ms"),
            "count", "sum",
        )
    )


def changelog_writer(aggregate: DataFrame, path: str) -> DataStreamWriter:
    """Changed aggregates per micro-batch (update mode), replayable by batch id."""
    return aggregate.writeStream.outputMode("update").foreachBatch(
        lambda df, batch_id: write_batch(df, path, batch_id)
    )


def dedup_within(stream: DataFrame, key: str, horizon: str) -> DataFrame:
    """First arrival per id; ids are forgotten once the watermark is past the horizon."""
    return stream.withWatermark("event_time", horizon).dropDuplicatesWithinWatermark([key])


def append_writer(stream: DataFrame, path: str) -> DataStreamWriter:
    """At-least-once: a batch repeated after a crash is appended again."""
    return stream.writeStream.foreachBatch(
        lambda df, _: df.write.mode("append").parquet(path)
    )


def idempotent_writer(stream: DataFrame, path: str) -> DataStreamWriter:
    """Effectively-once: a batch repeated after a crash replaces its own output."""
    return stream.writeStream.foreachBatch(lambda df, batch_id: write_batch(df, path, batch_id))


def strict_late_batches(path: str, wait_ms: int) -> BatchWriter:
    """Batch writer for the record-level late rule.

    Inside a micro-batch the watermark is a prefix scan; from batch to batch only
    one number, the largest event time so far, is carried. It is stored under the
    batch id, and a batch looks up its predecessor's alone, so a repeated batch starts from
    the same number. Writes ``on_time``, ``late`` and ``carry`` below ``path``.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        rows = df.persist()
        try:
            carry = None
            if batch_id and is_complete(spark, f"{path}/carry", batch_id - 1):
                carry = spark.read.parquet(batch_path(f"{path}/carry", batch_id - 1)).first()["max_ms"]
            top = F.greatest(F.col("max_ms"), F.lit(carry).cast("long"))
            marked = running_watermark(rows, wait_ms).withColumns(
                {"max_ms": top, "watermark_ms": top - wait_ms}
            )
            write_batch(marked.filter(~is_late()), f"{path}/on_time", batch_id)
            write_batch(marked.filter(is_late()), f"{path}/late", batch_id)
            write_batch(
                rows.agg(F.greatest(F.max("ms"), F.lit(carry).cast("long")).alias("max_ms")),
                f"{path}/carry", batch_id,
            )
        finally:
            rows.unpersist()

    return write


def with_event_time(df: DataFrame, ms: str | None = None) -> DataFrame:
    """``event_time`` as the zoned timestamp that watermarks need, from ms or ``ts``."""
    if ms is None:
        return df.withColumn("event_time", F.col("ts").cast("timestamp"))
    return df.withColumn("event_time", F.timestamp_millis(F.col(ms)))


def late_schema(rows: StructType) -> StructType:
    """Schema of ``on_time`` and ``late``."""
    return StructType([*rows.fields]).add("max_ms", "long").add("watermark_ms", "long")
