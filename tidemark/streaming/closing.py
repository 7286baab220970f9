"""Windows of a stream that ends: a closing marker for Spark's watermark, and strict windows with figures per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.scalars import window_start_ms
from tidemark.operators.arrival import is_late, running_watermark
from tidemark.streaming.runs import (
    BatchWriter, batch_path, complete_batches, forget_batches, is_complete, read_batches, write_batch,
)

#: Event time of the marker, about the year 9000: behind no record.
CLOSING_MS = 221_845_392_000_000
FIGURES = "input_rows long, late_rows long, closed_windows long, open_windows long, watermark_ms long"


def prepare_closing(spark: SparkSession, path: str) -> None:
    """An empty log of markers at ``path``."""
    spark.createDataFrame([], "ms long").write.mode("ignore").parquet(path)


def close_stream(spark: SparkSession, path: str) -> None:
    """Put the marker into the log: the next run closes every window. Records that come later still are late."""
    spark.createDataFrame([(CLOSING_MS,)], "ms long").coalesce(1).write.mode("append").parquet(path)


def with_closing(stream: DataFrame, path: str, time: str = "event_time") -> DataFrame:
    """The stream and its log of markers as one; set the watermark on the result.

    A marker is a row of nulls but for its time. It moves the watermark past all windows and its own window is never
    emitted, as no watermark reaches its end.
    """
    markers = stream.sparkSession.readStream.schema("ms long").parquet(path)
    return stream.unionByName(markers.select(F.timestamp_millis("ms").alias(time)), allowMissingColumns=True)


# ---- strict rule -------------------------------------------------------------------------

def strict_window_batches(
    path: str, wait_ms: int, size_ms: int, keys: Sequence[str], amount: str = "amount"
) -> BatchWriter:
    """Batch writer of tumbling windows under the record-level late rule, with the figures of the run.

    A batch carries the largest event time so far and the windows that are still open (one row each), both under its
    own id, so a repeated batch starts from the same state. It writes below ``path``: ``closed`` (windows whose end the
    watermark has reached), ``late`` (records), ``open``, ``carry`` and ``figures`` (one row: records, late records,
    windows closed by this batch, windows left open, watermark). Older states are removed; the cost of a batch follows
    its records and the open windows.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        rows = df.persist()
        try:
            carry = None
            if batch_id and is_complete(spark, f"{path}/carry", batch_id - 1):
                carry = spark.read.parquet(batch_path(f"{path}/carry", batch_id - 1)).first()["max_ms"]
            top = F.greatest(F.col("max_ms"), F.lit(carry).cast("long"))
            marked = running_watermark(rows, wait_ms).withColumns({"max_ms": top, "watermark_ms": top - wait_ms})
            count, latest = rows.agg(F.count("*"), F.greatest(F.max("ms"), F.lit(carry).cast("long"))).first()
            windows = marked.filter(~is_late()).groupBy(*keys, window_start_ms(F.col("ms"), size_ms).alias("window_start_ms")).agg(
                F.count("*").alias("count"), F.sum(amount).alias("sum"))
            if batch_id and is_complete(spark, f"{path}/open", batch_id - 1):
                before = spark.read.schema(windows.schema).parquet(batch_path(f"{path}/open", batch_id - 1))
                windows = windows.unionByName(before).groupBy(*keys, "window_start_ms").agg(
                    F.sum("count").alias("count"), F.sum("sum").alias("sum"))
            reached = F.coalesce(F.col("window_start_ms") + size_ms <= F.lit(latest).cast("long") - wait_ms, F.lit(False))
            write_batch(marked.filter(is_late()), f"{path}/late", batch_id)
            write_batch(windows.filter(reached), f"{path}/closed", batch_id)
            write_batch(windows.filter(~reached), f"{path}/open", batch_id)
            write_batch(spark.createDataFrame([(latest,)], "max_ms long").coalesce(1), f"{path}/carry", batch_id)
            late, closed, still = (spark.read.schema(marked.schema if part == "late" else windows.schema).parquet(
                batch_path(f"{path}/{part}", batch_id)).count() for part in ("late", "closed", "open"))
            mark = None if latest is None else latest - wait_ms
            write_batch(spark.createDataFrame([(count, late, closed, still, mark)], FIGURES).coalesce(1), f"{path}/figures", batch_id)
            for part in ("open", "carry"):
                forget_batches(spark, f"{path}/{part}", before=batch_id - 1)
        finally:
            rows.unpersist()

    return write


def read_strict_windows(spark: SparkSession, path: str, keys: StructType, amount_type: str = "double") -> DataFrame:
    """All windows of a stream that has ended: the closed ones and, as the end closes every window, those left open."""
    schema = StructType([*keys.fields]).add("window_start_ms", "long").add("count", "long").add("sum", amount_type)
    done = complete_batches(spark, f"{path}/open")
    left = read_batches(spark, f"{path}/open", schema, after=done[-1] - 1 if done else -1)
    return read_batches(spark, f"{path}/closed", schema).unionByName(left).drop("batch_id")


def run_figures(spark: SparkSession, path: str) -> DataFrame:
    """The figures of every batch, with ``batch_id``."""
    return read_batches(spark, f"{path}/figures", FIGURES)
