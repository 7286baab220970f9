"""Delay reports from a stream: counters live for one report interval, the ids that were seen for ever."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.scalars import DELAY_EDGES_MS, delay_ms, window_start_ms
from tidemark.operators.delays import report_of_counts
from tidemark.streaming.runs import batch_path, complete_batches, forget_batches, is_complete, read_batches, write_batch

COUNTS = "interval_ms long, v long, cnt long, firsts long"


def delay_report_writer(
    stream: DataFrame, path: str, interval_ms: int = 2_000, edges: Sequence[int] = DELAY_EDGES_MS
) -> DataStreamWriter:
    """Write the report of every interval that is over below ``path/reports``.

    Two states of different life: which ids were seen is Spark's keyed state and stays; the counts of the interval that
    is still open (records per delay, first arrivals) are written with the batch and end with the report. Arrival is the
    clock: a batch holds later arrivals than the one before. ``last_report`` closes the interval that the end leaves open.
    """
    records = stream.select("event_id", "arr", "ms", F.lit(False).alias("fresh"))
    fresh = stream.select("event_id").filter(F.col("event_id").isNotNull()).dropDuplicates(["event_id"]).withColumn("fresh", F.lit(True))

    def write(df: DataFrame, batch_id: int) -> None:
        rows = df.persist()
        try:
            _write(rows, path, batch_id, interval_ms, edges)
        finally:
            rows.unpersist()

    return records.unionByName(fresh, allowMissingColumns=True).writeStream.foreachBatch(write)


def _write(rows: DataFrame, path: str, batch_id: int, interval_ms: int, edges: Sequence[int]) -> None:
    spark = rows.sparkSession
    counts = _counts(rows, interval_ms)
    if batch_id and is_complete(spark, f"{path}/open", batch_id - 1):
        counts = counts.unionByName(spark.read.schema(COUNTS).parquet(batch_path(f"{path}/open", batch_id - 1)))
    counts = counts.groupBy("interval_ms", "v").agg(F.sum("cnt").alias("cnt"), F.sum("firsts").alias("firsts"))
    write_batch(counts, f"{path}/counts", batch_id)
    counts = spark.read.schema(COUNTS).parquet(batch_path(f"{path}/counts", batch_id))
    still_open = counts.agg(F.max("interval_ms")).first()[0]
    write_batch(report_of_counts(counts.filter(F.col("interval_ms") < F.lit(still_open)), interval_ms, edges), f"{path}/reports", batch_id)
    write_batch(counts.filter(F.col("interval_ms") == F.lit(still_open)), f"{path}/open", batch_id)
    for part in ("counts", "open"):
        forget_batches(spark, f"{path}/{part}", before=batch_id - 1)


def _counts(rows: DataFrame, interval_ms: int) -> DataFrame:
    """Records per interval and delay, and first arrivals per interval (as a row without delay)."""
    records = rows.filter(~F.col("fresh"))
    interval = window_start_ms(F.col("arr"), interval_ms).alias("interval_ms")
    delays = records.select(interval, delay_ms(F.col("arr"), F.col("ms")).alias("v")).groupBy("interval_ms", "v").agg(
        F.count("*").alias("cnt"), F.lit(0).cast("long").alias("firsts"))
    first = records.join(rows.filter("fresh").select("event_id"), "event_id", "left_semi").groupBy("event_id").agg(F.min("arr").alias("arr"))
    nameless = records.filter(F.col("event_id").isNull()).select("arr")
    firsts = first.select("arr").unionByName(nameless).groupBy(interval).agg(F.count("*").alias("firsts"))
    return delays.unionByName(firsts.select("interval_ms", F.lit(None).cast("long").alias("v"), F.lit(0).cast("long").alias("cnt"), "firsts"))


def last_report(spark: SparkSession, path: str, interval_ms: int = 2_000, edges: Sequence[int] = DELAY_EDGES_MS) -> DataFrame:
    """The report of the interval that was open when the stream ended."""
    done = complete_batches(spark, f"{path}/open")
    return report_of_counts(read_batches(spark, f"{path}/open", COUNTS, after=done[-1] - 1 if done else -1).drop("batch_id"), interval_ms, edges)


def read_reports(spark: SparkSession, path: str, interval_ms: int = 2_000, edges: Sequence[int] = DELAY_EDGES_MS) -> DataFrame:
    """All reports of a stream that has ended."""
    last = last_report(spark, path, interval_ms, edges)
    return read_batches(spark, f"{path}/reports", last.schema).drop("batch_id").unionByName(last)
