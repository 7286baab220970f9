"""The strict, record-level reading of a watermark.

A record's watermark is the largest event time seen up to and including that
record, minus the wait. Spark's own watermark moves once per micro-batch and
drops by window, so it cannot give this result; a prefix scan can.

Columns: ``ms`` event time, ``arr`` arrival time (both epoch ms), ``event_id``
breaks ties of the arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import delay_ms, window_start_ms
from tidemark.operators.prefix import BUCKET, running, with_order_buckets

ORDER = ("arr", "event_id")
# The three timeliness classes.
CLASSES = ("green", "orange", "red")
STEPS_PER_BUCKET = 1024


def running_watermark(
    df: DataFrame, wait_ms: int = 0, order: Sequence[str] = ORDER, buckets: int | None = None
) -> DataFrame:
    """Add ``max_ms`` (running maximum of event time) and ``watermark_ms``.

    The rows are ordered and written once, ahead of the plan. A record without event time moves nothing.
    """
    placed = with_order_buckets(df, *order, buckets=buckets)
    return (
        running(placed, order, {"max_ms": ("max", F.col("ms"))})
        .withColumn("watermark_ms", F.col("max_ms") - F.lit(wait_ms))
        .drop(BUCKET)
    )


def is_late() -> Column:
    """Late once its own record has moved the watermark past it."""
    return F.col("ms") < F.col("watermark_ms")


def late_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(is_late())


def on_time_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(~is_late())


def strict_windows(
    marked: DataFrame, size_ms: int = 10_000, keys: Sequence[str] = ("user",), amount: Column | str = "amount"
) -> DataFrame:
    """Tumbling count and sum of the records that were not late.

    The end of the input closes every window, so all of them are returned.
    """
    start = window_start_ms(F.col("ms"), size_ms)
    return (
        on_time_rows(marked)
        .groupBy(*keys, start.alias("window_start_ms"))
        .agg(F.count("*").alias("count"), F.sum(amount).alias("sum"))
        .withColumn("window_end_ms", F.col("window_start_ms") + size_ms)
    )


def timeliness(on_time_ms: int = 60_000) -> Column:
    """red: behind the watermark; else orange: delayed too long; else green."""
    return (
        F.when(is_late(), "red")
        .when(delay_ms(F.col("arr"), F.col("ms")) > on_time_ms, "orange")
        .otherwise("green")
    )


def class_counts(classed: DataFrame, column: str = "color") -> DataFrame:
    """Rows per class with zeros kept, and the dead-letter total (the red ones)."""
    wide = classed.agg(*[F.count_if(F.col(column) == c).alias(c) for c in CLASSES])
    pairs = F.array(*[F.struct(F.lit(c).alias(column), F.col(c).alias("n")) for c in CLASSES])
    return wide.select(F.inline(pairs), F.col("red").alias("dlq_count"))


def close_lags(rows: DataFrame, windows: DataFrame, size_ms: int, wait_ms: int = 0) -> DataFrame:
    """Arrival of the record that closed each window, minus the window end.

    The watermark reaches a window end with the first record whose own event time
    is the wait past it, so the closing arrival is a minimum over those records and
    needs no running watermark. It is taken per step of ``size_ms`` and then over
    all later steps, without a range join. Steps are unique, so spans of equal
    width serve as the buckets of that scan. Windows closed by the end of the
    input have no lag (null).
    """
    reached = F.struct(
        window_start_ms(F.col("ms") - F.lit(wait_ms), size_ms).alias("window_end_ms"),
        F.col("arr").alias("arr"),
    )
    asked = F.struct(
        (window_start_ms(F.col("ms"), size_ms) + size_ms).alias("window_end_ms"),
        F.lit(None).cast("long").alias("arr"),
    )
    frame = (
        rows.select(F.inline(F.array(reached, asked)))
        .groupBy("window_end_ms").agg(F.min("arr").alias("arr"))
        .withColumn("back", -F.col("window_end_ms"))
        .withColumn(BUCKET, window_start_ms(F.col("back"), size_ms * STEPS_PER_BUCKET))
    )
    closes = running(frame, ["back"], {"close_arr": ("min", F.col("arr"))})
    return (
        windows.join(closes.select("window_end_ms", "close_arr"), "window_end_ms", "left")
        .withColumn("close_lag_ms", F.col("close_arr") - F.col("window_end_ms"))
    )
