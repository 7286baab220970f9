"""Tumbling aggregates and their changelog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import composite_key, window_start_ms
from tidemark.operators.prefix import BUCKET, running, with_order_buckets


def tumbling_agg(df: DataFrame, size_ms: int = 60_000) -> DataFrame:
    """Count, quantity and value per symbol and event-time window; windows never close."""
    return (
        df.groupBy("symbol", window_start_ms(F.col("ms"), size_ms).alias("window_start_ms"))
        .agg(
            F.count("*").alias("count"),
            F.sum("qty").alias("sum_qty"),
            F.sum(F.col("price") * F.col("qty")).alias("gmv"),
        )
        .withColumn("window_end_ms", F.col("window_start_ms") + size_ms)
    )


def agg_changelog(
    df: DataFrame,
    size_ms: int = 60_000,
    order: Sequence[str] = ("arr", "event_id"),
    buckets: int | None = None,
) -> DataFrame:
    """One row per record: the aggregate of its window and symbol after that record."""
    placed = with_order_buckets(
        df.withColumn("window_start_ms", window_start_ms(F.col("ms"), size_ms)), *order,
        buckets=buckets,
    )
    out = running(
        placed, order,
        {
            "count": ("sum", F.lit(1)),
            "sum_qty": ("sum", F.col("qty")),
            "gmv": ("sum", F.col("price") * F.col("qty")),
        },
        by=("window_start_ms", "symbol"),
    )
    return (
        out.drop(BUCKET)
        .withColumn("window_end_ms", F.col("window_start_ms") + size_ms)
        .withColumn("key", composite_key(F.col("window_start_ms"), F.col("symbol")))
    )

