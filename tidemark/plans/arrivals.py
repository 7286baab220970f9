"""The arrival stream over the ``events`` table.

``events`` is in time order with unique ids, so delay and re-delivery are derived
from the id: most records come up to half an hour late, some hours late, and one
in twenty comes twice, half of the copies inside the 10-minute dedup time limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import epoch_ms
from tidemark.sources.readers import table

MINUTE = 60_000
HOUR = 60 * MINUTE


def with_times(events: DataFrame) -> DataFrame:
    """Event time, first arrival and the fields of a market record."""
    spread = (F.col("event_id") * 7919) % 1000
    minutes = (
        F.when(spread < 700, spread % 30)
        .when(spread < 900, 90 + spread % 150)
        .otherwise(360 + spread % 180)
    )
    ms = epoch_ms(F.col("ts"))
    return events.select(
        "event_id",
        "user_id",
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("long").alias("qty"),
        ms.alias("ms"),
        (ms + minutes * MINUTE).alias("arr"),
    )


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    return arrivals_of(table(spark, folder, "events"))


def arrivals_of(events: DataFrame) -> DataFrame:
    """Every arrival, copies included, from one scan. The order is (arr, event_id)."""
    once = with_times(events)
    copy = F.when(F.col("event_id") % 40 == 0, F.lit(1_000)).otherwise(F.lit(20 * MINUTE))
    times = F.when(
        F.col("event_id") % 20 == 0, F.array(F.col("arr"), F.col("arr") + copy)
    ).otherwise(F.array("arr"))
    return once.withColumn("arr", F.explode(times))
