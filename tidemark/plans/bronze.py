"""Bronze rows and the gold table of the batch flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import cyclic, padded_id

# Fixed values of the two bronze tables: names, first minute, number of articles, and
# price = BASE + STEP * (i % CYCLE), quantity = 1 + i % QUANTITIES.
SELLERS = ("seller_a", "seller_b", "seller_c")
CHANNELS = ("web", "mobile", "marketplace")
SQL_START, SQL_SKUS, SQL_BASE, SQL_STEP, SQL_CYCLE, SQL_QUANTITIES = "2026-02-20 15:00:00", 6, 30, 12, 9, 5
FRAME_START, FRAME_SKUS, FRAME_BASE, FRAME_STEP, FRAME_CYCLE, FRAME_QUANTITIES = "2026-02-20 14:00:00", 5, 40, 10, 7, 4


def _by_thirds(i: Column, names: tuple[str, str, str]) -> Column:
    return F.when(i % 3 == 0, names[0]).when(i % 3 == 1, names[1]).otherwise(names[2])


def bronze_sql_style(numbers: DataFrame) -> DataFrame:
    """Bronze rows from a column ``i``, with 32-bit quantities."""
    i = F.col("i")
    price = SQL_BASE + (i % SQL_CYCLE) * SQL_STEP
    qty = 1 + i % SQL_QUANTITIES
    return numbers.select(
        padded_id("duck_ev_", i, 3).alias("event_id"),
        F.expr(f"TIMESTAMP_NTZ '{SQL_START}' + i * INTERVAL '1' MINUTE").alias("event_time"),
        _by_thirds(i, SELLERS).alias("seller_id"),
        _by_thirds(i, CHANNELS).alias("channel"),
        padded_id("sku_", i % SQL_SKUS + 1, 1).alias("sku"),
        price.cast("double").alias("price"),
        qty.cast("int").alias("qty"),
        (price * qty).cast("double").alias("gmv"),
    )


def bronze_frame_style(numbers: DataFrame) -> DataFrame:
    """Bronze rows from a column ``i``, with list lookups and 64-bit quantities."""
    i = F.col("i")
    rows = numbers.select(
        padded_id("ev_", i, 3).alias("event_id"),
        F.expr(f"TIMESTAMP_NTZ '{FRAME_START}' + i * INTERVAL '1' MINUTE").alias("event_time"),
        cyclic(SELLERS, i).alias("seller_id"),
        cyclic(CHANNELS, i).alias("channel"),
        padded_id("sku_", i % FRAME_SKUS + 1, 1).alias("sku"),
        (FRAME_BASE + (i % FRAME_CYCLE) * FRAME_STEP).cast("double").alias("price"),
        (1 + i % FRAME_QUANTITIES).cast("long").alias("qty"),
    )
    return rows.withColumn("gmv", F.col("price") * F.col("qty"))


def gold_kpis(bronze: DataFrame) -> DataFrame:
    """Value, mean ticket and events by seller and channel; ordered when read, not here."""
    return bronze.groupBy("seller_id", "channel").agg(
        F.sum("gmv").alias("gmv_total"),
        F.avg("gmv").alias("ticket_medio"),
        F.count("*").alias("eventos"),
    )


def gmv_by_channel(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("channel").agg(F.sum("gmv").alias("gmv_total"))
