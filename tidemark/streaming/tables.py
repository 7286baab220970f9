"""Upsert table and KPI snapshot kept up to date from a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tidemark.functions.scalars import units
from tidemark.operators.latest import latest_per_key
from tidemark.sources.readers import read_snapshot
from tidemark.sources.sinks import write_snapshot
from tidemark.streaming.runs import (
    BatchWriter, batch_path, complete_batches, forget_batches, is_complete, read_batches, write_batch,
)


def upsert_writer(
    stream: DataFrame, path: str, keys: Sequence[str], version: Sequence[str]
) -> DataStreamWriter:
    """Write the newest row per key of each micro-batch below ``path/log``; readers merge.

    The cost of a batch follows the batch, not the table. A ``position`` column
    (``readers.with_position``) decides between equal versions: the later one wins.
    """
    order = [*version, *(["position"] if "position" in stream.columns else [])]
    return stream.writeStream.foreachBatch(
        lambda df, batch_id: write_batch(latest_per_key(df, keys, order).drop("position"), f"{path}/log", batch_id)
    )


def read_upsert(
    spark: SparkSession, path: str, keys: Sequence[str], version: Sequence[str], schema: StructType,
    upto: int | None = None,
) -> DataFrame:
    """Newest row per key; of equal versions the later batch wins.

    Reads the last compacted base and only the complete batches after it, up to ``upto``.
    """
    bases = [b for b in complete_batches(spark, f"{path}/base") if upto is None or b <= upto]
    after = bases[-1] if bases else -1
    rows = read_batches(spark, f"{path}/log", schema, after, upto)
    if bases:
        base = spark.read.schema(schema).parquet(batch_path(f"{path}/base", after))
        rows = rows.unionByName(base.withColumn("batch_id", F.lit(after).cast("long")))
    return latest_per_key(rows, keys, [*version, "batch_id"]).drop("batch_id")


def compact_upsert(
    spark: SparkSession, path: str, keys: Sequence[str], version: Sequence[str], schema: StructType
) -> None:
    """Fold the complete batches into a new base; the old base stays until this one is whole."""
    done = complete_batches(spark, f"{path}/log")
    if done:
        write_batch(read_upsert(spark, path, keys, version, schema, done[-1]), f"{path}/base", done[-1])


KPI_TOTALS = "g long, p long, orders long"


def kpi_writer(stream: DataFrame, path: str) -> DataStreamWriter:
    """Keep the executive KPIs of a stream of order lines current.

    Which orders were seen is Spark's keyed state: it looks up the ids of the batch and nothing else, so the cost of a
    batch follows the batch. Lines and orders seen for the first time reach :func:`kpi_batches` together.
    """
    profit = F.when(F.col("status") == "PAID", F.col("net_revenue") - F.col("cogs"))
    lines = stream.select(F.col("gross").alias("g"), profit.alias("p"), F.lit(0).cast("long").alias("orders"))
    fresh = stream.select("order_id").filter(F.col("order_id").isNotNull()).dropDuplicates(["order_id"])
    return lines.unionByName(fresh.select(F.lit(1).cast("long").alias("orders")), allowMissingColumns=True).writeStream.foreachBatch(kpi_batches(path))


def kpi_batches(path: str) -> BatchWriter:
    """Batch writer that adds a batch's sums to the totals of the batch before it.

    The totals are written under the batch's own id, then the snapshot at ``path/snapshot``, a fixed place. A repeated
    batch replaces its own figures, and a crash between two writes leaves the last whole totals: sums and orders always
    belong to the same rows. Only the totals of the last two batches are kept.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        parts = df.select("g", "p", "orders")
        if batch_id and is_complete(spark, f"{path}/totals", batch_id - 1):
            parts = parts.unionByName(spark.read.schema(KPI_TOTALS).parquet(batch_path(f"{path}/totals", batch_id - 1)))
        write_batch(parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("g", "p", "orders")]), f"{path}/totals", batch_id)
        totals = spark.read.schema(KPI_TOTALS).parquet(batch_path(f"{path}/totals", batch_id))
        write_snapshot(kpi_figures(totals), f"{path}/snapshot")
        forget_batches(spark, f"{path}/totals", before=batch_id - 1)

    return write


def kpi_figures(totals: DataFrame) -> DataFrame:
    figures = totals.select(units(F.col("g")).alias("gmv"), units(F.col("p")).alias("net_profit"), "orders")
    return figures.select("gmv", "net_profit", F.try_divide(F.col("gmv"), F.col("orders")).alias("avg_ticket"))


def kpi_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The snapshot at its fixed place; None before the first batch."""
    return read_snapshot(spark, f"{path}/snapshot", StructType().add("gmv", "double").add("net_profit", "double").add("avg_ticket", "double"))


# ---- raw orders --------------------------------------------------------------------------

def orders_writer(stream: DataFrame, path: str, unit: str = "day") -> DataStreamWriter:
    """Append raw order facts; a batch that is delivered again replaces its own rows."""
    return stream.writeStream.foreachBatch(lambda df, batch_id: append_orders(df, path, batch_id, unit))


def append_orders(df: DataFrame, path: str, batch_id: int, unit: str = "day") -> None:
    """One batch of raw order facts in its own folder, split by day (or a longer ``unit``, by its first day).

    Readers prune by ``order_date`` and take complete batches only. Each part is written by one task, large ones by several.
    """
    dated = df.withColumn("order_date", F.to_date(F.date_trunc(unit, "event_time")))
    dated.hint("rebalance", "order_date").write.mode("overwrite").partitionBy("order_date").parquet(batch_path(path, batch_id))


def read_orders(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The order facts of all complete batches, with ``order_date`` and ``batch_id``."""
    return read_batches(spark, path, StructType([*schema.fields]).add("order_date", "date"))


def compact_orders(spark: SparkSession, path: str, into: str, schema: StructType) -> None:
    """Copy the complete batches into one table at ``into``, split by ``order_date`` alone; replaces what was there."""
    read_orders(spark, path, schema).drop("batch_id").hint("rebalance", "order_date").write.mode("overwrite").partitionBy("order_date").parquet(into)
