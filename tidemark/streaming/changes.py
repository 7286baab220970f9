"""A change per record: the running aggregate of its window and key after every single record of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tidemark.functions.scalars import window_start_ms
from tidemark.operators.windows import agg_changelog, tumbling_agg
from tidemark.streaming.runs import write_batch

MEASURES = ("count", "sum_qty", "gmv")


def record_changelog_writer(stream: DataFrame, path: str, size_ms: int = 60_000) -> DataStreamWriter:
    """Write the changelog of each micro-batch below ``path``; a repeated batch replaces itself.

    The stream carries the records and, in update mode, the totals of the keys that they touch, which Spark keeps in its
    state store. In a batch the totals less the batch's own sums are what each key had before it; the prefix scan over
    the batch goes on from there. The cost of a batch follows its records and not the keys seen so far.
    """
    records = stream.select("event_id", "arr", "ms", "symbol", "price", "qty")
    totals = tumbling_agg(records, size_ms).select(
        "symbol", "window_start_ms", *[F.col(m).alias(f"all_{m}") for m in MEASURES], F.lit(True).alias("is_total"))
    both = records.withColumn("is_total", F.lit(False)).unionByName(totals, allowMissingColumns=True)

    def write(df: DataFrame, batch_id: int) -> None:
        rows = df.persist()
        try:
            write_batch(_changes(rows, size_ms), path, batch_id)
        finally:
            rows.unpersist()

    return both.writeStream.outputMode("update").foreachBatch(write)


def _changes(rows: DataFrame, size_ms: int) -> DataFrame:
    records = rows.filter(~F.col("is_total")).select("event_id", "arr", "ms", "symbol", "price", "qty")
    own = records.groupBy(F.col("symbol").alias("s"), window_start_ms(F.col("ms"), size_ms).alias("w")).agg(
        F.count("*").alias("own_count"), F.sum("qty").alias("own_sum_qty"), F.sum(F.col("price") * F.col("qty")).alias("own_gmv"))
    same = F.col("symbol").eqNullSafe(F.col("s")) & F.col("window_start_ms").eqNullSafe(F.col("w"))
    before = rows.filter("is_total").join(own, same).select(
        "s", "w", *[(F.col(f"all_{m}") - F.col(f"own_{m}")).alias(f"before_{m}") for m in MEASURES])
    out = agg_changelog(records, size_ms).join(before, same)
    return out.withColumns({m: F.col(m) + F.col(f"before_{m}") for m in MEASURES}).drop("s", "w", *[f"before_{m}" for m in MEASURES])


def changelog_schema(records: StructType) -> StructType:
    """Schema of the written changelog."""
    fields = [f for f in records.fields if f.name in ("event_id", "arr", "ms", "symbol", "price", "qty")]
    return StructType(fields).add("window_start_ms", "long").add("count", "long").add("sum_qty", "long").add("gmv", "double").add(
        "window_end_ms", "long").add("key", "string")
