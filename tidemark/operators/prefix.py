"""Running aggregates over a total order, without one task that holds all rows.

A window over the whole stream, or over one hot key, would put every row of it
into one task. Here the rows are range-partitioned by the whole order, tie-break
included, so a millisecond that holds a third of all rows is cut like any other
stretch and the tie may be of any type. Each bucket is scanned on its own, and
only one row per bucket (and key) is carried from bucket to bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

BUCKET = "__bucket"
# Bytes of input, by Spark's own estimate, that make one bucket.
BUCKET_BYTES = 64 << 20
# Rows that fill one bucket, where rows are counted.
BUCKET_ROWS = 250_000


def bucket_count(df: DataFrame) -> int:
    """Buckets follow the size of the input; small inputs use the session's parallelism.

    Spark's estimate is a bound that a join multiplies and that rows from Python do not have, so an estimate that asks
    for more than the parallelism is checked by a count of the rows.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) // BUCKET_BYTES)
    return max(least, min(wanted, -(-df.count() // BUCKET_ROWS))) if wanted > least else least


def with_order_buckets(
    df: DataFrame, order: str, tie: str | None = None, buckets: int | None = None
) -> DataFrame:
    """Add ``__bucket``: an int that never falls along the order ``(order, tie)``.

    The bucket is the range partition of the row. The placed rows are written to the
    shared folder, so every reader sees the same cuts, also after a lost executor.
    Cuts bear on speed alone; every result built on them is exact.
    """
    columns = [order] if tie is None else [order, tie]
    placed = df.repartitionByRange(buckets or bucket_count(df), *columns).withColumn(BUCKET, F.spark_partition_id())
    path = scratch_path(df.sparkSession, "ordered")
    placed.write.parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def running(
    df: DataFrame,
    order: Sequence[str],
    aggs: dict[str, tuple[str, Column]],
    by: Sequence[str] = (),
) -> DataFrame:
    """Running ``max`` / ``min`` / ``sum`` up to and including each row.

    ``df`` comes from :func:`with_order_buckets`. ``aggs`` maps a new column to
    (function name, input). ``by`` restarts the scan per key; a hot key is still
    spread over the buckets, and a null key is a key. The rows are shuffled once, on (by, bucket), which
    serves both the in-bucket window and the join with the carried values.
    """
    keys = [*by, BUCKET]
    fold = {"max": F.max, "min": F.min, "sum": F.sum}
    totals = df.groupBy(*keys).agg(*[fold[f](c).alias(f"__c_{n}") for n, (f, c) in aggs.items()])
    before = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, *[fold[f](f"__c_{n}").over(before).alias(f"__p_{n}") for n, (f, _) in aggs.items()]
    )
    inside = (
        Window.partitionBy(*keys).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = df.withColumns({n: fold[f](c).over(inside) for n, (f, c) in aggs.items()})
    join = {"max": F.greatest, "min": F.least}
    merged = {
        n: join[f](F.col(n), F.col(f"__p_{n}")) if f in join
        else F.col(n) + F.coalesce(F.col(f"__p_{n}"), F.lit(0))
        for n, (f, _) in aggs.items()
    }
    same = F.lit(True)
    for k in keys:
        carried = carried.withColumnRenamed(k, f"__k_{k}")
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return (
        local.join(carried, same, "left").withColumns(merged)
        .drop(*[f"__p_{n}" for n in aggs], *[f"__k_{k}" for k in keys])
    )
