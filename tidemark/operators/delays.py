"""Delay figures: nearest-rank percentiles, histograms, duplicates, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import DELAY_EDGES_MS, bucket_index, delay_ms, window_start_ms

# Bands of the percentile search: values per band, and bands per band of the level above.
BAND = 1 << 20


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per group and value ``v``, combined before the shuffle; missing values are left out."""
    rows = df.filter(F.col(value).isNotNull())
    return rows.groupBy(*keys, F.col(value).cast("long").alias("v")).agg(F.count("*").alias("cnt"))


def percentile_low(
    df: DataFrame, keys: Sequence[str], value: str, percents: Sequence[int], width: int = BAND
) -> DataFrame:
    """Exact ``sorted[int(p/100*(n-1))]`` per group, as columns ``p<percent>``; a null group is a group.

    ``value`` is integral. The rank is located level by level: the band of
    ``width**2`` values that holds it, the band of ``width`` values inside that one,
    then the value. A window task sees the bands of one band of the level above,
    however many rows the group has and however far apart its values are.
    """
    return percentile_of_counts(value_counts(df, keys, value), keys, percents, width)


def percentile_of_counts(
    counts: DataFrame, keys: Sequence[str], percents: Sequence[int], width: int = BAND
) -> DataFrame:
    rank = F.array(*[
        F.struct(F.lit(p).alias("p"), F.floor(F.lit(p / 100) * (F.col("n") - 1)).cast("long").alias("rank"))
        for p in percents
    ])
    wanted = counts.groupBy(*keys).agg(F.sum("cnt").alias("n")).select(*keys, F.inline(rank))
    above: list[str] = []
    for level, size in enumerate((width * width, width, 1)):
        band = f"band{level}"
        bands = counts.groupBy(
            *keys, *[window_start_ms(F.col("v"), width ** (2 - k)).alias(f"band{k}") for k in range(level + 1)]
        ).agg(F.sum("cnt").alias("cnt")) if size > 1 else counts.select(
            *keys, *[window_start_ms(F.col("v"), width ** (2 - k)).alias(f"band{k}") for k in range(level)],
            F.col("v").alias(band), "cnt",
        )
        open_bands = _join_null_safe(bands, wanted, [*keys, *above])
        inside = Window.partitionBy(*keys, *above, "p").orderBy(band).rowsBetween(Window.unboundedPreceding, -1)
        wanted = (
            open_bands.withColumn("below", F.coalesce(F.sum("cnt").over(inside), F.lit(0)))
            .filter((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("cnt")))
            .select(*keys, *above, band, "p", (F.col("rank") - F.col("below")).alias("rank"))
        )
        above.append(band)
    return wanted.groupBy(*keys).agg(
        *[F.max(F.when(F.col("p") == p, F.col(above[-1]))).alias(f"p{p}") for p in percents]
    )


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys, null equal to null; the keys come from the left."""
    same = F.lit(True)
    for k in keys:
        right = right.withColumnRenamed(k, f"__r_{k}")
        same = same & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(right, same).drop(*[f"__r_{k}" for k in keys])


def histogram_columns(
    value: str, edges: Sequence[int] = DELAY_EDGES_MS, weight: str | None = None
) -> list[Column]:
    """One count per delay bucket, ``b0`` to ``b<len(edges)>``, zeros kept."""
    index = bucket_index(F.col(value), edges)
    each = F.lit(1) if weight is None else F.col(weight)
    return [
        F.sum(F.when(index == i, each).otherwise(F.lit(0))).alias(f"b{i}")
        for i in range(len(edges) + 1)
    ]


def duplicate_counts(df: DataFrame, interval_ms: int) -> DataFrame:
    """Second and later arrivals of an id, counted in the interval they arrive in; rows without id are no copies."""
    rows = df.groupBy(_interval(interval_ms)).agg(F.count("*").alias("messages"))
    return _with_duplicates(rows, df, interval_ms)


def delay_stats(df: DataFrame, interval_ms: int) -> DataFrame:
    """Least, mean and p95 delay per interval of arrival."""
    counts = _delay_counts(df, interval_ms)
    basic = counts.groupBy("interval_ms").agg(
        F.min("v").alias("min_delay"),
        (F.sum(F.col("v") * F.col("cnt")) / F.sum("cnt")).alias("avg_delay"),
    )
    return basic.join(percentile_of_counts(counts, ["interval_ms"], [95]), "interval_ms")


def delay_report(
    df: DataFrame, interval_ms: int = 2_000, edges: Sequence[int] = DELAY_EDGES_MS
) -> DataFrame:
    """Rate, p50, p95, duplicates and histogram per report interval.

    Counters restart with each interval; which ids were seen does not. Rate,
    histogram and percentiles come from one count per interval and delay.
    """
    counts = _delay_counts(df, interval_ms)
    basic = counts.groupBy("interval_ms").agg(
        F.sum("cnt").alias("messages"), *histogram_columns("v", edges, "cnt")
    )
    return (
        _with_duplicates(basic, df, interval_ms)
        .withColumn("rate", F.col("messages") / F.lit(interval_ms / 1000))
        .join(percentile_of_counts(counts, ["interval_ms"], [50, 95]), "interval_ms")
    )


def report_of_counts(counts: DataFrame, interval_ms: int, edges: Sequence[int] = DELAY_EDGES_MS) -> DataFrame:
    """The report from its counters: ``cnt`` records per ``interval_ms`` and delay ``v``, and ``firsts``, the first arrivals."""
    basic = counts.groupBy("interval_ms").agg(
        F.sum("cnt").alias("messages"), (F.sum("cnt") - F.sum("firsts")).alias("dups"), *histogram_columns("v", edges, "cnt"))
    some = counts.filter(F.col("v").isNotNull())
    return basic.withColumn("rate", F.col("messages") / F.lit(interval_ms / 1000)).join(
        percentile_of_counts(some.select("interval_ms", "v", "cnt"), ["interval_ms"], [50, 95]), "interval_ms", "left")


def _interval(interval_ms: int) -> Column:
    return window_start_ms(F.col("arr"), interval_ms).alias("interval_ms")


def _delay_counts(df: DataFrame, interval_ms: int) -> DataFrame:
    timed = df.select(_interval(interval_ms), delay_ms(F.col("arr"), F.col("ms")).alias("delay"))
    return value_counts(timed, ["interval_ms"], "delay")


def _with_duplicates(basic: DataFrame, df: DataFrame, interval_ms: int) -> DataFrame:
    """Add ``dups``. The first arrival of an id is a minimum, so a hot id is combined
    before the shuffle; everything that is not a first arrival is a duplicate."""
    named = df.filter(F.col("event_id").isNotNull())
    nameless = df.filter(F.col("event_id").isNull()).select("arr")
    firsts = (
        named.groupBy("event_id").agg(F.min("arr").alias("arr")).select("arr").unionByName(nameless)
        .groupBy(_interval(interval_ms)).agg(F.count("*").alias("firsts"))
    )
    return (
        basic.join(firsts, "interval_ms", "left")
        .withColumn("dups", F.col("messages") - F.coalesce(F.col("firsts"), F.lit(0)))
        .drop("firsts")
    )
