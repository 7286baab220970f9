"""Latest row per key: compacted logs and upsert tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row with the greatest version per key; later tie-breaks go last in ``version``.

    An aggregate, not a ranking window: rows of a hot key are combined on the map
    side, and a filter on the key reaches the scan.
    """
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("row"))
        .select(*keys, "row.*")
        .select(*df.columns)
    )


def compacted(log: DataFrame, position: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """Last value per key. Null keys are skipped; a null value stays as the key's value."""
    return latest_per_key(
        log.filter(F.col("key").isNotNull()).select("key", "value", *position), ["key"], position
    ).select("key", "value")


def append_loads(*loads: DataFrame) -> DataFrame:
    """One log of several loads in order; ``load_no`` breaks ties between them."""
    numbered = [df.withColumn("load_no", F.lit(i)) for i, df in enumerate(loads)]
    return reduce(DataFrame.unionByName, numbered)
