"""Lookups against dimensions and known ids.

No join carries a broadcast hint: Spark broadcasts a side only when its own size
check (``spark.sql.autoBroadcastJoinThreshold``, re-checked by AQE on real sizes)
allows it, and sort-merges with skew splitting otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Target of a seller that has none.
DEFAULT_TARGET_GMV = 320_000.0
DEFAULT_TARGET_ORDERS = 450


def with_targets(df: DataFrame, targets: DataFrame) -> DataFrame:
    """Target columns by ``seller_id``; a seller without one gets the defaults."""
    found = targets.select("seller_id", "target_gmv", "target_orders")
    return df.join(found, "seller_id", "left").withColumns({
        "target_gmv": F.coalesce("target_gmv", F.lit(DEFAULT_TARGET_GMV)),
        "target_orders": F.coalesce("target_orders", F.lit(DEFAULT_TARGET_ORDERS)),
    })


def unseen(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose id is not among the known ones."""
    return df.join(known.select(key).distinct(), key, "left_anti")


def already_seen(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose id is among the known ones."""
    return df.join(known.select(key).distinct(), key, "left_semi")


def target_vs_actual(targets: DataFrame, actuals: DataFrame) -> DataFrame:
    """Targets beside actual ``gmv`` and ``orders``; sellers without orders are kept."""
    return (
        targets.join(actuals, "seller_id", "left")
        .withColumns({
            "gmv": F.coalesce("gmv", F.lit(0.0)),
            "orders": F.coalesce("orders", F.lit(0)),
        })
        .withColumn("gmv_ratio", F.try_divide("gmv", "target_gmv"))
        .withColumn("orders_ratio", F.try_divide("orders", "target_orders"))
    )
