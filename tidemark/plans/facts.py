"""Order facts over the sales tables.

Every step joins one dimension, so a query takes only those it needs. Money is
in cents and rates in ten-thousandths (longs) until the last step, so sums are
exact in any order; results are doubles in currency units.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import cents, rate, share
from tidemark.sources.readers import table

# Status of an order line.
STATUS = {"N": "PAID", "A": "CANCELLED", "R": "RETURNED"}
# Fixed value: the channel that stands for physical stores.
STORE_CHANNEL = "1-URGENT"
# Added likelihoods of cancellation and return.
CANCEL_BASE, CANCEL_DEEP = 0.04, 0.05
RETURN_BASE, RETURN_CATEGORY = 0.05, 0.03


def order_lines(spark: SparkSession, folder: str, only: str | None = None) -> DataFrame:
    """Order lines of the table; ``only`` keeps one status, as a filter that reaches the scan."""
    source = table(spark, folder, "lineitem")
    if only:
        source = source.filter(F.col("l_returnflag").isin([f for f, s in STATUS.items() if s == only]))
    return lines_of(source)


def lines_of(source: DataFrame) -> DataFrame:
    """Order lines, batch or stream, with the measures that need no other table."""
    status = F
    for flag, name in STATUS.items():
        status = status.when(F.col("l_returnflag") == flag, F.lit(name))
    lines = source.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").alias("event_time"),
        cents(F.col("l_extendedprice")).alias("gross"),
        rate(F.col("l_discount")).alias("discount_rate"),
        rate(F.col("l_tax")).alias("shipping_rate"),
        status.alias("status"),
    )
    charged = lines.withColumns({
        "discount_amount": share(F.col("gross"), F.col("discount_rate")),
        "shipping": share(F.col("gross"), F.col("shipping_rate")),
    })
    return charged.withColumn(
        "net_revenue", F.col("gross") - F.col("discount_amount") + F.col("shipping")
    )


def with_product(lines: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Category and cost."""
    part = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        ((40 + F.col("p_size") % 30) * 100).cast("long").alias("cogs_rate"),
    )
    return lines.join(part, "product_id").withColumn(
        "cogs", share(F.col("gross"), F.col("cogs_rate"))
    )


def with_channel(lines: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("channel"),
    )
    return lines.join(orders, "order_id")


def without_store_shipping(lines: DataFrame, channel: str = STORE_CHANNEL) -> DataFrame:
    """Lines with their channel: a physical store charges no shipping, which lowers its net revenue."""
    in_store = F.col("channel") == channel
    return lines.withColumn("shipping", F.when(in_store, F.lit(0).cast("long")).otherwise(F.col("shipping"))).withColumn(
        "net_revenue", F.col("gross") - F.col("discount_amount") + F.col("shipping"))


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    """Seller, store and region."""
    supplier = table(spark, folder, "supplier")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_name"),
            F.col("n_name").alias("store"), F.col("r_name").alias("region"),
        )
    )


def targets(spark: SparkSession, folder: str) -> DataFrame:
    """Targets grow with the seller number; sellers with a negative balance have none."""
    n = F.col("s_suppkey") + 1
    return table(spark, folder, "supplier").filter(F.col("s_acctbal") >= 0).select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_name").alias("seller_name"),
        (F.lit(250_000) + n * 32_500).cast("double").alias("target_gmv"),
        (F.lit(350) + n * 27).cast("int").alias("target_orders"),
    )


def risk_columns(
    discount_rate: Column, category: Column, deep_rate: int, categories: Sequence[str]
) -> dict[str, Column]:
    """Likelihood of cancellation and of return."""
    return {
        "p_cancel": F.lit(CANCEL_BASE)
        + F.when(discount_rate >= deep_rate, F.lit(CANCEL_DEEP)).otherwise(F.lit(0.0)),
        "p_return": F.lit(RETURN_BASE)
        + F.when(category.isin(*categories), F.lit(RETURN_CATEGORY)).otherwise(F.lit(0.0)),
    }
