"""Sales KPIs.

GMV counts every order line; profit, cost and margin count PAID lines only; the
ticket is gross value per distinct order. Per-seller figures are aggregated
before any dimension is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import RATE_UNIT, units
from tidemark.plans.facts import order_lines, with_channel, with_product


def _paid(value: Column) -> Column:
    return F.coalesce(F.sum(F.when(F.col("status") == "PAID", value)), F.lit(0))


def _profit() -> Column:
    return F.col("net_revenue") - F.col("cogs")


def executive(lines: DataFrame) -> DataFrame:
    """GMV = sum of gross; net profit = sum of (net revenue - cost), PAID; ticket."""
    sums = lines.agg(
        F.sum("gross").alias("g"), _paid(_profit()).alias("p"),
        F.count_distinct("order_id").alias("orders"),
    )
    return sums.select(
        units(F.col("g")).alias("gmv"),
        units(F.col("p")).alias("net_profit"),
        F.try_divide(units(F.col("g")), F.col("orders")).alias("avg_ticket"),
    )


def sales(lines: DataFrame) -> DataFrame:
    """Distinct orders, gross per order, mean discount rate over lines."""
    sums = lines.agg(
        F.sum("gross").alias("g"), F.sum("discount_rate").alias("d"), F.count("*").alias("n"),
        F.count_distinct("order_id").alias("orders"),
    )
    return sums.select(
        "orders",
        F.try_divide(units(F.col("g")), F.col("orders")).alias("avg_ticket"),
        F.try_divide(F.col("d") / F.lit(float(RATE_UNIT)), F.col("n")).alias("avg_discount"),
    )


def control(lines: DataFrame) -> DataFrame:
    """Gross margin = (revenue - cost) / revenue, null without revenue; cost. PAID lines."""
    sums = lines.agg(_paid(F.col("net_revenue")).alias("r"), _paid(F.col("cogs")).alias("c"))
    revenue, cost = units(F.col("r")), units(F.col("c"))
    return sums.select(
        F.try_divide(revenue - cost, revenue).alias("gross_margin"), cost.alias("cost")
    )


def discount_impact(lines: DataFrame) -> DataFrame:
    """Discount granted and its share of gross value."""
    sums = lines.agg(F.sum("discount_amount").alias("d"), F.sum("gross").alias("g"))
    return sums.select(
        units(F.col("d")).alias("discount_total"),
        F.try_divide(units(F.col("d")), units(F.col("g"))).alias("discount_share"),
    )


def cancel_return(lines: DataFrame) -> DataFrame:
    """Count, gross value and rate of cancelled and of returned lines; zeros kept."""
    names = ("CANCELLED", "RETURNED")
    sums = lines.agg(
        F.count("*").alias("all"),
        *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in names],
        *[F.coalesce(F.sum(F.when(F.col("status") == s, F.col("gross"))), F.lit(0)).alias(f"g_{s}")
          for s in names],
    )
    rows = [
        F.struct(
            F.lit(s).alias("status"), F.col(f"n_{s}").alias("lines"),
            units(F.col(f"g_{s}")).alias("gross_value"),
            F.try_divide(F.col(f"n_{s}"), F.col("all")).alias("rate"),
        )
        for s in names
    ]
    return sums.select(F.inline(F.array(*rows)))


def gmv_by_seller(lines: DataFrame) -> DataFrame:
    return lines.groupBy("seller_id").agg(F.sum("gross").alias("g"))


def named_gmv_by_seller(lines: DataFrame, sellers_dim: DataFrame) -> DataFrame:
    return (
        gmv_by_seller(lines).join(sellers_dim, "seller_id")
        .select("seller_id", "seller_name", units(F.col("g")).alias("gmv"))
    )


def gmv_by_store(lines: DataFrame, sellers_dim: DataFrame) -> DataFrame:
    return (
        gmv_by_seller(lines).join(sellers_dim, "seller_id")
        .groupBy("store", "region").agg(units(F.sum("g")).alias("gmv"))
    )


def ranked_sellers(lines: DataFrame, n: int, best: bool) -> DataFrame:
    """The ``n`` sellers with the most (or least) GMV; ties by seller id."""
    order = [F.desc("g") if best else F.asc("g"), F.asc("seller_id")]
    few = gmv_by_seller(lines).orderBy(*order).limit(n)
    return few.select(
        F.row_number().over(Window.orderBy(*order)).cast("long").alias("rank"), "seller_id",
        units(F.col("g")).alias("gmv"),
    )


def actuals_by_seller(lines: DataFrame) -> DataFrame:
    return lines.groupBy("seller_id").agg(
        units(F.sum("gross")).alias("gmv"), F.count_distinct("order_id").alias("orders")
    )


def profit_by_category(paid_lines: DataFrame) -> DataFrame:
    return paid_lines.groupBy("category").agg(units(F.sum(_profit())).alias("net_profit"))


def profit_by_channel(spark: SparkSession, folder: str) -> DataFrame:
    """Profit is summed per order first: one narrow row per order enters the join."""
    paid = with_product(order_lines(spark, folder, only="PAID"), spark, folder)
    per_order = paid.groupBy("order_id").agg(F.sum(_profit()).alias("profit"))
    return (
        with_channel(per_order, spark, folder)
        .groupBy("channel").agg(units(F.sum("profit")).alias("net_profit"))
    )


def gold_by_seller_channel(spark: SparkSession, folder: str) -> DataFrame:
    """The gold table over order facts: value, mean ticket, events."""
    lines = with_channel(
        order_lines(spark, folder).select("order_id", "seller_id", "gross"), spark, folder
    )
    sums = lines.groupBy("seller_id", "channel").agg(
        F.sum("gross").alias("g"), F.count("*").alias("eventos")
    )
    return sums.select(
        "seller_id", "channel",
        units(F.col("g")).alias("gmv_total"),
        (units(F.col("g")) / F.col("eventos")).alias("ticket_medio"),
        "eventos",
    )
