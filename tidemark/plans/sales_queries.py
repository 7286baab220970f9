"""Batch queries over bronze rows and order facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import RATE_UNIT, cents, rate, share, units
from tidemark.operators.lookup import target_vs_actual, with_targets
from tidemark.plans import kpis
from tidemark.plans.bronze import (
    bronze_frame_style, bronze_sql_style, gmv_by_channel, gold_kpis,
)
from tidemark.plans.facts import (
    STORE_CHANNEL, order_lines, risk_columns, sellers, targets, with_channel, with_product, without_store_shipping,
)
from tidemark.plans.oracle import BRONZE_FRAME, BRONZE_SQL, FACTS, GOLD, TARGETS
from tidemark.plans.registry import query
from tidemark.session import scratch_path
from tidemark.sources import sinks
from tidemark.sources.readers import (
    TARGET_SCHEMA, read_csv, read_snapshot, read_versioned, table, targets_or_default,
)

# Parameters of the risk columns over these tables.
DEEP_DISCOUNT = 0.08
RISK_CATEGORIES = ("ECONOMY", "PROMO")


def _numbers(spark, folder):
    return table(spark, folder, "events").select((F.col("event_id") + 1).alias("i"))


def _r(name: str, places: int = 6):
    return F.round(name, places).alias(name)


# ---- bronze and gold ---------------------------------------------------------------------

@query("bronze_range", f"WITH {BRONZE_SQL} SELECT * FROM b")
def _(spark, folder):
    return bronze_sql_style(_numbers(spark, folder))


@query("bronze_polars_rows", f"WITH {BRONZE_FRAME} SELECT * FROM b")
def _(spark, folder):
    return bronze_frame_style(_numbers(spark, folder))


@query("bronze_gold", f"""WITH {BRONZE_SQL} SELECT seller_id, channel, SUM(gmv) AS gmv_total,
ROUND(AVG(gmv), 6) AS ticket_medio, COUNT(*) AS eventos FROM b GROUP BY 1, 2""")
def _(spark, folder):
    gold = gold_kpis(bronze_sql_style(_numbers(spark, folder)))
    return gold.withColumn("ticket_medio", F.round("ticket_medio", 6))


@query("gold_kpis", f"""WITH {GOLD} SELECT seller_id, channel, gmv_total,
ROUND(ticket_medio, 6) AS ticket_medio, eventos FROM g ORDER BY gmv_total DESC""")
def gold(spark, folder):
    return kpis.gold_by_seller_channel(spark, folder).select(
        "seller_id", "channel", "gmv_total", _r("ticket_medio"), "eventos"
    ).orderBy(F.desc("gmv_total"))


def _gold_unordered(spark, folder):
    return kpis.gold_by_seller_channel(spark, folder).withColumn(
        "ticket_medio", F.round("ticket_medio", 6)
    )


_GOLD_ROWS = f"""WITH {GOLD} SELECT seller_id, channel, gmv_total,
ROUND(ticket_medio, 6) AS ticket_medio, eventos FROM g"""


@query("gmv_by_channel", f"""WITH {FACTS} SELECT channel, CAST(SUM(gross) AS DOUBLE) AS gmv_total
FROM f GROUP BY 1""")
def _(spark, folder):
    lines = with_channel(order_lines(spark, folder).select("order_id", "gross"), spark, folder)
    sums = gmv_by_channel(lines.withColumnRenamed("gross", "gmv"))
    return sums.withColumn("gmv_total", units(F.col("gmv_total")))


@query("derive_gmv", """SELECT l_orderkey, l_linenumber,
ROUND(l_extendedprice / l_quantity * l_quantity, 4) AS gmv FROM lineitem""")
def _(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("qty"),
    )
    priced = lines.withColumn("gmv", F.col("price") * F.col("qty"))
    return priced.select("l_orderkey", "l_linenumber", _r("gmv", 4))


@query("row_count", """SELECT COUNT(*) AS n_rows,
(SELECT COUNT(*) FROM information_schema.columns WHERE table_name = 'lineitem') AS n_columns
FROM lineitem""")
def _(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.agg(
        F.count("*").alias("n_rows"), F.lit(len(lines.columns)).cast("long").alias("n_columns")
    )


@query("peak_hours", """SELECT event_id, CAST(ts AS DATE) AS order_date,
CAST(hour(ts) AS INTEGER) AS hour, CASE WHEN hour(ts) BETWEEN 15 AND 20 THEN 0.09::DOUBLE ELSE 0.03::DOUBLE
END AS bonus FROM events""")
def _(spark, folder):
    hour = F.hour("ts")
    return table(spark, folder, "events").select(
        "event_id", F.to_date("ts").alias("order_date"), hour.alias("hour"),
        F.when(hour.between(15, 20), F.lit(0.09)).otherwise(F.lit(0.03)).alias("bonus"),
    )


@query("round_money", """SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(12,2))
* CAST(l_discount AS DECIMAL(5,4)), 2) AS DOUBLE) AS amount FROM lineitem""")
def _(spark, folder):
    amount = share(cents(F.col("l_extendedprice")), rate(F.col("l_discount")))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", units(amount).alias("amount")
    )


# ---- facts -------------------------------------------------------------------------------

_MEASURES = ("gross", "discount_amount", "shipping", "cogs", "net_revenue")


@query("order_economics", f"""WITH {FACTS} SELECT order_id, line_number, seller_id, status,
{", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in _MEASURES)} FROM f""")
def _(spark, folder):
    lines = with_product(order_lines(spark, folder), spark, folder)
    return lines.select(
        "order_id", "line_number", "seller_id", "status",
        *[units(F.col(m)).alias(m) for m in _MEASURES],
    )


@query("store_shipping", f"""WITH {FACTS}, t AS (
  SELECT order_id, line_number, seller_id, channel, status, gross, discount_amount, cogs,
         CASE WHEN channel = '{STORE_CHANNEL}' THEN 0 ELSE shipping END AS shipping FROM f)
SELECT order_id, line_number, seller_id, channel, status, CAST(shipping AS DOUBLE) AS shipping,
       CAST(gross - discount_amount + shipping AS DOUBLE) AS net_revenue,
       CAST(gross - discount_amount + shipping - cogs AS DOUBLE) AS profit FROM t""")
def _(spark, folder):
    """Order economics where physical stores charge no shipping."""
    lines = without_store_shipping(with_channel(with_product(order_lines(spark, folder), spark, folder), spark, folder))
    return lines.select(
        "order_id", "line_number", "seller_id", "channel", "status", units(F.col("shipping")).alias("shipping"),
        units(F.col("net_revenue")).alias("net_revenue"), units(F.col("net_revenue") - F.col("cogs")).alias("profit"))


@query("order_risk", f"""WITH {FACTS} SELECT order_id, line_number,
ROUND(CAST(0.04 AS DOUBLE) + CASE WHEN discount_pct >= {DEEP_DISCOUNT} THEN CAST(0.05 AS DOUBLE) ELSE 0 END, 6)
AS p_cancel,
ROUND(CAST(0.05 AS DOUBLE) + CASE WHEN category IN {RISK_CATEGORIES} THEN CAST(0.03 AS DOUBLE) ELSE 0 END, 6)
AS p_return FROM f""")
def _(spark, folder):
    lines = with_product(
        order_lines(spark, folder).select("order_id", "line_number", "product_id", "gross", "discount_rate"),
        spark, folder,
    )
    risks = risk_columns(
        F.col("discount_rate"), F.col("category"), round(DEEP_DISCOUNT * RATE_UNIT), RISK_CATEGORIES
    )
    return lines.select("order_id", "line_number", *[F.round(c, 6).alias(n) for n, c in risks.items()])


@query("star_enrich", f"""WITH {FACTS} SELECT order_id, line_number, seller_name, store, region, channel,
category, CAST(gross AS DOUBLE) AS gross FROM f""")
def _(spark, folder):
    lines = order_lines(spark, folder).select("order_id", "line_number", "product_id", "seller_id", "gross")
    star = with_channel(with_product(lines, spark, folder), spark, folder)
    return star.join(sellers(spark, folder), "seller_id").select(
        "order_id", "line_number", "seller_name", "store", "region", "channel", "category",
        units(F.col("gross")).alias("gross"),
    )


@query("target_lookup", f"""WITH {TARGETS} SELECT l_orderkey AS order_id, l_suppkey AS seller_id,
COALESCE(target_gmv, 320000.0) AS target_gmv, COALESCE(target_orders, 450) AS target_orders
FROM lineitem LEFT JOIN t ON l_suppkey = t.seller_id""")
def _(spark, folder):
    lines = order_lines(spark, folder).select("order_id", "seller_id")
    return with_targets(lines, targets(spark, folder)).select(
        "order_id", "seller_id", "target_gmv", "target_orders"
    )


@query("targets_or_default", f"""WITH {TARGETS}
SELECT 'file' AS origin, seller_id::VARCHAR AS seller_id, target_gmv * 2 AS target_gmv, target_orders FROM t
UNION ALL
SELECT 'default' AS origin, seller_id::VARCHAR AS seller_id, target_gmv, target_orders FROM t""")
def _(spark, folder):
    """Once with a targets file in place, once without."""
    default = targets(spark, folder).select(
        F.col("seller_id").cast("string").alias("seller_id"), "target_gmv", "target_orders"
    )
    filed = default.select(
        "seller_id", F.lit("").alias("seller_name"), (F.col("target_gmv") * 2).alias("target_gmv"),
        "target_orders", F.lit("2025-11-28").alias("target_date"),
    )
    path = scratch_path(spark, "targets")
    sinks.write_csv(filed, path)
    found = targets_or_default(spark, path, default).withColumn("origin", F.lit("file"))
    missing = targets_or_default(spark, f"{path}-none", default).withColumn("origin", F.lit("default"))
    return found.unionByName(missing).select("origin", "seller_id", "target_gmv", "target_orders")


# ---- sinks read back ---------------------------------------------------------------------

@query("parquet_roundtrip", _GOLD_ROWS)
def _(spark, folder):
    """Written twice: the second write replaces the first."""
    path = scratch_path(spark, "gold")
    gold_rows = _gold_unordered(spark, folder)
    sinks.write_parquet(table(spark, folder, "supplier").select(F.col("s_suppkey").alias("seller_id")), path)
    sinks.write_parquet(gold_rows, path)
    return spark.read.parquet(path)


@query("versioned_roundtrip", _GOLD_ROWS)
def _(spark, folder):
    path = scratch_path(spark, "gold-versioned")
    sinks.write_versioned(_gold_unordered(spark, folder), path)
    return read_versioned(spark, path)


@query("csv_roundtrip", _GOLD_ROWS)
def _(spark, folder):
    path = scratch_path(spark, "gold-csv")
    gold_rows = _gold_unordered(spark, folder)
    sinks.write_csv(gold_rows, path)
    return read_csv(spark, path, gold_rows.schema)


@query("csv_targets", f"""WITH {TARGETS} SELECT seller_id::VARCHAR AS seller_id, seller_name, target_gmv,
target_orders, DATE '2025-11-28' AS target_date FROM t""")
def _(spark, folder):
    path = scratch_path(spark, "targets")
    rows = targets(spark, folder).select(
        F.col("seller_id").cast("string").alias("seller_id"), "seller_name", "target_gmv",
        "target_orders", F.lit("2025-11-28").alias("target_date"),
    )
    sinks.write_csv(rows, path)
    return read_csv(spark, path, TARGET_SCHEMA)


@query("ctas_gold", _GOLD_ROWS)
def _(spark, folder):
    rows = _gold_unordered(spark, folder)
    return sinks.rebuild_table(rows, "gold_sales_kpis", scratch_path(spark, "gold-table"))


_LISTED = ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")


@query("show_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in _LISTED))
def _(spark, folder):
    """The catalog's tables with their row counts."""
    for name in _LISTED:
        table(spark, folder, name).createOrReplaceTempView(name)
    listed = sinks.list_tables(spark).filter(F.col("tableName").isin(*_LISTED) & F.col("isTemporary"))
    counts = [
        spark.table(row.tableName).agg(F.count("*").alias("n_rows"))
        .select(F.lit(row.tableName).alias("table_name"), "n_rows")
        for row in listed.collect()
    ]
    for name in _LISTED:  # the frames hold their plans
        spark.catalog.dropTempView(name)
    return reduce(DataFrame.unionByName, counts)


@query("named_queries", f"""WITH {GOLD}
SELECT 'gmv_by_channel' AS query, channel AS label, ROUND(SUM(gmv_total), 2) AS value FROM g GROUP BY channel
UNION ALL SELECT 'events_by_seller', seller_id::VARCHAR, CAST(SUM(eventos) AS DOUBLE) FROM g GROUP BY seller_id""")
def _(spark, folder):
    kpis.gold_by_seller_channel(spark, folder).createOrReplaceTempView("gold_kpis")
    results = sinks.run_named(spark, {
        "gmv_by_channel":
            "SELECT channel AS label, ROUND(SUM(gmv_total), 2) AS value FROM gold_kpis GROUP BY 1",
        "events_by_seller":
            "SELECT CAST(seller_id AS STRING) AS label, CAST(SUM(eventos) AS DOUBLE) AS value "
            "FROM gold_kpis GROUP BY 1",
    })
    spark.catalog.dropTempView("gold_kpis")  # the frames hold their plans
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("query"), "label", "value") for name, df in results.items()
    ])


# ---- KPIs --------------------------------------------------------------------------------

EXECUTIVE = f"""WITH {FACTS} SELECT CAST(SUM(gross) AS DOUBLE) AS gmv,
CAST(SUM(CASE WHEN status = 'PAID' THEN net_revenue - cogs END) AS DOUBLE) AS net_profit,
ROUND(CAST(SUM(gross) AS DOUBLE) / COUNT(DISTINCT order_id), 6) AS avg_ticket FROM f"""


def _executive(spark, folder):
    lines = with_product(order_lines(spark, folder), spark, folder)
    return kpis.executive(lines).select("gmv", "net_profit", _r("avg_ticket"))


@query("kpi_executive", EXECUTIVE)
def _(spark, folder):
    return _executive(spark, folder)


@query("kpi_snapshot", EXECUTIVE)
def _(spark, folder):
    path = scratch_path(spark, "snapshot")
    rows = _executive(spark, folder)
    sinks.write_snapshot(rows, path)
    return read_snapshot(spark, path, rows.schema)


@query("kpi_sales", f"""WITH {FACTS} SELECT COUNT(DISTINCT order_id) AS orders,
ROUND(CAST(SUM(gross) AS DOUBLE) / COUNT(DISTINCT order_id), 6) AS avg_ticket,
ROUND(CAST(SUM(discount_pct) AS DOUBLE) / COUNT(*), 6) AS avg_discount FROM f""")
def _(spark, folder):
    return kpis.sales(order_lines(spark, folder)).select("orders", _r("avg_ticket"), _r("avg_discount"))


@query("kpi_control", f"""WITH {FACTS},
p AS (SELECT CAST(SUM(net_revenue) AS DOUBLE) AS r, CAST(SUM(cogs) AS DOUBLE) AS c FROM f WHERE status = 'PAID')
SELECT ROUND((r - c) / r, 6) AS gross_margin, c AS cost FROM p""")
def _(spark, folder):
    lines = with_product(order_lines(spark, folder, only="PAID"), spark, folder)
    return kpis.control(lines).select(_r("gross_margin"), "cost")


@query("discount_impact", f"""WITH {FACTS} SELECT CAST(SUM(discount_amount) AS DOUBLE) AS discount_total,
ROUND(CAST(SUM(discount_amount) AS DOUBLE) / CAST(SUM(gross) AS DOUBLE), 6) AS discount_share FROM f""")
def _(spark, folder):
    return kpis.discount_impact(order_lines(spark, folder)).select("discount_total", _r("discount_share"))


@query("cancel_return", f"""WITH {FACTS} SELECT status, COUNT(*) AS lines,
CAST(SUM(gross) AS DOUBLE) AS gross_value,
ROUND(CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM f), 6) AS rate
FROM f WHERE status <> 'PAID' GROUP BY status""")
def _(spark, folder):
    out = kpis.cancel_return(order_lines(spark, folder))
    return out.select("status", "lines", "gross_value", _r("rate"))


@query("gmv_by_seller", f"""WITH {FACTS} SELECT seller_id, seller_name, CAST(SUM(gross) AS DOUBLE) AS gmv
FROM f GROUP BY 1, 2""")
def _(spark, folder):
    return kpis.named_gmv_by_seller(order_lines(spark, folder), sellers(spark, folder))


@query("gmv_by_store", f"""WITH {FACTS} SELECT store, region, CAST(SUM(gross) AS DOUBLE) AS gmv
FROM f GROUP BY 1, 2""")
def _(spark, folder):
    return kpis.gmv_by_store(order_lines(spark, folder), sellers(spark, folder))


def _ranked_oracle(order: str) -> str:
    return f"""WITH {FACTS}, g AS (SELECT seller_id, SUM(gross) AS g FROM f GROUP BY 1)
SELECT rank, seller_id, CAST(g AS DOUBLE) AS gmv FROM (
  SELECT *, ROW_NUMBER() OVER (ORDER BY g {order}, seller_id) AS rank FROM g) WHERE rank <= 5"""


@query("top_performers", _ranked_oracle("DESC"))
def _(spark, folder):
    return kpis.ranked_sellers(order_lines(spark, folder), 5, best=True)


@query("bottom_performers", _ranked_oracle("ASC"))
def _(spark, folder):
    return kpis.ranked_sellers(order_lines(spark, folder), 5, best=False)


@query("target_vs_actual", f"""WITH {TARGETS}, {FACTS},
a AS (SELECT seller_id, CAST(SUM(gross) AS DOUBLE) AS gmv, COUNT(DISTINCT order_id) AS orders FROM f GROUP BY 1)
SELECT t.seller_id, target_gmv, target_orders, COALESCE(gmv, 0) AS gmv, COALESCE(orders, 0) AS orders,
ROUND(COALESCE(gmv, 0) / target_gmv, 6) AS gmv_ratio,
ROUND(CAST(COALESCE(orders, 0) AS DOUBLE) / target_orders, 6) AS orders_ratio
FROM t LEFT JOIN a ON t.seller_id = a.seller_id""")
def _(spark, folder):
    actuals = kpis.actuals_by_seller(order_lines(spark, folder))
    return target_vs_actual(targets(spark, folder), actuals).select(
        "seller_id", "target_gmv", "target_orders", "gmv", "orders", _r("gmv_ratio"), _r("orders_ratio")
    )


@query("profit_by_category", f"""WITH {FACTS} SELECT category, CAST(SUM(net_revenue - cogs) AS DOUBLE) AS net_profit
FROM f WHERE status = 'PAID' GROUP BY 1""")
def _(spark, folder):
    return kpis.profit_by_category(with_product(order_lines(spark, folder, only="PAID"), spark, folder))


@query("profit_by_channel", f"""WITH {FACTS} SELECT channel, CAST(SUM(net_revenue - cogs) AS DOUBLE) AS net_profit
FROM f WHERE status = 'PAID' GROUP BY 1""")
def _(spark, folder):
    return kpis.profit_by_channel(spark, folder)
