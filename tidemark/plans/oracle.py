"""Shared parts of the ANSI-SQL oracles (DuckDB dialect)."""

# Arrival stream over events; the order is (arr, event_id).
S = """
base AS (
  SELECT event_id, user_id, event_type AS symbol, value AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS qty,
         epoch_us(ts) // 1000 AS ms, (event_id * 7919) % 1000 AS d
  FROM events),
once AS (
  SELECT event_id, user_id, symbol, price, qty, ms,
         ms + 60000 * (CASE WHEN d < 700 THEN d % 30 WHEN d < 900 THEN 90 + d % 150
                            ELSE 360 + d % 180 END) AS arr
  FROM base),
s AS (
  SELECT * FROM once
  UNION ALL
  SELECT event_id, user_id, symbol, price, qty, ms,
         arr + CASE WHEN event_id % 40 = 0 THEN 1000 ELSE 1200000 END
  FROM once WHERE event_id % 20 = 0)"""


def watermark(wait_ms: int) -> str:
    """``m``: the stream with its record-level watermark."""
    return f"""{S},
m AS (
  SELECT *, max_ms - {wait_ms} AS watermark_ms FROM (
    SELECT *, max(ms) OVER (ORDER BY arr, event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS max_ms FROM s))"""


def dedup(ttl_ms: int) -> str:
    """``k``: rows kept under the TTL; exact because no id arrives more than twice (``dedup_chain`` has more)."""
    return f"""{S},
k AS (
  SELECT * EXCLUDE (prev) FROM (
    SELECT *, lag(arr) OVER (PARTITION BY event_id ORDER BY arr) AS prev FROM s)
  WHERE prev IS NULL OR arr - prev > {ttl_ms})"""


# Order facts, all dimensions joined.
FACTS = """
raw AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_suppkey AS seller_id,
         s_name AS seller_name, n_name AS store, r_name AS region, o_orderpriority AS channel,
         p_type AS category, l_shipdate AS event_time,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS gross,
         CAST(l_discount AS DECIMAL(5,4)) AS discount_pct,
         CAST(l_tax AS DECIMAL(5,4)) AS tax,
         CAST((40 + p_size % 30) * 0.01 AS DECIMAL(5,4)) AS cogs_rate,
         CASE l_returnflag WHEN 'N' THEN 'PAID' WHEN 'A' THEN 'CANCELLED'
                           WHEN 'R' THEN 'RETURNED' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey),
priced AS (
  SELECT *, CAST(round(gross * discount_pct, 2) AS DECIMAL(12,2)) AS discount_amount,
         CAST(round(gross * tax, 2) AS DECIMAL(12,2)) AS shipping,
         CAST(round(gross * cogs_rate, 2) AS DECIMAL(12,2)) AS cogs
  FROM raw),
f AS (SELECT *, gross - discount_amount + shipping AS net_revenue FROM priced)"""

TARGETS = """
t AS (
  SELECT s_suppkey AS seller_id, s_name AS seller_name,
         CAST(250000 + (s_suppkey + 1) * 32500 AS DOUBLE) AS target_gmv,
         CAST(350 + (s_suppkey + 1) * 27 AS INTEGER) AS target_orders
  FROM supplier WHERE s_acctbal >= 0)"""

# Gold figures by seller and channel over the order facts.
GOLD = f"""{FACTS},
g AS (
  SELECT seller_id, channel, CAST(SUM(gross) AS DOUBLE) AS gmv_total,
         CAST(SUM(gross) AS DOUBLE) / COUNT(*) AS ticket_medio, COUNT(*) AS eventos
  FROM f GROUP BY seller_id, channel)"""

# Bronze rows; i is numbered from the events. The names and numbers are the fixed values of plans/bronze.py.
_PARTIES = "(VALUES (0, 'seller_a', 'web'), (1, 'seller_b', 'mobile'), (2, 'seller_c', 'marketplace')) AS party(rest, seller_id, channel)"
_NUMBERS = "numbers AS (SELECT event_id + 1 AS i FROM events)"


def _bronze(prefix: str, start: str, skus: int, price: str, qty: str, qty_type: str) -> str:
    """``b``: price and quantity are worked out in a step of their own, the value from those two."""
    return f"""
{_NUMBERS},
priced AS (
  SELECT i, ({price})::DOUBLE AS price, ({qty})::{qty_type} AS qty FROM numbers),
b AS (
  SELECT '{prefix}' || CASE WHEN i < 100 THEN right('00' || i, 3) ELSE i::VARCHAR END AS event_id,
         date_add(TIMESTAMP '{start}', to_minutes(i)) AS event_time, party.seller_id, party.channel,
         'sku_' || (1 + i % {skus}) AS sku, price, qty, price * qty AS gmv
  FROM priced JOIN {_PARTIES} ON party.rest = i % 3)"""


BRONZE_SQL = _bronze("duck_ev_", "2026-02-20 15:00:00", 6, "30 + 12 * (i % 9)", "1 + i % 5", "INTEGER")
BRONZE_FRAME = _bronze("ev_", "2026-02-20 14:00:00", 5, "40 + 10 * (i % 7)", "1 + i % 4", "BIGINT")
