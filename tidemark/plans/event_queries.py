"""Event-time queries over the arrival stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import (
    bucket_index, cents, clamp, composite_key, delay_ms, iso_utc, padded_id, parse_symbols, row_id, window_start_ms,
)
from tidemark.operators.arrival import (
    ORDER, class_counts, close_lags, late_rows, running_watermark, strict_windows, timeliness,
)
from tidemark.operators.clean import parse_json, rejected, require_fields
from tidemark.operators.dedup import dedup_ttl, first_arrivals
from tidemark.operators.delays import (
    delay_report, delay_stats, duplicate_counts, histogram_columns, percentile_low,
)
from tidemark.operators.latest import append_loads, compacted, latest_per_key
from tidemark.operators.lookup import already_seen, unseen
from tidemark.operators.windows import agg_changelog, tumbling_agg
from tidemark.plans.arrivals import HOUR, MINUTE, arrivals, with_times
from tidemark.plans.oracle import S, dedup, watermark
from tidemark.plans.registry import query
from tidemark.sources.readers import table
from tidemark.sources.sinks import describe

WAIT = 5 * HOUR
TTL = 10 * MINUTE
# Fixed value: hour-scale edges, as the derived delays are minutes to hours.
WIDE_EDGES = (MINUTE, 5 * MINUTE, 15 * MINUTE, 60 * MINUTE)
# Fixed value: 2024-01-16 00:00 UTC, the border between the two loads.
CUT_MS = 1_705_363_200_000


def _r(name: str, places: int = 6):
    return F.round(name, places).alias(name)


# ---- watermark, late rule, classes -----------------------------------------------------

@query("running_watermark", f"""WITH {watermark(WAIT)}
SELECT event_id, arr, ms, max_ms, watermark_ms FROM m""")
def _(spark, folder):
    rows = arrivals(spark, folder).select("event_id", "arr", "ms")
    return running_watermark(rows, WAIT).select("event_id", "arr", "ms", "max_ms", "watermark_ms")


@query("strict_window", f"""WITH {watermark(WAIT)}
SELECT user_id, ms - ms % {HOUR} AS window_start_ms, ms - ms % {HOUR} + {HOUR} AS window_end_ms,
       COUNT(*) AS count, ROUND(SUM(price), 6) AS sum
FROM m WHERE ms >= watermark_ms GROUP BY 1, 2, 3""")
def _(spark, folder):
    rows = arrivals(spark, folder).select("event_id", "user_id", "arr", "ms", "price")
    out = strict_windows(running_watermark(rows, WAIT), HOUR, ["user_id"], F.col("price"))
    return out.select("user_id", "window_start_ms", "window_end_ms", "count", _r("sum"))


@query("late_rows", f"""WITH {watermark(WAIT)}
SELECT event_id, arr, ms, watermark_ms FROM m WHERE ms < watermark_ms""")
def _(spark, folder):
    rows = arrivals(spark, folder).select("event_id", "arr", "ms")
    return late_rows(running_watermark(rows, WAIT)).select("event_id", "arr", "ms", "watermark_ms")


_CLASS = f"""CASE WHEN ms < watermark_ms THEN 'red' WHEN arr - ms > {HOUR} THEN 'orange'
            ELSE 'green' END"""


@query("timeliness_class", f"""WITH {watermark(WAIT)}
SELECT event_id, arr, ms, {_CLASS} AS color FROM m""")
def _(spark, folder):
    rows = arrivals(spark, folder).select("event_id", "arr", "ms")
    marked = running_watermark(rows, WAIT)
    return marked.select("event_id", "arr", "ms", timeliness(HOUR).alias("color"))


@query("timeliness_points", f"""WITH {watermark(WAIT)}
SELECT event_id, arr AS x_processing_ms, ms AS y_event_ms, arr AS y_line_ms, {_CLASS} AS color
FROM m""")
def _(spark, folder):
    rows = arrivals(spark, folder).select("event_id", "arr", "ms")
    return running_watermark(rows, WAIT).select(
        "event_id", F.col("arr").alias("x_processing_ms"), F.col("ms").alias("y_event_ms"),
        F.col("arr").alias("y_line_ms"), timeliness(HOUR).alias("color"),
    )


@query("class_counts", f"""WITH {watermark(WAIT)}, c AS (SELECT {_CLASS} AS color FROM m)
SELECT l.color, COUNT(c.color) AS n, (SELECT COUNT(*) FROM c WHERE color = 'red') AS dlq_count
FROM (VALUES ('green'), ('orange'), ('red')) AS l(color) LEFT JOIN c ON c.color = l.color
GROUP BY l.color""")
def _(spark, folder):
    rows = arrivals(spark, folder).select("event_id", "arr", "ms")
    marked = running_watermark(rows, WAIT)
    return class_counts(marked.select(timeliness(HOUR).alias("color")))


@query("window_close_lag", f"""WITH {watermark(WAIT)},
w AS (SELECT user_id, ms - ms % {HOUR} + {HOUR} AS window_end_ms, COUNT(*) AS count
      FROM m WHERE ms >= watermark_ms GROUP BY 1, 2),
steps AS (SELECT watermark_ms, MIN(arr) AS arr FROM m GROUP BY 1),
ends AS (SELECT DISTINCT window_end_ms FROM w),
closes AS (SELECT e.window_end_ms, MIN(arr) AS close_arr
           FROM ends e JOIN steps ON watermark_ms >= e.window_end_ms GROUP BY 1)
SELECT user_id, w.window_end_ms, count, close_arr - w.window_end_ms AS close_lag_ms
FROM w LEFT JOIN closes ON w.window_end_ms = closes.window_end_ms""")
def _(spark, folder):
    rows = arrivals(spark, folder).select("event_id", "user_id", "arr", "ms", "price")
    windows = strict_windows(running_watermark(rows, WAIT), HOUR, ["user_id"], F.col("price"))
    return close_lags(rows, windows, HOUR, WAIT).select(
        "user_id", "window_end_ms", "count", "close_lag_ms"
    )


# ---- windows, changelog, compacted log -------------------------------------------------

TUMBLING = f"""SELECT symbol, ms - ms % {HOUR} AS window_start_ms,
       ms - ms % {HOUR} + {HOUR} AS window_end_ms, COUNT(*) AS count,
       CAST(SUM(qty) AS BIGINT) AS sum_qty, ROUND(SUM(price * qty), 4) AS gmv"""


def _tumbling_columns(df):
    return df.select("symbol", "window_start_ms", "window_end_ms", "count", "sum_qty", _r("gmv", 4))


@query("tumbling_agg", f"WITH {S} {TUMBLING} FROM s GROUP BY 1, 2, 3")
def _(spark, folder):
    return _tumbling_columns(tumbling_agg(arrivals(spark, folder), HOUR))


_CHANGELOG = f"""
c AS (
  SELECT event_id, arr, symbol, ms - ms % {HOUR} AS window_start_ms,
         COUNT(*) OVER w AS count, CAST(SUM(qty) OVER w AS BIGINT) AS sum_qty,
         SUM(price * qty) OVER w AS gmv
  FROM s WINDOW w AS (PARTITION BY symbol, ms - ms % {HOUR} ORDER BY arr, event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query("agg_changelog", f"""WITH {S}, {_CHANGELOG}
SELECT event_id, arr, window_start_ms || '|' || symbol AS key, count, sum_qty,
       ROUND(gmv, 4) AS gmv FROM c""")
def _(spark, folder):
    rows = arrivals(spark, folder).drop("user_id")
    return agg_changelog(rows, HOUR).select(
        "event_id", "arr", "key", "count", "sum_qty", _r("gmv", 4)
    )


def _compacted_log(spark, folder):
    """The changelog as a keyed log in arrival order; some values are null."""
    log = agg_changelog(arrivals(spark, folder).drop("user_id"), HOUR)
    value = F.when(F.col("event_id") % 50 != 0, F.to_json(F.struct("count", "sum_qty")))
    return log.select("arr", "event_id", "key", value.alias("value"))


_COMPACTED = f"""WITH {S}, {_CHANGELOG},
log AS (
  SELECT window_start_ms || '|' || symbol AS key,
         CASE WHEN event_id % 50 <> 0
              THEN '{{"count":' || count || ',"sum_qty":' || sum_qty || '}}' END AS value,
         ROW_NUMBER() OVER (ORDER BY arr, event_id) - 1 AS pos
  FROM c),
latest AS (
  SELECT key, value FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY pos DESC) AS rn FROM log)
  WHERE rn = 1)"""


@query("compacted_latest", f"{_COMPACTED} SELECT key, value FROM latest")
def _(spark, folder):
    return compacted(_compacted_log(spark, folder), ORDER)


@query("compacted_first10", f"{_COMPACTED} SELECT key, value FROM latest ORDER BY key LIMIT 10")
def _(spark, folder):
    return compacted(_compacted_log(spark, folder), ORDER).orderBy("key").limit(10)


@query("window_start", f"""SELECT event_id, epoch_us(ts) // 1000 // 60000 * 60000 AS start_60s,
       epoch_us(ts) // 1000 // 10000 * 10000 AS start_10s FROM events""")
def _(spark, folder):
    rows = with_times(table(spark, folder, "events"))
    return rows.select(
        "event_id", window_start_ms(F.col("ms"), 60_000).alias("start_60s"),
        window_start_ms(F.col("ms"), 10_000).alias("start_10s"),
    )


@query("composite_key", """SELECT event_id,
       (epoch_us(ts) // 1000 // 60000 * 60000) || '|' || event_type AS by_symbol,
       user_id || '|' || (epoch_us(ts) // 1000 // 10000 * 10000) AS by_user FROM events""")
def _(spark, folder):
    rows = with_times(table(spark, folder, "events"))
    return rows.select(
        "event_id",
        composite_key(window_start_ms(F.col("ms"), 60_000), F.col("symbol")).alias("by_symbol"),
        composite_key(F.col("user_id"), window_start_ms(F.col("ms"), 10_000)).alias("by_user"),
    )


@query("iso_utc", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_time FROM events")
def _(spark, folder):
    return table(spark, folder, "events").select("event_id", iso_utc(F.col("ts")).alias("event_time"))


@query("fmt_ids", """SELECT event_id, printf('ev_%03d', event_id) AS short_id,
       printf('ORD-%07d', event_id) AS order_id, printf('RT-%09d', event_id) AS live_id,
       printf('C%05d', user_id) AS customer_id FROM events""")
def _(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        padded_id("ev_", F.col("event_id"), 3).alias("short_id"),
        padded_id("ORD-", F.col("event_id"), 7).alias("order_id"),
        padded_id("RT-", F.col("event_id"), 9).alias("live_id"),
        padded_id("C", F.col("user_id"), 5).alias("customer_id"),
    )


# ---- delay -------------------------------------------------------------------------------

_BUCKET = """CASE WHEN arr - ms < {0} THEN 0 WHEN arr - ms < {1} THEN 1 WHEN arr - ms < {2} THEN 2
                  WHEN arr - ms < {3} THEN 3 ELSE 4 END"""
_NARROW = _BUCKET.format(1000, 5000, 15000, 60000)
_WIDE = _BUCKET.format(*WIDE_EDGES)
_INTERVAL = f"arr - arr % {HOUR} AS interval_ms"


def _ranks(*percents: int) -> str:
    """Nearest-rank-low percentiles of the delay per interval, as CTE ``p``."""
    picks = ", ".join(
        f"MAX(CASE WHEN rn = CAST(floor(CAST({p / 100} AS DOUBLE) * (n - 1)) AS BIGINT) THEN delay END)"
        f" AS p{p}" for p in percents
    )
    return f"""
p AS (
  SELECT interval_ms, {picks} FROM (
    SELECT {_INTERVAL}, arr - ms AS delay,
           ROW_NUMBER() OVER (PARTITION BY arr - arr % {HOUR} ORDER BY arr - ms) - 1 AS rn,
           COUNT(*) OVER (PARTITION BY arr - arr % {HOUR}) AS n FROM s)
  GROUP BY interval_ms)"""


_DUPS = f"""
d AS (
  SELECT {_INTERVAL}, COUNT(*) AS messages, COUNT(*) FILTER (rn > 1) AS dups FROM (
    SELECT arr, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY arr) AS rn FROM s)
  GROUP BY 1)"""
_HIST = ", ".join(f"COUNT(*) FILTER (b = {i}) AS b{i}" for i in range(5))


@query("delay_bucket", f"""WITH {S} SELECT event_id, arr, {_NARROW} AS bucket,
       {_WIDE} AS wide_bucket FROM s""")
def _(spark, folder):
    delay = delay_ms(F.col("arr"), F.col("ms"))
    return arrivals(spark, folder).select(
        "event_id", "arr", bucket_index(delay).alias("bucket"),
        bucket_index(delay, WIDE_EDGES).alias("wide_bucket"),
    )


@query("delay_hist", f"""WITH {S} SELECT symbol, {_HIST} FROM (SELECT symbol, {_WIDE} AS b FROM s)
GROUP BY symbol""")
def _(spark, folder):
    rows = arrivals(spark, folder).withColumn("delay", delay_ms(F.col("arr"), F.col("ms")))
    return rows.groupBy("symbol").agg(*histogram_columns("delay", WIDE_EDGES))


@query("pctl_low", f"""WITH {S}, r AS (
  SELECT symbol, arr - ms AS delay,
         ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY arr - ms) - 1 AS rn,
         COUNT(*) OVER (PARTITION BY symbol) AS n FROM s)
SELECT symbol, MAX(CASE WHEN rn = CAST(floor(CAST(0.5 AS DOUBLE) * (n - 1)) AS BIGINT) THEN delay END) AS p50,
       MAX(CASE WHEN rn = CAST(floor(CAST(0.95 AS DOUBLE) * (n - 1)) AS BIGINT) THEN delay END) AS p95
FROM r GROUP BY symbol""")
def _(spark, folder):
    rows = arrivals(spark, folder).select("symbol", delay_ms(F.col("arr"), F.col("ms")).alias("delay"))
    return percentile_low(rows, ["symbol"], "delay", [50, 95])


@query("delay_stats", f"""WITH {S}, {_ranks(95)},
a AS (SELECT {_INTERVAL}, MIN(arr - ms) AS min_delay, ROUND(AVG(arr - ms), 4) AS avg_delay
      FROM s GROUP BY 1)
SELECT interval_ms, min_delay, avg_delay, p95 FROM a JOIN p USING (interval_ms)""")
def _(spark, folder):
    out = delay_stats(arrivals(spark, folder), HOUR)
    return out.select("interval_ms", "min_delay", _r("avg_delay", 4), "p95")


@query("dup_count", f"WITH {S}, {_DUPS} SELECT interval_ms, messages, dups FROM d")
def _(spark, folder):
    return duplicate_counts(arrivals(spark, folder), HOUR)


@query("delay_report", f"""WITH {S}, {_ranks(50, 95)}, {_DUPS},
h AS (SELECT interval_ms, {_HIST} FROM (SELECT {_INTERVAL}, {_WIDE} AS b FROM s) GROUP BY 1)
SELECT interval_ms, messages, dups, ROUND(messages / CAST({HOUR // 1000} AS DOUBLE), 6) AS rate,
       p50, p95, b0, b1, b2, b3, b4
FROM d JOIN p USING (interval_ms) JOIN h USING (interval_ms)""")
def _(spark, folder):
    out = delay_report(arrivals(spark, folder), HOUR, WIDE_EDGES)
    return out.withColumn("rate", F.round("rate", 6))


_GAPS = f"""{S},
g AS (SELECT event_id, arr, CASE WHEN event_id % 3 <> 0 THEN ms END AS ms, NULLIF(symbol, 'error') AS symbol FROM s),
gd AS (SELECT *, arr - coalesce(ms, arr) AS delay FROM g)"""


def _with_gaps(spark, folder):
    """Records without event time, and records without symbol."""
    return arrivals(spark, folder).withColumns({
        "ms": F.when(F.col("event_id") % 3 != 0, F.col("ms")), "symbol": F.nullif(F.col("symbol"), F.lit("error")),
    })


@query("delay_gaps", f"""WITH {_GAPS}, r AS (
  SELECT symbol, delay, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY delay) - 1 AS rn,
         COUNT(*) OVER (PARTITION BY symbol) AS n FROM gd),
q AS (SELECT symbol, MAX(CASE WHEN rn = CAST(floor(CAST(0.5 AS DOUBLE) * (n - 1)) AS BIGINT) THEN delay END) AS p50
      FROM r GROUP BY symbol),
h AS (SELECT symbol, COUNT(*) AS n, MIN(delay) AS min_delay, {_HIST} FROM (
        SELECT symbol, delay, {_WIDE.replace("arr - ms", "delay")} AS b FROM gd) GROUP BY symbol)
SELECT h.*, p50 FROM h JOIN q ON q.symbol IS NOT DISTINCT FROM h.symbol""")
def _(spark, folder):
    """A missing event time is no delay, a missing symbol a group."""
    rows = _with_gaps(spark, folder).withColumn("delay", delay_ms(F.col("arr"), F.col("ms")))
    figures = rows.groupBy("symbol").agg(
        F.count("*").alias("n"), F.min("delay").alias("min_delay"), *histogram_columns("delay", WIDE_EDGES))
    middle = percentile_low(rows, ["symbol"], "delay", [50]).withColumnRenamed("symbol", "other")
    return figures.join(middle, F.col("symbol").eqNullSafe(F.col("other"))).drop("other")


@query("changelog_gaps", f"""WITH {_GAPS} SELECT event_id, arr, symbol,
  COUNT(*) OVER (PARTITION BY symbol, ms - ms % {HOUR} ORDER BY arr, event_id ROWS UNBOUNDED PRECEDING) AS count
FROM gd WHERE ms IS NOT NULL""")
def _(spark, folder):
    """Records without event time have no window and are skipped; the null symbol has its own windows."""
    rows = require_fields(_with_gaps(spark, folder), ["ms"]).drop("user_id")
    return agg_changelog(rows, HOUR).select("event_id", "arr", "symbol", "count")


@query("pctl_wide", """WITH r AS (
  SELECT l_returnflag, CAST(round(l_extendedprice * 100) AS BIGINT) AS v,
         ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY round(l_extendedprice * 100)) - 1 AS rn,
         COUNT(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
SELECT l_returnflag, MAX(CASE WHEN rn = CAST(floor(CAST(0.5 AS DOUBLE) * (n - 1)) AS BIGINT) THEN v END) AS p50,
       MAX(CASE WHEN rn = CAST(floor(CAST(0.95 AS DOUBLE) * (n - 1)) AS BIGINT) THEN v END) AS p95
FROM r GROUP BY l_returnflag""")
def _(spark, folder):
    """Percentiles of the line value in cents, a wide column."""
    rows = table(spark, folder, "lineitem").select("l_returnflag", cents(F.col("l_extendedprice")).alias("v"))
    return percentile_low(rows, ["l_returnflag"], "v", [50, 95])


# ---- duplicates --------------------------------------------------------------------------

@query("dedup_ttl", f"WITH {dedup(TTL)} SELECT event_id, symbol, arr, ms FROM k")
def _(spark, folder):
    return dedup_ttl(arrivals(spark, folder).select("event_id", "symbol", "arr", "ms"), TTL)


@query("dedup_all", f"WITH {S} SELECT event_id, symbol, MIN(arr) AS arr, ms FROM s GROUP BY ALL")
def _(spark, folder):
    return first_arrivals(arrivals(spark, folder).select("event_id", "symbol", "arr", "ms"))


@query("effectively_once_agg", f"WITH {dedup(TTL)} {TUMBLING} FROM k GROUP BY 1, 2, 3")
def _(spark, folder):
    return _tumbling_columns(tumbling_agg(dedup_ttl(arrivals(spark, folder), TTL), HOUR))


CHAIN_TTL = 6 * HOUR
RUN_TTL = 3 * HOUR


def chain(key: str, ttl_ms: int) -> str:
    """``k``: the kept arrivals of each id, one after another; for any number of arrivals."""
    return f"""RECURSIVE {S.strip()},
k AS (
  SELECT {key}, MIN(arr) AS arr FROM s GROUP BY {key}
  UNION ALL
  SELECT k.{key}, MIN(s.arr) FROM k JOIN s ON s.{key} = k.{key} AND s.arr > k.arr + {ttl_ms} GROUP BY k.{key})"""


@query("dedup_chain", f"WITH {chain('user_id', CHAIN_TTL)} SELECT user_id, arr FROM k")
def _(spark, folder):
    """Many arrivals per id: at most one record of a user in six hours, counted from the kept one."""
    rows = arrivals(spark, folder).select("user_id", "arr", "event_id")
    return dedup_ttl(rows, CHAIN_TTL, key="user_id").select("user_id", "arr")


@query("dedup_long_run", f"WITH {chain('symbol', RUN_TTL)} SELECT symbol, arr FROM k")
def _(spark, folder):
    """Ids that never pause: a symbol has a record every few minutes over the whole stream."""
    rows = arrivals(spark, folder).select("symbol", "arr", "event_id")
    return dedup_ttl(rows, RUN_TTL, key="symbol").select("symbol", "arr")


def _loads(spark, folder):
    rows = arrivals(spark, folder)
    return rows.filter(F.col("arr") < CUT_MS), rows.filter(F.col("arr") >= CUT_MS)


# The first and the second half of each hour: copies fall on both sides.
_FIRST_HALF = f"arr % {HOUR} < {HOUR // 2}"


def _halves(spark, folder):
    rows = arrivals(spark, folder)
    return rows.filter(_FIRST_HALF), rows.filter(f"NOT {_FIRST_HALF}")


@query("new_ids_anti", f"""WITH {S} SELECT event_id, arr FROM s WHERE NOT {_FIRST_HALF}
AND event_id NOT IN (SELECT event_id FROM s WHERE {_FIRST_HALF})""")
def _(spark, folder):
    known, fresh = _halves(spark, folder)
    return unseen(fresh, known, "event_id").select("event_id", "arr")


@query("seen_ids_semi", f"""WITH {S} SELECT event_id, arr FROM s WHERE NOT {_FIRST_HALF}
AND event_id IN (SELECT event_id FROM s WHERE {_FIRST_HALF})""")
def _(spark, folder):
    known, fresh = _halves(spark, folder)
    return already_seen(fresh, known, "event_id").select("event_id", "arr")


@query("stable_ids", """SELECT event_id, sha256(event_id || '|' || user_id || '|' || event_type) AS id FROM events""")
def _(spark, folder):
    """An id that a repeated run gives again."""
    rows = table(spark, folder, "events")
    return rows.select("event_id", row_id(F.col("event_id"), F.col("user_id"), F.col("event_type")).alias("id"))


@query("symbol_list", """WITH t AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN ' ' || event_type || ' ,, X' || user_id
                ELSE (event_id % 4)::VARCHAR END AS text FROM events)
SELECT event_id, CASE WHEN event_id % 2 = 1 THEN array_to_string(list_transform(range(1, event_id % 4 + 1), lambda i: 'SYM' || i), ' ')
            ELSE array_to_string(list_filter(list_transform(string_split(text, ','), lambda x: trim(x)), lambda x: x <> ''), ' ') END AS symbols
FROM t""")
def _(spark, folder):
    """The list parameter: names with blanks and gaps, or a number of generated names."""
    listed = F.concat(F.lit(" "), F.col("event_type"), F.lit(" ,, X"), F.col("user_id").cast("string"))
    text = F.when(F.col("event_id") % 2 == 0, listed).otherwise((F.col("event_id") % 4).cast("string"))
    return table(spark, folder, "events").select("event_id", F.array_join(parse_symbols(text), " ").alias("symbols"))


@query("describe_events", """SELECT column_name AS col_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
       WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' ELSE column_type END AS data_type
FROM (DESCRIBE events)""")
def _(spark, folder):
    view = f"described_{uuid.uuid4().hex}"
    table(spark, folder, "events").createOrReplaceTempView(view)
    try:
        rows = describe(spark, view).select("col_name", "data_type").collect()  # a row for each column
    finally:
        spark.catalog.dropTempView(view)
    return spark.createDataFrame(rows, "col_name string, data_type string")


# ---- validation and parsing --------------------------------------------------------------

@query("require_fields", """SELECT event_id, NULLIF(event_type, 'error') AS symbol, value AS price,
       event_type = 'error' AS rejected FROM events""")
def _(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("symbol"),
        F.col("value").alias("price"),
    )
    needed = ["event_id", "symbol", "price"]
    kept = require_fields(rows, needed).withColumn("rejected", F.lit(False))
    return kept.unionByName(rejected(rows, needed).withColumn("rejected", F.lit(True)))


_MESSAGE = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("qty", T.LongType()),
    T.StructField("price", T.DoubleType()),
])


@query("json_cast", """SELECT event_id,
       CASE WHEN event_type = 'error' THEN NULL
            ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS qty,
       CASE WHEN event_type = 'signup' THEN NULL ELSE value END AS price FROM events""")
def _(spark, folder):
    """Numbers arrive as numbers, as text, as bad text and not at all."""
    qty = F.when(F.col("event_type") == "error", "n/a").otherwise(F.get_json_object("props", "$.k"))
    price = F.when(F.col("event_type") != "signup", F.col("value"))
    rows = table(spark, folder, "events").select(
        F.to_json(F.struct("event_id", qty.alias("qty"), price.alias("price"))).alias("value")
    )
    return parse_json(rows, _MESSAGE)


@query("replay_first_n", f"""WITH {S} SELECT event_id, symbol, arr FROM s WHERE symbol <> 'error'
ORDER BY arr, event_id LIMIT 50""")
def _(spark, folder):
    rows = arrivals(spark, folder).withColumn("symbol", F.nullif(F.col("symbol"), F.lit("error")))
    valid = require_fields(rows.select("event_id", "symbol", "arr"), ["event_id", "symbol", "arr"])
    return valid.orderBy("arr", "event_id").limit(50)


@query("clamp_discount", """SELECT event_id, LEAST(0.75::DOUBLE, GREATEST(0.05::DOUBLE, value / 100)) AS pct
FROM events""")
def _(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", clamp(F.col("value") / 100, 0.05, 0.75).alias("pct")
    )


@query("first_events", """SELECT event_id, ts, event_type, value FROM events
ORDER BY ts, event_id LIMIT 8""")
def _(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    return rows.orderBy("ts", "event_id").limit(8)


# ---- upsert ------------------------------------------------------------------------------

LATEST = """SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""


def _upserted(spark, folder):
    rows = table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(rows, ["user_id"], ["ts", "event_id"])


@query("upsert_latest", LATEST)
def _(spark, folder):
    return _upserted(spark, folder)


@query("upsert_point_lookup", f"SELECT * FROM ({LATEST}) WHERE user_id = 3 LIMIT 1")
def _(spark, folder):
    return _upserted(spark, folder).filter(F.col("user_id") == 3).limit(1)


@query("upsert_ids", "SELECT DISTINCT user_id FROM events ORDER BY user_id LIMIT 100")
def _(spark, folder):
    return _upserted(spark, folder).select("user_id").orderBy("user_id").limit(100)


@query("append_loads", f"""WITH {S} SELECT event_id, symbol, arr, CASE WHEN arr < {CUT_MS} THEN 0 ELSE 1 END
AS load_no FROM s""")
def _(spark, folder):
    first, second = _loads(spark, folder)
    columns = ["event_id", "symbol", "arr"]
    return append_loads(first.select(*columns), second.select(*columns))
