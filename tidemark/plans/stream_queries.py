"""Streaming runs over the given tables: each ends with what was there and is read back."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import composite_key, units
from tidemark.operators.clean import require_fields
from tidemark.operators.windows import tumbling_agg
from tidemark.plans.arrivals import HOUR, arrivals
from tidemark.plans.event_queries import CHAIN_TTL, LATEST, TUMBLING, WAIT, WIDE_EDGES, chain
from tidemark.plans.facts import order_lines, with_product
from tidemark.plans.oracle import FACTS, S, dedup, watermark
from tidemark.operators.latest import latest_per_key
from tidemark.plans.registry import ORACLES, query
from tidemark.plans.sales_queries import EXECUTIVE
from tidemark.session import scratch_path
from tidemark.sources.readers import json_stream, table, with_position
from tidemark.sources.sinks import write_keyed_json
from tidemark.streaming import changes, closing, repeats, reports, tables, windows
from tidemark.streaming.runs import (
    RunTotals, disk_state, first_records, read_batches, run_available, run_until_idle, taken, write_batch,
)


LOADS = 3


def _parquet_sink(stream: DataFrame, path: str):
    return stream.writeStream.format("parquet").option("path", f"{path}/out")


def _by_load(rows: DataFrame, order: str) -> list[DataFrame]:
    """All rows as loads of equal stretches of ``order``, a number."""
    low, high = rows.agg(F.min(order), F.max(order)).first()
    if low is None:
        return [rows]
    step = (high - low) // LOADS + 1
    return [rows.filter((F.col(order) >= low + i * step) & (F.col(order) < low + (i + 1) * step)) for i in range(LOADS)]


def _run_loads(
    spark: SparkSession, rows: DataFrame, order: str, path: str, start: Callable[[DataFrame], object],
    after: Callable[[int], None] = lambda load: None,
) -> None:
    """The loads reach a folder one after another; each is read by a new run on one checkpoint."""
    for number, load in enumerate(_by_load(rows, order)):
        load.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        with disk_state(spark):
            run_available(start(stream), f"{path}/checkpoint")
        after(number)


@query("stream_json_scan", f"WITH {S} SELECT event_id, symbol, price, qty, ms, arr FROM s")
def _(spark, folder):
    """The arrivals as a JSON log, scanned as a stream of one file a micro-batch."""
    path = scratch_path(spark, "json-scan")
    rows = arrivals(spark, folder).drop("user_id")
    rows.select(F.to_json(F.struct("*")).alias("value")).repartition(LOADS).write.text(f"{path}/log")
    stream = json_stream(spark, f"{path}/log", rows.schema, max_files=1)
    run_available(_parquet_sink(stream, path), f"{path}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{path}/out").select("event_id", "symbol", "price", "qty", "ms", "arr")


@query("keyed_json_rows", f"""WITH {S}, w AS ({TUMBLING} FROM s GROUP BY 1, 2, 3)
SELECT window_start_ms || '|' || symbol AS key, symbol, window_start_ms, count, sum_qty, gmv FROM w""")
def _(spark, folder):
    path = scratch_path(spark, "keyed-json")
    rows = tumbling_agg(arrivals(spark, folder), HOUR)
    write_keyed_json(rows, composite_key(F.col("window_start_ms"), F.col("symbol")), path)
    read = spark.read.schema("key string, value string").json(path)
    parsed = read.withColumn("v", F.from_json("value", rows.schema)).select("key", "v.*")
    return parsed.select(
        "key", "symbol", "window_start_ms", "count", "sum_qty", F.round("gmv", 4).alias("gmv")
    )


@query("watermark_window_stream", f"""WITH {S},
lim AS (SELECT MIN(arr) AS lo, (MAX(arr) - MIN(arr)) // {LOADS} + 1 AS step FROM s),
l AS (SELECT s.*, (arr - lo) // step AS load FROM s, lim),
tops AS (SELECT load, MAX(ms) AS top FROM l GROUP BY load),
marks AS (SELECT a.load, MAX(b.top) - {2 * HOUR} AS mark FROM tops a LEFT JOIN tops b ON b.load < a.load GROUP BY a.load),
w AS (SELECT user_id, ms - ms % {HOUR} AS window_start_ms, COUNT(*) AS count, ROUND(SUM(price), 6) AS sum
      FROM l JOIN marks USING (load) WHERE mark IS NULL OR ms - ms % {HOUR} + {HOUR} > mark GROUP BY 1, 2)
SELECT user_id, window_start_ms, window_start_ms + {HOUR} AS window_end_ms, count, sum FROM w
WHERE window_start_ms + {HOUR} <= (SELECT MAX(top) - {2 * HOUR} FROM tops)""")
def _(spark, folder):
    """Spark's own watermark over three loads: rows behind it are dropped, windows it did not pass stay open."""
    path = scratch_path(spark, "watermark")
    rows = arrivals(spark, folder).select("user_id", "ms", "price", "arr")

    def start(stream):
        timed = windows.with_event_time(stream, "ms")
        return _parquet_sink(windows.watermarked_windows(timed, "2 hours", "1 hour", ["user_id"], "price"), path)

    _run_loads(spark, rows, "arr", path, start)
    schema = "user_id long, window_start_ms long, window_end_ms long, count long, sum double"
    return spark.read.schema(schema).parquet(f"{path}/out").withColumn("sum", F.round("sum", 6))


@query("flushed_windows_stream", ORACLES["watermark_window_stream"].rsplit("WHERE", 1)[0])
def _(spark, folder):
    """The same three loads, then a marker that closes the windows which the watermark had not passed."""
    path = scratch_path(spark, "flushed")
    rows = windows.with_event_time(arrivals(spark, folder).select("user_id", "ms", "price", "arr"), "ms")
    closing.prepare_closing(spark, f"{path}/markers")

    def start(stream):
        both = closing.with_closing(stream, f"{path}/markers")
        return _parquet_sink(windows.watermarked_windows(both, "2 hours", "1 hour", ["user_id"], "price"), path)

    _run_loads(spark, rows, "arr", path, start)
    closing.close_stream(spark, f"{path}/markers")
    with disk_state(spark):
        run_available(start(spark.readStream.schema(rows.schema).parquet(f"{path}/in")), f"{path}/checkpoint")
    schema = "user_id long, window_start_ms long, window_end_ms long, count long, sum double"
    return spark.read.schema(schema).parquet(f"{path}/out").withColumn("sum", F.round("sum", 6))


@query("run_totals", f"""WITH {S} SELECT COUNT(*) AS input_rows FROM s""")
def _(spark, folder):
    """Rows that a run of many micro-batches took in, from its listener."""
    path = scratch_path(spark, "totals")
    rows = arrivals(spark, folder).select("event_id", "arr")
    with RunTotals(spark) as totals:
        _run_loads(spark, rows, "arr", path, lambda s: windows.idempotent_writer(s, f"{path}/out"))
    return table(spark, folder, "events").agg(F.lit(totals.input_rows).cast("long").alias("input_rows"))


@query("changelog_stream", f"WITH {S} {TUMBLING} FROM s GROUP BY 1, 2, 3")
def _(spark, folder):
    """Update mode over three loads; the last change of each key is its aggregate."""
    path = scratch_path(spark, "changelog")
    rows = arrivals(spark, folder)
    _run_loads(spark, rows, "arr", path, lambda s: windows.changelog_writer(tumbling_agg(s, HOUR), f"{path}/out"))
    changes = read_batches(spark, f"{path}/out", tumbling_agg(rows, HOUR).schema)
    last = latest_per_key(changes, ["symbol", "window_start_ms"], ["batch_id"])
    return last.select("symbol", "window_start_ms", "window_end_ms", "count", "sum_qty", F.round("gmv", 4).alias("gmv"))


@query("strict_window_stream", f"""WITH {watermark(WAIT)}
SELECT event_id, arr, ms, watermark_ms FROM m WHERE ms < watermark_ms""")
def _(spark, folder):
    """The late output of the record-level rule over three loads; one number is carried between them."""
    path = scratch_path(spark, "strict")
    rows = arrivals(spark, folder).select("event_id", "arr", "ms")
    _run_loads(spark, rows, "arr", path, lambda s: s.writeStream.foreachBatch(windows.strict_late_batches(path, WAIT)))
    late = read_batches(spark, f"{path}/late", windows.late_schema(rows.schema))
    return late.select("event_id", "arr", "ms", "watermark_ms")


@query("restart_idempotent", f"""WITH {S}, k AS (SELECT DISTINCT event_id, symbol, price, qty, ms FROM s)
{TUMBLING} FROM k GROUP BY 1, 2, 3""")
def _(spark, folder):
    """Three loads; every batch is delivered to the sink twice, as after a crash between write and commit.

    Deduplication by id and one output folder per batch leave the totals as if nothing had happened.
    """
    path = scratch_path(spark, "restart")
    rows = arrivals(spark, folder)

    def write(df: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            write_batch(tumbling_agg(df, HOUR), f"{path}/out", batch_id)

    def start(stream):
        return windows.dedup_within(windows.with_event_time(stream, "ms"), "event_id", "12 hours").writeStream.foreachBatch(write)

    _run_loads(spark, rows, "arr", path, start)
    totals = read_batches(spark, f"{path}/out", tumbling_agg(rows, HOUR).schema)
    return totals.groupBy("symbol", "window_start_ms", "window_end_ms").agg(
        F.sum("count").alias("count"), F.sum("sum_qty").alias("sum_qty"),
        F.round(F.sum("gmv"), 4).alias("gmv"),
    )


@query("upsert_stream", LATEST)
def _(spark, folder):
    """Three loads, compacted after the second."""
    path = scratch_path(spark, "upsert")
    keys, version = ["user_id"], ["ts", "event_id"]
    rows = table(spark, folder, "events").drop("props")

    def after(load: int) -> None:
        if load == 1:
            tables.compact_upsert(spark, path, keys, version, rows.schema)

    _run_loads(spark, rows, "event_id", path, lambda s: tables.upsert_writer(with_position(s), path, keys, version), after)
    return tables.read_upsert(spark, path, keys, version, rows.schema)


@query("orders_append", f"""WITH {FACTS} SELECT CAST(date_trunc('month', event_time) AS DATE) AS order_date, COUNT(*) AS lines,
CAST(SUM(gross) AS DOUBLE) AS gross FROM f GROUP BY 1""")
def _(spark, folder):
    """Raw order lines appended in folders by month, as the tables span years; every batch is delivered twice."""
    path = scratch_path(spark, "orders")
    lines = order_lines(spark, folder)

    def twice(df: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            tables.append_orders(df, f"{path}/out", batch_id, "month")

    _run_loads(spark, lines, "order_id", path, lambda s: s.writeStream.foreachBatch(twice))
    days = tables.read_orders(spark, f"{path}/out", lines.schema)
    return days.groupBy("order_date").agg(F.count("*").alias("lines"), units(F.sum("gross")).alias("gross"))


@query("kpi_stream", EXECUTIVE)
def _(spark, folder):
    """Executive KPIs kept current over three loads, read back from their snapshot."""
    path = scratch_path(spark, "kpi")
    lines = with_product(order_lines(spark, folder), spark, folder).select("order_id", "gross", "net_revenue", "cogs", "status")
    _run_loads(spark, lines, "order_id", path, lambda s: tables.kpi_writer(s, path))
    return tables.kpi_snapshot(spark, path).withColumn("avg_ticket", F.round("avg_ticket", 6))


@query("dedup_stream", f"WITH {dedup(12 * HOUR)} SELECT event_id, symbol, ms FROM k")
def _(spark, folder):
    """Deduplication over three loads with a bounded state: ids are kept for 12 hours of event time."""
    path = scratch_path(spark, "dedup")
    rows = arrivals(spark, folder).select("event_id", "symbol", "ms", "arr")

    def start(stream):
        once = windows.dedup_within(windows.with_event_time(stream, "ms"), "event_id", "12 hours")
        return _parquet_sink(once, path)

    _run_loads(spark, rows, "arr", path, start)
    return spark.read.schema("event_id long, symbol string, ms long").parquet(f"{path}/out")


# ---- state with a life of its own --------------------------------------------------------

@query("dedup_chain_stream", f"""WITH {chain('user_id', CHAIN_TTL)} SELECT s.event_id, s.user_id, s.arr,
NOT (k.arr IS NOT NULL AND s.event_id = MIN(s.event_id) OVER (PARTITION BY s.user_id, s.arr)) AS duplicate
FROM s LEFT JOIN k ON k.user_id = s.user_id AND k.arr = s.arr""")
def _(spark, folder):
    """Every record with its duplicate flag, over three loads: a user is forgotten six hours after the kept record and comes back."""
    path = scratch_path(spark, "chain-stream")
    rows = arrivals(spark, folder).select("event_id", "user_id", "arr")

    def start(stream):
        return _parquet_sink(repeats.flag_repeats(stream, "user_id", CHAIN_TTL), path)

    _run_loads(spark, rows, "arr", path, start)
    return spark.read.schema("event_id long, user_id long, arr long, duplicate boolean").parquet(f"{path}/out")


@query("record_changelog_stream", ORACLES["agg_changelog"])
def _(spark, folder):
    """A change per record over three loads: totals are carried from load to load."""
    path = scratch_path(spark, "record-changelog")
    rows = arrivals(spark, folder).drop("user_id")
    _run_loads(spark, rows, "arr", path, lambda s: changes.record_changelog_writer(s, f"{path}/out", HOUR))
    found = read_batches(spark, f"{path}/out", changes.changelog_schema(rows.schema))
    return found.select("event_id", "arr", "key", "count", "sum_qty", F.round("gmv", 4).alias("gmv"))


@query("delay_report_stream", ORACLES["delay_report"])
def _(spark, folder):
    """Reports over three loads: counters restart with each interval, the ids that were seen stay."""
    path = scratch_path(spark, "reports")
    rows = arrivals(spark, folder).select("event_id", "arr", "ms")
    _run_loads(spark, rows, "arr", path, lambda s: reports.delay_report_writer(s, path, HOUR, WIDE_EDGES))
    out = reports.read_reports(spark, path, HOUR, WIDE_EDGES)
    return out.withColumn("rate", F.round("rate", 6))


_STRICT_LOADS = f"""{watermark(WAIT)},
lim AS (SELECT MIN(arr) AS lo, (MAX(arr) - MIN(arr)) // {LOADS} + 1 AS step FROM s),
l AS (SELECT m.*, (arr - lo) // step AS load FROM m, lim),
marks AS (SELECT load, MAX(MAX(ms)) OVER (ORDER BY load) - {WAIT} AS mark FROM l GROUP BY load),
w AS (SELECT user_id, ms - ms % {HOUR} AS window_start_ms, COUNT(*) AS count, ROUND(SUM(price), 6) AS sum, MIN(load) AS opened
      FROM l WHERE ms >= watermark_ms GROUP BY 1, 2),
z AS (SELECT w.*, (SELECT MIN(load) FROM marks WHERE mark >= window_start_ms + {HOUR}) AS closed FROM w)"""


def _strict_run(spark, folder, path):
    rows = arrivals(spark, folder).select("event_id", "user_id", "arr", "ms", "price")
    write = closing.strict_window_batches(path, WAIT, HOUR, ["user_id"], "price")
    _run_loads(spark, rows, "arr", path, lambda s: s.writeStream.foreachBatch(write))
    return rows


@query("strict_flush_stream", f"WITH {_STRICT_LOADS} SELECT user_id, window_start_ms, count, sum FROM w")
def _(spark, folder):
    """All windows of the record-level rule: those closed by three loads and those that the end closes."""
    path = scratch_path(spark, "strict-flush")
    rows = _strict_run(spark, folder, path)
    found = closing.read_strict_windows(spark, path, rows.select("user_id").schema)
    return found.withColumn("sum", F.round("sum", 6))


@query("run_figures", f"""WITH {_STRICT_LOADS}
SELECT marks.load AS batch_id, n.input_rows, n.late_rows, marks.mark AS watermark_ms,
  (SELECT COUNT(*) FROM z WHERE closed = marks.load) AS closed_windows,
  (SELECT COUNT(*) FROM z WHERE opened <= marks.load AND (closed IS NULL OR closed > marks.load)) AS open_windows
FROM marks JOIN (SELECT load, COUNT(*) AS input_rows, COUNT(*) FILTER (ms < watermark_ms) AS late_rows FROM l GROUP BY load) n USING (load)""")
def _(spark, folder):
    """Late records, closed and open windows of every batch, stored with the batch."""
    path = scratch_path(spark, "figures")
    _strict_run(spark, folder, path)
    return closing.run_figures(spark, path).select(
        "batch_id", "input_rows", "late_rows", "watermark_ms", "closed_windows", "open_windows")


# ---- runs that end by themselves, and timed micro-batches --------------------------------

IDLE_S, GAP_S, FLUSH_S = 6, 2, 3


def _deliver(loads: list[DataFrame], path: str) -> threading.Thread:
    """The loads reach the log one by one while the query runs."""
    def put() -> None:
        for load in loads:
            load.write.mode("append").parquet(path)
            time.sleep(GAP_S)

    thread = threading.Thread(target=put)
    thread.start()
    return thread


@query("replay_until_idle", f"WITH {S} SELECT event_id, symbol, arr FROM s")
def _(spark, folder):
    """A running query over files that arrive late; it stops by itself once none came for some seconds."""
    path = scratch_path(spark, "idle")
    rows = arrivals(spark, folder).select("event_id", "symbol", "arr")
    spark.createDataFrame([], rows.schema).write.parquet(f"{path}/in")
    thread = _deliver(_by_load(rows, "arr"), f"{path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
    run_until_idle(windows.idempotent_writer(stream, f"{path}/out"), f"{path}/checkpoint", IDLE_S)
    thread.join()
    return read_batches(spark, f"{path}/out", rows.schema).drop("batch_id")


@query("replay_first_n_stream", f"""WITH {S}, v AS (SELECT *, ROW_NUMBER() OVER (ORDER BY arr, event_id) AS n FROM s WHERE symbol <> 'error')
SELECT event_id, symbol, arr FROM v WHERE n <= (SELECT COUNT(*) // 2 FROM events)""")
def _(spark, folder):
    """The first n valid records over micro-batches, n half the events; the query stops when it has them."""
    path = scratch_path(spark, "first-n")
    rows = arrivals(spark, folder).select("event_id", F.nullif(F.col("symbol"), F.lit("error")).alias("symbol"), "arr")
    wanted = table(spark, folder, "events").count() // 2
    spark.createDataFrame([], rows.schema).write.parquet(f"{path}/in")
    thread = _deliver(_by_load(rows, "arr"), f"{path}/in")
    valid = require_fields(spark.readStream.schema(rows.schema).parquet(f"{path}/in"), ["event_id", "symbol", "arr"])
    writer = valid.writeStream.foreachBatch(first_records(f"{path}/out", wanted, ["arr", "event_id"]))
    run_until_idle(writer, f"{path}/checkpoint", IDLE_S, enough=lambda: taken(spark, f"{path}/out") >= wanted)
    thread.join()
    return read_batches(spark, f"{path}/out/rows", rows.schema).drop("batch_id")


@query("timed_batches", f"""WITH {S}, f AS (SELECT event_id % 6 AS file, COUNT(*) AS n FROM s GROUP BY 1)
SELECT COUNT(*) // 2 AS batches, CAST(2 AS BIGINT) AS most_files, CAST(SUM(n) AS BIGINT) AS input_rows, true AS spaced FROM f""")
def _(spark, folder):
    """Six files, two a micro-batch, a flush every three seconds: batches, files of the largest, rows, and whether the flushes kept their distance."""
    path = scratch_path(spark, "timed")
    rows = arrivals(spark, folder).select("event_id", "arr").withColumn("file", F.col("event_id") % 6)
    rows.repartition(6, "file").write.partitionBy("file").parquet(f"{path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    starts: dict[int, float] = {}

    def write(df: DataFrame, batch_id: int) -> None:
        starts[batch_id] = time.monotonic()
        write_batch(df, f"{path}/out", batch_id)

    run_until_idle(stream.writeStream.foreachBatch(write), f"{path}/checkpoint", 2 * FLUSH_S, f"{FLUSH_S} seconds")
    times = [starts[b] for b in sorted(starts)]
    spaced = all(b - a > FLUSH_S - 1 for a, b in zip(times[1:], times[2:]))  # the first flush starts at once
    found = read_batches(spark, f"{path}/out", rows.schema)
    per_batch = found.groupBy("batch_id").agg(F.count_distinct("file").alias("files"), F.count("*").alias("rows"))
    return per_batch.agg(F.count("*").alias("batches"), F.max("files").alias("most_files"), F.sum("rows").alias("input_rows"),
                         F.lit(spaced).alias("spaced"))
