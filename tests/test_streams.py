"""Streams give what the batch form gives, over several micro-batches and restarts."""

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.arrival import late_rows, on_time_rows, running_watermark, strict_windows
from tidemark.operators.clean import parse_json
from tidemark.operators.latest import latest_per_key
from tidemark.operators.delays import delay_report
from tidemark.operators.windows import agg_changelog, tumbling_agg
from tidemark.plans import kpis
from tidemark.plans.arrivals import HOUR, arrivals
from tidemark.plans.facts import order_lines, with_product
from tidemark.session import scratch_path
from tidemark.plans import event_queries, stream_queries  # noqa: F401
from tidemark.plans.registry import PLANS
from tidemark.sources.readers import json_stream, kafka_stream, with_position
from tidemark.streaming import changes, closing, repeats, reports, tables, windows
from tidemark.streaming.runs import (
    RunTotals, batch_path, complete_batches, disk_state, first_records, read_batches, run_available, run_continuously,
    run_until_idle, taken, write_batch,
)
from test_fixtures import ORDER_SCHEMA, upsert_loads


def run_loads(spark, frames, path, writer_of):
    """Append each frame to a folder and run the stream on what is new."""
    for frame in frames:
        frame.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(frame.schema).parquet(f"{path}/in")
        run_available(writer_of(stream), f"{path}/checkpoint", timeout_s=300)


def slices(rows, parts):
    low, high = rows.agg(F.min("arr"), F.max("arr")).first()
    step = (high - low) // parts + 1
    starts = [low + i * step for i in range(parts)]
    return [rows.filter((F.col("arr") >= s) & (F.col("arr") < s + step)) for s in starts]


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_strict_late_rule_over_batches(spark, small):
    path = scratch_path(spark, "test-strict")
    rows = arrivals(spark, small).select("event_id", "arr", "ms")
    write = windows.strict_late_batches(path, 5 * HOUR)
    run_loads(spark, slices(rows, 3), path, lambda s: s.writeStream.foreachBatch(write))
    assert complete_batches(spark, f"{path}/carry") == [0, 1, 2]
    marked = running_watermark(rows, 5 * HOUR)
    columns = ["event_id", "arr", "ms", "max_ms", "watermark_ms"]
    schema = windows.late_schema(rows.schema)
    assert as_set(read_batches(spark, f"{path}/late", schema).select(columns)) == as_set(late_rows(marked).select(columns))
    assert as_set(read_batches(spark, f"{path}/on_time", schema).select(columns)) == as_set(on_time_rows(marked).select(columns))
    # a repeated batch replaces its own output
    before = as_set(read_batches(spark, f"{path}/late", schema))
    write(slices(rows, 3)[1], 1)
    assert as_set(read_batches(spark, f"{path}/late", schema)) == before


@pytest.mark.parametrize("idempotent", [True, False])
def test_delivery_after_a_crash(spark, idempotent):
    path = scratch_path(spark, "test-delivery")
    spark.range(10).write.parquet(f"{path}/in")
    crash = {"armed": True}

    def write(df, batch_id):
        if idempotent:
            write_batch(df, f"{path}/out", batch_id)
        else:
            df.write.mode("append").parquet(f"{path}/out")
        if crash.pop("armed", None):
            raise RuntimeError("crash")

    def run():
        stream = spark.readStream.schema("id long").parquet(f"{path}/in")
        run_available(stream.writeStream.foreachBatch(write), f"{path}/checkpoint", timeout_s=300)

    with pytest.raises(StreamingQueryException):
        run()
    run()
    run()  # nothing new, nothing repeated
    assert spark.read.parquet(f"{path}/out").count() == (10 if idempotent else 20)


def test_writers(spark):
    path = scratch_path(spark, "test-writers")
    spark.range(6).write.parquet(f"{path}/in")
    stream = spark.readStream.schema("id long").parquet(f"{path}/in")
    run_available(windows.append_writer(stream, f"{path}/a"), f"{path}/checkpoint-a", timeout_s=300)
    run_available(windows.idempotent_writer(stream, f"{path}/b"), f"{path}/checkpoint-b", timeout_s=300)
    assert spark.read.parquet(f"{path}/a").count() == 6
    assert read_batches(spark, f"{path}/b", stream.schema).count() == 6


def test_changelog_stream(spark, small):
    path = scratch_path(spark, "test-changelog")
    rows = arrivals(spark, small)
    run_loads(spark, slices(rows, 2), path,
              lambda s: windows.changelog_writer(tumbling_agg(s, 24 * HOUR), f"{path}/out"))
    changes = read_batches(spark, f"{path}/out", tumbling_agg(rows, 24 * HOUR).schema)
    last = latest_per_key(changes, ["symbol", "window_start_ms"], ["batch_id"])
    columns = ["symbol", "window_start_ms", "count", "sum_qty"]
    assert as_set(last.select(columns)) == as_set(tumbling_agg(rows, 24 * HOUR).select(columns))
    assert changes.count() > last.count()


def test_upsert_stream(spark):
    path = scratch_path(spark, "test-upsert")
    keys, version = ["order_id"], ["event_time"]
    run_loads(spark, upsert_loads(spark), path,
              lambda s: tables.upsert_writer(s, path, keys, version))
    rows = tables.read_upsert(spark, path, keys, version, ORDER_SCHEMA)
    assert rows.count() == 12
    assert rows.filter("order_id = 3").first().status == "PAID"
    before = as_set(rows)
    tables.compact_upsert(spark, path, keys, version, ORDER_SCHEMA)
    assert as_set(tables.read_upsert(spark, path, keys, version, ORDER_SCHEMA)) == before
    more = spark.createDataFrame([(4, "C004", "PAID", 1.0, 1_730_000_009_999)], ORDER_SCHEMA)
    run_loads(spark, [more], path, lambda s: tables.upsert_writer(s, path, keys, version))
    rows = tables.read_upsert(spark, path, keys, version, ORDER_SCHEMA)
    assert rows.count() == 12
    assert rows.filter("order_id = 4").first().status == "PAID"


def test_equal_versions_take_the_later_batch(spark):
    path = scratch_path(spark, "test-ties")
    frames = [spark.createDataFrame([(1, "C1", s, 1.0, 5)], ORDER_SCHEMA) for s in ("CREATED", "PAID")]
    run_loads(spark, frames, path,
              lambda s: tables.upsert_writer(s, path, ["order_id"], ["event_time"]))
    assert tables.read_upsert(spark, path, ["order_id"], ["event_time"], ORDER_SCHEMA).first().status == "PAID"


def test_equal_versions_of_one_batch_take_the_later_position(spark):
    path = scratch_path(spark, "test-positions")
    frame = spark.createDataFrame([(1, "C1", s, 1.0, 5) for s in ("CREATED", "SHIPPED", "PAID")], ORDER_SCHEMA).coalesce(1)
    run_loads(spark, [frame], path, lambda s: tables.upsert_writer(with_position(s), path, ["order_id"], ["event_time"]))
    assert tables.read_upsert(spark, path, ["order_id"], ["event_time"], ORDER_SCHEMA).first().status == "PAID"


def test_incomplete_batches_are_not_read(spark):
    path = scratch_path(spark, "test-incomplete")
    write_batch(spark.range(3), path, 0)
    spark.range(5).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(batch_path(path, 1))
    assert read_batches(spark, path, spark.range(0).schema).count() == 3
    assert read_batches(spark, f"{path}-none", spark.range(0).schema).columns == ["id", "batch_id"]


def kpi_parts(spark, small):
    lines = with_product(order_lines(spark, small), spark, small).select(
        "order_id", "gross", "net_revenue", "cogs", "status")
    # orders split over batches are counted once
    return lines, [lines.filter("gross < 2000000"), lines.filter("gross >= 2000000 AND order_id % 2 = 0"), lines.filter("gross >= 2000000 AND order_id % 2 = 1")]


def test_kpi_snapshot_over_batches(spark, small):
    path = scratch_path(spark, "test-kpi")
    assert tables.kpi_snapshot(spark, path) is None
    lines, parts = kpi_parts(spark, small)
    with disk_state(spark):
        run_loads(spark, parts, path, lambda s: tables.kpi_writer(s, path))
    assert as_set(tables.kpi_snapshot(spark, path)) == as_set(kpis.executive(lines))
    assert complete_batches(spark, f"{path}/totals") == [1, 2]  # older totals are gone


@pytest.mark.parametrize("crash_at", ["write_batch", "write_snapshot", "forget_batches"])
def test_no_torn_kpi_figures(spark, monkeypatch, crash_at):
    """A crash after any write leaves whole figures, and the restarted stream ends with the right ones."""
    path = scratch_path(spark, "test-torn")
    schema = "order_id long, gross long, net_revenue long, cogs long, status string"
    batches = [spark.createDataFrame([(i, 100, 100, 0, "PAID"), (7, 100, 100, 0, "PAID")], schema) for i in range(2)]
    with disk_state(spark):
        run_loads(spark, batches[:1], path, lambda s: tables.kpi_writer(s, path))
        real = getattr(tables, crash_at)

        def failing(*args, **named):
            real(*args, **named)
            raise RuntimeError("crash")

        monkeypatch.setattr(tables, crash_at, failing)
        with pytest.raises(StreamingQueryException):
            run_loads(spark, batches[1:], path, lambda s: tables.kpi_writer(s, path))
        monkeypatch.undo()
        assert tuple(tables.kpi_snapshot(spark, path).first()) in {(2.0, 2.0, 1.0), (4.0, 4.0, 4.0 / 3)}
        stream = spark.readStream.schema(schema).parquet(f"{path}/in")
        run_available(tables.kpi_writer(stream, path), f"{path}/checkpoint", timeout_s=300)
    assert tuple(tables.kpi_snapshot(spark, path).first()) == (4.0, 4.0, 4.0 / 3)


def test_ids_expire_and_come_back(spark):
    """The flag over batches equals the rule in plain Python; state of ids whose limit is over is gone."""
    path = scratch_path(spark, "test-flags")
    rng = random.Random(11)
    rows = sorted((rng.randrange(100_000), i, f"id{rng.randrange(8)}" if i % 40 else None, None) for i in range(400))
    rows = [(at, i, ident, note) for at, i, ident, note in rows]
    schema = "arr long, event_id long, name string, note string"
    loads = [rows[:150], rows[150:151], rows[151:300], rows[300:]]
    want, kept = {}, {}
    for at, i, ident, _ in rows:
        if ident is not None:
            want[i] = ident in kept and at - kept[ident] <= 3_000
            if not want[i]:
                kept[ident] = at
    frames = [spark.createDataFrame(load, schema) for load in loads]
    with disk_state(spark):
        run_loads(spark, frames, path, lambda s: windows.idempotent_writer(repeats.flag_repeats(s, "name", 3_000), f"{path}/out"))
        late = spark.createDataFrame([(10_000_000, 1, "last", None)], schema)
        with RunTotals(spark) as totals:
            run_loads(spark, [late, spark.createDataFrame([(10_000_001, 2, "last", None)], schema)], path,
                      lambda s: windows.idempotent_writer(repeats.flag_repeats(s, "name", 3_000), f"{path}/out"))
    got = read_batches(spark, f"{path}/out", StructType.fromDDL(schema + ", duplicate boolean")).filter("arr < 1000000").collect()
    assert {r["event_id"]: r["duplicate"] for r in got} == want and len(got) == len(want)
    assert totals.ended == 2


def test_reports_of_batches(spark):
    path = scratch_path(spark, "test-reports")
    rng = random.Random(4)
    rows = sorted((rng.randrange(20_000), rng.choice([None, *range(120)])) for _ in range(500))
    rows = [(i, at, None if at % 17 == 0 else at - rng.randrange(70_000)) for at, i in rows]
    schema = "event_id long, arr long, ms long"
    loads = [rows[:10], rows[10:300], rows[300:301], rows[301:]]
    run_loads(spark, [spark.createDataFrame(load, schema) for load in loads], path, lambda s: reports.delay_report_writer(s, path, 2_000))
    want = delay_report(spark.createDataFrame(rows, schema), 2_000)
    got = reports.read_reports(spark, path, 2_000)
    assert as_set(got.select(sorted(got.columns))) == as_set(want.select(sorted(got.columns)))
    assert got.count() == want.count()


def test_changes_of_a_hot_and_a_null_key(spark):
    path = scratch_path(spark, "test-changes")
    rng = random.Random(9)
    rows = [(i, i * 10, rng.randrange(50_000), rng.choice(["HOT", "HOT", "A", None]), float(rng.randrange(9)), rng.randrange(5)) for i in range(400)]
    schema = "event_id long, arr long, ms long, symbol string, price double, qty long"
    frames = [spark.createDataFrame(part, schema) for part in (rows[:100], rows[100:101], rows[101:])]
    run_loads(spark, frames, path, lambda s: changes.record_changelog_writer(s, f"{path}/out", 20_000))
    frame = spark.createDataFrame(rows, schema)
    columns = ["event_id", "symbol", "window_start_ms", "count", "sum_qty", "gmv"]
    got = read_batches(spark, f"{path}/out", changes.changelog_schema(frame.schema)).select(columns)
    assert as_set(got) == as_set(agg_changelog(frame, 20_000).select(columns)) and got.count() == 400


def test_strict_windows_over_batches(spark):
    path = scratch_path(spark, "test-strict-windows")
    rng = random.Random(2)
    rows = [(i, i * 100, i * 100 - rng.randrange(6_000), f"u{rng.randrange(3)}", 1.0) for i in range(300)]
    schema = "event_id long, arr long, ms long, user string, amount double"
    frames = [spark.createDataFrame(part, schema) for part in (rows[:120], rows[120:121], rows[121:])]
    write = closing.strict_window_batches(path, 2_000, 3_000, ["user"])
    run_loads(spark, frames, path, lambda s: s.writeStream.foreachBatch(write))
    write(frames[2], 2)  # a repeated batch
    marked = running_watermark(spark.createDataFrame(rows, schema), 2_000)
    want = strict_windows(marked, 3_000).select("user", "window_start_ms", "count", "sum")
    assert as_set(closing.read_strict_windows(spark, path, frames[0].select("user").schema)) == as_set(want)
    figures = closing.run_figures(spark, path).orderBy("batch_id").collect()
    assert [r["input_rows"] for r in figures] == [120, 1, 179]
    assert sum(r["late_rows"] for r in figures) == late_rows(marked).count()
    assert sum(r["closed_windows"] for r in figures) + figures[-1]["open_windows"] == want.count()
    write(spark.createDataFrame([], schema), 3)  # an empty batch changes nothing
    assert as_set(closing.read_strict_windows(spark, path, frames[0].select("user").schema)) == as_set(want)


def test_idle_run_surfaces_a_failure(spark):
    path = scratch_path(spark, "test-idle")
    spark.range(3).write.parquet(f"{path}/in")
    stream = spark.readStream.schema("id long").parquet(f"{path}/in")

    def fail(df, batch_id):
        raise RuntimeError("crash")

    with pytest.raises(StreamingQueryException):
        run_until_idle(stream.writeStream.foreachBatch(fail), f"{path}/checkpoint", 30)
    run_until_idle(windows.idempotent_writer(stream, f"{path}/out"), f"{path}/checkpoint", 2)
    assert read_batches(spark, f"{path}/out", stream.schema).count() == 3


def test_first_records_of_repeated_batches(spark):
    path = scratch_path(spark, "test-first")
    write = first_records(path, 5, ["id"])
    for batch_id, (low, high) in enumerate([(0, 3), (3, 10), (10, 12)]):
        for _ in range(2):
            write(spark.range(low, high), batch_id)
    assert sorted(r["id"] for r in read_batches(spark, f"{path}/rows", spark.range(0).schema).collect()) == [0, 1, 2, 3, 4]
    assert taken(spark, path) == 5


def test_folders_of_part_files(spark, small, tmp_path):
    """Streams give the same from a table of many files as from one file."""
    for name in ("events", "lineitem", "orders", "part", "supplier", "nation", "region"):
        rows = spark.read.parquet(f"{small}/{name}.parquet")
        rows.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("stream_json_scan", "restart_idempotent", "orders_append", "kpi_stream", "upsert_stream", "dedup_chain", "pctl_wide"):
        assert as_set(PLANS[name](spark, str(tmp_path))) == as_set(PLANS[name](spark, small)), name


def test_json_stream_is_tolerant(spark):
    path = scratch_path(spark, "test-json")
    schema = spark.range(0).selectExpr("id", "CAST(id AS DOUBLE) AS price").schema
    lines = spark.createDataFrame([('{"id": "7", "price": 1}',), ("{oops",)], "value string")
    lines.write.text(f"{path}/in")
    stream = json_stream(spark, f"{path}/in", schema, max_files=1)
    writer = stream.writeStream.format("parquet").option("path", f"{path}/out")
    run_available(writer, f"{path}/checkpoint", timeout_s=300)
    assert as_set(spark.read.parquet(f"{path}/out")) == {(7, 1.0), (None, None)} == as_set(parse_json(lines, schema))


def test_continuous_run(spark):
    path = scratch_path(spark, "test-continuous")
    spark.range(3).write.parquet(f"{path}/in")
    stream = spark.readStream.schema("id long").parquet(f"{path}/in")
    query = run_continuously(windows.idempotent_writer(stream, f"{path}/out"), f"{path}/checkpoint", "1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert read_batches(spark, f"{path}/out", stream.schema).count() == 3


def test_run_totals(spark):
    path = scratch_path(spark, "test-state")
    times = [(i, 3_600_000 + i * 60_000) for i in range(10)] + [(10, 3_600_000)]
    stream_rows = spark.createDataFrame(times, "event_id long, ms long")
    with RunTotals(spark) as totals, disk_state(spark):
        for load in (stream_rows.filter("event_id < 10"), stream_rows.filter("event_id = 10")):
            load.write.mode("append").parquet(f"{path}/in")
            stream = spark.readStream.schema(load.schema).parquet(f"{path}/in")
            once = windows.dedup_within(windows.with_event_time(stream, "ms"), "event_id", "1 minute")
            run_available(windows.idempotent_writer(once, f"{path}/out"), f"{path}/checkpoint", timeout_s=300)
    assert (totals.late_rows, totals.input_rows, totals.state_rows, totals.ended) == (1, 11, 10, 2)


def test_kafka_needs_its_connector(spark):
    with pytest.raises(RuntimeError, match="connector"):
        kafka_stream(spark, "localhost:1", "t", spark.range(0).schema)
