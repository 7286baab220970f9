"""Fixed inputs with known results."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S
from tidemark.operators.arrival import (
    class_counts, close_lags, late_rows, running_watermark, strict_windows, timeliness,
)
from tidemark.operators.clean import parse_json, rejected, require_fields
from tidemark.operators.delays import percentile_low
from tidemark.operators.latest import append_loads, compacted, latest_per_key
from tidemark.operators.lookup import target_vs_actual, with_targets
from tidemark.plans.bronze import bronze_frame_style, bronze_sql_style, gmv_by_channel, gold_kpis
from tidemark.session import scratch_path
from tidemark.sources import readers, sinks
from tidemark.streaming import tables

WATERMARK_EVENTS = [
    (1, "alice", 5.0, 0), (2, "bob", 3.0, 4), (3, "alice", 7.0, 12), (4, "alice", 2.0, 8),
    (5, "bob", 4.0, 16), (6, "bob", 6.0, 5), (7, "alice", 1.0, 26), (8, "alice", 10.0, 2),
]
BASE = 1_700_000_000_000


@pytest.fixture(scope="module")
def eight(spark):
    rows = [(seq, user, amount, BASE + t * 1000, BASE + seq) for seq, user, amount, t in WATERMARK_EVENTS]
    return spark.createDataFrame(rows, "event_id long, user string, amount double, ms long, arr long")


@pytest.mark.parametrize("wait, late, cells", [
    (0, [4, 6, 8], {("alice", 0): (1, 5), ("bob", 0): (1, 3), ("alice", 10): (1, 7),
                    ("bob", 10): (1, 4), ("alice", 20): (1, 1)}),
    (5, [6, 8], {("alice", 0): (2, 7), ("bob", 0): (1, 3), ("alice", 10): (1, 7),
                 ("bob", 10): (1, 4), ("alice", 20): (1, 1)}),
    (20, [8], {("alice", 0): (2, 7), ("bob", 0): (2, 9), ("alice", 10): (1, 7),
               ("bob", 10): (1, 4), ("alice", 20): (1, 1)}),
])
def test_strict_windows(eight, wait, late, cells):
    marked = running_watermark(eight, wait * 1000)
    assert sorted(r.event_id for r in late_rows(marked).collect()) == late
    got = {
        (r.user, (r.window_start_ms - BASE) // 1000): (r["count"], r["sum"])
        for r in strict_windows(marked, 10_000, ["user"], F.col("amount")).collect()
    }
    assert got == cells


def test_close_lag(eight):
    marked = running_watermark(eight, 5_000)
    windows = strict_windows(marked, 10_000, ["user"], F.col("amount"))
    lags = {
        (r.user, (r.window_end_ms - BASE) // 1000): r.close_arr
        for r in close_lags(eight, windows, 10_000, 5_000).collect()
    }
    # record 5 (16 s) brings the watermark to 11 s, record 7 (26 s) to 21 s; nothing reaches 30 s
    assert lags == {("alice", 10): BASE + 5, ("bob", 10): BASE + 5,
                    ("alice", 20): BASE + 7, ("bob", 20): BASE + 7, ("alice", 30): None}


def test_timeliness_edges(spark):
    rows = [(1, 1000, 1000), (2, 700, 60_700), (3, 700, 60_701), (4, 699, 60_702), (5, 1001, 60_703)]
    df = spark.createDataFrame(rows, "event_id long, ms long, arr long")
    marked = running_watermark(df, 300).withColumn("color", timeliness(60_000))
    # equal to the watermark is not red, a delay of exactly the limit is green
    assert {r.event_id: r.color for r in marked.collect()} == {
        1: "green", 2: "green", 3: "orange", 4: "red", 5: "green"}
    counts = class_counts(marked.filter(F.col("color") != "orange")).collect()
    assert {r.color: r.n for r in counts} == {"green": 3, "orange": 0, "red": 1}
    assert {r.dlq_count for r in counts} == {1}


@pytest.mark.parametrize("values, percent, want", [
    ([1, 2, 3], 95, 2), (range(1, 11), 50, 5), (range(1, 11), 95, 9), ([7], 95, 7), ([-3, -1, 4], 50, -1),
])
def test_percentile_low(spark, values, percent, want):
    df = spark.createDataFrame([(0, v) for v in values], "g int, v long")
    assert percentile_low(df, ["g"], "v", [percent], width=4).first()[f"p{percent}"] == want
    assert percentile_low(df, [], "v", [percent], width=4).first()[f"p{percent}"] == want


def test_bucket_edges(spark):
    edges = {-5: 0, 999: 0, 1000: 1, 4999: 1, 5000: 2, 15_000: 3, 59_999: 3, 60_000: 4}
    df = spark.createDataFrame([(v,) for v in edges], "v long")
    got = {r.v: r.b for r in df.withColumn("b", S.bucket_index(F.col("v"))).collect()}
    assert got == edges


def test_scalars(spark):
    row = spark.range(1).select(
        S.window_start_ms(F.lit(-1), 60_000).alias("floor"),
        S.delay_ms(F.lit(50), F.lit(None).cast("long")).alias("no_time"),
        S.clamp(F.lit(0.9), 0.05, 0.75).alias("high"),
        S.clamp(F.lit(0.01), 0.05, 0.75).alias("low"),
        S.padded_id("RT-", F.lit(42), 9).alias("padded"),
        S.composite_key(F.lit(60_000), F.lit("SYM1")).alias("key"),
        S.cyclic(["a", "b", "c"], F.lit(5)).alias("cyclic"),
        S.iso_utc(F.lit(datetime(2026, 2, 20, 14, 3, 9, 999)).cast("timestamp_ntz")).alias("iso"),
        S.units(S.share(S.cents(F.lit(26.75)), S.rate(F.lit(0.1)))).alias("tie"),
        S.units(S.share(S.cents(F.lit(-26.75)), S.rate(F.lit(0.1)))).alias("negative_tie"),
        S.units(S.share(S.cents(F.lit(100.0)), S.rate(F.lit(-0.0)))).alias("negative_zero"),
    ).first()
    assert row.floor == -60_000 and row.no_time == 0
    assert (row.high, row.low) == (0.75, 0.05)
    assert (row.padded, row.key, row.cyclic) == ("RT-000000042", "60000|SYM1", "c")
    assert row.iso == "2026-02-20T14:03:09Z"
    assert (row.tie, row.negative_tie, row.negative_zero) == (2.68, -2.68, 0.0)


@pytest.mark.parametrize("text, want", [
    ("A, B ,,C", ["A", "B", "C"]), ("3", ["SYM1", "SYM2", "SYM3"]), ("0", []), ("", []), (" 2 ", ["SYM1", "SYM2"]),
])
def test_parse_symbols(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(S.parse_symbols(F.col("t")).alias("s")).first().s == want


def test_ids(spark):
    df = spark.range(4)
    random = df.withColumn("u", S.random_id())
    assert random.select("u").distinct().count() == 4
    stable = df.select(S.row_id(F.col("id"), F.lit("x")).alias("u"))
    assert as_rows(stable) == as_rows(stable) and stable.distinct().count() == 4


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_gold_of_the_fixed_ranges(spark):
    wide = bronze_sql_style(readers.number_range(spark, 1, 41))
    assert wide.count() == 40 and dict(wide.dtypes)["qty"] == "int"
    gold = {(r.seller_id, r.channel): (r.gmv_total, r.ticket_medio, r.eventos) for r in gold_kpis(wide).collect()}
    assert gold == {
        ("seller_c", "marketplace"): (3240.0, 249.23076923076923, 13),
        ("seller_b", "mobile"): (3054.0, 218.14285714285714, 14),
        ("seller_a", "web"): (2634.0, 202.6153846153846, 13),
    }
    assert {r.channel: r.gmv_total for r in gmv_by_channel(wide).collect()}["web"] == 2634.0
    frame = bronze_frame_style(readers.number_range(spark, 1, 31))
    assert dict(frame.dtypes)["qty"] == "bigint"
    gold = {r.seller_id: (r.gmv_total, r.ticket_medio, r.eventos) for r in gold_kpis(frame).collect()}
    assert gold == {"seller_a": (1960.0, 196.0, 10), "seller_c": (1700.0, 170.0, 10),
                    "seller_b": (1520.0, 152.0, 10)}
    first = frame.orderBy("event_time").first()
    assert (first.event_id, first.sku, first.event_time) == ("ev_001", "sku_2", datetime(2026, 2, 20, 14, 1))


ORDER_SCHEMA = "order_id int, customer_id string, status string, amount double, event_time long"


def upsert_loads(spark):
    amounts = [120, 90, 200, 75, 330, 50, 410, 130, 99, 280]
    t = 1_730_000_000_000
    first = [(i, f"C{i:03d}", "CREATED", float(a), t + i) for i, a in enumerate(amounts, 1)]
    second = [(3, "C003", "PAID", 260.0, t + 1011), (11, "C011", "CREATED", 145.0, t + 1012),
              (12, "C012", "CREATED", 500.0, t + 1013)]
    return spark.createDataFrame(first, ORDER_SCHEMA), spark.createDataFrame(second, ORDER_SCHEMA)


def test_upsert(spark):
    log = append_loads(*upsert_loads(spark))
    table = latest_per_key(log, ["order_id"], ["event_time", "load_no"])
    rows = {r.order_id: r for r in table.collect()}
    assert sorted(rows) == list(range(1, 13))
    assert (rows[3].status, rows[3].amount) == ("PAID", 260.0)
    assert sum(r.amount for r in rows.values()) == 2489.0
    # applying the same loads again changes nothing; of equal versions the later load wins
    again = append_loads(*upsert_loads(spark), *upsert_loads(spark))
    assert {tuple(r)[:5] for r in latest_per_key(again, ["order_id"], ["event_time", "load_no"]).collect()} \
        == {tuple(r)[:5] for r in rows.values()}


def test_compacted(spark):
    rows = [("b", "1", 0, 1), ("b", None, 0, 2), (None, "x", 0, 3), ("a", "1", 1, 1), ("a", "2", 1, 5)]
    log = spark.createDataFrame(rows, "key string, value string, partition int, offset long")
    assert {tuple(r) for r in compacted(log).collect()} == {("a", "2"), ("b", None)}


def test_parse_and_reject(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("qty", T.DoubleType())])
    lines = ['{"id": 1, "qty": 2.5}', '{"id": "2", "qty": "3"}', '{"id": 3, "qty": "x"}', '{"id": 4}', "{oops"]
    df = parse_json(spark.createDataFrame([(x,) for x in lines], "value string"), schema)
    good = require_fields(df, ["id", "qty"])
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2.5), (2, 3.0)]
    assert rejected(df, ["id", "qty"]).count() == 3


def test_targets(spark):
    target_type = "seller_id string, target_gmv double, target_orders int"
    targets = spark.createDataFrame([("S1", 100.0, 4), ("S2", 50.0, 0)], target_type)
    looked = with_targets(spark.createDataFrame([("S1",), ("S9",)], "seller_id string"), targets)
    assert {tuple(r) for r in looked.collect()} == {("S1", 100.0, 4), ("S9", 320_000.0, 450)}
    actual = spark.createDataFrame([("S1", 25.0, 2)], "seller_id string, gmv double, orders long")
    got = {r.seller_id: (r.gmv, r.orders, r.gmv_ratio, r.orders_ratio)
           for r in target_vs_actual(targets, actual).collect()}
    assert got == {"S1": (25.0, 2, 0.25, 0.5), "S2": (0.0, 0, 0.0, None)}


def test_csv_and_snapshot(spark):
    path = scratch_path(spark, "test-csv")
    empty = spark.createDataFrame([], readers.TARGET_SCHEMA)
    with pytest.raises(ValueError):
        sinks.write_csv(empty, path)
    rows = [{"seller_id": "S001", "seller_name": "Ana, F", "target_gmv": 282500.0, "target_orders": 377,
             "target_date": datetime(2025, 11, 28).date()}]
    frame = readers.frame_from_rows(spark, rows, readers.TARGET_SCHEMA)
    sinks.write_csv(frame, path)
    assert readers.read_csv(spark, path, readers.TARGET_SCHEMA).collect() == frame.collect()
    assert readers.read_snapshot(spark, f"{path}-none", frame.schema) is None
    sinks.write_snapshot(frame, f"{path}-json")
    assert readers.read_snapshot(spark, f"{path}-json", frame.schema).collect() == frame.collect()


def test_catalog(spark):
    path = scratch_path(spark, "test-table")
    frame = spark.createDataFrame([(1, "a")], "k int, v string")
    sinks.rebuild_table(frame, "rebuilt", path)
    assert sinks.rebuild_table(frame, "rebuilt", path).count() == 1
    assert "rebuilt" in {r.tableName for r in sinks.list_tables(spark).collect()}
    assert {(r.col_name, r.data_type) for r in sinks.describe(spark, "rebuilt").collect()} \
        == {("k", "int"), ("v", "string")}
    last = sinks.run_script(spark, ["DROP TABLE rebuilt", "SELECT ';' AS semicolon"])[-1]
    assert last.first().semicolon == ";"


def test_raw_orders_once(spark):
    """A batch that is delivered twice is there once; readers prune by day; compaction keeps the rows."""
    path = scratch_path(spark, "test-orders")
    schema = "id int, event_time timestamp_ntz"
    loads = [[(1, datetime(2025, 1, 2)), (2, datetime(2025, 1, 3)), (3, None)], [(4, datetime(2025, 1, 2))], []]
    for number, load in enumerate(loads):
        for _ in range(2):
            tables.append_orders(spark.createDataFrame(load, schema), path, number)
    frame = spark.createDataFrame([], schema)
    read = tables.read_orders(spark, path, frame.schema)
    assert sorted((r["id"], r["batch_id"]) for r in read.collect()) == [(1, 0), (2, 0), (3, 0), (4, 1)]
    day = read.filter("order_date = DATE '2025-01-02'")
    assert sorted(r["id"] for r in day.collect()) == [1, 4]
    assert all("order_date=2025-01-02" in f for f in (r[0] for r in day.select(F.input_file_name()).collect()))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan
    tables.compact_orders(spark, path, f"{path}-whole", frame.schema)
    assert spark.read.parquet(f"{path}-whole").count() == 4
