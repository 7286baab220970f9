"""Exactness under skew, against brute force in plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.arrival import close_lags, running_watermark, strict_windows
from tidemark.operators.dedup import PAGE_MS, _block_map, _chain, _walk, dedup_ttl, first_arrivals
from tidemark.operators.delays import delay_report, duplicate_counts, percentile_low
from tidemark.operators.latest import latest_per_key
from tidemark.operators.prefix import BUCKET, bucket_count, with_order_buckets
from tidemark.operators.windows import agg_changelog

EVENT = "event_id long, arr long, ms long, symbol string, price double, qty long"


def stream(n, hot_ms=False, hot_key=False, seed=1):
    """Rows in which a third share one millisecond, or one symbol, if asked for."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        arr = rng.randrange(1_000_000)
        if hot_ms and i % 3 == 0:
            arr = 500_000
        symbol = "HOT" if hot_key and i % 3 == 0 else f"S{rng.randrange(20)}"
        rows.append((i, arr, arr - rng.randrange(200_000), symbol, float(rng.randrange(100)), rng.randrange(9)))
    return rows


@pytest.mark.parametrize("hot", [False, True])
def test_running_watermark(spark, hot):
    rows = stream(3000, hot_ms=hot)
    df = spark.createDataFrame(rows, EVENT).repartition(7)
    want, top = {}, None
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        top = r[2] if top is None else max(top, r[2])
        want[r[0]] = top
    got = {r.event_id: r.max_ms for r in running_watermark(df, 0, buckets=40).collect()}
    assert got == want


def test_buckets_split_a_hot_millisecond(spark):
    df = spark.createDataFrame(stream(6000, hot_ms=True), EVENT)
    sizes = [r["count"] for r in with_order_buckets(df, "arr", "event_id", 30).groupBy(BUCKET).count().collect()]
    assert sum(sizes) == 6000
    assert max(sizes) < 6000 / 30 * 3
    placed = with_order_buckets(df, "arr", "event_id", 30).select("arr", "event_id", BUCKET).collect()
    order = [r[BUCKET] for r in sorted(placed, key=lambda r: (r.arr, r.event_id))]
    assert order == sorted(order)


def test_changelog_of_a_hot_key(spark):
    rows = stream(3000, hot_key=True)
    df = spark.createDataFrame(rows, EVENT).repartition(5)
    want, state = {}, {}
    for i, arr, ms, symbol, price, qty in sorted(rows, key=lambda r: (r[1], r[0])):
        key = (ms - ms % 300_000, symbol)
        count, total, value = state.get(key, (0, 0, 0.0))
        state[key] = want[i] = (count + 1, total + qty, value + price * qty)
    got = {r.event_id: (r["count"], r.sum_qty, r.gmv) for r in agg_changelog(df, 300_000, buckets=25).collect()}
    assert got == want


@pytest.mark.parametrize("width", [7, 1000, 60_000])
def test_percentiles(spark, width):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 11}", rng.randrange(-500, 90_000)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v long")
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    want = {g: tuple(sorted(v)[int(p / 100 * (len(v) - 1))] for p in (50, 95, 100)) for g, v in groups.items()}
    got = {r.g: (r.p50, r.p95, r.p100) for r in percentile_low(df, ["g"], "v", [50, 95, 100], width).collect()}
    assert got == want


def arrivals_of_ids(seed, n=1500, span=400_000):
    """One id holds most rows, in dense stretches with pauses; others have a few."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        ident = 0 if rng.random() < 0.6 else rng.randrange(1, 60)
        at = rng.randrange(span)
        rows.append((ident, at - at % 97 if rng.random() < 0.3 else at + (at // 100_000) * 50_000))
    return [(ident, at, i) for i, (ident, at) in enumerate(rows)]


def keep_by_ttl(rows, ttl):
    last, kept = {}, set()
    for ident, at, i in sorted(rows, key=lambda r: (r[1], r[2])):
        if ident not in last or at - last[ident] > ttl:
            last[ident] = at
            kept.add((ident, at, i))
    return kept


@pytest.mark.parametrize("ttl,few,block_pages", [(0, 256, 64), (1_000, 0, 1), (17_000, 5, 2), (90_000, 0, 1), (600_000, 40, 3)])
def test_dedup_ttl(spark, ttl, few, block_pages):
    rows = arrivals_of_ids(ttl)
    df = spark.createDataFrame(rows, "event_id long, arr long, seq long").repartition(6)
    got = dedup_ttl(df, ttl, order=("arr", "seq"), few=few, block_pages=block_pages).collect()
    assert {tuple(r) for r in got} == keep_by_ttl(rows, ttl) and len(got) == len({tuple(r) for r in got})


def test_an_id_that_never_pauses_is_many_blocks(spark):
    """A billion milliseconds of one id: every block is a row of its own on the way, and no task holds two thirds of them."""
    rows = [("hot", at * 1_000 + at % 7) for at in range(1_000_000)]
    df = spark.range(1_000_000).selectExpr("'hot' AS event_id", "id * 1000 + id % 7 AS arr")
    times = _chain(df.selectExpr("event_id", "arr AS at"), "event_id", 600_000)
    want, last = [], None
    for _, at in rows:
        if last is None or at - last > 600_000:
            want.append(at)
            last = at
    assert sorted(r["at"] for r in times.collect()) == want
    spread = df.selectExpr("event_id", f"arr - arr % {64 * PAGE_MS} AS block").distinct().repartition(8, "event_id", "block")
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 3


@pytest.mark.parametrize("seed", range(5))
def test_block_map(seed):
    rng = random.Random(seed)
    for _ in range(60):
        at = np.array(sorted({1_000 + rng.randrange(rng.choice([50, 500, 5_000])) for _ in range(rng.randrange(1, 80))}))
        ttl = rng.choice([0, 1, 7, 60, 900])
        ends, steps = _block_map(at, 1_000 + ttl, ttl)
        for before in [None, *(999 - rng.randrange(ttl + 50) for _ in range(6))]:
            kept, last = [], before
            for a in at.tolist():
                if last is None or a - last > ttl:
                    kept.append(a)
                    last = a
            assert _walk(at, before, ttl) == kept
            step = 0 if before is None else int(np.searchsorted(ends, before + ttl, side="right"))
            assert (int(steps[step]) if step < len(ends) else before) == last


def test_buckets_of_a_joined_input(spark, small):
    """Spark multiplies the sizes of joined tables; the rows do not."""
    events = spark.read.parquet(f"{small}/events.parquet")
    joined = events.crossJoin(spark.range(1)).join(events.select("event_id", F.col("value").alias("v")), "event_id")
    assert bucket_count(joined) <= 2 * max(4, bucket_count(events))


def test_dedup_ttl_of_text_ids(spark):
    rows = [("a", 0), ("a", 5), ("a", 11), ("a", 12), ("b", 3), ("a", 22), ("a", 23)]
    df = spark.createDataFrame(rows, "event_id string, arr long")
    got = dedup_ttl(df, 10, order=("arr",)).collect()
    assert sorted(tuple(r) for r in got) == [("a", 0), ("a", 11), ("a", 22), ("b", 3)]


def test_rows_without_id_are_left_out(spark):
    df = spark.createDataFrame([(None, 0), (None, 5_000), ("a", 1)], "event_id string, arr long")
    assert [tuple(r) for r in dedup_ttl(df, 1_000, order=("arr",)).collect()] == [("a", 1)]


def test_text_ids_and_a_hot_millisecond(spark):
    rows = [(f"{i * 7919 % 100_003:05x}-uuid", 500 if i % 10 == 0 else i % 977, i % 1000) for i in range(20_000)]
    df = spark.createDataFrame(rows, "event_id string, arr long, ms long")
    placed = with_order_buckets(df, "arr", "event_id", 200)
    sizes = [r["count"] for r in placed.groupBy(BUCKET).count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 3 * len(rows) / 200
    want, top = {}, None
    for ident, _, ms in sorted(rows, key=lambda r: (r[1], r[0])):
        top = want[ident] = ms if top is None else max(top, ms)
    assert {r.event_id: r.max_ms for r in running_watermark(df, 0, buckets=50).collect()} == want


def test_changelog_of_a_null_symbol(spark):
    df = spark.createDataFrame([(i, i, 0, None, 1.0, 1) for i in range(2000)], EVENT)
    assert agg_changelog(df, 300_000, buckets=20).agg(F.max("count")).first()[0] == 2000


def test_null_groups_and_far_values_have_percentiles(spark):
    rows = [(None, 5), (None, 7), ("a", -10**15), ("a", 3), ("a", 10**17), ("b", None)]
    got = {r.g: (r.p50, r.p100) for r in percentile_low(spark.createDataFrame(rows, "g string, v long"), ["g"], "v", [50, 100]).collect()}
    assert got == {None: (5, 7), "a": (3, 10**17)}


def test_missing_event_time_is_no_delay(spark):
    rows = [(1, 10_000, 5_000, "a", 1.0, 1), (2, 10_001, None, "a", 1.0, 1), (3, 10_002, None, None, 1.0, 1)]
    r = delay_report(spark.createDataFrame(rows, EVENT), 250_000).first()
    assert (r.messages, r.dups, r.p50, r.b0, r.b2, r.b4) == (3, 0, 0, 2, 1, 0)


def test_first_arrivals_and_duplicates(spark):
    rows = arrivals_of_ids(5)
    df = spark.createDataFrame(rows, "event_id long, arr long, seq long")
    firsts, dups = {}, {}
    for ident, at, i in sorted(rows, key=lambda r: (r[1], r[2])):
        if ident in firsts:
            dups[at - at % 50_000] = dups.get(at - at % 50_000, 0) + 1
        else:
            firsts[ident] = (ident, at, i)
    assert {tuple(r) for r in first_arrivals(df, order=("arr", "seq")).collect()} == set(firsts.values())
    got = {r.interval_ms: r.dups for r in duplicate_counts(df, 50_000).collect() if r.dups}
    assert got == dups


def test_delay_report(spark):
    rows = stream(2000)
    got = {r.interval_ms: r for r in delay_report(spark.createDataFrame(rows, EVENT), 250_000).collect()}
    for start in range(0, 1_000_000, 250_000):
        delays = sorted(r[1] - r[2] for r in rows if start <= r[1] < start + 250_000)
        r = got[start]
        assert r.messages == len(delays) and r.dups == 0 and r.rate == len(delays) / 250
        assert (r.p50, r.p95) == tuple(delays[int(p * (len(delays) - 1))] for p in (0.5, 0.95))
        bounds = [-10**9, 1000, 5000, 15_000, 60_000, 10**9]
        assert [r[f"b{i}"] for i in range(5)] == [
            sum(lo <= d < hi for d in delays) for lo, hi in zip(bounds, bounds[1:])]


def test_close_lags(spark):
    rows = stream(1500, hot_ms=True)
    df = spark.createDataFrame(rows, EVENT)
    marked = running_watermark(df, 30_000)
    windows = strict_windows(marked, 20_000, ["symbol"], F.col("price"))
    closing, top = [], None
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        top = r[2] if top is None else max(top, r[2])
        closing.append((r[1], top - 30_000))
    for r in close_lags(df, windows, 20_000, 30_000).collect():
        assert r.close_arr == next((arr for arr, mark in closing if mark >= r.window_end_ms), None)


def test_latest_of_a_hot_key(spark):
    rows = stream(2000, hot_key=True)
    got = latest_per_key(spark.createDataFrame(rows, EVENT), ["symbol"], ["arr", "event_id"])
    want = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        want[r[3]] = r
    assert {r.symbol: tuple(r) for r in got.collect()} == want
