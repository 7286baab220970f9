"""Sharding by a communication matrix: a uniform shuffle with exact shard sizes.

Rows are dealt to source buckets by a seeded hash. The matrix says how many rows of each bucket go to each shard; it is
drawn from the multivariate hypergeometric law, so every way to split the rows into shards of the fixed sizes is
equally likely. Rows are permuted inside their bucket and cut by the bucket's row of the matrix, exchanged, and permuted
again inside their shard. Shard sizes differ by one row at most (law ``rows``), whatever the texts are: equal texts are
rows like any other, so a group of copies spreads evenly and needs no one task.

Buckets and strips are many and fixed (``BUCKETS``, ``STRIPS`` for each shard), so a task sorts a small share of the rows
at any size and the sorts spill. Only the counts (one for each bucket) reach the driver. Every draw depends on the seed, the key and the row's content
alone: a lost task recomputes the same rows.

Defined cases: a null text has size 1 and the checksum of the empty text; null keys are rows like others; equal rows
each get a place of their own (which of them takes which place is of no consequence, they are equal); an empty table
gives no rows; further columns travel with their row, those named like a result column are replaced.
"""

from __future__ import annotations

import random
from itertools import accumulate
from math import exp, lgamma

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 2048
STRIPS = 256


def hypergeometric(rng: random.Random, marked: int, rest: int, drawn: int) -> int:
    """How many of ``drawn`` items without replacement are marked, by inversion from the mode outwards."""
    low, high = max(0, drawn - rest), min(marked, drawn)
    if low == high:
        return low
    total = marked + rest
    mode = min(high, max(low, (drawn + 1) * (marked + 1) // (total + 2)))
    choose = lambda n, k: lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
    top = exp(choose(marked, mode) + choose(rest, drawn - mode) - choose(total, drawn))
    left = right = mode
    p_left = p_right = top
    u = rng.random() - top
    while u > 0:
        if right < high:
            p_right *= (marked - right) * (drawn - right) / ((right + 1) * (rest - drawn + right + 1))
            right += 1
            u -= p_right
            if u <= 0:
                return right
        if left > low:
            p_left *= left * (rest - drawn + left) / ((marked - left + 1) * (drawn - left + 1))
            left -= 1
            u -= p_left
            if u <= 0:
                return left
        if left == low and right == high:
            return mode
    return mode


def communication_matrix(sources: list[int], targets: list[int], seed: int = 0) -> list[list[int]]:
    """Rows sum to ``sources``, columns to ``targets`` (equal totals); drawn as if all rows were shuffled at once."""
    if sum(sources) != sum(targets):
        raise ValueError("sources and targets must have equal totals")
    rng, free, matrix = random.Random(seed), list(targets), []
    for size in sources:
        row, rest = [], sum(free)
        for k, room in enumerate(free):
            rest -= room
            row.append(hypergeometric(rng, room, rest, size))
            size -= row[-1]
        free = [f - r for f, r in zip(free, row, strict=True)]
        matrix.append(row)
    return matrix


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def _draw(seed: int, salt: str, columns: list[Column]) -> Column:
    """A 64-bit number of the row's content, another for each salt."""
    return F.xxhash64(F.lit(f"{salt}{seed}"), *columns)


def shuffle_to_shards(df: DataFrame, keys: list[str], shards: int, seed: int = 0) -> DataFrame:
    """``df`` with ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 in each shard), a uniform shuffle of the rows."""
    keep = [c for c in df.columns if c not in ("shard", "slot")]
    content = [F.col(c) for c in keys]
    dealt = df.select(
        *keep, F.pmod(_draw(seed, "bucket", content), F.lit(BUCKETS)).cast("int").alias("__b"),
        _draw(seed, "inner", content).alias("__r"),
    )
    counts = {r["__b"]: r["n"] for r in dealt.groupBy("__b").agg(F.count(F.lit(1)).alias("n")).collect()}
    sources = [counts.get(b, 0) for b in range(BUCKETS)]
    matrix = communication_matrix(sources, shard_sizes(sum(sources), shards), seed)
    cuts = [list(accumulate(row)) for row in matrix]
    local = Window.partitionBy("__b").orderBy("__r", *keys)
    ranked = dealt.withColumn("__k", F.row_number().over(local) - 1)
    ends = F.from_json(F.lit(str(cuts)), "array<array<bigint>>")
    bounds = df.sparkSession.range(1).select(F.posexplode(ends).alias("__b", "__ends"))  # one row for each bucket
    placed = ranked.join(bounds, "__b").select(
        *keep, F.size(F.filter("__ends", lambda e: e <= F.col("__k"))).cast("int").alias("shard"),
        _draw(seed, "outer", content).alias("__r"),
    )
    # The second permutation sorts by a random number; its top part cuts a shard into strips that are sorted apart.
    strip = placed.withColumn("__s", F.pmod(F.shiftright(F.col("__r"), 20), F.lit(STRIPS)).cast("int"))
    inner = Window.partitionBy("shard", "__s").orderBy("__r", *keys)
    numbered = strip.withColumn("__k", F.row_number().over(inner) - 1)
    sizes = strip.groupBy("shard", "__s").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(
        Window.partitionBy("shard").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    return numbered.join(before, ["shard", "__s"]).select(
        *keep, "shard", (F.col("__before") + F.col("__k")).cast("long").alias("slot"))


def write_shards(df: DataFrame, keys: list[str], shards: int, path: str, seed: int = 0) -> None:
    """The shuffled rows as Parquet, a folder for each shard, rows of each file in the order of their slots."""
    out = shuffle_to_shards(df, keys, shards, seed)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)
