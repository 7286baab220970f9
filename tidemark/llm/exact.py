"""Exact duplicates over deliveries that become immutable snapshots of an index.

Texts are equal when they are identical after each run of white space became one space. A delivery is worked off so:

1. Its own copies are grouped by SHA-256 of the normalised text: first row and number of copies of each digest.
2. Each older snapshot has one static binary-fuse filter for each bucket of its digests. The delivery's digests go to
   the buckets; what a filter does not know is new, and no text of it is read again.
3. Positives join the exact buckets, where the bytes of both texts are compared; false positives fall out here.
4. What is new becomes a snapshot of its own with its filters. Nothing of an older snapshot is changed.

A delivery that is repeated replaces its own folder, so a job that was cut off is simply run again. A group of any size
is spread: its rows join their class by digest and one of ``SALTS`` salts, and only salts that occur are rows.

Defined cases: a null text is the empty text and empty texts are equal to each other; a null key sorts last; of repeated
rows with one key one stays; an empty delivery makes an empty snapshot; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_GAP

#: Salts of a group's rows.
SALTS = 1 << 16
#: Digests of one filter, about; the number of buckets follows the digests.
BUCKET_KEYS = 1 << 17
FILTER = "bucket int, seed long, segment int, segments int, prints binary"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WORD_GAP, " ")


def digest(body: Column) -> Column:
    return F.unhex(F.sha2(body, 256))


# ---- binary-fuse filter ------------------------------------------------------------------

def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser over key and seed."""
    h = keys + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def slots(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three slots of each hash, in three neighbouring segments."""
    top, low = h >> np.uint64(32), h & np.uint64(0xFFFFFFFF)
    first = ((top * np.uint64(segment * segments)) >> np.uint64(32)).astype(np.int64)
    mask = segment - 1
    second = (first + segment) ^ ((low >> np.uint64(16)).astype(np.int64) & mask)
    third = (first + 2 * segment) ^ (low.astype(np.int64) & mask)
    return np.stack([first, second, third])


def prints_of(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Seed, segment length, segments and one byte a slot, so that the three slots of each key xor to its print.

    Keys that are alone in a slot are peeled round by round; each then gets the slot in which it was alone, last first.
    A seed under which the peeling stops early is followed by the next one.
    """
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    segment = 1 << int(np.log(max(n, 2)) / np.log(3.33) + 2.25)
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    segments = max(1, -(-int(n * factor) // segment) - 2)
    for seed in range(1, 1000):
        h = mixed(keys, seed)
        places = slots(h, segment, segments)
        size = segment * (segments + 2)
        rounds = _peel(places, size)
        if rounds is not None:
            table = np.zeros(size, np.uint8)
            wanted = prints_of(h)
            for found, slot in reversed(rounds):
                at = places[:, found]
                table[slot] = wanted[found] ^ table[at[0]] ^ table[at[1]] ^ table[at[2]]  # its own slot is still zero
            return seed, segment, segments, table.tobytes()
    raise RuntimeError("no seed peels the keys")


def _peel(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot in which each is alone), or None."""
    count = np.bincount(places.ravel(), minlength=size)
    who = np.zeros(size, np.int64)
    ids = np.arange(places.shape[1])
    for row in places:
        np.bitwise_xor.at(who, row, ids)
    rounds, left = [], len(ids)
    frontier = np.flatnonzero(count == 1)
    while len(frontier):
        found, first = np.unique(who[frontier], return_index=True)
        slot = frontier[first]
        rounds.append((found, slot))
        left -= len(found)
        touched = places[:, found].ravel()
        np.subtract.at(count, touched, 1)
        np.bitwise_xor.at(who, touched, np.tile(found, 3))
        touched = np.unique(touched)
        frontier = touched[count[touched] == 1]
    return rounds if not left else None


def known(keys: np.ndarray, seed: int, segment: int, segments: int, prints: np.ndarray) -> np.ndarray:
    """Which keys the filter may hold; never False for one that it holds."""
    h = mixed(keys.astype(np.uint64), seed)
    at = slots(h, segment, segments)
    return prints[at[0]] ^ prints[at[1]] ^ prints[at[2]] == prints_of(h)


def _keys(column: pa.Array) -> np.ndarray:
    """The first eight bytes of each 32-byte digest."""
    column = column.cast(pa.binary(32))
    flat = np.frombuffer(column.buffers()[1], np.uint8)[column.offset * 32:(column.offset + len(column)) * 32]
    return np.ascontiguousarray(flat.reshape(-1, 32)[:, :8]).view("<u8").ravel()


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One filter for each bucket; the rows come sorted by bucket."""
    held: list[np.ndarray] = []
    now = None

    def closed() -> pa.RecordBatch:
        seed, segment, segments, prints = build_filter(np.concatenate(held))
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array([now], pa.int32()), "seed": pa.array([seed], pa.int64()), "segment": pa.array([segment], pa.int32()),
            "segments": pa.array([segments], pa.int32()), "prints": pa.array([prints], pa.binary())})

    for batch in batches:
        buckets, keys = batch.column("bucket").to_numpy(), _keys(batch.column("digest"))
        cuts = np.flatnonzero(np.diff(buckets)) + 1
        for start, stop in zip([0, *cuts], [*cuts, len(buckets)], strict=True):
            if start == stop:
                continue
            if now is not None and buckets[start] != now:
                yield closed()
                held = []
            now = int(buckets[start])
            held.append(keys[start:stop])
    if held:
        yield closed()


def _screened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests that the filter of their bucket may hold; in each bucket the filter comes first."""
    place, held = None, None
    for batch in batches:
        snapshot, bucket = batch.column("snapshot").to_numpy(), batch.column("bucket").to_numpy()
        asked = batch.column("seed").is_null().to_numpy(zero_copy_only=False)
        change = (np.diff(snapshot) != 0) | (np.diff(bucket) != 0) | ~asked[1:] | ~asked[:-1]
        cuts = np.flatnonzero(change) + 1
        for start, stop in zip([0, *cuts], [*cuts, len(asked)], strict=True):
            if start == stop:
                continue
            at = (snapshot[start], bucket[start])
            if not asked[start]:
                row = {c: batch.column(c)[start].as_py() for c in ("seed", "segment", "segments", "prints")}
                place, held = at, (row["seed"], row["segment"], row["segments"], np.frombuffer(row["prints"], np.uint8))
            elif at == place:
                part = batch.slice(start, stop - start)
                hit = pa.array(known(_keys(part.column("digest")), *held))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).filter(hit) for c in ("snapshot", "digest")], names=["snapshot", "digest"])


# ---- index -------------------------------------------------------------------------------

def _path(index: str, number: int, part: str) -> str:
    return f"{index}/snapshot-{number:06d}/{part}"


def _store(df: DataFrame, index: str, number: int, part: str) -> DataFrame:
    path = _path(index, number, part)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _load(spark: SparkSession, index: str, number: int, part: str) -> DataFrame:
    return spark.read.parquet(_path(index, number, part))


def add_delivery(docs: DataFrame, index: str, number: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Work off delivery ``number`` (0, 1, ...) against the snapshots 0 to ``number - 1`` and store it as a snapshot.

    Returns one row for each distinct text of the delivery: ``digest``, ``home`` (the snapshot in which the text was
    first seen, ``number`` itself where it is new) and ``copies`` (rows of this delivery).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), digest(normalised(F.col(text))).alias("digest")).withColumn(
        "place", F.monotonically_increasing_id())
    members = _store(rows.withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int")), index, number, "members")
    first = F.min(F.struct(F.col("key").isNull().alias("without"), "key", "place")).alias("first")
    parts = _store(members.groupBy("digest", "salt").agg(first, F.count("*").alias("copies")), index, number, "parts")
    groups = parts.groupBy("digest").agg(F.min("first").alias("first"), F.sum("copies").alias("copies"))
    groups = _store(groups, index, number, "groups")
    body = normalised(F.col(text))
    bodies = docs.select(digest(body).alias("digest"), body.alias("body")).groupBy("digest").agg(F.first("body").alias("body"))
    bodies = _store(bodies, index, number, "texts")
    found = _store(_found(spark, groups, bodies, index, number), index, number, "found")
    classes = groups.join(found, "digest", "left").select(
        "digest", F.coalesce("home", F.lit(number)).alias("home"), "first", "copies")
    classes = _store(classes, index, number, "classes")
    fresh = classes.filter(F.col("home") == number).select("digest")
    buckets = max(1, -(-fresh.count() // BUCKET_KEYS))
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(_path(index, number, "layout"))
    placed = fresh.select(_bucket(buckets), "digest").repartition("bucket").sortWithinPartitions("bucket")
    _store(placed.mapInArrow(_filters, FILTER), index, number, "filters")
    return classes.select("digest", "home", "copies")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket")


def _found(spark: SparkSession, groups: DataFrame, bodies: DataFrame, index: str, number: int) -> DataFrame:
    """``digest`` and ``home`` of the texts that an older snapshot holds."""
    none = spark.createDataFrame([], "digest binary, home int")
    asked = None
    for older in range(number):
        buckets = _load(spark, index, older, "layout").first()["buckets"]
        filters = _load(spark, index, older, "filters").withColumn("snapshot", F.lit(older))
        mine = groups.select(F.lit(older).alias("snapshot"), _bucket(buckets), "digest")
        both = filters.unionByName(mine, allowMissingColumns=True)
        asked = both if asked is None else asked.unionByName(both)
    if asked is None:
        return none
    placed = asked.repartition("snapshot", "bucket").sortWithinPartitions("snapshot", "bucket", F.col("seed").asc_nulls_last())
    maybe = _store(placed.mapInArrow(_screened, "snapshot int, digest binary"), index, number, "positives")
    new = bodies.join(maybe, "digest").select("digest", "snapshot", "body")
    matches = none
    for older in range(number):
        mine = maybe.filter(F.col("snapshot") == older).select("digest")
        held = _load(spark, index, older, "classes").filter(F.col("home") == older).select("digest").join(mine, "digest", "left_semi")
        old = _load(spark, index, older, "texts").join(held, "digest", "left_semi").withColumnRenamed("body", "held")
        same = new.filter(F.col("snapshot") == older).join(old, "digest").filter(F.col("body") == F.col("held"))
        matches = matches.unionByName(same.select("digest", F.lit(older).alias("home")))
    return matches


def keepers(spark: SparkSession, index: str, deliveries: int) -> DataFrame:
    """Every row of the deliveries: ``key``, ``digest``, ``keep`` (key of the row that stays), ``copies``, ``kept``."""
    all_classes = None
    for number in range(deliveries):
        mine = _load(spark, index, number, "classes").withColumn("delivery", F.lit(number))
        all_classes = mine if all_classes is None else all_classes.unionByName(mine)
    own = F.when(F.col("delivery") == F.col("home"), F.col("first"))
    totals = all_classes.groupBy("home", "digest").agg(F.max(own).alias("first"), F.sum("copies").alias("copies"))
    named = all_classes.select("delivery", "home", "digest").join(totals, ["home", "digest"])
    out = None
    for number in range(deliveries):
        parts = _load(spark, index, number, "parts").select("digest", "salt")
        labels = parts.join(named.filter(F.col("delivery") == number), "digest")
        mine = _load(spark, index, number, "members").join(labels, ["digest", "salt"]).select(
            "key", "digest", F.col("first.key").alias("keep"), "copies",
            ((F.col("home") == number) & (F.col("place") == F.col("first.place"))).alias("kept"))
        out = mine if out is None else out.unionByName(mine)
    return out


def two_deliveries(docs: DataFrame, key: str = "doc_id") -> list[DataFrame]:
    """The rows up to the middle of the range of keys, then the rest with those that have no key."""
    low, high = docs.agg(F.min(key), F.max(key)).first()
    if low is None:
        return [docs]
    early = F.coalesce(F.col(key) <= F.lit((low + high) // 2), F.lit(False))
    return [docs.filter(early), docs.filter(~early)]


def exact_duplicates(docs: DataFrame, index: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of a table with an integer key as two deliveries, so that of equal texts the least key stays."""
    loads = two_deliveries(docs, key)
    for number, load in enumerate(loads):
        add_delivery(load, index, number, key, text)
    return keepers(docs.sparkSession, index, len(loads))


#: Columns of the query.
ORACLE = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g"""
