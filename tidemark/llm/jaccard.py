"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

Documents with the same set of shingles are one node. A node's shingles are ordered rare first; two nodes of a
similarity of 0.8 or more share one of their first ``n - ceil(0.8 n) + 1`` shingles, so nodes meet in the list of such a
shingle. The order comes from counts in a fixed number of buckets over all documents (any common order gives the same
result; the counts push what many documents share behind everyone's prefix).

1. one pass: size, signature and profile of every document, and the counts;
2. prefixes, dealt by shingle; lists of one node vanish;
3. in each list every node meets two nodes only, the first and the last in a pseudo-random order. What is left of these
   pairs after the filters is verified once, and the links give components. While the lists hold many pairs across
   components and a turn removes half of them, this is repeated in another order;
4. lists that still hold several components give all pairs across components, under the same filters, less those verified.

So a group of g near copies costs about g verifications, not g squared, and no link between different components is lost.
Filters: length (5 min >= 4 max), position (what is left behind the match must suffice), suffix (the pivots of a fixed
partition of the shingles split both sets into segments; their size differences bound the overlap from above).

Defined cases: a null, empty or blank text has an empty set and is its own component; rows are handled one by one, equal
rows or equal ids do no harm; the component id is the smallest id (null ids are ignored, all null: null); an empty table
gives no rows; further columns are ignored. Shingles and signatures are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts, written
from tidemark.llm.components import components
from tidemark.llm.shingles import mix, shingle_sets

#: Buckets of the counts, segments of a profile, bits of the filter of needed sets: fixed sizes of what is broadcast.
BUCKETS, SEGMENTS, BITS = 1 << 18, 256, 1 << 25
#: Pairs across components for each row of a list up to which all of them are tried.
LINEAR = 4


def least_overlap(x, y):
    """Smallest overlap of sets of these sizes at similarity 0.8: 100 o >= 80 (x + y - o)."""
    return -(-4 * (x + y) // 9)


def _signature(found: np.ndarray) -> int:
    both = found.sum(dtype=np.uint64, keepdims=True) * np.uint64(31) + np.bitwise_xor.reduce(found, keepdims=True)
    return int(mix(both)[0].astype(np.int64))


def _survey(docs: DataFrame) -> DataFrame:
    """Rows of documents (``key``, ``n``, ``sig``, ``profile``) and rows of counts (``bucket``, ``count``), in one pass."""
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            key_type = batch.column("key").type
            size, sig, profile = [], [], []
            for found in shingle_sets(texts(batch.column("text"))):
                size.append(len(found))
                sig.append(_signature(found))
                segments = np.bincount((found >> np.uint64(56)).astype(np.int64), minlength=SEGMENTS)
                profile.append(np.minimum(segments, 255).astype(np.uint8).tobytes())  # cut sizes bound from above still
                np.add.at(counts, (found % np.uint64(BUCKETS)).astype(np.int64), 1)
            none = pa.nulls(len(size), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(size, pa.int64()), pa.array(sig, pa.int64()), pa.array(profile, pa.binary()), none, none],
                names=["key", "n", "sig", "profile", "bucket", "count"])
        used = np.flatnonzero(counts)
        for at in range(0, len(used), 50_000):
            part = used[at:at + 50_000]
            none = pa.nulls(len(part), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(part), key_type), none, none, pa.nulls(len(part), pa.binary()), pa.array(part), pa.array(counts[part])],
                names=["key", "n", "sig", "profile", "bucket", "count"])

    return docs.mapInArrow(run, f"key {kind}, n bigint, sig bigint, profile binary, bucket bigint, count bigint")


def _prefixes(docs: DataFrame, weight: np.ndarray) -> DataFrame:
    """``h``, ``sig``, ``n``, ``pos``: the prefix of every document, once for each signature and task."""
    held = docs.sparkSession.sparkContext.broadcast(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            rows: list[tuple] = []
            for found in shingle_sets(texts(batch.column("text"))):
                n = len(found)
                sig = _signature(found)
                if not n or sig in done:
                    continue
                done.add(sig)
                order = np.lexsort((found, held.value[(found % np.uint64(BUCKETS)).astype(np.int64)]))
                first = found[order[:n - -(-4 * n // 5) + 1]]
                rows.append((first.view(np.int64), np.full(len(first), sig), np.full(len(first), n), np.arange(len(first))))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], names=["h", "sig", "n", "pos"])

    return docs.select("text").mapInArrow(run, "h bigint, sig bigint, n bigint, pos bigint")


def _by_list(rows: DataFrame, work: Callable[[dict[str, np.ndarray], np.ndarray], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """Hands whole lists (rows of one ``h``) to ``work`` with their bounds; lists are streamed in order of ``h``, size and node."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: dict[str, np.ndarray] | None = None

        def out(part):
            bounds = np.flatnonzero(np.concatenate([[True], part["h"][1:] != part["h"][:-1], [True]]))
            made = work(part, bounds)
            size = len(next(iter(made.values())))
            for at in range(0, size, 100_000):
                yield pa.RecordBatch.from_pydict({k: pa.array(v[at:at + 100_000]) for k, v in made.items()})

        for batch in batches:
            part = {c: _profiles(batch.column(c)) if c == "profile" else batch.column(c).to_numpy() for c in names}
            if rest is not None:
                part = {c: np.concatenate([rest[c], part[c]]) for c in names}
            if not len(part["h"]):
                continue
            cut = int(np.searchsorted(part["h"], part["h"][-1]))  # the last list may go on
            if cut:
                yield from out({c: v[:cut] for c, v in part.items()})
            rest = {c: v[cut:] for c, v in part.items()}
        if rest is not None:
            yield from out(rest)

    return rows.repartition("h").sortWithinPartitions("h", "n", "sig").mapInArrow(run, schema)


def _shared(part: dict[str, np.ndarray], bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Rows of lists with two nodes or more; a node that several tasks sent stands once.

    Rows without a partner that length and position allow go as well: what is left of row i behind the match is enough
    for partners of up to ``9 left / 4 - n`` shingles, so the smallest one that is long enough decides.
    """
    keep = np.ones(len(part["h"]), bool)
    keep[1:] = (part["h"][1:] != part["h"][:-1]) | (part["sig"][1:] != part["sig"][:-1]) | (part["n"][1:] != part["n"][:-1])
    number = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[keep]
    part = {c: v[keep] for c, v in part.items()}
    for _ in range(2):  # the second turn: partners that went in the first
        n, left = part["n"], part["n"] - part["pos"]
        place = number * (int(n.max(initial=0)) * 2 + 1)  # lists side by side, in each the rows by size
        at = np.searchsorted(place + n, place + -(-4 * n // 5))
        at += at == np.arange(len(n))
        there = np.minimum(at, len(n) - 1)
        good = (at < len(n)) & (number[there] == number) & (n[there] <= np.minimum(9 * left // 4 - n, 5 * n // 4))
        part, number = {c: v[good] for c, v in part.items()}, number[good]
    return part


def _passes(part: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length and position filters for rows i and j of a list."""
    x, y = part["n"][i], part["n"][j]
    left = np.minimum(x - part["pos"][i], y - part["pos"][j])
    return (5 * np.minimum(x, y) >= 4 * np.maximum(x, y)) & (left >= least_overlap(x, y)) & (part["sig"][i] != part["sig"][j])


def _as_pairs(part: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> dict[str, np.ndarray]:
    a, b = part["sig"][i], part["sig"][j]
    swap = a > b
    pairs = np.unique(np.stack([np.where(swap, b, a), np.where(swap, a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return {"a": pairs[:, 0], "b": pairs[:, 1]}


def _meetings(salt: int) -> Callable:
    """Each row with two nodes of its list, those of other components only.

    These are the first and the last in an order that the salt gives; in the first round the first one is the node whose
    match lies nearest to its start, the one with the fewest shingles of its own, to which copies of one text are closest.
    """
    def work(part: dict[str, np.ndarray], bounds: np.ndarray) -> dict[str, np.ndarray]:
        size, at = np.diff(bounds), np.arange(len(part["h"]))
        order = mix(part["sig"].view(np.uint64) ^ np.uint64(salt))
        nearest = order if salt else (np.minimum(part["pos"], (1 << 24) - 1).astype(np.uint64) << np.uint64(40)) | (order >> np.uint64(24))

        def place(extreme: np.ufunc, order: np.ndarray) -> np.ndarray:
            """For each row the row of its list's extreme node."""
            hit = np.flatnonzero(order == np.repeat(extreme.reduceat(order, bounds[:-1]), size))
            return np.repeat(hit[np.searchsorted(hit, bounds[:-1])], size)

        i, j = np.concatenate([at, at]), np.concatenate([place(np.minimum, nearest), place(np.maximum, order)])
        good = _passes(part, i, j) & (part["root"][i] != part["root"][j])
        return _as_pairs(part, i[good], j[good])

    return work


def _all_meetings(part: dict[str, np.ndarray], bounds: np.ndarray) -> dict[str, np.ndarray]:
    """All pairs of a list across components. Rows are in order of size, so a row is done at the first too large partner."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    at, step = np.arange(len(part["h"])), 1
    while len(at):
        at = at[at + step < len(part["h"])]
        at = at[(part["h"][at] == part["h"][at + step]) & (5 * part["n"][at] >= 4 * part["n"][at + step])]
        good = at[(part["root"][at] != part["root"][at + step])]
        good = good[_passes(part, good, good + step)]
        for block in np.array_split(good, -(-len(good) // 20_000) or 1):
            there = block + step
            fits = _leave_room(part["n"][block], part["n"][there], part["profile"][block], part["profile"][there])
            found.append((block[fits], there[fits]))
        step += 1
    if not found:
        return _as_pairs(part, np.zeros(0, np.int64), np.zeros(0, np.int64))
    return _as_pairs(part, *(np.concatenate(c) for c in zip(*found, strict=True)))


def _profiles(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SEGMENTS)


def _leave_room(x: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Suffix filter: what the segments' sizes allow as overlap is enough."""
    apart = (np.maximum(p, q) - np.minimum(p, q)).sum(axis=1, dtype=np.int64)
    return (x + y - apart) // 2 >= least_overlap(x, y)


def _suffix_filter(pairs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pairs whose segment sizes leave room for the least overlap."""
    side = lambda s: profiles.select(F.col("sig").alias(s), F.col("n").alias(f"n_{s}"), F.col("profile").alias(f"p_{s}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            good = _leave_room(x, y, *(_profiles(batch.column(c)) for c in ("p_a", "p_b")))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a bigint, b bigint")


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``sig`` and the set of the nodes. A bit field of fixed size keeps out almost all others before anything is dealt."""
    bit = F.pmod(F.col("sig"), F.lit(BITS)) + 1
    maps = nodes.groupBy(F.bitmap_bucket_number(bit).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("m")).collect()
    field = np.zeros(BITS // 8, np.uint8)
    for row in maps:  # at most BITS / 32768 rows of 4 KB
        at = (row["k"] - 1) * 4096
        field[at:at + 4096] = np.frombuffer(row["m"], np.uint8)
    held = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            sigs, data = [], []
            for found in shingle_sets(texts(batch.column("text"))):
                sig = _signature(found)
                place = sig % BITS
                if len(found) and sig not in done and held.value[place // 8] >> (place % 8) & 1:
                    done.add(sig)
                    sigs.append(sig)
                    data.append(found.tobytes())
            if sigs:
                yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), pa.array(data, pa.binary())], names=["sig", "data"])

    return docs.select("text").mapInArrow(run, "sig bigint, data binary").groupBy("sig").agg(F.first("data").alias("data"))


def _verify(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The linked ones among distinct pairs, by their whole sets."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    sets = _sets(docs, nodes)
    side = lambda s: sets.select(F.col("sig").alias(s), F.col("data").alias(f"d_{s}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("d_a"), batch.column("d_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")  # two sorted runs: one merge
                good.append(int((both[1:] == both[:-1]).sum()) >= least_overlap(len(x), len(y)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["u", "v"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "d_a", "d_b").mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row its ``key``, ``n_shingles`` and ``component_id`` (the smallest key that links reach)."""
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    survey = written(_survey(rows), "survey")
    known = survey.where("bucket IS NULL").select("key", "n", "sig", "profile")
    weight = np.zeros(BUCKETS, np.int64)
    for bucket, count in survey.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("count").alias("count")).collect():
        weight[bucket] = count  # a row for each bucket at most
    profiles = known.where("n > 0").groupBy("sig").agg(F.first("n").alias("n"), F.first("profile").alias("profile"))

    lists = written(_by_list(_prefixes(rows, weight), _shared, "h bigint, sig bigint, n bigint, pos bigint"), "lists")
    several = lists.withColumn("root", F.col("sig"))
    links = tried = classes = None
    salt, last, open_pairs = 0, False, None
    while True:
        met = several.join(profiles.select("sig", "profile"), "sig") if last else several
        pairs = _by_list(met, _all_meetings if last else _meetings(salt), "a bigint, b bigint").distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        fresh = written(pairs if last else _suffix_filter(pairs, profiles), "pairs")
        found = written(_verify(rows, fresh), "links")
        more = not found.isEmpty()
        if more or links is None:
            links = found if links is None else links.union(found)
            classes = components(links).select(F.col("node").alias("sig"), "root")
        if last:
            break
        tried = fresh if tried is None else tried.union(fresh)
        before = open_pairs
        several, open_pairs, open_rows = _open_lists(lists, classes)
        salt, last = salt + 1, open_pairs <= LINEAR * open_rows or before is not None and 2 * open_pairs > before

    ids = known.groupBy("sig").agg(F.min("key").alias("least"))
    named = ids.join(classes, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = known.where("n > 0").join(named.join(least, "root").select("sig", "component_id"), "sig")
    alone = known.where("n = 0").withColumn("component_id", F.col("key"))
    out = lambda d: d.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")
    return out(linked).unionByName(out(alone))


def _open_lists(lists: DataFrame, classes: DataFrame) -> tuple[DataFrame, int, int]:
    """The lists that hold more than one component, with ``root``; their pairs across components and their rows."""
    placed = lists.join(classes, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    sizes = placed.groupBy("h", "root").agg(F.count(F.lit(1)).alias("k"))
    several = sizes.groupBy("h").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("k2"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    several = written(several, "open-lists")
    pairs, rows = several.agg(F.sum((F.col("k") * F.col("k") - F.col("k2")) / 2), F.sum("k")).first()
    return written(placed.join(several.select("h"), "h", "left_semi").select("h", "sig", "n", "pos", "root"), "open"), pairs or 0, rows or 0


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the copies: of each component the row of the smallest key stays.

    Rows without words all stay. Of rows with one key and one text (by a 64-bit hash), null keys included, one stays.
    """
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    found = near_duplicates(docs, key, text).where("n_shingles > 0")
    stay = found.where(F.col(key).eqNullSafe(F.col("component_id"))).select(F.col(key).alias("__k")).distinct()
    kept = docs.where(worded).join(stay, docs[key].eqNullSafe(stay["__k"]), "left_semi")
    kept = kept.withColumn("__h", F.xxhash64(text)).dropDuplicates([key, "__h"])  # combines in each task first
    return kept.select(*docs.columns).unionByName(docs.where(~worded))
