"""Context-tree weighting over bytes, for code lengths of texts.

Every byte is eight binary decisions; a node is a context of up to ``DEPTH`` earlier bytes with the bits of the byte so
far. A node predicts by the Krichevsky-Trofimov estimate of its own counts, and its weighted probability is half that
and half the product of the nodes one byte deeper. The prediction of a bit therefore mixes the estimates of all depths;
the mixture along a path ends at the deepest context that the training data hold.

The tree is a table: counts of all byte sequences of length ``DEPTH + 1`` (combined in the tasks before they are dealt),
then one aggregation for each depth upwards and one join for each depth downwards. All of it grows with the corpus and
none of it passes through the driver. Scoring needs the code length of each sequence of a text. The most frequent ones,
at most ``FAST`` of them, go to the tasks as a table of fixed size; all others are summed by text and meet the full
table in a join, and sequences the training data lack are worked out bit by bit against the nodes. Both ways give the
same values, so the table's size changes the cost alone. Word counts for the base score are treated alike (``FAST_WORDS``).

Defined cases: a null or empty text is one end symbol; texts begin in a context of zero bytes; rows are scored one by
one, equal rows equally, null keys like others (of the empty crc); without training rows every bit costs one bit and
the base has N = V = 0; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_bucket, texts, written

DEPTH = 5
FAST, FAST_WORDS = 1 << 20, 1 << 18
#: Bytes of text that a task works on at once; a dozen arrays of eight times that size live meanwhile.
CHUNK = 1 << 19
#: Ends a text; no byte of UTF-8 has this value.
END = 255
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def grams(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences of ``DEPTH + 1`` bytes that end at each byte or at the end of a text, and the text of each."""
    pad, stop = bytes(DEPTH), bytes([END])
    raw = np.frombuffer(b"".join(x for d in data for x in (pad, d, stop)), np.uint8)
    keys = np.zeros(max(len(raw) - DEPTH, 0), np.uint64)
    for k in range(DEPTH + 1):
        keys = (keys << np.uint64(8)) | raw[k:len(raw) - DEPTH + k]
    sizes = np.array([len(d) + 1 for d in data], np.int64)
    owner = np.repeat(np.arange(len(data)), sizes)
    return keys[np.arange(len(owner)) + DEPTH * owner].view(np.int64), owner


def lowered(values: Iterable[str]) -> Iterator[bytes]:
    for value in values:
        yield value.encode("utf-8", "replace").translate(_LOWER)


def in_chunks(values: Iterable[bytes]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for value in values:
        group.append(value)
        size += len(value)
        if size >= CHUNK:
            yield group
            group, size = [], 0
    if group:
        yield group


def gram_counts(docs: DataFrame) -> DataFrame:
    """``key`` and ``n`` over all rows of ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, parts, size = None, None, [], 0

        def merged():
            every, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            parts.clear()
            order = np.argsort(every, kind="stable")
            every, n = every[order], n[order]
            del order
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            return every[first], np.add.reduceat(n, first)

        def out(keys, counts):
            for at in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[at:at + 100_000]), pa.array(counts[at:at + 100_000])], names=["key", "n"])

        for batch in batches:
            for group in in_chunks(lowered(texts(batch.column("text")))):
                parts.append(np.unique(grams(group)[0], return_counts=True))
                size += len(parts[-1][0])
                if size > 3_000_000:
                    keys, counts = merged()
                    parts, size = [(keys, counts)], len(keys)
                    if size > 1_500_000:
                        yield from out(keys, counts)
                        parts, size = [], 0
        if parts:
            yield from out(*merged())

    return docs.select("text").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``n`` over all rows of ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()

        for batch in batches:
            for value in lowered(texts(batch.column("text"))):
                counts.update(value.split())
                if len(counts) > 300_000:
                    yield from out()
        if counts:
            yield from out()

    return docs.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def lgamma(x: Column) -> Column:
    """Logarithm of the gamma function of a positive number: recurrence up by eight, then Stirling's series."""
    y, product = x + 8, x
    for k in range(1, 8):
        product = product * (x + k)
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def _kt(zeros: Column, ones: Column) -> Column:
    return lgamma(zeros + 0.5) + lgamma(ones + 0.5) - lgamma(zeros + ones + 1.0) - math.log(math.pi)


def _decisions(key: Column, depth: int) -> Column:
    """Node and bit of the eight decisions of a sequence's last byte, in a context of ``depth`` bytes."""
    byte = F.pmod(key, F.lit(256))
    context = F.shiftright(key, 8).bitwiseAND(F.lit((1 << 8 * depth) - 1))
    return F.array(*[F.struct(
        (context * 256 + (1 << k) + F.shiftright(byte, 8 - k)).alias("x"), F.shiftright(byte, 7 - k).bitwiseAND(F.lit(1)).alias("bit"),
    ) for k in range(8)])


def tree(counts: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """For each depth ``x`` and ``stop`` (chance of a one if the path ends here), and ``code_lengths`` of all sequences.

    The deepest nodes are counted where their context's sequences are dealt to, so no decision is dealt by itself.
    """
    context = F.shiftright("key", 8)
    deepest = counts.repartition(context).select(context.alias("c"), "n", F.explode(_decisions(F.col("key"), DEPTH)).alias("d"))
    deepest = deepest.select("c", "n", F.col("d.x").alias("x"), "d.bit").groupBy("c", "x").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("n1"))
    kt = _kt(F.col("n0"), F.col("n1"))
    levels = [written(deepest.select("x", "n0", "n1"), "nodes")]
    for depth in range(DEPTH - 1, -1, -1):
        parent = F.col("x").bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1))
        below = F.col("lw") if depth < DEPTH - 1 else kt
        level = levels[0].groupBy(parent.alias("x")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum(below).alias("below"))
        level = level.withColumn("kt", kt).withColumn("top", F.greatest("kt", "below"))
        both = F.log(F.exp(F.col("kt") - F.col("top")) + F.exp(F.col("below") - F.col("top")))
        levels.insert(0, written(level.select("x", "n0", "n1", (math.log(0.5) + F.col("top") + both).alias("lw")), "nodes"))
    out, above = [], None
    for depth, level in enumerate(levels):
        last = depth == DEPTH
        share = F.exp(math.log(0.5) + kt - F.col("lw")) if not last else F.lit(1.0)
        own = level.select("x", ((F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)).alias("p"), share.alias("w"), *(["n0", "n1"] if last else []))
        if above is None:
            mixed = own.withColumns({"acc": F.lit(0.0), "rest": F.lit(1.0)})
        else:
            up = above.select(F.col("x").alias("up"), "acc", "rest")
            mixed = own.withColumn("up", F.col("x").bitwiseAND(F.lit((1 << 8 * depth) - 1))).join(up, "up")
        stop = (F.col("acc") + F.col("rest") * F.col("p")).alias("stop")
        above = written(mixed.select("x", stop, "n0", "n1") if last else mixed.select(
            "x", stop, (F.col("acc") + F.col("rest") * F.col("w") * F.col("p")).alias("acc"), (F.col("rest") * (1 - F.col("w"))).alias("rest")), "mixed")
        out.append(above.select("x", "stop"))
    return out, code_lengths(above)


def code_lengths(deepest: DataFrame) -> DataFrame:
    """``key``, ``n`` and ``lp`` (decimal logarithm of the chance of the last byte) of the sequences that the nodes hold.

    Nodes are streamed in order of context and bits; a node's sum is that of the node one bit before plus its decision.
    """
    rows = deepest.repartition(F.shiftright("x", 8)).sortWithinPartitions("x")
    names = ["x", "stop", "n0", "n1"]

    def lengths(x, stop, n0, n1) -> pa.RecordBatch:
        bits, total = x & 255, np.zeros(len(x))
        decision = (np.log10(1 - stop), np.log10(stop))
        for level in range(1, 8):
            here = np.flatnonzero(bits >> level == 1)
            up = np.searchsorted(x, (x[here] & ~255) | (bits[here] >> 1))
            total[here] = total[up] + np.where(bits[here] & 1, decision[1][up], decision[0][up])
        leaf = np.flatnonzero(bits >= 128)
        parts = [(leaf[n[leaf] > 0], bit) for bit, n in ((0, n0), (1, n1))]
        key = np.concatenate([(x[i] & ~255) | ((bits[i] << 1 | bit) & 255) for i, bit in parts])
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.concatenate([(n0, n1)[bit][i] for i, bit in parts])), pa.array(
            np.concatenate([total[i] + decision[bit][i] for i, bit in parts]))], names=["key", "n", "lp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            part = [batch.column(c).to_numpy() for c in names]
            if rest is not None:
                part = [np.concatenate(pair) for pair in zip(rest, part, strict=True)]
            if not len(part[0]):
                continue
            cut = int(np.searchsorted(part[0], part[0][-1] & ~255))  # the last context may go on: 255 nodes at most
            if cut:
                yield lengths(*(c[:cut] for c in part))
            rest = [c[cut:] for c in part]
        if rest is not None:
            yield lengths(*rest)

    return rows.select(*names).mapInArrow(run, "key bigint, n bigint, lp double")


def unseen_lengths(keys: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``key`` and ``lp`` of sequences that the training data lack: each decision ends at the deepest node there is."""
    rows = keys.select("key", F.explode(_decisions(F.col("key"), DEPTH)).alias("d")).select("key", "d.bit", F.col("d.x").alias("x5"))
    for depth in range(DEPTH + 1):
        node = F.col("x5").bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1))
        rows = rows.withColumn("x", node).join(levels[depth].withColumnRenamed("stop", f"s{depth}"), "x", "left").drop("x")
    rows = rows.withColumn("stop", F.coalesce(*[F.col(f"s{d}") for d in range(DEPTH, -1, -1)], F.lit(0.5)))
    return rows.groupBy("key").agg(F.sum(F.log10(F.when(F.col("bit") == 1, F.col("stop")).otherwise(1 - F.col("stop")))).alias("lp"))


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The rows of the highest counts, as many whole steps of counts as fit into ``limit`` rows."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    total, least = 0, None
    for row in counts.groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect():  # some hundred steps
        total += row["count"]
        if total > limit:
            break
        least = row["s"]
    return counts.where(F.lit(False) if least is None else step >= least)


def slots(keys: np.ndarray, table: int, size: int) -> np.ndarray:
    """Places of keys in a table whose size is a power of two."""
    return ((keys.view(np.uint64) * np.uint64(_MULTIPLIERS[table])) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def fast_table(keys: np.ndarray, values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two tables, twice and once as large as the keys; a key that finds both of its places taken is left to the join."""
    tables = []
    for t in range(2):
        size = 1 << max(1, (2 * len(keys)).bit_length() - t)
        place, first = np.unique(slots(keys, t, size), return_index=True)
        k, v = np.full(size, -1, np.int64), np.zeros(size, np.float64)
        k[place], v[place] = keys[first], values[first]
        tables.append((k, v))
        left = np.ones(len(keys), bool)
        left[first] = False
        keys, values = keys[left], values[left]
    return tables


def score_texts(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row ``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``n_bytes``.

    ``train``: a condition on the key; the rows to learn from.
    """
    source = docs.select(docs[key].alias("id"), docs[text].alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    learn = docs.where(train).select(docs[text].alias("text"))
    counts = gram_counts(learn)
    words = written(word_counts(learn), "words")
    ends = learn.count()
    sums = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, types = (sums[0] or 0) + ends, sums[1] + (ends > 0)
    base = math.log10(tokens + types + 1)
    levels, lengths = tree(counts)
    lengths = written(lengths, "lengths")

    found = most_frequent(lengths, FAST).select("key", "lp").toArrow()
    tables = fast_table(found.column("key").to_numpy(), found.column("lp").to_numpy())
    common = most_frequent(words, FAST_WORDS).select("word", "n").toArrow()
    held = docs.sparkSession.sparkContext.broadcast((tables, {
        w: math.log10(n + 1) - base for w, n in zip(common.column("word").to_pylist(), common.column("n").to_pylist(), strict=True)}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (first, second), price = held.value
        end = math.log10(ends + 1) - base
        for batch in batches:
            at = 0
            for group in in_chunks(lowered(texts(batch.column("text")))):
                grams_of, owner = grams(group)
                place = slots(grams_of, 0, len(first[0]))
                hit, value = first[0][place] == grams_of, first[1][place]
                miss = np.flatnonzero(~hit)
                place = slots(grams_of[miss], 1, len(second[0]))
                second_hit = second[0][place] == grams_of[miss]
                value[miss] = np.where(second_hit, second[1][place], 0.0)
                sums = np.bincount(owner, weights=value, minlength=len(group))
                miss = miss[~second_hit]
                rest, rest_of = grams_of[miss], owner[miss]
                order = np.lexsort((rest, rest_of))
                rest, rest_of = rest[order], rest_of[order]
                new = np.flatnonzero(np.concatenate([[True], (rest[1:] != rest[:-1]) | (rest_of[1:] != rest_of[:-1])])) if len(rest) else np.zeros(0, np.int64)
                times = np.diff(np.concatenate([new, [len(rest)]]))
                cuts = np.searchsorted(rest_of[new], np.arange(len(group) + 1))
                n_tokens, known, bases, other, other_n, other_cuts = [], [], [], [], [], [0]
                for data in group:
                    total, sure, count = end, int(ends > 0), 1
                    for word, n in Counter(data.split()).items():
                        count += n
                        if (p := price.get(word)) is not None:
                            total += n * p
                            sure += n
                        else:
                            other.append(word)
                            other_n.append(n)
                    other_cuts.append(len(other))
                    n_tokens.append(count)
                    known.append(sure)
                    bases.append(total)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(at, len(group)), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(bases, pa.float64()),
                    pa.array(sums), pa.array([len(d) + 1 for d in group], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(rest[new], pa.int64())),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(times, pa.int64())),
                    pa.ListArray.from_arrays(pa.array(other_cuts, pa.int32()), pa.array(other, pa.binary())),
                    pa.ListArray.from_arrays(pa.array(other_cuts, pa.int32()), pa.array(other_n, pa.int64())),
                ], names=["id", "n_tokens", "n_known", "base", "score", "n_bytes", "keys", "key_n", "words", "word_n"])
                at += len(group)

    part = written(source.mapInArrow(
        run, f"id {kind}, n_tokens bigint, n_known bigint, base double, score double, n_bytes bigint, "
        "keys array<bigint>, key_n array<bigint>, words array<binary>, word_n array<bigint>").withColumn("uid", F.monotonically_increasing_id()), "scores")

    missed = part.select("uid", F.explode(F.arrays_zip("keys", "key_n")).alias("m")).select("uid", F.col("m.keys").alias("key"), F.col("m.key_n").alias("n"))
    need = missed.select("key").distinct()
    new = unseen_lengths(need.join(lengths, "key", "left_anti"), levels)
    known = lengths.join(need, "key", "left_semi").select("key", "lp")
    more = missed.join(known.union(new), "key").groupBy("uid").agg(F.sum(F.col("n") * F.col("lp")).alias("more"))
    rare = part.select("uid", F.explode(F.arrays_zip("words", "word_n")).alias("m")).select("uid", F.col("m.words").alias("word"), F.col("m.word_n").alias("k"))
    rare = rare.join(words, "word", "left").groupBy("uid").agg(
        F.sum(F.col("k") * (F.log10(F.coalesce("n", F.lit(0)) + 1.0) - base)).alias("rare"), F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("sure"))
    return part.drop("keys", "key_n", "words", "word_n").join(more, "uid", "left").join(rare, "uid", "left").select(
        F.col("id").alias(key), "n_tokens", (F.col("n_known") + F.coalesce("sure", F.lit(0))).alias("n_known"), F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare", F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"), "n_bytes")


def held_out(key: Column, folds: int = 7, fold: int = 2) -> Column:
    return crc_bucket(key, folds) == fold
