"""Phrase collocations by a multikey three-way quicksort of suffix pointers.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into words. Every word begins a
suffix: itself and up to three more words of its piece.

1. Words are counted for each language, and hashes of neighbouring words over all. Two filters of fixed size tell the
   tasks which words and which pairs reach ``least``; a suffix ends before a word or a pair that does not, as no frequent
   phrase holds it. What a filter lets through wrongly costs work, not exactness.
2. Each task combines its equal suffixes. They are written once, then routed by their leading words: range partitions
   over language and words, so a leading word of any frequency is cut at its second, third or fourth word.
3. A task sorts pointers to its suffixes to depth four. All open partitions take a round together: each is split by a
   pivot word into less, equal and greater. The size of an equal partition is the count of a phrase; it goes on one word
   deeper. Partitions below ``least`` are abandoned. Only a phrase at either end of a task's range can have occurrences
   next door; these are counted apart and summed over the tasks.

Defined cases: a null text is empty, a null language ``und``; texts without two words in a piece add words and no phrase;
repeated rows count as often as they occur; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

DEPTH = 4
#: What ends a piece, as bytes.
ENDS = b".,;:!?\n\x0b\x0c\r"
#: All piece ends to a line feed, a tab to a space.
SIMPLER = bytes.maketrans(ENDS + b"\t", b"\n" * len(ENDS) + b" ")
#: Text that is worked at once, in bytes; a longer text is one portion.
PORTION = 4 << 20
#: Bits of the filter of frequent words (a power of two).
FILTER_BITS = 1 << 27
#: Where the second of a hash's two bits is taken from, for hashes of 64 and of 32 bits.
WIDE, NARROW = 32, 5
#: Rows of suffixes that make one range.
RANGE_ROWS = 250_000
#: A suffix is one text, each word with a space after it, so that what begins with the same words lies side by side.
SUFFIX = "lang string, words string, n int"


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Language and text of portions: lower case, pieces apart by line feeds, words by spaces."""
    for batch in batches:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            lang, data = lang.as_py() or "und", (text.as_py() or "").encode("utf-8", "surrogatepass").lower().translate(SIMPLER)
            held.setdefault(lang, []).append(data)
            sizes[lang] = sizes.get(lang, 0) + len(data)
            if sizes[lang] > PORTION:
                yield lang, b"\n".join(held.pop(lang))
                sizes[lang] = 0
        for lang, parts in held.items():
            yield lang, b"\n".join(parts)


def _coded(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the word at each place, and the number of its piece."""
    words = pc.split_pattern(pa.array([data.replace(b"\n", b" ")], pa.large_binary()), " ").flatten()
    words = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
    raw = np.frombuffer(data, np.uint8)
    letter = (raw != 32) & (raw != 10)
    letter[1:] &= (raw[:-1] == 32) | (raw[:-1] == 10)  # from here on: the first letter of a word
    return words.dictionary.cast(pa.binary()), words.indices.to_numpy(), np.searchsorted(np.flatnonzero(raw == 10), np.flatnonzero(letter))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, data in _portions(batches):
        words, codes, _ = _coded(data)
        if len(words):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), words.cast(pa.string()), pa.array(np.bincount(codes), pa.int64())],
                names=["lang", "word", "n"])


def frequent_bits(hashes: DataFrame, wide: bool = True) -> bytes:
    """Filter of the column ``h``, 64 or 32 bits wide: two bits of each hash. Its size is fixed."""
    h = F.col("h").cast("long").bitwiseAND(F.lit(-1 if wide else 0xFFFFFFFF))
    bits = hashes.select(F.explode(F.array(
        h.bitwiseAND(F.lit(FILTER_BITS - 1)), F.shiftrightunsigned(h, WIDE if wide else NARROW).bitwiseAND(F.lit(FILTER_BITS - 1)))).alias("bit"))
    pages = bits.groupBy(F.floor(F.col("bit") / 32768).alias("page")).agg(F.bitmap_construct_agg(F.col("bit") % 32768).alias("bits"))
    out = bytearray(FILTER_BITS // 8)
    for row in pages.toLocalIterator():  # at most FILTER_BITS / 32768 pages of 4 KiB
        out[row["page"] * 4096:(row["page"] + 1) * 4096] = row["bits"]
    return bytes(out)


def _within(h: np.ndarray, bits: np.ndarray, wide: bool = True) -> np.ndarray:
    """Which hashes the filter may hold."""
    mask = np.uint64(FILTER_BITS - 1)
    found = np.ones(len(h), bool)
    h = h.astype(np.uint64)
    for bit in (h & mask, (h >> np.uint64(WIDE if wide else NARROW)) & mask):
        found &= (bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return found


def _frequent(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[tuple]:
    """Of each portion: language, frequent words (the empty word first), word at each place, pairs' 32-bit hashes (0: no pair).

    A place holds 0 where its word is not frequent; a pair is a frequent word and the frequent word after it in its piece.
    """
    for lang, data in _portions(batches):
        words, codes, piece = _coded(data)
        head = lang.encode() + b"\0"
        h = np.fromiter((xxhash.xxh64_intdigest(head + w, 42) for w in words.to_pylist()), np.uint64, len(words))
        kept = _within(h, bits)
        codes = np.where(kept[codes], np.cumsum(kept)[codes], 0)
        words = pa.concat_arrays([pa.array([b""], pa.binary()), words.filter(pa.array(kept))])
        h = np.append(np.zeros(1, np.uint64), h[kept])
        pair = np.zeros(len(codes), np.uint32)
        there = (codes[:-1] > 0) & (codes[1:] > 0) & (piece[:-1] == piece[1:])
        after = h[codes[1:][there]]
        pair[:-1][there] = ((h[codes[:-1][there]] ^ (after << np.uint64(31) | after >> np.uint64(33))) >> np.uint64(20)).astype(np.uint32) | np.uint32(1)
        yield lang, words, codes, pair


def pair_hashes(bits) -> callable:
    """Hashes of neighbouring frequent words with their number in each portion."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, pair in _frequent(batches, np.frombuffer(bits.value, np.uint8)):
            keys, n = np.unique(pair[pair > 0], return_counts=True)
            yield from pa.Table.from_arrays([pa.array(keys.view(np.int32)), pa.array(n, pa.int32())], names=["h", "n"]).to_batches(max_chunksize=200_000)

    return run


def suffixes(bits, pair_bits) -> callable:
    """Distinct suffixes of two words or more of each portion, with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, codes, pair in _frequent(batches, np.frombuffer(bits.value, np.uint8)):
            goes_on = pair > 0
            goes_on[goes_on] = _within(pair[goes_on], np.frombuffer(pair_bits.value, np.uint8), wide=False)
            columns = [codes.astype(np.int64)]
            for depth in range(1, DEPTH):
                ahead = np.zeros(len(codes), np.int64)
                if len(codes) > depth:
                    ahead[:-depth] = np.where(goes_on[depth - 1:-1], codes[depth:], 0)
                columns.append(np.where(columns[-1] > 0, ahead, 0))
            there = columns[1] > 0
            if not there.any():
                continue
            columns = [c[there] for c in columns]
            size = len(words)
            left, left_at = np.unique(columns[0] * size + columns[1], return_inverse=True)
            right, right_at = np.unique(columns[2] * size + columns[3], return_inverse=True)
            keys, n = np.unique(left_at * len(right) + right_at, return_counts=True)
            a, b = left[keys // len(right)], right[keys % len(right)]
            spaced = pc.binary_join_element_wise(words.cast(pa.string()), pa.scalar(""), " ")
            spaced = pa.concat_arrays([pa.array([""], pa.string()), spaced[1:]])  # no word, no space
            parts = [spaced.take(pa.array(x)) for x in (a // size, a % size, b // size, b % size)]
            yield from pa.Table.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pc.binary_join_element_wise(*parts, ""), pa.array(n, pa.int32())],
                names=["lang", "words", "n"]).to_batches(max_chunksize=100_000)

    return run


def sorted_counts(columns: list[np.ndarray], weight: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(a pointer, words, count) of every phrase of two words or more that occurs ``least`` times.

    ``columns`` hold the word at each depth, 0 for none. Multikey three-way quicksort, all open partitions a round.
    """
    order = np.arange(len(weight))
    begin = np.zeros(1 if len(order) else 0, np.int64)  # first place of each open partition; they lie side by side
    depth = np.zeros(len(begin), np.int64)
    table = np.stack(columns)
    turn = 0
    while len(begin):
        sizes = np.diff(np.append(begin, len(order)))
        part = np.repeat(np.arange(len(begin)), sizes)
        pivot = begin + (sizes * (0.5 + 0.31 * (turn % 3 - 1))).astype(np.int64)
        turn += 1
        word = table[depth[part], order]
        side = np.sign(word - word[pivot][part]) + 1  # 0 less, 1 equal, 2 greater
        group = part * 3 + side
        total = np.bincount(group, weights=weight[order], minlength=3 * len(begin)).astype(np.int64)
        deep = np.repeat(depth, 3)
        deep[1::3] += 1
        equal = np.arange(1, 3 * len(begin), 3)
        found = equal[(total[equal] >= least) & (deep[equal] >= 2) & (word[pivot] > 0)]
        for g in found:
            yield int(order[pivot[g // 3]]), int(deep[g]), int(total[g])
        open_ = (total >= least) & (deep < len(columns))
        open_[1::3] &= word[pivot] > 0  # after the last word of a suffix nothing follows
        goes = open_[group]
        group, order = group[goes], order[goes]
        order = order[np.argsort(group, kind="stable")]
        ids, counts = np.unique(group, return_counts=True)
        begin = np.cumsum(counts) - counts
        depth = deep[ids]


def counted(least: int) -> callable:
    """Counts of the phrases of one range; those at its ends whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if held is None or not held.num_rows:
            return
        for lang in pc.unique(held.column("lang")).to_pylist():
            mine = held.filter(pc.equal(held.column("lang"), lang))
            size = mine.num_rows
            listed = pc.split_pattern(pc.utf8_rtrim(mine.column("words").combine_chunks(), " "), " ")
            coded, counts = listed.flatten().dictionary_encode(), pc.list_value_length(listed).to_numpy()
            # by bytes and with the space, as the routing compares them
            by_bytes = pc.sort_indices(pc.binary_join_element_wise(coded.dictionary, pa.scalar(""), " ").cast(pa.binary())).to_numpy()
            rank = np.empty(len(by_bytes), np.int64)
            rank[by_bytes] = np.arange(1, len(by_bytes) + 1)  # 0 stands for no word
            codes, first = rank[coded.indices.to_numpy()], np.cumsum(counts) - counts
            columns = [np.zeros(size, np.int64) for _ in range(DEPTH)]
            for depth, column in enumerate(columns):
                there = counts > depth
                column[there] = codes[first[there] + depth]
            names = ["", *coded.dictionary.take(pa.array(by_bytes)).to_pylist()]
            weight = mine.column("n").to_numpy().astype(np.int64)
            phrases, counts = [], []
            ends = set()
            for pick in (np.min, np.max):
                same = np.ones(size, bool)
                prefix: tuple[int, ...] = ()
                for column in columns:
                    word = int(pick(column[same]))
                    if not word:
                        break
                    same &= column == word
                    prefix += (word,)
                    if len(prefix) >= 2 and prefix not in ends:
                        ends.add(prefix)
                        phrases.append(" ".join(names[w] for w in prefix))
                        counts.append(int(weight[same].sum()))
            for at, deep, total in sorted_counts(columns, weight, least):
                prefix = tuple(int(c[at]) for c in columns[:deep])
                if prefix not in ends:
                    phrases.append(" ".join(names[w] for w in prefix))
                    counts.append(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.string()), pa.array(counts, pa.int64())],
                names=["lang", "phrase", "n"])

    return run


def phrase_counts(docs: DataFrame, least: int = 30, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Words of each language with their counts (all of them), and its phrases of 2 to 4 words from ``least`` on."""
    spark = docs.sparkSession
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    words = rows.mapInArrow(count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = written(words, "phrase-words")
    named = F.xxhash64(F.concat(F.encode("lang", "UTF-8"), F.unhex(F.lit("00")), F.encode("word", "UTF-8")))
    bits = spark.sparkContext.broadcast(frequent_bits(words.filter(F.col("n") >= least).select(named.alias("h"))))
    pairs = rows.mapInArrow(pair_hashes(bits), "h int, n int").groupBy("h").agg(F.sum("n").alias("n"))
    pair_bits = spark.sparkContext.broadcast(frequent_bits(pairs.filter(F.col("n") >= least), wide=False))
    found = written(rows.mapInArrow(suffixes(bits, pair_bits), SUFFIX), "phrase-suffixes")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-found.count() // RANGE_ROWS))
    routed = found.repartitionByRange(ranges, "lang", "words")
    counts = routed.mapInArrow(counted(least), "lang string, phrase string, n long")
    phrases = written(counts.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "phrase-counts")
    bits.destroy()
    pair_bits.destroy()
    return words, phrases


def collocations(docs: DataFrame, top: int = 2000, least: int = 30, text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``top`` phrases of each language by their weakest cut.

    A phrase cut after word k has the score floor(2,000,000 a / (l + r)); the lowest of its cuts counts, of equal ones the
    first. Phrases that stand inside a longer one with four fifths of their occurrences or more are left out.
    """
    words, phrases = phrase_counts(docs, least, text, lang)
    totals = words.groupBy("lang").agg(F.sum("n").alias("words"))
    parts = words.filter(F.col("n") >= least).withColumnRenamed("word", "phrase").unionByName(phrases)
    split = F.split("phrase", " ")
    listed = phrases.select("lang", "phrase", F.col("n").alias("a"), split.alias("w"))

    size = F.size("w")
    longer = listed.filter(size > 2).select("lang", F.col("a").alias("whole"), "w")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda k: F.transform(
        F.sequence(F.lit(1), size - k + 1), lambda i: F.array_join(F.slice("w", i, k), " "))))
    inside = longer.select("lang", F.explode(spans).alias("phrase"), "whole").groupBy("lang", "phrase").agg(F.max("whole").alias("whole"))
    big = lambda c: F.col(c).cast("decimal(20,0)")
    free = listed.join(inside, ["lang", "phrase"], "left").filter(
        F.col("whole").isNull() | (big("whole") * 100 < big("a") * 80)).drop("whole")

    cuts = free.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, size - F.col("k")), " ").alias("tail"))
    left = parts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"]).withColumn(
        "score", F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    worst = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")).select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = worst.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")


ORACLE = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, words FROM (
    SELECT lang, regexp_extract_all(part, '[^\x20\x09]+') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS part
      FROM documents)) WHERE len(words) > 0),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
sizes AS (SELECT unnest(range(1, 5)) AS size),
counts AS (
  SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase, count(*) AS n
  FROM starts, sizes WHERE i + size - 1 <= len(words) GROUP BY 1, 2, 3),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
listed AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2 AND n >= 30),
inside AS (
  SELECT lang, phrase, max(whole) AS whole FROM (
    SELECT lang, a AS whole, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, a, w, k, unnest(range(1, CAST(size - k + 2 AS BIGINT))) AS i
          FROM (SELECT *, unnest(range(2, CAST(size AS BIGINT))) AS k FROM listed WHERE size > 2)))
  GROUP BY 1, 2),
free AS (
  SELECT l.* FROM listed l LEFT JOIN inside USING (lang, phrase) WHERE whole IS NULL OR 100 * whole < 80 * a),
cuts AS (
  SELECT *, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, CAST(size AS BIGINT))) AS k FROM free)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, x.n AS l, y.n AS r,
         CAST((2000000 * CAST(a AS HUGEINT)) // (x.n + y.n) AS BIGINT) AS score
  FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = cuts.head JOIN counts y ON y.lang = cuts.lang AND y.phrase = cuts.tail),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
SELECT lang, rank, phrase, a, l, r, totals.n AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
