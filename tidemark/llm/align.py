"""Alignment of the tokens of two tokenizers, A (byte-level BPE) and B (sentencepiece), over one corpus.

Both tokenizers cut the same bytes, a space and the text. Places where tokens of both end cut them into groups; inside a
group every A and B token that overlap are a link.

* Identity map: for each A id the B id of the same bytes, worked out once from the vocabularies. A group of one A and one
  B token is such a pair nearly always; these are counted in vectors as long as A's vocabulary, one a task.
* Only the pairs of other groups go through a shuffle, combined by the task.
* The counts that all documents need come back in three bounded pieces: the vector of identity pairs, the highest count
  of each B id, and the ``HOT`` most frequent other pairs. Pairs beyond these, each rare by then, are joined.

Words after single spaces, and lines after single line ends inside them, are aligned one by one and kept in a bounded
table: A's public pattern begins a piece there, and a vocabulary in which no B piece has a space after another character
or a line end beside one (checked) lets no B token cross.
Texts with other spaces, and those that hold B's own mark for a space, are aligned whole.

Defined cases: a text that is null, empty, or that either tokenizer does not give back byte by byte has no tokens, zeros
and an empty ``groups``; repeated rows and keys stay separate rows; null keys are kept; an empty table gives no row;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import written
from tidemark.llm.dac import _byte_letters

#: Pairs beside the identity map whose counts go to every task: 2 MB.
HOT = 1 << 17
#: Words kept by each of two tables, and the longest that is kept.
KEPT_WORDS, KEPT_LENGTH = 150_000, 64
#: Pairs gathered before a task combines them.
GATHERED = 2_000_000
MARK = "▁"
#: A space before white space or the end.
ODD = re.compile(r" (?:\s|\Z)")
#: A letter that is one token of both after a space.
CARRIER = "a"


def vocabulary_bytes(path_a: str, path_b: str) -> tuple[list[bytes], list[bytes]]:
    """The bytes of every token id."""
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path_a)
    plain = {letter: byte for byte, letter in enumerate(_byte_letters())}
    a = [b""] * tokenizer.get_vocab_size()
    for token, number in tokenizer.get_vocab().items():
        a[number] = bytes(plain[c] for c in token) if all(c in plain for c in token) else token.encode()
    model = sentencepiece.SentencePieceProcessor(model_file=path_b)
    b = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        b.append(bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace(MARK, " ").encode())
    return a, b


def identity_map(a: list[bytes], b: list[bytes], skip: int = 3) -> np.ndarray:
    """B id of the same bytes for each A id, -1 for none; the last such B id, so a piece wins over a byte."""
    by = {data: number for number, data in enumerate(b) if number >= skip}
    return np.array([by.get(data, -1) for data in a], np.int64)


class RankWords:
    """A's ids of texts, by the ranks of its vocabulary: an id is the rank of its merge. Special tokens are ordinary text."""

    def __init__(self, vocabulary: list[bytes], special: set[int], pattern: str):
        import tiktoken

        ranks = {data: number for number, data in enumerate(vocabulary) if number not in special}
        self.encoding = tiktoken.Encoding("A", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.begins = [data[:1] == b" " for data in vocabulary]

    def ids(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)


def _cut(ids: list[int], begins: list[bool], words: list[str]) -> list[list[int]] | None:
    """The ids of words that spaces part, one list for each word; None where the tokens do not begin at the words."""
    starts = [place for place, number in enumerate(ids) if begins[number]]
    if len(starts) != len(words) or starts[0]:
        return None
    return [ids[a:b] for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)]


class Aligner:
    """Aligned words and texts of one pair of tokenizers."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = vocabulary_bytes(path_a, path_b)
        self.words_a = RankWords(self.a, set(Tokenizer.from_file(path_a).get_added_tokens_decoder()), pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.size_a, self.size_b = list(map(len, self.a)), list(map(len, self.b))
        self.stride = len(self.b)
        self.identity = identity_map(self.a, self.b)
        self.begins = [data[:1] == b" " for data in self.b]
        # Words may be worked alone only where no piece goes on after a space, and lines of one only where none has a line end inside.
        self.by_words = not any(b" " in data.lstrip(b" ") for data in self.b)
        carrier = b" " + CARRIER.encode()
        self.by_lines = carrier in self.a and carrier in self.b and not any(b"\n" in data for data in self.b if data != b"\n")
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def pair(self, data: bytes, ids_a: list[int], ids_b: list[int]) -> tuple | None:
        """(A tokens, B tokens, groups, links, groups as text, A ids of identity groups, keys of other pairs); None where bytes differ."""
        if b"".join([self.a[i] for i in ids_a]) != data or b"".join([self.b[i] for i in ids_b]) != data:
            return None
        ends_a = list(accumulate([self.size_a[i] for i in ids_a]))
        ends_b = list(accumulate([self.size_b[i] for i in ids_b]))
        groups, same, other = [], [], []
        i = j = from_a = from_b = 0
        while i < len(ends_a):
            if ends_a[i] != ends_b[j]:
                other.append(ids_a[i] * self.stride + ids_b[j])
                if ends_a[i] < ends_b[j]:
                    i += 1
                else:
                    j += 1
                continue
            if i == from_a and j == from_b and self.identity[ids_a[i]] == ids_b[j]:
                same.append(ids_a[i])
                groups.append(f"{ids_a[i]}|{ids_b[j]}")
            else:
                other.append(ids_a[i] * self.stride + ids_b[j])
                groups.append(",".join(map(str, ids_a[from_a:i + 1])) + "|" + ",".join(map(str, ids_b[from_b:j + 1])))
            i += 1
            j += 1
            from_a, from_b = i, j
        return (len(ids_a), len(ids_b), len(groups), len(same) + len(other), ";".join(groups).encode(),
                array("i", same).tobytes(), array("q", other).tobytes())

    def _each(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """A and B ids of a space and the word, for each of some words."""
        text = " ".join(words)
        found_a = _cut(self.words_a.ids(" " + text), self.words_a.begins, words)
        found_b = _cut(self.model.encode(text), self.begins, words)
        return (found_a or [self.words_a.ids(" " + word) for word in words], found_b or [self.model.encode(word) for word in words])

    def _learn(self, words: list[str]) -> dict[str, tuple | None]:
        """Words with their entries; one that begins with a line end is worked behind a letter that is one token of both."""
        found = {}
        for word, ids_a, ids_b in zip(words, *self._each([CARRIER + w if w[0] == "\n" else w for w in words]), strict=True):
            line = word[0] == "\n"
            found[word] = self.pair(word.encode() if line else (" " + word).encode(), ids_a[line:], ids_b[line:])
        return found

    def _lines(self, word: str) -> list[str] | None:
        """A word with single line ends as its first line and the others, each with its line end; None for other words."""
        if "\n" not in word or not self.by_lines:
            return None
        first, *rest = word.split("\n")
        if not first or "" in rest[:-1] or len(word.split()) != len(rest) + 1 - (rest[-1] == ""):
            return None
        return [first, *["\n" + part for part in rest]]

    def _words(self, words: list[str]) -> list[tuple | None]:
        if len(self.young) > KEPT_WORDS:
            self.young, self.old = {}, self.young
        young, old, missing, lines = self.young, self.old, set(), {}
        for word in set(words).difference(young):
            parts = self._lines(word)
            if parts:
                lines[word] = parts
            for part in parts or [word]:
                if part not in young:
                    if part in old:
                        young[part] = old[part]
                    else:
                        missing.add(part)
        fresh = self._learn(list(missing)) if missing else {}
        young.update((w, x) for w, x in fresh.items() if len(w) <= KEPT_LENGTH)
        out = []
        for word in words:
            if word in young:
                out.append(young[word])
            else:
                out += [young[part] if part in young else fresh[part] for part in lines.get(word, (word,))]
        return out

    def text(self, text: str) -> tuple | None:
        """As :meth:`pair`, for a whole text; None where it has no tokens."""
        if not text:
            return None
        if not self.by_words or MARK in text or ODD.search(" " + text):
            return self.pair((" " + text).encode(), self.words_a.ids(" " + text), self.model.encode(text))
        parts = self._words(text.split(" "))
        if None in parts:
            return None
        n_a, n_b, n_groups, links, groups, same, other = zip(*parts, strict=True)
        return sum(n_a), sum(n_b), sum(n_groups), sum(links), b";".join(groups), b"".join(same), b"".join(other)


_ALIGNERS: dict[tuple[str, ...], Aligner] = {}


def _aligner(*place: str) -> Aligner:
    if place not in _ALIGNERS:
        _ALIGNERS[place] = Aligner(*place)
    return _ALIGNERS[place]


def _tally(data: bytes, dtype) -> tuple[bytes, bytes]:
    """Distinct numbers and how often each occurs."""
    numbers, counts = np.unique(np.frombuffer(data, dtype), return_counts=True)
    return numbers.tobytes(), counts.astype(np.int32).tobytes()


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = T.StructType([
    T.StructField("row", T.LongType()), *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("groups_sha256", T.StringType()),
    T.StructField("groups", T.StringType()), *[T.StructField(c, T.BinaryType()) for c in ("same", "same_n", "other", "other_n")]])


def align(
    docs: DataFrame, path_a: str, path_b: str, pattern: str, key: str = "doc_id", text: str = "text", groups: bool = True
) -> DataFrame:
    """One row for each document: its counts, its groups (as text where asked for) and its pairs, ``row`` numbering the rows.

    ``same`` are the distinct A ids of identity groups (32 bits each) with ``same_n``, ``other`` the distinct keys
    ``A id * size of B + B id`` of all other links (64 bits) with ``other_n``. The rows are written once.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["key"], *ALIGNED.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b, pattern)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            at, held, size = 0, [], 0
            for place, value in enumerate(batch.column("text")):
                found = aligner.text(value.as_py() or "")
                n, listed, same, other = (found[:4], *found[4:]) if found else ((0, 0, 0, 0), b"", b"", b"")
                held.append((row, *n, hashlib.sha256(listed).hexdigest() if listed else "", listed.decode() if groups else None,
                             *_tally(same, np.int32), *_tally(other, np.int64)))
                row += 1
                size += len(listed) + len(same) + len(other)
                if size > 16 << 20:
                    yield _batch(batch.column("key")[at:place + 1], held)
                    at, held, size = place + 1, [], 0
            if held:
                yield _batch(batch.column("key")[at:], held)

    def _batch(keys: pa.Array, held: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.binary()] * 4
        columns = [pa.array(c, kind) for c, kind in zip(zip(*held, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([keys, *columns], names=["key", *ALIGNED.names])

    return written(rows.mapInArrow(run, schema), "aligned")


def _numbers(column: pa.Array, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in column), dtype)


def pair_counts(aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``key`` (A id * size of B + B id) and ``n``, the links of that pair in all documents."""
    a, b = vocabulary_bytes(path_a, path_b)
    stride, identity = len(b), identity_map(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(identity), np.int64)
        held, held_n, size = [], [], 0

        def combined() -> pa.RecordBatch:
            keys, at = np.unique(np.concatenate(held), return_inverse=True)
            return _counted(keys, np.bincount(at, weights=np.concatenate(held_n)).astype(np.int64))

        for batch in batches:
            np.add.at(vector, _numbers(batch.column("same"), np.int32), _numbers(batch.column("same_n"), np.int32))
            held.append(_numbers(batch.column("other"), np.int64))
            held_n.append(_numbers(batch.column("other_n"), np.int32))
            size += len(held[-1])
            if size > GATHERED:
                yield combined()
                held, held_n, size = [], [], 0
        if held:
            yield combined()
        there = np.flatnonzero(vector)
        yield _counted(there * stride + identity[there], vector[there])

    def _counted(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])

    counts = aligned.select("same", "same_n", "other", "other_n").mapInArrow(run, "key long, n long")
    return written(counts.groupBy("key").agg(F.sum("n").alias("n")), "aligned-pairs")


def best_links(aligned: DataFrame, pairs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The rows of :func:`align` with ``count_sum`` (of the pair counts of its links) and ``n_best``.

    ``n_best`` counts the links whose pair has the highest count of all pairs of its B id.
    """
    spark = aligned.sparkSession
    a, b = vocabulary_bytes(path_a, path_b)
    stride, identity = len(b), identity_map(a, b)
    tops = written(pairs.groupBy((F.col("key") % stride).alias("b")).agg(F.max("n").alias("top")), "aligned-tops")  # a row for each B id at most
    best = np.zeros(stride, np.int64)
    for row in tops.toLocalIterator():
        best[row["b"]] = row["top"]
    known = np.flatnonzero(identity >= 0)
    keys = spark.createDataFrame([(int(k),) for k in known * stride + identity[known]], "key long")  # a row for each A id at most
    same = np.zeros(len(a), np.int64)
    for row in pairs.join(keys, "key", "left_semi").toLocalIterator():
        same[row["key"] // stride] = row["n"]
    hot = sorted((r["key"], r["n"]) for r in pairs.orderBy(F.desc("n"), "key").limit(HOT).collect())
    told = spark.sparkContext.broadcast((
        best, same, identity, np.array([k for k, _ in hot], np.int64), np.array([n for _, n in hot], np.int64)))
    passed = [f for f in aligned.schema if f.name in ("key", "row", *COUNTS, "groups_sha256", "groups")]
    schema = T.StructType([*passed, *[T.StructField(c, T.LongType()) for c in ("count_sum", "n_best", "pair", "times")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, same, identity, hot_keys, hot_n = told.value
        for batch in batches:
            owner, ids, times = _tallies(batch, "same", np.int32)
            total = same[ids]
            rows = batch.num_rows
            sums = np.bincount(owner, minlength=rows).astype(np.int64) * 0
            tops = sums.copy()
            np.add.at(sums, owner, total * times)
            np.add.at(tops, owner, np.where(total == best[identity[ids]], times, 0))
            owner, keys, times = _tallies(batch, "other", np.int64)
            at = np.minimum(np.searchsorted(hot_keys, keys), max(len(hot_keys) - 1, 0))
            there = hot_keys[at] == keys if len(hot_keys) else np.zeros(len(keys), bool)
            total = hot_n[at[there]]
            np.add.at(sums, owner[there], total * times[there])
            np.add.at(tops, owner[there], np.where(total == best[keys[there] % stride], times[there], 0))
            none = pa.nulls(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in passed], pa.array(sums), pa.array(tops), none, none], names=schema.names)
            owner, keys, times = owner[~there], keys[~there], times[~there]
            if len(keys):
                number = batch.column("row").to_numpy()[owner]
                blank = {f.name: pa.nulls(len(keys), batch.schema.field(f.name).type) for f in passed}
                blank |= {"row": pa.array(number), "count_sum": pa.nulls(len(keys), pa.int64()), "n_best": pa.nulls(len(keys), pa.int64()),
                          "pair": pa.array(keys), "times": pa.array(times.astype(np.int64))}
                yield pa.RecordBatch.from_arrays([blank[c] for c in schema.names], names=schema.names)

    parts = written(aligned.mapInArrow(run, schema), "aligned-parts")
    rare = parts.filter(F.col("pair").isNotNull()).select("row", F.col("pair").alias("key"), "times").join(pairs, "key")
    rare = rare.join(tops, F.col("key") % stride == F.col("b")).groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("more_best"))
    whole = parts.filter(F.col("pair").isNull()).drop("pair", "times").join(rare, "row", "left")
    return whole.withColumns({
        "count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0)),
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0))}).drop("more", "more_best", "row")


def _tallies(batch: pa.RecordBatch, name: str, dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the batch, number and how often, for all tallies of a column."""
    column = batch.column(name)
    sizes = np.array([len(v.as_py()) for v in column], np.int64) // np.dtype(dtype).itemsize
    return np.repeat(np.arange(len(sizes)), sizes), _numbers(column, dtype), _numbers(batch.column(name + "_n"), np.int32).astype(np.int64)


def cross_alignment(
    docs: DataFrame, path_a: str, path_b: str, pattern: str, key: str = "doc_id", text: str = "text", groups: bool = False
) -> DataFrame:
    """Alignment of every document with the counts that its links have in the whole corpus.

    ``path_a`` is the JSON file of a byte-level BPE whose ids are the ranks of its merges, ``pattern`` what cuts its texts.
    """
    rows = align(docs, path_a, path_b, pattern, key, text, groups)
    return best_links(rows, pair_counts(rows, path_a, path_b), path_a, path_b).withColumnRenamed("key", key)


def id_map(spark: SparkSession, pairs: DataFrame, path_b: str) -> DataFrame:
    """For each A id the B id with most links (of equal ones the smallest), their number and the share of the A id's links."""
    import sentencepiece

    stride = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    split = pairs.select(F.floor(F.col("key") / stride).alias("a"), (F.col("key") % stride).alias("b"), "n")
    chosen = split.groupBy("a").agg(F.max(F.struct("n", (-F.col("b")).alias("back"))).alias("top"), F.sum("n").alias("links"))
    return chosen.select("a", (-F.col("top.back")).alias("b"), F.col("top.n").alias("n"), (F.col("top.n") / F.col("links")).alias("share"))
