"""Benchmark decontamination: BM25 over an inverted index of test items, searched with block-max WAND.

The index holds the items in chunks of at most ``CHUNK`` words; every passage of every training text is a query
(``2 * CHUNK`` words, a new one every ``CHUNK``, so a chunk lies whole inside one of them). Impacts are divided by the
chunk's threshold, ``SHARE`` of the score it gives itself, so everything of 1 or more is retrieved; there is no top-k.

For all passages of a batch at once the block maxima of their terms are added up. A passage whose bound is below 1 in
every block is done; the others walk the postings document at a time, skip blocks whose bound is below 1, and score what
the pivot rule leaves. A retrieved item is then verified in the text around the passage: of the question's word n-grams
and of the answer's (the last line of an item of several lines) at least ``OVERLAP`` each must stand there.

With ``parts`` (the default) a piece of an item is enough. Rolling hashes of word ids, checked word by word,
find every run of ``RUN`` words of an item and every stretch of ``2 * CHUNK`` words that holds ``OVERLAP`` of a chunk's word
n-grams, whatever their BM25 score; shorter items count where all their words stand in a row. A last line is then an answer
only below a question mark or behind a mark of its own (``ANSWER``), and no copy is let off because its answer is missing.

The items are a stated query set. Their statistics come from all items; the index is cut into slices of about ``SLICE``
items or chunks, whichever makes more slices, and the texts are read once for each slice. Each slice's index is built on
the driver, and an item is not cut, so an item of very many chunks makes a slice of its size.

An item of fewer than ``SHORT`` words is too common a phrase to count inside a sentence: it must be a whole line of the
text, or several.

Defined cases: a null or empty text has no passage; an item without words is never reported, one with fewer than ``NGRAM``
words only with ``parts`` (share 1), as n-grams cannot verify it; item ids may be of any type; equal items are all reported; rows are searched one by one, null or repeated keys like others; an
empty table on either side gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts, written

WORD = re.compile(r"[^\W_]+")
CHUNK, BLOCK, SLICE, NGRAM = 48, 4, 4096, 5
SHARE, OVERLAP = 0.6, 0.5
#: Items of fewer words count only as whole lines.
SHORT = 8
RUN, MIX = 13, np.uint64(0x9E3779B97F4A7C15)
ANSWER = re.compile(r"\s*(?:answer|solution|a)\s*[:.)]|\s*####", re.IGNORECASE)
K1, B = 1.2, 0.75


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def chunks_of(words: list[str]) -> list[list[str]]:
    """Even chunks of ``CHUNK`` words at most."""
    parts = -(-len(words) // CHUNK) or 1
    return [words[len(words) * k // parts:len(words) * (k + 1) // parts] for k in range(parts)]


def ngrams(words: list[str], size: int) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def overlap(part: list[str], there: list[str]) -> float:
    """Share of the part's n-grams (all of its words if it is shorter) that stand in a stretch of words."""
    size = min(NGRAM, len(part))
    own = ngrams(part, size)
    return len(own & ngrams(there, size)) / len(own) if size else 1.0


class Item(NamedTuple):
    item: int | str | None
    length: int
    question: list[str]
    answer: list[str]
    words: list[str]


class Places(NamedTuple):
    hashes: np.ndarray
    places: dict[int, list[tuple[int, int]]]


class Index(NamedTuple):
    """Postings with normalised impacts; ``bounds[t, b]``: the largest impact of term t in block b.

    Empty without ``parts``: ``starts``, the words before each chunk in its item; ``need``, the n-grams that a chunk must share;
    ``grams`` and ``runs``, the sorted hashes and their places, (chunk, gram) and by length of the run (item, word).
    """

    terms: dict[str, int]
    chunks: list[list[int]]
    impacts: list[list[float]]
    bounds: np.ndarray
    owner: list[int]
    items: list[Item]
    starts: list[int]
    need: list[int]
    grams: Places
    runs: dict[int, Places]


def hashes(ids: np.ndarray, sizes: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each of the sizes the rolling hashes of so many neighbouring ids."""
    out = np.zeros(len(ids), np.uint64)
    for k in range(min(max(sizes, default=0), len(ids))):
        out = out[:len(ids) - k] * MIX + ids[k:]
        if k + 1 in sizes:
            yield k + 1, out


def build(rows: list[tuple[int, str]], total: int, mean: float, frequency: dict[str, int], parts_too: bool = False) -> Index:
    """Index of one slice. ``total``, ``mean`` and ``frequency``: chunks, words per chunk and chunks of a word, over all items."""
    terms: dict[str, int] = {}
    chunks: list[list[int]] = []
    impacts: list[list[float]] = []
    owner, items, pieces, starts, short = [], [], [], [], []
    for number, text in rows:
        words = words_of(text)
        if len(words) < NGRAM:
            short += [Item(number, len(words), words, [], words)] if words and parts_too else []
            continue
        question, _, answer = (text or "").rstrip().rpartition("\n")
        parts = (words_of(question), words_of(answer)) if words_of(question) and words_of(answer) else (words, [])
        if parts_too and not (question.rstrip().endswith(("?", "\uff1f")) or ANSWER.match(answer)):
            parts = (words, [])
        items.append(Item(number, len(words), *parts, words))
        for chunk in chunks_of(words):
            starts.append(starts[-1] + len(pieces[-1]) if owner and owner[-1] == len(items) - 1 else 0)
            pieces.append(chunk)
            weight = {}
            for w, n in Counter(chunk).items():
                idf = np.log(1 + (total - frequency[w] + 0.5) / (frequency[w] + 0.5))
                weight[w] = float(idf * n * (K1 + 1) / (n + K1 * (1 - B + B * len(chunk) / mean)))
            need = SHARE * sum(weight.values())
            for w, value in weight.items():
                t = terms.setdefault(w, len(terms))
                if t == len(chunks):
                    chunks.append([])
                    impacts.append([])
                chunks[t].append(len(owner))
                impacts[t].append(value / need)
            owner.append(len(items) - 1)
    bounds = np.zeros((len(terms), -(-len(owner) // BLOCK)), np.float32)
    for t, (at, value) in enumerate(zip(chunks, impacts, strict=True)):
        np.maximum.at(bounds[t], np.array(at) // BLOCK, np.array(value, np.float32))
    bounds *= np.float32(1 + 1e-6)
    if not parts_too:
        return Index(terms, chunks, impacts, bounds, owner, items, [], [], Places(np.zeros(0, np.uint64), {}), {})
    items += short
    for item in short:
        for w in item.words:
            terms.setdefault(w, len(terms))  # beyond the postings

    def placed(sequences: list[list[str]], size: int) -> Places:
        places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, words in enumerate(sequences):
            for _, found in hashes(np.array([terms[w] + 1 for w in words], np.uint64), {size}):
                for at, value in enumerate(found.tolist()):
                    places[value].append((k, at))
        return Places(np.array(sorted(places), np.uint64), dict(places))

    lengths = {min(RUN, item.length) for item in items}
    runs = {size: placed([item.words if min(RUN, item.length) == size else [] for item in items], size) for size in lengths}
    need = [max(1, int(np.ceil(OVERLAP * len(ngrams(chunk, NGRAM))))) for chunk in pieces]
    return Index(terms, chunks, impacts, bounds, owner, items, starts, need, placed(pieces, NGRAM), runs)


def search(index: Index, query: list[int], bound: np.ndarray) -> dict[int, float]:
    """Chunks whose score for the distinct terms of ``query`` is 1 or more. ``bound``: the query's bound for each block."""
    ends = len(index.owner)
    cursor = [[index.chunks[t][0], 0, t] for t in query]
    top = {t: float(index.bounds[t].max()) for t in query}
    found = {}

    def move(c: list, least: int) -> None:
        at, place = index.chunks[c[2]], c[1]
        while place < len(at) and at[place] < least:
            place += 1
        c[0], c[1] = (at[place] if place < len(at) else ends), place

    while True:
        cursor.sort()
        total, pivot = 0.0, None
        for c in cursor:
            if c[0] >= ends:
                break
            total += top[c[2]]
            if total >= 1:
                pivot = c[0]
                break
        if pivot is None:
            return found
        block = pivot // BLOCK
        if bound[block] < 1:
            least = (block + 1) * BLOCK
        elif cursor[0][0] < pivot:
            least = pivot
        else:
            score = sum(index.impacts[c[2]][c[1]] for c in cursor if c[0] == pivot)
            if score >= 1 - 1e-9:
                found[pivot] = score * SHARE
            least = pivot + 1
        for c in cursor:
            if c[0] < least:
                move(c, least)


def passages(index: Index, words: list[str]) -> Iterator[tuple[int, list[int], np.ndarray]]:
    """Start, distinct known terms and block bounds of the passages that may reach a threshold."""
    get = index.terms.get
    ids = np.array([get(w, -1) for w in words], np.int64)
    size = len(index.chunks)
    place = np.flatnonzero((ids >= 0) & (ids < size))
    if not len(place):
        return
    half = place // CHUNK
    pairs = np.unique(np.concatenate([half, np.maximum(half - 1, 0)]) * size + np.tile(ids[place], 2))
    number, term = pairs // size, pairs % size
    first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    bound = np.add.reduceat(index.bounds[term], first, axis=0)
    last = np.append(first[1:], len(term))
    for k in np.flatnonzero(bound.max(axis=1) >= 1):
        yield int(number[first[k]]) * CHUNK, term[first[k]:last[k]].tolist(), bound[k]


def copied(index: Index, words: list[str]) -> Iterator[tuple[int, int, int]]:
    """Item, chunk (-1: none) and place in ``words`` of copied runs and of stretches that share enough of a chunk."""
    get = index.terms.get
    ids = np.array([get(w, -1) for w in words], np.int64).astype(np.uint64) + np.uint64(1)  # unknown: 0
    sizes = {*index.runs, NGRAM}
    for size, found in hashes(ids, sizes):
        if table := index.runs.get(size):
            for at in _hits(found, table.hashes):
                for k, start in table.places[int(found[at])]:
                    if words[at:at + size] == index.items[k].words[start:start + size]:
                        chunk = bisect_left(index.owner, k)
                        while chunk + 1 < len(index.owner) and index.owner[chunk + 1] == k and index.starts[chunk + 1] <= start:
                            chunk += 1
                        yield k, chunk if index.items[k].length >= NGRAM else -1, at
        if size == NGRAM:
            shared: dict[int, list[tuple[int, tuple[str, ...]]]] = defaultdict(list)
            for at in _hits(found, index.grams.hashes):
                gram = tuple(words[at:at + NGRAM])
                for chunk, start in index.grams.places[int(found[at])]:
                    start += index.starts[chunk]
                    if gram == tuple(index.items[index.owner[chunk]].words[start:start + NGRAM]):
                        shared[chunk].append((at, gram))
            for chunk, hits in shared.items():
                inside, first = Counter(), 0
                for at, gram in hits:
                    inside[gram] += 1
                    while hits[first][0] + 2 * CHUNK < at + NGRAM:
                        gone = hits[first][1]
                        inside[gone] -= 1
                        if not inside[gone]:
                            del inside[gone]
                        first += 1
                    if len(inside) >= index.need[chunk]:
                        yield index.owner[chunk], chunk, hits[first][0]


def _hits(found: np.ndarray, known: np.ndarray) -> list[int]:
    if not len(known):
        return []
    return np.flatnonzero(known[np.minimum(np.searchsorted(known, found), len(known) - 1)] == found).tolist()


def share_of(index: Index, chunk: int, there: list[str]) -> float:
    """The chunk's BM25 score for a stretch of words as share of its own."""
    total = 0.0
    for t in {index.terms[w] for w in there if w in index.terms}:
        if t < len(index.chunks) and (place := bisect_left(index.chunks[t], chunk)) < len(index.chunks[t]) and index.chunks[t][place] == chunk:
            total += index.impacts[t][place]
    return total * SHARE


def stands_alone(text: str, item: list[str]) -> bool:
    """Whether the words are all the words of one line or of some lines in a row."""
    words: list[str] = []
    edges = [0]
    for line in text.split("\n"):
        words += words_of(line)
        edges.append(len(words))
    ends = set(edges)
    return any(at + len(item) in ends and words[at:at + len(item)] == item for at in edges)


def matches(index: Index, text: str) -> dict[int, tuple[float, float, float]]:
    """Item places with the best normalised score, question overlap and answer overlap, verified ones only."""
    words = words_of(text)
    best: dict[int, tuple[float, float, float]] = {}
    for start, query, bound in passages(index, words):
        for chunk, score in search(index, query, bound).items():
            k = index.owner[chunk]
            item = index.items[k]
            there = words[max(0, start - item.length):start + 2 * CHUNK + item.length]
            question, answer = overlap(item.question, there), overlap(item.answer, there)
            if min(question, answer) >= OVERLAP and (k not in best or best[k] < (score, question, answer)):
                best[k] = (score, question, answer)
    seen: set[tuple[int, int, int]] = set()
    for k, chunk, at in copied(index, words) if index.runs else ():
        if (k, chunk, at // CHUNK) in seen:
            continue
        seen.add((k, chunk, at // CHUNK))
        item = index.items[k]
        there = words[max(0, at - item.length):at + 2 * CHUNK + item.length]
        score = share_of(index, chunk, words[at // CHUNK * CHUNK:at // CHUNK * CHUNK + 2 * CHUNK]) if chunk >= 0 else 1.0
        found = (score, overlap(item.question, there), overlap(item.answer, there))
        best[k] = max(best.get(k, found), found)
    return {k: found for k, found in best.items() if index.items[k].length >= SHORT or stands_alone(text, index.items[k].words)}


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
                 parts: bool = True) -> DataFrame:
    """One row for each text and item that it holds (with ``parts``: a piece of it): keys, BM25 share, question and answer overlap."""
    spark = docs.sparkSession
    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    named = items.schema[item].dataType
    item_kind = "bigint" if named.simpleString() in ("tinyint", "smallint", "int", "bigint") else "string"
    tests = items.select(items[item].cast(item_kind).alias("item"), items[item_text].alias("text"))

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, size, seen = 0, 0, Counter()
            for value in texts(batch.column("text")):
                words = words_of(value)
                if len(words) >= NGRAM:
                    for chunk in chunks_of(words):
                        count, size = count + 1, size + len(chunk)
                        seen.update(set(chunk))
            yield pa.RecordBatch.from_pydict({
                "word": pa.array(["", *seen], pa.string()), "chunks": pa.array([count, *seen.values()], pa.int64()), "size": pa.array([size] + [0] * len(seen), pa.int64())})

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"word": pa.array(list({w for value in texts(batch.column("text")) for w in words_of(value)}), pa.string())})

    counts = written(tests.select("text").mapInArrow(statistics, "word string, chunks bigint, size bigint").groupBy("word").agg(
        F.sum("chunks").alias("chunks"), F.sum("size").alias("size")), "item-words")
    whole = counts.where("word = ''").first()
    schema = f"key {kind}, item {item_kind}, score double, question double, answer double"
    item_type = pa.int64() if item_kind == "bigint" else pa.string()
    out = spark.createDataFrame([], schema)
    total, size = (whole["chunks"] or 0, whole["size"] or 0) if whole else (0, 0)
    slices = max(1, -(-max(tests.count(), total) // SLICE))
    for number in range(slices if total or parts else 0):
        part = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == number)
        rows = [(r["item"], r["text"]) for r in part.collect()]
        known = counts.join(part.select("text").mapInArrow(vocabulary, "word string").distinct(), "word", "left_semi") if slices > 1 else counts
        index = spark.sparkContext.broadcast(build(rows, total, size / max(total, 1), {r["word"]: r["chunks"] for r in known.collect()}, parts))

        def run(batches: Iterator[pa.RecordBatch], held=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, found = [], []
                for at, value in enumerate(texts(batch.column("text"))):
                    for k, measures in matches(held.value, value).items():
                        keys.append(at)
                        found.append((held.value.items[k].item, *measures))
                columns = list(zip(*found, strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(keys, pa.int64())), pa.array(columns[0], item_type), *(pa.array(c, pa.float64()) for c in columns[1:])],
                    names=["key", "item", "score", "question", "answer"])

        found = source.mapInArrow(run, schema)
        out = out.union(found) if number else found
    return out.select(F.col("key").alias(key), F.col("item").cast(named).alias("item_id"), F.col("score").alias("bm25_share"),
                      F.col("question").alias("question_overlap"), F.col("answer").alias("answer_overlap"))


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", parts: bool = True) -> DataFrame:
    """The documents that hold no test item (with ``parts``: no piece of one)."""
    held = written(contaminated(docs, items, key, text, parts=parts).select(F.col(key).alias("__k")).distinct(), "contaminated")
    return docs.join(held, docs[key].eqNullSafe(held["__k"]), "left_anti")
