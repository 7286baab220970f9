"""Token ids in directly addressable codes.

An id is cut into chunks, the low bits first. Level 0 holds the first chunk of every id; a continuation bitmap says
which ids go on, and their next chunks form level 1, and so on. The place of an id in the next level is the rank of its
bit; a directory of ranks every ``BLOCK`` bits makes that one look-up, so any token is read without decoding others.

A file: the levels' chunks, bitmaps and directories, the start of every document, the documents' keys, then a JSON
footer with the places of all these, its length and ``MAGIC``. Files are named by their order; ascending keys run
through the files in that order.

Defined cases: a null text is empty and gets the end id alone; a null key sorts first and is kept as null; repeated keys
follow each other in the order of their texts; an empty table makes no file and no row; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import open_store, put_file, settled, texts

MAGIC = b"TDMKDAC1"
BLOCK = 512
#: Chunk widths in bits for ids up to 65,535; ``chunk_widths`` fits them to a vocabulary. Whole bytes need no shifting.
WIDTHS = (8, 8)
#: A file is closed once it has this many ids, a reader decodes about so many at once.
FILE_IDS, READ_IDS = 8_000_000, 1_000_000
#: Key types that stand in the files as they are; others stand there as text.
PLAIN = {"tinyint", "smallint", "int", "bigint", "string"}
#: Tasks of the reader at most; each reads one file after the other.
READERS = 10_000


def chunk_widths(largest: int) -> tuple[int, ...]:
    """Widths that cover ids up to ``largest``."""
    return (8,) * max(1, -(-int(largest).bit_length() // 8))


def pack(values: np.ndarray, width: int) -> bytes:
    """Fixed-width numbers, lowest bit first."""
    if width == 8:
        return values.astype(np.uint8).tobytes()
    bits = (values[:, None].astype(np.uint32) >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, skip: int, count: int, width: int) -> np.ndarray:
    """``count`` numbers after ``skip`` bits."""
    if width == 8 and not skip:
        return np.frombuffer(data, np.uint8, count).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=skip + count * width, bitorder="little")[skip:]
    return bits.reshape(count, width).astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def in_parts(values: np.ndarray, width: int, step: int = 1 << 19) -> list[bytes]:
    """``pack`` by parts that end on whole bytes."""
    return [pack(values[i:i + step], width) for i in range(0, len(values), step)]


def encode_file(ids: np.ndarray, starts: np.ndarray, keys: list, widths: tuple[int, ...] = WIDTHS) -> list[bytes]:
    """The parts of one file."""
    parts: list[bytes] = []
    footer: dict = {"ids": len(ids), "levels": [], "block": BLOCK}
    size = 0

    def add(data: bytes | list[bytes]) -> list[int]:
        nonlocal size
        data = [data] if isinstance(data, bytes) else data
        at, length = size, sum(map(len, data))
        parts.extend(data)
        size += length
        return [at, length]

    rest = ids.astype(np.uint32)
    for depth, width in enumerate(widths):
        level = {"width": width, "count": len(rest), "chunks": add(in_parts(rest if width == 8 else rest & np.uint32((1 << width) - 1), width))}
        rest = rest >> np.uint32(width)
        if depth + 1 < len(widths):
            more = rest > 0
            level["bitmap"] = add(np.packbits(more, bitorder="little").tobytes())
            blocks = np.add.reduceat(more.astype(np.int64), np.arange(0, len(more), BLOCK)) if len(more) else np.zeros(0, np.int64)
            level["ranks"] = add(np.concatenate([[0], np.cumsum(blocks)]).astype("<u8").tobytes())
            rest = rest[more]
        elif rest.any():
            raise ValueError("an id is wider than all chunks")
        footer["levels"].append(level)
    footer["starts"] = add(starts.astype("<u8").tobytes())
    footer["keys"] = add(json.dumps(keys).encode())
    end = json.dumps(footer).encode()
    return [*parts, end, struct.pack("<Q", len(end)), MAGIC]


class DacFile:
    """Random access to one file; reads only the bytes asked for."""

    def __init__(self, path: str):
        store, name = open_store(path)
        self.source = store.open_input_file(name)
        size = self.source.size()
        length, = struct.unpack("<Q", self._read(size - 16, 8))
        if self._read(size - 8, 8) != MAGIC:
            raise ValueError(f"{path} is no such file")
        self.footer = json.loads(self._read(size - 16 - length, length))
        self.starts = np.frombuffer(self._read(*self.footer["starts"]), "<u8").astype(np.int64)
        self.keys = json.loads(self._read(*self.footer["keys"]))

    def _read(self, at: int, length: int) -> bytes:
        return self.source.read_at(length, at)

    def _rank(self, level: dict, place: int) -> int:
        """Set bits before ``place``: the directory's number and the bits of one block."""
        block = place // BLOCK
        before, = struct.unpack("<Q", self._read(level["ranks"][0] + 8 * block, 8))
        bits = self._read(level["bitmap"][0] + block * BLOCK // 8, min(BLOCK // 8, level["bitmap"][1] - block * BLOCK // 8))
        return before + int(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")[:place - block * BLOCK].sum())

    def read(self, first: int, last: int, depth: int = 0) -> np.ndarray:
        """Ids ``first`` to ``last`` (excluded)."""
        level, count = self.footer["levels"][depth], last - first
        if count <= 0:
            return np.zeros(0, np.uint32)
        width = level["width"]
        bit = first * width
        out = unpack(self._read(level["chunks"][0] + bit // 8, (last * width + 7) // 8 - bit // 8), bit % 8, count, width)
        if "bitmap" in level:
            bits = self._read(level["bitmap"][0] + first // 8, (last + 7) // 8 - first // 8)
            more = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")[first % 8:first % 8 + count].astype(bool)
            if goes_on := int(more.sum()):
                below = self._rank(level, first)
                out[more] |= self.read(below, below + goes_on, depth + 1) << np.uint32(width)
        return out

    def __getitem__(self, place: int) -> int:
        return int(self.read(place, place + 1)[0])


def _byte_letters() -> list[str]:
    """The printable character by which byte-level vocabularies write each byte: itself, or the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class WordIds:
    """Token ids of texts from the tokenizers library, which gets every word once while the tables hold it.

    The public pattern always begins a piece at a space before another character, so a text is its first word and the
    words with a space before them. A word of letters is one piece and goes to the library's merges; marks of ASCII after and
    between letters, but for the apostrophe, are pieces of their own, as are single line feeds between others than white space; all other words, and texts in which a space comes
    before white space or the end, go to the library whole, as do texts that hold the content of an added token, which
    the library finds before it cuts pieces. Two bounded tables: what is used moves to the younger. Of words that end in
    marks they keep the letters alone.
    """

    LIMIT = 800_000
    ODD = re.compile(r" (?:\s|\Z)")
    #: Marks that the pattern takes as one piece, and a line feed.
    MARKS = re.compile(r"([!-&(-/:-@\[-`{-~]+|\n)")
    #: The same marks one by one.
    ENDS = "".join(mark for mark in map(chr, range(33, 127)) if not mark.isalnum() and mark != "'")
    #: Longer words without a space before them are not kept.
    KEPT = 64

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(token.content) for token in self.tokenizer.get_added_tokens_decoder().values() if token.content]
        self.added = re.compile("|".join(added) if added else r"(?!)")
        self.merges = self.tokenizer.model.tokenize
        self.letters = dict(enumerate(_byte_letters()))
        self.space = self.letters[32]
        self.largest = max(self.tokenizer.get_vocab().values(), default=0)
        self.young, self.old = _Young(self), {}
        self.inner: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, word: str, before: str | None = None) -> bytes:
        """Letters, with a space before them unless told otherwise."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.merges((self.space if before is None else before) + word)]).tobytes()

    def _inner(self, part: str) -> bytes:
        """Ids of letters, marks, a line feed or what begins a line; a bounded table."""
        found = self.inner.get(part)
        if found is None:
            if part.isalpha():
                found = self.piece(part, "")
            elif cuts := self._cuts(part):
                found = b"".join(map(self._inner, cuts))
            else:
                found = self.whole(part)
            if len(part) <= self.KEPT:
                if len(self.inner) > self.LIMIT // 4:
                    self.inner.clear()
                self.inner[part] = found
        return found

    def _cuts(self, word: str) -> list[str]:
        """Letters, then marks, line feeds and letters by turns; none if the word holds anything else."""
        first, *rest = self.MARKS.split(word)
        if first.isalpha() and "\n\n" not in word and all(part.isalpha() for part in rest[1::2] if part):
            return [first, *filter(None, rest)]
        return []

    def word(self, word: str) -> bytes:
        """Ids of a space and a word."""
        if word.isalpha():
            return self.piece(word)
        if cuts := self._cuts(word):
            return self.young[cuts[0]] + b"".join(map(self._inner, cuts[1:]))
        return self.whole(" " + word)

    def _start(self, word: str) -> bytes:
        """Ids of the word that begins a text."""
        return b"" if not word else self.whole(word) if "\n" in word else self._inner(word)

    def ids(self, text: str, end: int) -> np.ndarray:
        return self.ids_of([text], end)[0]

    def ids_of(self, found: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, each with the end id, and how many each has.

        Arrow finds the distinct words of them all, so the tables are asked once for each, and puts the ids in their places.
        """
        if len(self.young) > self.LIMIT:
            self.young, self.old = _Young(self), self.young
        plain = ["" if self.ODD.search(text) or self.added.search(text) else text for text in found]
        starts = [self._start(cut.split(" ", 1)[0]) if cut or not text else self.whole(text) for text, cut in zip(found, plain, strict=True)]
        words = pc.split_pattern(pa.array(plain, pa.string()), " ")
        coded = words.values.dictionary_encode()
        bounds, order = words.offsets.to_numpy(), coded.indices.to_numpy().copy()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        order[bounds[:-1]] = len(distinct) + np.arange(len(plain))  # the first words have no space before them
        asked = np.bincount(order)[:len(distinct)].tolist()
        known = [self.young[word] if times else b"" for word, times in zip(distinct, asked, strict=True)] + starts
        places = np.concatenate([[0], np.cumsum(np.fromiter(map(len, known), np.int64, len(known))) // 4])
        table = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(np.frombuffer(b"".join(known), "<u4")))
        placed = table.take(pa.array(order))
        ends = placed.offsets.to_numpy()[bounds[1:]]
        return np.insert(placed.values.to_numpy(), ends, end), np.diff(ends, prepend=0) + 1


class _Young(dict):
    """The younger table: a word that is missing comes from the older one, or is worked out."""

    def __init__(self, known: WordIds):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> bytes:
        if "\n" in word:  # two words around a line end hardly come again: each by itself, the single line feeds between
            first, *rest = parts = word.split("\n")
            if parts != word.split():
                return self.known.word(word)
            inner = self.known._inner
            return self[first] + b"".join([inner("\n") + inner(part) for part in rest])
        if (letters := word.rstrip(self.known.ENDS)) != word and letters.isalpha():  # put together anew: only the letters are kept
            return self[letters] + self.known._inner(word[len(letters):])
        found = self.known.old.get(word)
        if found is None:
            found = self.known.word(word)
        self[word] = found
        return found


_WORDS: dict[str, WordIds] = {}


def portions(batches: Iterator[pa.RecordBatch], size: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text; a longer text is not cut."""
    for batch in batches:
        before = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(before // size)) + 1).tolist(), batch.num_rows]
        for at, stop in zip(cuts[:-1], cuts[1:], strict=True):
            if stop > at:
                yield batch.slice(at, stop - at)


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the files and returns one row for each: order, path, documents, ids."""
    folder = settled(docs.sparkSession, folder)
    ordered = docs.select(docs[key].alias("key"), docs[text].alias("text")) \
        .repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions("key", "text")
    if docs.schema[key].dataType.simpleString() not in PLAIN:
        ordered = ordered.withColumn("key", F.col("key").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _WORDS:
            _WORDS[tokenizer] = WordIds(tokenizer)
        known = _WORDS[tokenizer]
        part, number, total, held, keys, lengths = TaskContext.get().partitionId(), 0, 0, [], [], []

        def close() -> pa.RecordBatch:
            ids = np.concatenate(held)
            data = encode_file(ids, np.concatenate([[0], np.cumsum(lengths)]), keys, chunk_widths(max(known.largest, end)))
            path = put_file(folder, f"part-{part:06d}-{number:06d}.dac", data)
            return pa.RecordBatch.from_pydict({"part": [part], "number": [number], "path": [path], "docs": [len(keys)], "ids": [len(ids)]})

        for rows in portions(batches):
            found, counts = known.ids_of(list(texts(rows.column("text"))), end)
            held.append(found)
            keys += rows.column("key").to_pylist()
            lengths += counts.tolist()
            total += len(found)
            if total >= FILE_IDS:
                yield close()
                number, total, held, keys, lengths = number + 1, 0, [], [], []
        if keys:
            yield close()

    return ordered.mapInArrow(run, "part bigint, number bigint, path string, docs bigint, ids bigint")


def read_ids(files: DataFrame, key: str = "doc_id", kind: str = "bigint") -> DataFrame:
    """One row for each document from the files: key, ``start`` (ids of all before it), ``n_tokens``, ``ids_crc32``.

    ``files`` is what ``write_ids`` returned, written down: a few columns for each file. ``kind`` is the key's type.
    """
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("before", F.coalesce(F.sum("ids").over(order), F.lit(0))).select("path", "before", "docs")
    spread = placed.repartition(max(1, min(files.count(), READERS)), "path")  # a number: not to be drawn together again

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True):
                file, doc = DacFile(path), 0
                starts = file.starts
                while doc < len(file.keys):
                    stop = min(len(file.keys), max(doc + 1, int(np.searchsorted(starts, starts[doc] + READ_IDS, "right")) - 1))
                    ids = file.read(int(starts[doc]), int(starts[stop])).astype("<u4")
                    cuts = starts[doc:stop + 1] - starts[doc]
                    sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(file.keys[doc:stop], arrow), pa.array(before + starts[doc:stop]),
                        pa.array(np.diff(cuts)), pa.array(sums, pa.int64()),
                    ], names=[key, "start", "n_tokens", "ids_crc32"])
                    doc = stop

    number = kind in PLAIN - {"string"}
    arrow = pa.int64() if number else pa.string()
    rows = spread.mapInArrow(run, f"`{key}` {'bigint' if number else 'string'}, start bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.withColumn(key, F.col(f"`{key}`").cast(kind))
