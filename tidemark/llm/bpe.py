"""Byte-level BPE as a monoid over byte strings.

Tokens of two neighbouring strings combine into the tokens of their concatenation. ``encode`` cuts a piece in halves,
encodes each and joins them; a leaf of ``LEAF`` bytes is merged directly. ``join`` encodes a window of bytes around the
seam anew and lets it grow until the tokens outside stand. The proof: a token sequence is the encoding of its bytes
exactly if every two neighbours are the encoding of their own concatenation. Inside each half that holds already,
inside the window by construction, so only the window's two edges are tested. The join is associative with the empty
sequence as its unit. Decoding is one flat join of the tokens' bytes, no tree. Every piece of the public pattern is encoded apart.

Defined cases: a null text is the empty text with no tokens; equal rows give equal results; an empty table gives an
empty table; columns other than the key and the text are ignored. A cache of pieces is bounded and holds no state
that results depend on.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import slices, texts

LEAF = 32
CACHE = 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Encoder:
    """Encodes and decodes with one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.digits = {rank: str(rank) for rank in self.bytes_of}
        self.seams: dict[tuple[int, int], bool] = {}
        outer = self

        class Pieces(dict):
            def __missing__(self, piece: str) -> tuple[int, ...]:
                ids = tuple(outer.encode(piece.encode("utf-8", "replace")))
                if len(piece) <= LEAF:
                    if len(self) >= CACHE:
                        self.clear()
                    self[piece] = ids
                return ids

        self.pieces = Pieces()

    def merge(self, data: bytes) -> list[int]:
        """Merges the pair of lowest rank, leftmost first, until none is left."""
        if data in self.ranks:
            return [self.ranks[data]]
        size, ranks = len(data), self.ranks
        if size <= 2 * LEAF:
            parts = [data[i:i + 1] for i in range(size)]
            while len(parts) > 1:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    rank = ranks.get(parts[i] + parts[i + 1])
                    if rank is not None and (best is None or rank < best):
                        best, at = rank, i
                if best is None:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            return [ranks[p] for p in parts]
        end, before = list(range(1, size + 1)), list(range(-1, size - 1))  # end[i]: where the part that starts at i ends
        queue = [(r, i, i + 2) for i in range(size - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, stop = heapq.heappop(queue)
            middle = end[i]
            if middle < 0 or middle >= size or end[middle] != stop:
                continue
            end[i], end[middle] = stop, -1
            if stop < size:
                before[stop] = i
                if (r := ranks.get(data[i:end[stop]])) is not None:
                    heapq.heappush(queue, (r, i, end[stop]))
            if (k := before[i]) >= 0 and (r := ranks.get(data[k:stop])) is not None:
                heapq.heappush(queue, (r, k, stop))
        out, i = [], 0
        while i < size:
            out.append(ranks[data[i:end[i]]])
            i = end[i]
        return out

    def stands(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens are the encoding of their concatenation."""
        known = self.seams.get((left, right))
        if known is None:
            if len(self.seams) >= CACHE:
                self.seams.clear()
            known = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self.seams[left, right] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The monoid's operation: tokens of the concatenation."""
        if not left or not right or self.stands(left[-1], right[0]):
            return left + right
        reach = 1
        while True:
            head, tail = left[:-reach], right[reach:]
            window = self.merge(self.decode(left[-reach:]) + self.decode(right[:reach]))
            if (not head or self.stands(head[-1], window[0])) and (not tail or self.stands(window[-1], tail[0])):
                return head + window + tail
            reach *= 2

    def encode(self, data: bytes) -> list[int]:
        """Tokens of one piece, by the tree."""
        if len(data) <= LEAF:
            return self.merge(data) if data else []
        half = len(data) // 2
        return self.join(self.encode(data[:half]), self.encode(data[half:]))

    def encode_text(self, text: str) -> list[int]:
        out: list[int] = []
        for ids in map(self.pieces.__getitem__, self.find(text)):
            out += ids
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each vocabulary and Python worker; its file is on every machine."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(load_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def tokenize(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """``key``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by one space), ``decoded_sha256`` and the ``ids``."""
    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        digits, token = enc.digits.__getitem__, enc.bytes_of.__getitem__
        for batch in slices(batches):
            counts, first, second, lists = [], [], [], []
            for value in texts(batch.column("text")):
                found = enc.encode_text(value)
                counts.append(len(found))
                first.append(hashlib.sha256(" ".join(map(digits, found)).encode()).hexdigest())
                second.append(hashlib.sha256(b"".join(map(token, found))).hexdigest())
                if ids:
                    lists.append(pa.array(found, pa.int32()))
            columns = [batch.column("key"), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns.append(pa.array([x.to_numpy() for x in lists], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return source.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids", text: str = "text") -> DataFrame:
    """``key`` and the text of the token ids (null: empty)."""
    source = tokens.select(tokens[key].alias("key"), tokens[ids].alias("ids"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            out = [enc.decode(v.as_py() or []).decode("utf-8", "replace") for v in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.string())], names=[key, text])

    return source.mapInArrow(run, f"`{key}` {kind}, `{text}` string")
