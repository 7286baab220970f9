"""Distinct word shingles of texts as 64-bit numbers, computed for many texts at once with numpy."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np

WORDS = 5
#: Bytes of text that are hashed in one go.
CHUNK = 1 << 20
_M = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_NEXT_GAP = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < size:
        for k, base in enumerate((_M, pow(_M, -1, 2**64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:size], _POWERS[1][:size]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of lower-cased bytes; a long text goes in parts that end between words."""
    at, parts = 0, []
    while len(data) - at > 2 * CHUNK and (gap := _NEXT_GAP.search(data, at + CHUNK)):
        starts, hashes = _word_hashes(data[at:gap.end()])
        parts.append((starts + at, hashes))
        at = gap.end()
    starts, hashes = _word_hashes(data[at:])
    parts.append((starts + at, hashes))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Differences of one running sum, so no loop over words."""
    raw = np.frombuffer(data, np.uint8)
    gap = np.concatenate([[True], _GAP[raw], [True]])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(len(raw) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[raw] * up[:len(raw)], dtype=np.uint64)])
    return starts, mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _fold(columns: Iterable[np.ndarray], size: int) -> np.ndarray:
    out = np.full(size, np.uint64(0x243F6A8885A308D3))
    for c in columns:
        out = mix(out * np.uint64(_M) + c)
    return out


def _sets_of(group: list[bytes]) -> Iterator[np.ndarray]:
    data = b"\n".join(group)
    starts, hashes = word_hashes(data)
    bounds = np.cumsum([0] + [len(g) + 1 for g in group])
    cuts = np.searchsorted(starts, bounds)
    long = max(len(hashes) - WORDS + 1, 0)
    shingles = _fold([hashes[k:k + long] for k in range(WORDS)], long)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a >= WORDS:
            yield np.unique(shingles[a:b - WORDS + 1])
        elif b > a:  # fewer words: the whole sequence, marked by its length
            yield _fold([*hashes[a:b].reshape(-1, 1), np.array([b - a], np.uint64)], 1)
        else:
            yield np.zeros(0, np.uint64)


def shingle_sets(texts: Iterable[str]) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its five-word shingles; A-Z count as a-z."""
    group, size = [], 0
    for text in texts:
        data = text.encode("utf-8", "replace").translate(_LOWER)
        group.append(data)
        size += len(data) + 1
        if size >= CHUNK:
            yield from _sets_of(group)
            group, size = [], 0
    if group:
        yield from _sets_of(group)
