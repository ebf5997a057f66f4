"""Words and word hashes of whole Arrow text columns, vectorized and in bounded pieces.

A word is a run of bytes other than the six ASCII white-space characters; runs end at row ends. Its hash is a polynomial
over its bytes modulo 2**64, read off a running sum, and then mixed. Everything is deterministic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 2 << 20  # texts are scanned in pieces of about this size, a longer text in pieces of its own
_STEP = U64(0x9E3779B97F4A7C15 | 1)
_WORD_STEP = U64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(step: U64, n: int, kept: dict) -> tuple[np.ndarray, np.ndarray]:
    """step**i and its inverse modulo 2**64 for i < n."""
    if len(kept.get("up", ())) < n:
        size = 1 << int(n - 1).bit_length()
        inverse = U64(pow(int(step), -1, 1 << 64))
        for key, base in (("up", step), ("down", inverse)):
            powers = np.full(size, base, U64)
            powers[0] = 1
            kept[key] = np.multiply.accumulate(powers)
    return kept["up"][:n], kept["down"][:n]


_BYTE_POWERS: dict = {}
_WORD_POWERS: dict = {}
_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Everything but ASCII letters and digits and the bytes of other characters separates.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def pieces(texts: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets into them) for runs of rows of at most ``limit`` bytes or one row; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def scan(data: np.ndarray, offsets: np.ndarray, lower: bool = False, block: int = 1 << 20, separators: np.ndarray = _IS_SPACE,
         prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, hash) of every word; with lower, hashes are of A-Z lower-cased words.

    With prefixes, hashes has one more column for each: that of the word's first bytes, 0 if the word has no more.
    """
    starts, ends, hashes, at = [], [], [], 0
    breaks = offsets[:-1]
    while at < len(data):
        stop = min(len(data), at + block)
        while stop < len(data) and not separators[data[stop]]:
            gap = np.flatnonzero(separators[data[stop:stop + 4096]])
            stop = stop + int(gap[0]) if len(gap) else min(len(data), stop + 4096)
        part = data[at:stop]
        inside = ~separators[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[0] = edge[-1] = True
        edge[1:-1] = inside[1:] != inside[:-1]
        own = breaks[np.searchsorted(breaks, at):np.searchsorted(breaks, stop)] - at
        edge[own] = True
        marks = np.flatnonzero(edge)
        word = inside[marks[:-1]] if len(part) else np.zeros(0, bool)
        s, e = marks[:-1][word], marks[1:][word]
        up, down = _powers(_STEP, len(part) + 1, _BYTE_POWERS)
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(_BYTE_VALUE[LOWER[part] if lower else part] * up[:-1], out=total[1:])
        starts.append(s + at)
        ends.append(e + at)
        own = [mix((total[e] - total[s]) * down[s] + (e - s).astype(U64))]
        for n in prefixes:
            cut = np.minimum(s + n, len(part))
            own.append(np.where(e - s > n, mix((total[cut] - total[s]) * down[s] + U64(n + (1 << 32))), U64(0)))
        hashes.append(np.stack(own, 1) if prefixes else own[0])
        at = stop
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(prefixes) + 1) if prefixes else 0, U64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def row_bounds(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of each row's first word, and the number of words at the end."""
    return np.searchsorted(starts, offsets)


def windows(hashes: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """Hash of the ``length`` words from each word on; the last length - 1 of the array have none."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, U64)
    up, down = _powers(_WORD_STEP, len(hashes) + 1, _WORD_POWERS)
    total = np.zeros(len(hashes) + 1, U64)
    np.cumsum(mix(hashes + U64(salt)) * up[:-1], out=total[1:])
    return mix((total[length:] - total[:n]) * down[:n] + U64(salt))


def owners(bounds: np.ndarray) -> np.ndarray:
    """Row of every word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
