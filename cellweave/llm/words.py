"""Words and word sequences of whole texts as 64-bit hashes, computed on Arrow columns.

A text is read as its UTF-8 bytes. All patterns used here tell words apart by ASCII bytes
alone, so no decoding is needed. A sequence of values ``v`` is hashed as the sum of
``v[i] * BASE**i`` modulo 2**64 and then mixed; sums over any window come from running
totals, so the work per window does not depend on its length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, hence invertible
INVERSE = pow(BASE, -1, 1 << 64)

#: Text handled in one go; a longer text counts as one go, and is still cut into blocks.
SLICE_BYTES = 2 << 20
BLOCK_BYTES = (1 << 18) - (1 << 12)


class Letters(NamedTuple):
    """Which bytes belong to words, and a random value for each of them."""

    inside: np.ndarray
    value: np.ndarray


def letters(separators: Iterable[int], lower: bool) -> Letters:
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    value = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
    if lower:
        value[65:91] = value[97:123]
    return Letters(inside, value)


SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: [^\x20\x09-\x0D]+, as it is or with A-Z in lower case.
SPACED = letters(SPACES, lower=False)
SPACED_LOWER = letters(SPACES, lower=True)
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z went to lower case.
ALPHANUMERIC = letters(
    [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)], lower=True
)


class Words(NamedTuple):
    """Words of several texts, one after the other.

    ``hashes``: a value per word; ``first``: index of each text's first word, and the
    number of words at the end; ``start`` and ``end``: the bytes of each word in ``data``,
    if they were asked for.
    """

    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray | None = None
    end: np.ndarray | None = None
    data: np.ndarray | None = None


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, U64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    return out


def powers(base: int, size: int) -> np.ndarray:
    return _powers(base, 1 << max(10, (size - 1).bit_length()))[:size]


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``; one to one. Changes ``x``."""
    x ^= x >> U64(31)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(29)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(32)
    return x


def sequence_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``values[start:end]`` for arrays of borders, with the length mixed in."""
    size = len(values)
    total = np.zeros(size + 1, U64)
    np.cumsum(values * powers(BASE, size), out=total[1:]) if size else None
    out = total[end] - total[start]
    out *= powers(INVERSE, size + 1)[start]
    out += (end - start).astype(U64) * U64(0xD6E8FEB86659FD93)
    return mixed(out)


def windows(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Every run of ``length`` words within a text: (index of its first word, hash)."""
    count = np.diff(words.first)
    last = np.repeat(words.first[1:] - length, np.maximum(count, 0))
    start = np.flatnonzero(np.arange(len(words.hashes)) <= last)
    return start, window_hashes(words.hashes, start, length)


def window_hashes(values: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Hashes of ``values[start:start + length]``, in blocks that bound the memory."""
    out = np.empty(len(start), U64)
    step = 1 << 17
    for at in range(0, len(start), step):
        part = start[at : at + step]
        low, high = int(part[0]), int(part[-1]) + length
        begin = part - low
        out[at : at + step] = sequence_hashes(values[low:high], begin, begin + length)
    return out


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and borders of a column of text; a null counts as empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, borders, data = column.buffers()
    offsets = np.frombuffer(borders, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def _next_cut(data: np.ndarray, at: int, end: int, inside: np.ndarray) -> int:
    """The first place from ``at`` on that no word goes across."""
    step = 4096
    while at < end:
        found = np.flatnonzero(~inside[data[at : min(end, at + step)]])
        if len(found):
            return at + int(found[0])
        at, step = at + step, step * 2
    return end


def split_words(column: pa.Array, kind: Letters, places: bool = False) -> Words:
    """The words of every text of a column."""
    data, offsets = buffers(column)
    hashes, starts, ends = [], [], []
    at, stop = int(offsets[0]), int(offsets[-1])
    while at < stop:
        to = _next_cut(data, min(stop, at + BLOCK_BYTES), stop, kind.inside)
        block = data[at:to]
        inside = kind.inside[block]
        border = np.zeros(len(block) + 1, bool)
        within = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to, "right")]
        border[within - at] = True
        border[[0, -1]] = True
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1] | border[1:-1]
        closes[:-1] &= ~inside[1:] | border[1:-1]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        hashes.append(sequence_hashes(kind.value[block], start, end))
        starts.append(start + at)
        if places:
            ends.append(end + at)
        at = to
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return Words(
        np.concatenate(hashes) if hashes else np.zeros(0, U64),
        np.searchsorted(start, offsets),
        start if places else None,
        (np.concatenate(ends) if ends else np.zeros(0, np.int64)) if places else None,
        data if places else None,
    )


def byte_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Hashes of the bytes ``begin`` to ``end``, both in order, some at a time."""
    out = np.empty(len(begin), U64)
    step = 1 << 15
    for at in range(0, len(begin), step):
        low, high = int(begin[at]), int(end[at : at + step][-1])
        out[at : at + step] = sequence_hashes(
            value[data[low:high]], begin[at : at + step] - low, end[at : at + step] - low
        )
    return out


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in runs with about ``limit`` bytes of text each, or a single text."""
    for batch in batches:
        _, offsets = buffers(batch.column(text))
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
