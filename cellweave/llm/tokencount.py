"""Numbers of tokens under a BPE piece model, by merging only: no ids are made."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cellweave.llm.batches import with_arrays
from cellweave.llm.words import U64, Letters, buffers, byte_hashes, letters, split_words

#: The mark that stands for a blank in the pieces.
BLANK = "▁"
#: Counts a process remembers, at 9 bytes each; when full, it starts anew.
REMEMBERED = 4_000_000

# Kinds of pieces and of models in a piece model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
BPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protocol buffer message."""

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    at = 0
    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, data[at : at + size]
            at += size


class PieceModel:
    """Ranks of the pieces that merging can make, best score first."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            message = list(_fields(file.read()))
        scores: dict[str, float] = {}
        for entry in (dict(_fields(x)) for field, x in message if field == 1):
            kind = entry.get(3, NORMAL)
            if kind in (USER_DEFINED, UNUSED):
                raise ValueError("pieces that users define or that are unused are not supported")
            if kind == NORMAL:
                scores[entry[1].decode()] = struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0
        trainer = dict(next(_fields(x) for field, x in message if field == 2))
        normal = dict(next((_fields(x) for field, x in message if field == 3), ()))
        if trainer.get(3) != BPE or not trainer.get(35):
            raise ValueError("not a BPE model with byte fallback")
        if normal.get(2) or normal.get(4, 1):
            raise ValueError("models that change the text before splitting it are not supported")
        if any(BLANK in piece.lstrip(BLANK) for piece in scores):
            raise ValueError("pieces with a blank after another character are not supported")
        self.prefix = bool(normal.get(3, 1))
        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {piece: order[score] for piece, score in scores.items()}
        known = {character for piece in scores for character in piece}
        #: No merge goes across the end of a word before these bytes: blanks only begin
        #: pieces, and the others are in no piece at all.
        self.kind: Letters = letters([0x20, *(i for i in range(0x20) if chr(i) not in known)], lower=False)

    def count(self, text: str) -> int:
        """Tokens of a text with blanks written as ``BLANK``.

        A heap gives the adjacent pair of best rank, leftmost first; symbols are a linked
        list. A character that is no piece counts as its bytes and never merges.
        """
        rank, size = self.rank, len(text)
        symbols: list[str | None] = list(text)
        total = size
        for character in symbols:
            if character not in rank:
                total += len(character.encode()) - 1
        heap = []
        for i in range(size - 1):
            found = rank.get(symbols[i] + symbols[i + 1])
            if found is not None:
                heap.append(found << 32 | i)
        if not heap:
            return total
        heapify(heap)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            left, j = symbols[i], after[i]
            if left is None or j == size:
                continue
            both = left + symbols[j]
            if rank.get(both) != top >> 32:
                continue  # one of the two has grown since
            symbols[i], symbols[j] = both, None
            total -= 1
            k = after[i] = after[j]
            if k < size:
                before[k] = i
                found = rank.get(both + symbols[k])
                if found is not None:
                    heappush(heap, found << 32 | i)
            k = before[i]
            if k >= 0:
                found = rank.get(symbols[k] + both)
                if found is not None:
                    heappush(heap, found << 32 | k)
        return total


class Counter:
    """Counts of texts, with the counts of segments seen before by their hashes."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.keys, self.counts = np.zeros(0, U64), np.zeros(0, np.int32)

    def _of(self, keys: np.ndarray, segment) -> np.ndarray:
        """Counts for distinct sorted keys; ``segment(i)`` gives the text of the i-th."""
        out = np.zeros(len(keys), np.int32)
        place = np.searchsorted(self.keys, keys)
        place[place == len(self.keys)] = 0
        known = self.keys[place] == keys if len(self.keys) else np.zeros(len(keys), bool)
        out[known] = self.counts[place[known]]
        new = np.flatnonzero(~known)
        count = self.model.count
        out[new] = [count(segment(i)) for i in new]
        if len(self.keys) + len(new) > REMEMBERED:
            self.keys, self.counts = np.zeros(0, U64), np.zeros(0, np.int32)
        if len(new) <= REMEMBERED:
            at = np.searchsorted(self.keys, keys[new])
            self.keys = np.insert(self.keys, at, keys[new])
            self.counts = np.insert(self.counts, at, out[new])
        return out

    def texts(self, column: pa.Array) -> np.ndarray:
        """A text is cut where a word ends. Each segment is what lies between two words and
        the word after it; what follows the last word is a segment of its own."""
        if pc.any(pc.match_substring(column, BLANK)).as_py():
            column = pc.replace_substring(column, BLANK, " ")
        _, offsets = buffers(column)
        words = split_words(column, self.model.kind, places=True)
        data, texts = words.data, np.arange(len(offsets) - 1)
        opening = np.zeros(len(words.end), bool)
        filled = np.diff(words.first) > 0
        opening[words.first[:-1][filled]] = True
        begin = np.empty_like(words.end)
        begin[1:] = words.end[:-1]
        owner = np.repeat(texts, np.diff(words.first))
        begin[opening] = offsets[:-1][owner[opening]]
        last = offsets[:-1].copy()
        last[filled] = words.end[words.first[1:][filled] - 1]
        rest = np.flatnonzero(last < offsets[1:])
        begin = np.concatenate([begin, last[rest]])
        end = np.concatenate([words.end, offsets[1:][rest]])
        owner = np.concatenate([owner, rest])
        opening = np.concatenate([opening, ~filled[rest]]) & self.model.prefix
        order = np.argsort(begin, kind="stable")
        begin, end, owner, opening = begin[order], end[order], owner[order], opening[order]
        keys = byte_hashes(data, begin, end, self.model.kind.value)
        keys[opening] ^= U64(0x5851F42D4C957F2D)
        distinct, where, inverse = np.unique(keys, return_index=True, return_inverse=True)

        def segment(i: int) -> str:
            at = where[i]
            raw = data[begin[at] : end[at]].tobytes().decode()
            return ((" " if opening[at] else "") + raw).replace(" ", BLANK)

        counts = self._of(distinct, segment)
        return np.bincount(owner, counts[inverse], minlength=len(texts)).astype(np.int64)


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    """Built once per process; what it remembers serves all tasks there."""
    return Counter(path)


def count_tokens(
    df: DataFrame, model_path: str, text: str = "text", count: str = "n_tokens", drop: tuple[str, ...] = ()
) -> DataFrame:
    """``df`` with the number of tokens of each text, without begin and end tokens.

    A null or empty text has none. Every row is counted alone, so repeated rows repeat. A
    column already named ``count`` is replaced. ``model_path`` names a file that every
    executor has. Equal segments are merged once per process; what is remembered is bounded.
    """

    def compute(column: pa.Array) -> dict[str, pa.Array]:
        return {count: pa.array(counter(model_path).texts(column.fill_null("")))}

    return with_arrays(df, text, {count: T.LongType()}, compute, drop)
