"""BPE encoding and decoding in which chunks that documents share are encoded once.

Texts are cut where a rolling hash of the last bytes says so, hence equal passages are cut
alike wherever they stand. Spark counts the chunks; those that occur more than once are
encoded once each and joined back. A cut falls anywhere, mostly within a word, so what lies
around a join is encoded again from the text, out to the last white space of one chunk and to
the first of the next. There the library is given the words on both sides in one piece: if
their ids are those that the span and the chunk have on their own, the join is right; if not,
the span grows over the whole text, which is then encoded in one piece.

Texts without a shared chunk are encoded where they are read and move nowhere. A process
gives the library each distinct word once, as far as it remembers them.
"""

from __future__ import annotations

import os
import random
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from cellweave.llm import bitmaps
from cellweave.llm.batches import fresh, same_name, stored
from cellweave.llm.words import BASE, INVERSE, U64, buffers, powers, slices

#: Bytes the rolling hash sees, the mean distance of its cuts as a power of two, and the least size of a chunk.
ROLLING = 32
CUT_BITS = 9
LEAST = 128
#: Bitmap of the shared chunks: 8 MB. Too small a one lets single chunks take the way of shared ones.
FILTER_BITS = 26
#: Words, and bytes of words, that a process remembers the ids of; when there are more, it forgets
#: those met once.
REMEMBERED_WORDS = 400_000
REMEMBERED_BYTES = 16 << 20
#: Texts that go to Python in one go, and bytes of text that are looked at in one go there.
BATCH_TEXTS = 1000
SLICE = 1 << 19

#: White space that surely parts words. No match of these tokenizers' patterns holds any, no
#: special token does, and neither composition nor lower-casing reaches over it.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0D]] = True
#: Hashes below this, one in 2 ** CUT_BITS, end a chunk.
CUT_BELOW = U64(1 << (64 - CUT_BITS))
ROLL_VALUE = np.random.default_rng(20250611).integers(1, 1 << 63, 256, dtype=U64)

#: Signs of ASCII, and those that are the end of a word behind a letter of its.
SIGNS = bytes([*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])
LAST_SIGNS = re.compile(rb"[!-/:-@[-`{-~](?<=[A-Za-z].)[!-/:-@[-`{-~]*(?=[ \t\n\r]|$)")
#: A word of small letters of ISO 8859-1. No composition or lower-casing changes it.
PLAIN_WORD = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch
#: How byte-level models write bytes: visible characters as they are, others by turns from 256 on.
_UNSEEN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE)]
BYTE_LETTERS = {b: 256 + n for n, b in enumerate(_UNSEEN)}

IDS = T.ArrayType(T.IntegerType(), False)


class Chunks(NamedTuple):
    """Chunks of several texts, one after the other; ``text`` says which text each is of."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray


def rolling(data: np.ndarray) -> np.ndarray:
    """A hash of every ``ROLLING`` bytes in a row: the sum of a value per byte times a power of
    its place. Sums over all windows are differences of running totals."""
    size = len(data)
    total = np.zeros(size + 1, U64)
    np.cumsum(ROLL_VALUE[data] * powers(BASE, size), out=total[1:])
    out = total[ROLLING:] - total[:-ROLLING]
    out *= powers(INVERSE, size)[: len(out)]
    return out


def cut(column: pa.Array) -> Chunks:
    """Every text of a column in chunks that depend on nothing but nearby bytes of that text."""
    data, offsets = buffers(column)
    # A slice of a batch comes with the bytes of all of it.
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    high = len(data)
    found = [np.zeros(0, np.int64)]
    for at in range(0, high - ROLLING, 1 << 16):
        found.append(np.flatnonzero(rolling(data[at : at + (1 << 16) + ROLLING - 1]) < CUT_BELOW) + (at + ROLLING))
    places = np.concatenate(found)
    places = places[places < high]
    places = places[data[places] & 0xC0 != 0x80]
    owner = np.searchsorted(offsets, places, "right") - 1
    places = places[places - ROLLING >= offsets[owner]]
    begin: list[int] = []
    text: list[int] = []
    nth = 0
    places = places.tolist()
    for i, (start, stop) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if start == stop:
            continue
        last = start
        begin.append(start)
        text.append(i)
        while nth < len(places) and places[nth] < stop:
            if places[nth] - last >= LEAST:
                last = places[nth]
                begin.append(last)
                text.append(i)
            nth += 1
    first = np.array(begin, np.int64)
    whose = np.array(text, np.int64)
    end = np.append(first[1:], high) if len(first) else first
    return Chunks(data, first, np.minimum(end, offsets[1:][whose]), whose)


def _keys(chunks: Chunks) -> tuple[list[bytes], np.ndarray]:
    """A digest of 128 bits for each chunk, and its first 64 bits as numbers."""
    data = chunks.data
    keys = [blake2b(data[a:b], digest_size=16).digest() for a, b in zip(chunks.begin, chunks.end)]
    return keys, np.frombuffer(b"".join(keys), np.int64)[::2]


def _inner(chunks: Chunks) -> tuple[np.ndarray, np.ndarray]:
    """What of each chunk can stand for itself: from its first white space to its last."""
    blanks = np.flatnonzero(SPACE[chunks.data])
    if not len(blanks):
        return chunks.end, chunks.end
    first = np.append(blanks, len(chunks.data))[np.searchsorted(blanks, chunks.begin)]
    last = blanks[np.searchsorted(blanks, chunks.end) - 1]
    empty = (first >= chunks.end) | (last <= first)
    return np.where(empty, chunks.end, first), np.where(empty, chunks.end, last)


class Encoder:
    """The tokenizer of a file, on one thread.

    Words between white space are given to the library once and remembered, as far as memory
    is set aside for it; ``whole`` gives it a text as it is.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.agree = lru_cache(maxsize=50_000)(self._agree)
        # Fewer words are different, and most need the model alone, if the library agrees that
        # case of ASCII letters makes no difference, that signs behind a letter are a word by
        # themselves, and that plain words pass its other steps as they are. It is asked.
        self.bare = Tokenizer(self.tokenizer.model)
        rng = random.Random(13)
        some = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzßàçéñöøüÿ", k=rng.randint(1, 9))).encode() for _ in range(400)]
        runs = [bytes([c]) for c in SIGNS] + [bytes(rng.choices(SIGNS, k=rng.randint(2, 4))) for _ in range(200)]
        self.one_case = all(np.array_equal(self.whole(w), self.whole(w.upper())) for w in some)
        self.apart = all(self._agree(rng.choice(some), run) for run in runs)
        self.plain_words = all(np.array_equal(self.whole(w), ids) for w, ids in zip(some, self._bare(some)))
        self.token = lru_cache(maxsize=None)(self.tokenizer.id_to_token)
        self._start()

    def _start(self) -> None:
        self.place: dict[bytes, int] = {}
        #: The ids of the n-th word are ``ids[first[n]:first[n + 1]]``; the arrays have room to spare.
        self.first, self.ids = np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.uint32)
        self.hits, self.size = np.zeros(1 << 12, np.int64), 0

    def _forget(self) -> None:
        """Keep of the words only those met more than once, and half of what there is room for."""
        known, words = len(self.place), list(self.place)
        often = np.sort(self.hits[:known])[-REMEMBERED_WORDS // 2 :][0]
        keep = np.flatnonzero(self.hits[:known] > max(1, often))
        sizes = np.cumsum([len(words[n]) for n in keep])
        keep = keep[: np.searchsorted(sizes, REMEMBERED_BYTES // 2)]
        begin, length = self.first[keep], self.first[keep + 1] - self.first[keep]
        ends = np.cumsum(length)
        ids = self.ids[np.repeat(begin - (ends - length), length) + np.arange(length.sum())]
        hits = self.hits[keep] // 2
        self.place = {words[n]: i for i, n in enumerate(keep.tolist())}
        self.first, self.hits = np.concatenate([[0], ends, np.zeros(1, np.int64)]), np.append(hits, [0, 0])
        self.ids, self.size = np.append(ids, np.uint32(0)), int(sizes[len(keep) - 1]) if len(keep) else 0

    def _put(self, words: list[bytes], ids: list) -> None:
        known = len(self.place)
        ends = self.first[known] + np.cumsum([len(x) for x in ids])
        while len(self.first) <= known + len(words):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.hits = np.concatenate([self.hits, np.zeros_like(self.hits)])
        while len(self.ids) < ends[-1]:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.first[known] : ends[-1]] = list(chain.from_iterable(ids))
        self.first[known + 1 : known + 1 + len(words)] = ends
        self.place.update(zip(words, range(known, known + len(words))))
        self.size += sum(map(len, words))

    def _bare(self, words: list[bytes]) -> list[list[int]]:
        letters = [w.decode("latin-1").translate(BYTE_LETTERS) for w in words]
        return [x.ids for x in self.bare.encode_batch_fast(letters, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        plain = [w for w in words if PLAIN_WORD(w)] if self.plain_words else []
        other = [w for w in words if not PLAIN_WORD(w)] if self.plain_words else words
        for at in range(0, len(plain), 1000):
            self._put(plain[at : at + 1000], self._bare(plain[at : at + 1000]))
        for at in range(0, len(other), 1000):
            some = other[at : at + 1000]
            coded = self.tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
            self._put(some, [x.ids for x in coded])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, put together from those of its words."""
        if len(self.place) > REMEMBERED_WORDS or self.size > REMEMBERED_BYTES:
            self._forget()
        words = [self._words(text) for text in texts]
        every = list(chain.from_iterable(words))
        place = np.fromiter(map(self.place.get, every, repeat(-1)), np.int64, len(every))
        new = np.flatnonzero(place < 0).tolist()
        if new:
            self._learn(list({every[n] for n in new}))
            place[new] = [self.place[every[n]] for n in new]
        self.hits[: len(self.place)] += np.bincount(place, minlength=len(self.place))
        begin = self.first[place]
        length = self.first[place + 1] - begin
        end = np.concatenate([[0], np.cumsum(length)])
        out = self.ids[np.repeat(begin - end[:-1], length) + np.arange(end[-1])]
        borders = end[np.concatenate([[0], np.cumsum([len(own) for own in words])]).astype(np.int64)].tolist()
        return [out[a:b] for a, b in zip(borders, borders[1:])]

    def _words(self, text: bytes) -> list[bytes]:
        if b"<" not in text:  # or there may be a special token, which is left as it is
            if self.one_case:
                text = text.lower()
            if self.apart:
                text = LAST_SIGNS.sub(rb" \g<0>", text)
        # Without an argument, split() on bytes parts them at ASCII white space alone.
        return text.split()

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32)

    def _agree(self, left: bytes, right: bytes) -> bool:
        """Whether two texts side by side have the ids that each has by itself."""
        return np.array_equal(self.whole(left + right), np.concatenate([self.whole(left), self.whole(right)]))

    def decode(self, ids: np.ndarray) -> str:
        if self.tokenizer.decoder is not None:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        # Without a decoder the library joins the tokens with blanks, and leaves out ids it does not know.
        return " ".join([t for t in map(self.token, ids.tolist()) if t is not None])


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """Built once per process."""
    return Encoder(path)


def _word_after(data: np.ndarray, begin: int, end: int) -> int:
    """Where the first word from the white space at ``begin`` on ends."""
    at = begin
    while at < end and SPACE[data[at]]:
        at += 1
    while at < end and not SPACE[data[at]]:
        at += 1
    return at


def _word_before(data: np.ndarray, begin: int, end: int) -> int:
    """Where the last word up to the white space at ``end`` begins, white space before it included."""
    at = end
    while at > begin and SPACE[data[at - 1]]:
        at -= 1
    while at > begin and not SPACE[data[at - 1]]:
        at -= 1
    while at > begin and SPACE[data[at - 1]]:
        at -= 1
    return at


class Piece(NamedTuple):
    """A part of a text: the inner part of a shared chunk, or text that was encoded here."""

    key: bytes | None
    ids: np.ndarray | None


def pieces(coder: Encoder, chunks: Chunks, shared: np.ndarray, keys: list[bytes], texts: int) -> list[list[Piece]]:
    """The pieces of each text. Joined, they are the ids of the whole text.

    Spans between shared chunks are encoded again. Where such a chunk begins or ends, the
    library is asked for the last word before and the first after in one piece.
    """
    data = chunks.data
    first, last = _inner(chunks)
    lent = np.flatnonzero(shared & (last > first)).tolist()
    bounds = np.searchsorted(chunks.text, np.arange(texts + 1)).tolist()
    spans: list[tuple[int, int, int]] = []  # text, begin, end
    after: list[int] = []  # the chunk after each, or -1
    wrong: set[int] = set()
    nth = 0
    for i in range(texts):
        low, high = bounds[i], bounds[i + 1]
        if low == high:
            continue
        begin, stop = int(chunks.begin[low]), int(chunks.end[high - 1])
        before = None
        while True:
            right = lent[nth] if nth < len(lent) and lent[nth] < high else -1
            end = int(first[right]) if right >= 0 else stop
            if before is not None:
                near = data[_word_before(data, before, begin) : begin].tobytes()
                if not coder.agree(near, data[begin : _word_after(data, begin, end)].tobytes()):
                    wrong.add(i)
            if right >= 0:
                near = data[_word_before(data, begin, end) : end].tobytes()
                if not coder.agree(near, data[end : _word_after(data, end, int(last[right]))].tobytes()):
                    wrong.add(i)
            spans.append((i, begin, end))
            after.append(right)
            if right < 0:
                break
            nth += 1
            before, begin = end, int(last[right])
    out: list[list[Piece]] = [[] for _ in range(texts)]
    for (i, _, _), right, ids in zip(spans, after, coder.encode([data[a:b].tobytes() for _, a, b in spans])):
        out[i].append(Piece(None, ids))
        if right >= 0:
            out[i].append(Piece(keys[right], None))
    for i in wrong:
        text = data[chunks.begin[bounds[i]] : chunks.end[bounds[i + 1] - 1]].tobytes()
        out[i] = [Piece(None, coder.whole(text))]
    return out


def shared_chunks(texts: DataFrame, filter_bits: int) -> np.ndarray:
    """Bitmap of the chunks in ``texts`` (text) that occur more than once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            keys, heads = _keys(cut(part.column("text")))
            seen: dict[bytes, list[int]] = {}
            for key, head in zip(keys, heads.tolist()):
                seen.setdefault(key, [head, 0])[1] += 1
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array(seen, pa.binary()),
                    "head": pa.array([x[0] for x in seen.values()], pa.int64()),
                    "n": pa.array([x[1] for x in seen.values()], pa.int64()),
                }
            )

    counted = texts.mapInArrow(run, "key binary, head long, n long").groupBy("key", "head").agg(F.sum("n").alias("n"))
    return bitmaps.bitmap(counted.filter("n > 1").select("head"), filter_bits)


def encoded_chunks(texts: DataFrame, known, model_path: str) -> DataFrame:
    """(key, ids) of every chunk in the bitmap, each encoded once."""

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            chunks = cut(part.column("text"))
            keys, heads = _keys(chunks)
            first, last = _inner(chunks)
            some = {
                keys[i]: chunks.data[first[i] : last[i]].tobytes()
                for i in np.flatnonzero(bitmaps.has(known.value, heads.view(U64)) & (last > first)).tolist()
            }
            yield pa.RecordBatch.from_pydict(
                {"key": pa.array(some.keys(), pa.binary()), "inner": pa.array(some.values(), pa.binary())}
            )

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model_path)
        for part in slices(batches, "inner", SLICE):
            ids = coder.encode(part.column("inner").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array([x.tobytes() for x in ids], pa.binary())], names=["key", "ids"]
            )

    once = texts.mapInArrow(listed, "key binary, inner binary").groupBy("key").agg(F.first("inner").alias("inner"))
    return stored(once.mapInArrow(code, "key binary, ids binary"), BATCH_TEXTS)


def _packed_lists(rows: list[bytes]) -> pa.Array:
    borders = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in rows], out=borders[1:])
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def _results(coder: Encoder, rows: list[bytes], packed: bool, decoded: bool) -> list[pa.Array]:
    """Columns of ids, and of text, from packed ids."""
    made = [pa.array(rows, pa.binary()) if packed else _packed_lists(rows)]
    if decoded:
        made.append(pa.array([coder.decode(np.frombuffer(x, np.uint32)) for x in rows], pa.string()))
    return made


def encode(
    df: DataFrame,
    model_path: str,
    text: str = "text",
    ids: str = "ids",
    drop: tuple[str, ...] = (),
    packed: bool = False,
    decoded: str | None = None,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``df`` without the columns ``drop`` and with the ids of its texts, as the tokenizers
    library gives them with ``add_special_tokens=False`` and without truncation and padding.

    ``packed`` gives them as bytes, four for each id, lowest first, instead of an array.
    ``decoded`` names a column for what ``decode`` makes of the ids, in the same pass. A null
    or empty text has no ids. Every row is kept, repeated rows repeat. Columns named like a
    new one, in whatever case, are replaced; all others may have any name. The file has to be
    on every executor; its tokenizer must not let a token hold white space.

    What moves: a key per chunk, each shared chunk once, and the ids of texts that have one.
    Texts without are encoded in the pass that reads the result, and nothing of them is
    stored. The table of encoded chunks and the places they occur at are both stored before
    they are joined, so adaptive execution splits a chunk that very many texts have. Ids of a
    text meet in one row, as the result has them.
    """
    new = [ids] if decoded is None else [ids, decoded]
    kept = [f for f in df.schema if not any(same_name(f.name, n) for n in new) and f.name not in drop]
    names = [f.name for f in kept]
    made = [T.StructField(ids, T.BinaryType() if packed else IDS)]
    made += [] if decoded is None else [T.StructField(decoded, T.StringType())]
    result = T.StructType([*kept, *made])
    source, group, seq, key, own, row = fresh([*df.columns, *new], "text", "group", "seq", "key", "own", "row")
    texts = df.select(F.col(text).alias("text")).filter("text <> ''")
    known = df.sparkSession.sparkContext.broadcast(shared_chunks(texts, filter_bits))
    coded = encoded_chunks(texts, known, model_path)
    given = df.select(*(f"`{n}`" for n in names), F.col(text).alias(source))

    def chunked(batches: Iterable[pa.RecordBatch], wanted: bool) -> Iterator[tuple[pa.RecordBatch, Chunks, list[bytes], np.ndarray]]:
        """Rows whose texts have a shared chunk, or those whose texts have none."""
        for part in slices(batches, source, SLICE):
            chunks = cut(part.column(source))
            keys, heads = _keys(chunks)
            shared = bitmaps.has(known.value, heads.view(U64)) if len(heads) else np.zeros(0, bool)
            first, last = _inner(chunks)
            touched = np.zeros(len(part), bool)
            touched[chunks.text[shared & (last > first)]] = True
            rows = np.flatnonzero(touched == wanted)
            if len(rows):
                mine = (touched == wanted)[chunks.text]
                some = Chunks(chunks.data, chunks.begin[mine], chunks.end[mine], np.searchsorted(rows, chunks.text[mine]))
                yield part.take(pa.array(rows)), some, [k for k, m in zip(keys, mine.tolist()) if m], shared[mine]

    def by_itself(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model_path)
        for part, _, _, _ in chunked(batches, False):
            found = coder.encode([x or b"" for x in part.column(source).cast(pa.binary()).to_pylist()])
            columns = _results(coder, [x.tobytes() for x in found], packed, decoded is not None)
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *columns], names=result.names)

    def in_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model_path)
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for part, chunks, keys, shared in chunked(batches, True):
            at, groups, seqs, chunk, here = [], [], [], [], []
            for i, own_pieces in enumerate(pieces(coder, chunks, shared, keys, len(part))):
                number += 1
                for n, piece in enumerate(own_pieces):
                    at.append(i if n == 0 else None)  # the columns of a row go with its first piece
                    groups.append(number)
                    seqs.append(n)
                    chunk.append(piece.key)
                    here.append(None if piece.ids is None else piece.ids.tobytes())
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(n).take(rows) for n in names),
                    pa.array(groups, pa.int64()),
                    pa.array(seqs, pa.int32()),
                    pa.array(chunk, pa.binary()),
                    pa.array(here, pa.binary()),
                ],
                names=[*names, group, seq, key, own],
            )

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model_path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                columns = _results(coder, [b"".join(x) for x in part.column(own).to_pylist()], packed, decoded is not None)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *columns], names=result.names)

    parts_schema = T.StructType(
        [
            *(T.StructField(f.name, f.dataType) for f in kept),
            T.StructField(group, T.LongType()),
            T.StructField(seq, T.IntegerType()),
            T.StructField(key, T.BinaryType()),
            T.StructField(own, T.BinaryType()),
        ]
    )
    parts = stored(given.mapInArrow(in_parts, parts_schema), BATCH_TEXTS)
    here = parts.filter(F.col(key).isNull()).select(
        group, seq, F.col(own), F.when(F.col(seq) == 0, F.struct(*(F.col(f"`{n}`") for n in names))).alias(row)
    )
    lent = (
        parts.filter(F.col(key).isNotNull())
        .select(group, seq, key)
        .join(coded.select(F.col("key").alias(key), F.col("ids").alias(own)), key)
        .select(group, seq, own)
        .withColumn(row, F.lit(None).cast(here.schema[row].dataType))
    )
    together = (
        here.unionByName(lent)
        .groupBy(group)
        .agg(
            F.first(row, ignorenulls=True).alias(row),
            F.array_sort(F.collect_list(F.struct(seq, own))).alias(own),
        )
        .select(*(F.col(row)[n].alias(n) for n in names), F.col(own)[own].alias(own))
    )
    return given.mapInArrow(by_itself, result).unionByName(together.mapInArrow(joined, result))


def decode(df: DataFrame, model_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text its ids (an array, or packed) stand for, as the library's
    ``decode`` gives it without skipping special tokens. Null or no ids give an empty text.
    A column named like ``decoded``, in whatever case, is replaced."""
    kept = [f for f in df.schema if not same_name(f.name, decoded)]
    names = [f.name for f in kept]
    packed = isinstance(df.schema[ids].dataType, T.BinaryType)
    source = fresh([*df.columns, decoded], "ids")[0]

    def numbers(x: object) -> np.ndarray:
        return np.frombuffer(x, np.uint32) if packed else np.array(x, np.uint32)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model_path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = [coder.decode(numbers(x)) if x else "" for x in part.column(source).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(texts, pa.string())], names=[*names, decoded]
                )

    schema = T.StructType([*kept, T.StructField(decoded, T.StringType())])
    return df.select(*(f"`{n}`" for n in names), F.col(ids).alias(source)).mapInArrow(run, schema)
