"""Removal of long passages that an earlier document has, by fixed-block anchors.

Every run of ``WINDOW`` (50) words of a document holds one whole block of ``BLOCK`` (25)
words that begins at a multiple of 25. These non-overlapping blocks are the index, with the
lowest id that has each. Every rolling run of 25 words of every document probes it. Blocks
that a higher id probes are live, and around each live run all windows of 50 words are
listed, in the probing as in the indexed document: a repeat of 50 words or more is among
them as a whole, so windows that adjoin make up the maximal repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.llm import bitmaps
from cellweave.llm.batches import fresh, stored, with_arrays
from cellweave.llm.words import SPACED, Words, buffers, signed, slices, split_words, window_hashes, windows

WINDOW = 50
BLOCK = 25
#: Bitmap of block hashes: 32 MB. More blocks than bits let more probes through, no fewer.
FILTER_BITS = 28
#: Bitmap of the documents that lose something: 8 MB.
CHANGED_BITS = 26
#: Texts that go to Python in one go.
BATCH_TEXTS = 1000


def _emit(docs: DataFrame, found: Callable[[Words, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Rows (hash, doc_id) that ``found`` makes from words and, for each text, its id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = split_words(part.column("text"), SPACED)
            hashes, ids = found(words, part.column("doc_id").to_numpy())
            yield pa.RecordBatch.from_pydict({"hash": signed(hashes), "doc_id": ids})

    return docs.mapInArrow(run, "hash long, doc_id long")


def _highest(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each hash once, with its highest id."""
    order = np.lexsort((ids, hashes))
    hashes, ids = hashes[order], ids[order]
    last = np.append(hashes[1:] != hashes[:-1], True) if len(hashes) else np.zeros(0, bool)
    return hashes[last], ids[last]


def repeated_windows(docs: DataFrame, window: int, block: int, filter_bits: int) -> DataFrame:
    """(hash, doc_id) of each window that also starts in a document with a smaller id."""
    spark = docs.sparkSession
    if window < 2 * block - 1:
        raise ValueError("a window must be sure to hold a whole block")

    def blocks(words: Words, ids: np.ndarray):
        # Runs at multiples of the block size, text by text.
        count = np.diff(words.first) // block
        owner = np.repeat(np.arange(len(ids)), count)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        return window_hashes(words.hashes, words.first[owner] + nth * block, block), ids[owner]

    index = stored(_emit(docs, blocks).groupBy("hash").agg(F.min("doc_id").alias("lowest")), BATCH_TEXTS)
    known = spark.sparkContext.broadcast(bitmaps.bitmap(index.select("hash"), filter_bits))

    def probes(words: Words, ids: np.ndarray):
        at, hashes = windows(words, block)
        keep = bitmaps.has(known.value, hashes)
        owner = np.searchsorted(words.first, at[keep], "right") - 1
        return _highest(hashes[keep], ids[owner])

    probed = _emit(docs, probes).groupBy("hash").agg(F.max("doc_id").alias("highest"))
    live = stored(index.join(probed, "hash").filter("lowest < highest").select("hash"), BATCH_TEXTS)
    known.unpersist()
    anchors = spark.sparkContext.broadcast(bitmaps.bitmap(live, filter_bits))

    def around(words: Words, ids: np.ndarray):
        at, hashes = windows(words, block)
        hit = at[bitmaps.has(anchors.value, hashes)]
        marks = np.zeros(len(words.hashes) + 1, np.int32)
        np.add.at(marks, np.maximum(hit - (window - block), 0), 1)
        np.add.at(marks, hit + 1, -1)
        opens, _ = _valid(words, window)
        opens = opens[np.cumsum(marks)[opens] > 0]
        owner = np.searchsorted(words.first, opens, "right") - 1
        return window_hashes(words.hashes, opens, window) if len(opens) else words.hashes[:0], ids[owner]

    listed = stored(_emit(docs, around), BATCH_TEXTS)
    anchors.unpersist()
    # Stored, so that the join below is one of two plain exchanges, which can be split.
    lowest = stored(
        listed.groupBy("hash")
        .agg(F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest"))
        .filter("lowest < highest")
        .select("hash", "lowest")
    )
    return listed.join(lowest, "hash").filter("doc_id > lowest").select("hash", "doc_id")


def _valid(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the runs of ``length`` words within a text, and the text of each."""
    count = np.maximum(np.diff(words.first) - length + 1, 0)
    owner = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return words.first[owner] + nth, owner


def _kept(column: pa.Array, gone: Callable[[int, np.ndarray], np.ndarray] | None, window: int) -> dict[str, pa.Array]:
    """Words left of each text, joined by blanks. ``gone(i, hashes)``: which windows of the
    i-th text go."""
    data, offsets = buffers(column)
    words = split_words(column, SPACED) if gone else None
    kept, n_words, n_removed = [], [], []
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        # Without an argument, split() on bytes parts them at just these six characters.
        every = data[a:b].tobytes().split()
        n_words.append(len(every))
        if gone and len(every) >= window:
            begins = np.arange(len(every) - window + 1)
            own = words.hashes[words.first[i] : words.first[i + 1]]
            hit = np.flatnonzero(gone(i, window_hashes(own, begins, window)))
            marks = np.zeros(len(every) + 1, np.int32)
            marks[hit] += 1
            marks[hit + window] -= 1
            every = list(compress(every, (np.cumsum(marks)[:-1] <= 0).tolist()))
        n_removed.append(n_words[-1] - len(every))
        kept.append(b" ".join(every))
    return {
        "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
        "n_words": pa.array(n_words, pa.int64()),
        "n_removed": pa.array(n_removed, pa.int64()),
    }


ADDED = {"kept_text": T.StringType(), "n_words": T.LongType(), "n_removed": T.LongType()}


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    block: int = BLOCK,
    filter_bits: int = FILTER_BITS,
    keep_text: bool = False,
) -> DataFrame:
    """``docs`` without its text (unless ``keep_text``) and with ``n_words``, ``n_removed``
    and ``kept_text``, the words that stay, joined by one blank.

    A word goes if it is covered by ``window`` consecutive words of its document that also
    start in a document with a smaller id, as the texts are given. Words are runs of bytes
    other than blank, tab, line feed, vertical tab, form feed and carriage return. Equality
    is that of 64-bit hashes of the whole window. So of copies the lowest id stays whole.
    Ids are whole numbers; a row with a null id takes no part and stays whole, rows with the
    same id do not count for each other. A null text has no words. Existing columns of the
    new names are replaced.

    What moves: a row per distinct block, a row per probe that a bitmap of the blocks lets
    through, and the listed windows. All are aggregated before they are shuffled, and no key
    needs its rows in one place, so passages that a third of the documents share are spread.
    Texts move only for documents that lose something.
    """
    slim = docs.filter(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    gone = stored(repeated_windows(slim, window, block, filter_bits))
    changed = bitmaps.bitmap(gone.select(F.xxhash64("doc_id").alias("h")).distinct(), CHANGED_BITS)
    docs = docs.drop(*ADDED)
    own_id, own_gone = fresh(docs.columns, "id", "gone")
    # Spark computes both hashes, so they agree; that of a null id is some number too.
    hashed = F.xxhash64(F.col(doc_id).cast("long"))
    _, touched = bitmaps.apart(docs, hashed, changed)
    drop = () if keep_text else (text,)
    same = bitmaps.within(docs, hashed, changed, False)
    whole = with_arrays(docs, text, ADDED, lambda column: _kept(column, None, window), drop, keep=same)
    # Each window of an id once, so a list is no longer than its text. Stored for the join's sake.
    sets = stored(gone.groupBy(F.col("doc_id").alias(own_id)).agg(F.collect_set("hash").alias(own_gone)))
    met = touched.join(sets.hint("shuffle_hash"), F.col(doc_id).cast("long") == F.col(own_id), "left").drop(own_id)
    return whole.unionByName(_cut(met, text, window, drop, own_gone))


def _cut(met: DataFrame, text: str, window: int, drop: tuple[str, ...], own_gone: str) -> DataFrame:
    kept = [f for f in met.schema if f.name not in drop and f.name != own_gone]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, *(T.StructField(name, kind) for name, kind in ADDED.items())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            sets = part.column(own_gone)

            def gone(i: int, hashes: np.ndarray, sets=sets) -> np.ndarray:
                own = sets[i].values
                if own is None:
                    return np.zeros(len(hashes), bool)
                return np.isin(hashes, own.to_numpy(zero_copy_only=False).view(np.uint64))

            made = _kept(part.column(text), gone, window)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n) for n in names), *(made[n] for n in ADDED)], names=[*names, *ADDED]
            )

    return met.mapInArrow(run, schema)
