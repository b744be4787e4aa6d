"""Benchmark passages in documents, found by winnowed fingerprints.

Of any ``WINDOW`` (10) words, the ``GRAM``-word runs in them have a smallest hash. Whoever
holds these words marks that run, so a document and an item that share them share a
fingerprint. Documents mark the runs that are smallest in some window and keep those which
a bitmap of the items' fingerprints lets through. These are joined with the fingerprints
themselves; each hit is then extended: every window around it is looked up among the
windows of the items, and adjoining windows merge to spans.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.llm import bitmaps
from cellweave.llm.batches import fresh, stored, with_arrays
from cellweave.llm.words import (
    ALPHANUMERIC,
    Letters,
    Words,
    signed,
    slices,
    split_words,
    window_hashes,
    windows,
)

WINDOW = 10
GRAM = 6
FILTER_BITS = 24
#: Bitmap of the documents that are hit: 8 MB.
CHANGED_BITS = 26

HIT = T.StructType(
    [
        T.StructField("print", T.LongType(), False),
        T.StructField("start", T.IntegerType(), False),
        T.StructField("size", T.IntegerType(), False),
        T.StructField("window", T.LongType(), False),
    ]
)


def winnowed(words: Words, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the runs of ``gram`` words that are smallest in some window
    of ``window`` words; all of them, if several are equally small."""
    opens, _ = windows(words, window)
    if not len(opens):
        return opens, words.hashes[:0]
    # Runs are hashed wherever one begins in the flat array; those across texts are in no window.
    begins = np.arange(len(words.hashes) - gram + 1)
    runs = window_hashes(words.hashes, begins, gram)
    width = window - gram + 1
    least = runs[opens]
    for step in range(1, width):
        np.minimum(least, runs[opens + step], out=least)
    marked = np.zeros(len(runs), bool)
    for step in range(width):
        marked[opens + step] |= runs[opens + step] == least
    at = np.flatnonzero(marked)
    return at, runs[at]


def _windows_around(words: Words, at: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``at``, first word) of each window of a text that holds the run there."""
    text = np.searchsorted(words.first, at, "right") - 1
    low, high = words.first[text], words.first[text + 1] - window
    which, opens = [], []
    for back in range(window - gram + 1):
        start = at - back
        ok = np.flatnonzero((start >= low) & (start <= high))
        which.append(ok)
        opens.append(start[ok])
    return np.concatenate(which), np.concatenate(opens)


def _hits(words: Words, window: int, gram: int, short: list[int], passes=None) -> dict[str, np.ndarray]:
    """Windows to look up: the fingerprint each was found by, its first word in the flat
    array, its length and hash. ``passes`` tells which fingerprints to keep."""
    at, prints = winnowed(words, window, gram)
    if passes is not None:
        keep = passes(prints)
        at, prints = at[keep], prints[keep]
    which, opens = _windows_around(words, at, window, gram)
    # Windows are few after the filter; their words are gathered rather than summed up to.
    out = [(prints[which], opens, np.full(len(opens), window), _gathered(words, opens, window))]
    for size in short:
        opens, hashes = windows(words, size)
        keep = slice(None) if passes is None else passes(hashes)
        opens, hashes = opens[keep], hashes[keep]
        out.append((hashes, opens, np.full(len(opens), size), hashes))
    return dict(zip(("print", "open", "size", "window"), (np.concatenate(x) for x in zip(*out))))


def _gathered(words: Words, opens: np.ndarray, size: int) -> np.ndarray:
    order = np.argsort(opens, kind="stable")
    out = np.empty(len(opens), np.uint64)
    out[order] = window_hashes(words.hashes, opens[order], size)
    return out


def item_windows(items: DataFrame, text: str, item_id: str, window: int, gram: int, kind: Letters) -> DataFrame:
    """Windows of the items: fingerprint, length, hash and the item's id as text. An item of
    fewer words is one window, with itself as fingerprint; without words it has none."""
    spec = "print long, size int, window long, item string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = split_words(part.column("text"), kind)
            length = np.diff(words.first)
            found = _hits(words, window, gram, [])
            lone = np.flatnonzero((length > 0) & (length < window))
            sizes = length[lone]
            whole = np.zeros(len(lone), np.uint64)
            for size in np.unique(sizes).tolist():
                whole[sizes == size] = _gathered(words, words.first[lone[sizes == size]], size)
            owner = np.concatenate([np.searchsorted(words.first, found["open"], "right") - 1, lone])
            yield pa.RecordBatch.from_pydict(
                {
                    "print": pa.array(signed(np.concatenate([found["print"], whole]))),
                    "size": pa.array(np.concatenate([found["size"], sizes]).astype(np.int32)),
                    "window": pa.array(signed(np.concatenate([found["window"], whole]))),
                    "item": part.column("item").take(pa.array(owner)),
                }
            )

    slim = items.select(F.col(text).alias("text"), F.col(item_id).cast("string").alias("item"))
    return slim.mapInArrow(run, spec).distinct()


def find(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    kind: Letters = ALPHANUMERIC,
    filter_bits: int = FILTER_BITS,
    keep_text: bool = False,
) -> DataFrame:
    """``docs`` without its text (unless ``keep_text``) and with ``n_words``, ``spans``
    (first word and word after the last of each hit passage, in order), ``n_hit`` (words in
    them) and ``items`` (ids of the items with a window in the document, as sorted texts).

    A document word is hit if it lies in an occurrence of ``window`` consecutive words of an
    item, or of all words of an item that has fewer. Words are the same if their 64-bit
    hashes and those of the windows are. Each row of ``docs`` is judged alone: repeated rows
    give repeated results, a null id is an id like others, a null or empty text has no
    words. An item without an id hits, but is not listed; repeated items count once. No
    items, no hits. Existing columns of the new names are replaced.

    Only fingerprints that pass the bitmap are joined. An item window that a third of the
    documents hold meets one row per item with it, and the join splits hot keys.
    """
    looked = stored(item_windows(items, item_text, item_id, window, gram, kind))
    known = docs.sparkSession.sparkContext.broadcast(bitmaps.bitmap(looked.select("print"), filter_bits))
    # At most window - 1 lengths.
    short = sorted(row[0] for row in looked.filter(F.col("size") < window).select("size").distinct().collect())

    def compute(column: pa.Array) -> dict[str, pa.Array]:
        words = split_words(column, kind)
        found = _hits(words, window, gram, short, lambda prints: bitmaps.has(known.value, prints))
        owner = np.searchsorted(words.first, found["open"], "right") - 1
        order = np.argsort(owner, kind="stable")
        start = found["open"] - words.first[owner]
        hits = pa.StructArray.from_arrays(
            [
                pa.array(signed(found["print"][order])),
                pa.array(start[order].astype(np.int32)),
                pa.array(found["size"][order].astype(np.int32)),
                pa.array(signed(found["window"][order])),
            ],
            names=HIT.names,
        )
        borders = np.searchsorted(owner[order], np.arange(len(column) + 1)).astype(np.int32)
        return {
            "n_words": pa.array(np.diff(words.first)),
            own_hits: pa.ListArray.from_arrays(pa.array(borders), hits),
        }

    # Rows that agree in id and text are the same for this purpose.
    key = F.concat_ws(":", F.xxhash64(doc_id, text), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    docs = docs.drop("spans", "n_hit", "items", "n_words")
    own_key, own_hits, every = fresh(docs.columns, "key", "hits", "all")
    docs = docs.withColumn(own_key, key)
    added = {"n_words": T.LongType(), own_hits: T.ArrayType(HIT, False)}
    seen = stored(with_arrays(docs, text, added, compute, () if keep_text else (text,)))

    # What is made unique is stored before it is joined: the join is then one of two plain
    # exchanges, and a window or a row that very many have can be split.
    hits = seen.select(F.col(own_key).alias("key"), F.explode(own_hits).alias("hit")).select("key", "hit.*")
    matched = (
        hits.join(stored(looked.select("print").distinct()), "print", "left_semi")
        .select("key", "start", "size", "window")
        .distinct()
        .join(stored(looked.select("size", "window").distinct()), ["size", "window"], "left_semi")
    )
    matched = stored(matched)
    spans = matched.groupBy(F.col("key").alias(own_key)).agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias(every)
    )
    listed = (
        matched.select("key", "size", "window")
        .distinct()
        .join(looked.select("size", "window", "item"), ["size", "window"])
        .groupBy(F.col("key").alias(own_key))
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    # Only documents with a hit have a row there, and only these are exchanged to meet it.
    judged = stored(spans.join(listed, own_key, "left"))
    hashed = F.xxhash64(own_key)
    hit = bitmaps.bitmap(judged.select(hashed.alias("hash")), CHANGED_BITS)
    same, touched = bitmaps.apart(seen.drop(own_hits), hashed, hit)
    nothing = {name: F.lit(None).cast(judged.schema[name].dataType) for name in (every, "items")}
    met = same.withColumns(nothing).unionByName(touched.join(judged, own_key, "left"))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def merge(done, span):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))),
        )
        return F.when((F.size(done) > 0) & (last["end"] >= span["start"]), joined).otherwise(
            F.concat(done, F.array(span))
        )

    out = met.withColumn("spans", F.aggregate(F.coalesce(every, none), none, merge)).withColumn(
        "items", F.coalesce("items", F.array().cast("array<string>"))
    )
    covered = F.aggregate("spans", F.lit(0), lambda sum_, span: sum_ + span["end"] - span["start"])
    return out.withColumn("n_hit", covered.cast("long")).drop(own_key, every)
