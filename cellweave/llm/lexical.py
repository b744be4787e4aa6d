"""Ranked lexical search: the best documents for each of a set of query texts.

A pass over the documents gives their number, their length and how many hold each term that
a query has. In a second one every task indexes the terms of the queries over blocks of its
documents and ranks each block for all queries, carrying the best of a query on from block to
block. A query is worked off in two ways: its short lists are summed term at a time into
accumulators, and these are then one more iterator, with a bound of its own, among the long
lists, which are walked document at a time. What can not reach the best found so far is
skipped: by window of documents, by iterators that suffice only together with others, and
document by document while the rest is looked up. The best of all tasks are merged by Spark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.llm import bitmaps
from cellweave.llm.batches import stored
from cellweave.llm.words import ALPHANUMERIC, U64, signed, slices, split_words

BEST = 20
#: Documents and postings that a task indexes at a time.
BLOCK_DOCS = 8192
BLOCK_POSTINGS = 4_000_000
#: Documents of a window, and the part of a block's documents up to which a list is short.
WINDOW_DOCS = 1024
SHORT = 1 / 32
#: Distinct terms of queries that go to the tasks at once, about 24 bytes each; more queries take more passes.
QUERY_TERMS = 1_000_000
#: Bitmap of the terms of all queries while they are counted: 2 MB.
FILTER_BITS = 24
#: Local results are merged in so many groups for a query before they are merged into one.
MERGES = 256


class Queries(NamedTuple):
    """``vocabulary``: sorted term hashes; ``weight``: of each. Query ``q`` has the terms
    ``term[first[q]:first[q + 1]]`` (places in the vocabulary), each ``repeats`` times."""

    vocabulary: np.ndarray
    weight: np.ndarray
    number: np.ndarray
    first: np.ndarray
    term: np.ndarray
    repeats: np.ndarray


def queries_of(rows: pa.Table) -> Queries:
    """From rows (item, hash, n, weight)."""
    item, hashes, n, weight = (rows.column(c).to_numpy() for c in ("item", "hash", "n", "weight"))
    vocabulary, where, term = np.unique(hashes.view(U64), return_index=True, return_inverse=True)
    order = np.argsort(item, kind="stable")
    number, first = np.unique(item[order], return_index=True)
    return Queries(
        vocabulary,
        weight[where],
        number,
        np.append(first, len(order)),
        term[order],
        n[order],
    )


class Best:
    """The best documents of one query so far: score down, id up, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)
        #: Documents below this score can be left out. A score of 0 is no result.
        self.least = 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        null = np.concatenate([self.null, null])
        order = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]
        if len(order) == self.k:
            self.least = int(self.score[-1])


class Lists:
    """Postings of a block of documents, by term and then by document."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, norm: np.ndarray, terms: int):
        order = np.lexsort((doc, term))
        term, self.doc, tf = term[order], doc[order], tf[order]
        self.impact = 1_000_000_000 * tf // (1000 * tf + 12 * norm[self.doc])
        self.first = np.searchsorted(term, np.arange(terms + 1))
        self.docs = len(norm)
        self.windows = -(-self.docs // WINDOW_DOCS)
        self.size = np.diff(self.first)
        self.top = np.zeros(terms, np.int64)
        if len(term):
            filled = self.size > 0
            self.top[filled] = np.maximum.reduceat(self.impact, self.first[:-1][filled])
        self._parted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def parted(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each window of a list begins, and the highest impact in it."""
        if term not in self._parted:
            a, b = self.first[term], self.first[term + 1]
            border = a + np.searchsorted(self.doc[a:b], np.arange(self.windows + 1) * WINDOW_DOCS)
            top = np.zeros(self.windows, np.int64)
            filled = np.diff(border) > 0
            top[filled] = np.maximum.reduceat(self.impact[a:b], border[:-1][filled] - a)
            self._parted[term] = border, top
        return self._parted[term]


def rank_block(lists: Lists, terms: np.ndarray, weight: np.ndarray, best: Best, doc: np.ndarray, null: np.ndarray) -> None:
    """Put the documents of a block that are among the best for a query into ``best``."""
    there = lists.size[terms] > 0
    terms, weight = terms[there], weight[there]
    if int((weight * lists.top[terms]).sum()) < best.least:
        return
    short = lists.size[terms] <= max(1, int(lists.docs * SHORT))

    # Term at a time: the short lists become one list of sums.
    sums = np.zeros(lists.windows * WINDOW_DOCS, np.int64)
    for t, w in zip(terms[short].tolist(), weight[short].tolist()):
        a, b = lists.first[t], lists.first[t + 1]
        sums[lists.doc[a:b]] += w * lists.impact[a:b]

    # Document at a time: iterators are the sums (None) and the long lists; for each window a bound.
    iterators: list[tuple[int | None, int]] = [(None, 1), *zip(terms[~short].tolist(), weight[~short].tolist())]
    tops = np.stack(
        [sums.reshape(lists.windows, WINDOW_DOCS).max(axis=1)] + [w * lists.parted(t)[1] for t, w in iterators[1:]]
    )
    bound = tops.sum(axis=0)
    for window in range(lists.windows):
        if bound[window] < best.least:
            continue
        top = tops[:, window]
        order = np.argsort(top)
        # Documents that only these have stay below the least score.
        weak = int(np.searchsorted(np.cumsum(top[order]), best.least))
        low = window * WINDOW_DOCS
        score = np.zeros(WINDOW_DOCS, np.int64)
        for i in order[weak:].tolist():
            t, w = iterators[i]
            if t is None:
                score += sums[low : low + WINDOW_DOCS]
            else:
                a, b = lists.parted(t)[0][window : window + 2]
                score[lists.doc[a:b] - low] += w * lists.impact[a:b]
        found = np.flatnonzero(score)
        rest = int(top[order[:weak]].sum())
        for i in order[:weak][::-1].tolist():
            if top[i] == 0:
                break
            found = found[score[found] + rest >= best.least]
            rest -= int(top[i])
            t, w = iterators[i]
            if t is None:
                score[found] += sums[low + found]
                continue
            a, b = lists.parted(t)[0][window : window + 2]
            own = lists.doc[a:b]
            at = np.searchsorted(own, found + low)
            at[at == len(own)] = 0
            hit = own[at] == found + low
            score[found[hit]] += w * lists.impact[a:b][at[hit]]
        found = found[score[found] >= best.least]
        if len(found):
            best.add(score[found], doc[low + found], null[low + found])


def rank_docs(
    parts: Iterable[pa.RecordBatch], queries: Queries, n_docs: int, n_terms: int, k: int
) -> dict[int, Best]:
    """The best of the documents in ``parts`` (doc_id, text) for each query."""
    best = {int(q): Best(k) for q in queries.number}
    terms = len(queries.vocabulary)
    block: list[tuple[np.ndarray, ...]] = []
    docs = postings = 0

    def rank() -> None:
        code, tf, length, doc, null = (np.concatenate(x) for x in zip(*block))
        lists = Lists(code % terms, code // terms, tf, 75 + 25 * length * n_docs // n_terms, terms)
        for i, q in enumerate(queries.number.tolist()):
            own = slice(queries.first[i], queries.first[i + 1])
            term = queries.term[own]
            rank_block(lists, term, queries.weight[term] * queries.repeats[own], best[q], doc, null)

    for part in parts:
        words = split_words(part.column("text"), ALPHANUMERIC)
        length = np.diff(words.first)
        at = np.searchsorted(queries.vocabulary, words.hashes)
        at[at == terms] = 0
        known = np.flatnonzero(queries.vocabulary[at] == words.hashes)
        owner = np.searchsorted(words.first, known, "right") - 1
        code, tf = np.unique((owner + docs) * terms + at[known], return_counts=True)
        ids = part.column("doc_id")
        null = ids.is_null().to_numpy(zero_copy_only=False)
        block.append((code, tf, length, ids.fill_null(0).to_numpy(), null))
        docs, postings = docs + len(part), postings + len(code)
        if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
            rank()
            block, docs, postings = [], 0, 0
    if block:
        rank()
    return best


def query_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, item_id, hash, n): the terms of each row, which gets a number of its own. Rows
    without a term are left out."""
    kind = items.schema[item_id].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for part in slices(batches, "text"):
            words = split_words(part.column("text"), ALPHANUMERIC)
            owner = np.repeat(np.arange(len(part)), np.diff(words.first))
            order = np.lexsort((words.hashes, owner))
            owner, hashes = owner[order], words.hashes[order]
            new = np.ones(len(owner), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number + owner[at]),
                    part.column("item_id").take(pa.array(owner[at])),
                    pa.array(signed(hashes[at])),
                    pa.array(np.diff(np.append(at, len(owner)))),
                ],
                names=["item", "item_id", "hash", "n"],
            )
            number += len(part)

    schema = T.StructType().add("item", "long").add("item_id", kind).add("hash", "long").add("n", "long")
    return items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def statistics(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(hash, docs, terms) from texts: for a hash that may be in the bitmap, the documents that
    hold it; for the null hash, all documents with a term, and all their terms."""
    known = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = total = 0
        for part in slices(batches, "text"):
            words = split_words(part.column("text"), ALPHANUMERIC)
            filled, total = filled + int((np.diff(words.first) > 0).sum()), total + len(words.hashes)
            some = np.flatnonzero(bitmaps.has(known.value, words.hashes))
            owner, hashes = np.searchsorted(words.first, some, "right") - 1, words.hashes[some]
            order = np.lexsort((owner, hashes))
            owner, hashes = owner[order], hashes[order]
            once = np.ones(len(owner), bool)
            once[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
            term, count = np.unique(hashes[once], return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {"hash": signed(term), "docs": count, "terms": np.zeros(len(term), np.int64)}
            )
        yield pa.RecordBatch.from_pydict({"hash": pa.array([None], pa.int64()), "docs": [filled], "terms": [total]})

    counted = docs.select("text").mapInArrow(run, "hash long, docs long, terms long")
    return counted.groupBy("hash").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms"))


def search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = BEST,
    query_terms_at_once: int = QUERY_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents for each row of ``items``.

    Terms are runs of ASCII letters and digits and of any other characters beyond ASCII, in
    whole texts, with only A-Z made lower case; they are told apart by 64-bit hashes. With N
    documents that have a term, L terms in all, n in one document, df documents with a term
    and tf of its occurrences in a document, the term weighs w = floor(1000 ln((2N + 2) /
    (2df + 1))) and adds w * (10**9 tf div (1000 tf + 12 m)) each time the query has it, where
    m = 75 + (25 n N div L). Only scores above 0 are results, so a query or a document that is
    null or empty has none. Equal scores come by ascending id, null ids last. Every row is an
    item or a document of its own, so repeated rows repeat; document ids are whole numbers,
    item ids of any type. Other columns are not looked at.

    Queries are sent to the tasks in blocks of about ``query_terms_at_once`` distinct terms
    (or one longer query), with a pass over the documents for each block; documents move
    nowhere. A task returns ``k`` rows a query, which are merged in two steps.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    terms = stored(query_terms(items, item_id, item_text))
    counted = stored(statistics(docs, bitmaps.bitmap(terms.select("hash"), FILTER_BITS)))
    total = counted.filter("hash is null").first()
    n_docs, n_terms = (total.docs, total.terms) if total else (0, 0)
    weight = F.floor(F.lit(1000.0) * F.ln(F.lit(2.0 * n_docs + 2) / (2 * F.col("docs") + 1)))
    weighted = terms.join(counted.filter("hash is not null and docs > 0"), "hash").select(
        "item", "hash", "n", weight.cast("long").alias("weight")
    )
    weighted = stored(weighted.filter("weight > 0"))
    blocks = -(-weighted.count() // query_terms_at_once)

    found = spark.createDataFrame([], "part int, item long, doc_id long, score long")
    for block in range(blocks):
        rows = weighted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()
        if rows.num_rows:
            ranked = _ranked(docs, queries_of(rows), n_docs, n_terms, k)
            found = found.unionByName(ranked if blocks == 1 else stored(ranked))

    def merged(df: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    best = merged(merged(found, "item", "part"), "item")
    names = terms.groupBy("item").agg(F.first("item_id").alias("item_id"))
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")


def _ranked(docs: DataFrame, queries: Queries, n_docs: int, n_terms: int, k: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = (TaskContext.get().partitionId() if TaskContext.get() else 0) % MERGES
        for item, best in rank_docs(slices(batches, "text"), sent.value, n_docs, n_terms, k).items():
            if len(best.score):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(best.score), part, np.int32)),
                        pa.array(np.full(len(best.score), item)),
                        pa.array(best.doc, mask=best.null),
                        pa.array(best.score),
                    ],
                    names=["part", "item", "doc_id", "score"],
                )

    return docs.mapInArrow(run, "part int, item long, doc_id long, score long")
