"""Approximate nearest neighbours by inner product, with an inverted multi-index.

Both halves of a vector are quantised on their own, so K centroids for each give K * K
cells. A query walks over pairs of centroids in the order of their summed distances (a
distance is the negative inner product with the query's half), taken from a heap, until the
cells it has seen hold enough rows. The rows in these cells are ranked by the real product.

How many rows are enough is measured: some queries are answered exactly, against all rows, and
the walk has to go as far as it takes to come by the wanted share of their neighbours.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.batches import shuffle_partitions, stored

CENTROIDS = 64
#: Rows the centroids are fitted on: those with the smallest hash of the id.
SAMPLE_ROWS = 20_000
ITERATIONS = 12
#: Queries answered exactly, and the share of their neighbours that the walk has to come by.
MEASURED_QUERIES = 256
RECALL = 0.95
#: Rows that queries meet in one task at a time, and queries scored in one go.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 256
#: Local results are merged in so many groups for a query before they are merged into one.
MERGES = 64
#: Products within this of the last place are computed again in a fixed order.
MARGIN = 1e-9


def vectors(table: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, vector as bytes) of the rows that take part.

    Left out are rows without an id, and vectors that are null or zero or hold nulls, NaN or
    infinities.
    """
    v = F.col("v")
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & ~bad).filter(F.exists(v, lambda x: x != 0))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.array(x).tobytes() for x in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "vector": pa.array(packed, pa.binary())})

    return rows.mapInArrow(run, "vec_id long, vector binary")


def _unpacked(column: Iterable[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(x) for x in column])


def _cut(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = (x.shape[1] + 1) // 2
    return x[:, :middle], x[:, middle:]


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for at in range(0, len(x), 8192):
        out[at : at + 8192] = np.argmin((centroids**2).sum(1) - 2 * x[at : at + 8192] @ centroids.T, axis=1)
    return out


def _k_means(x: np.ndarray, k: int) -> np.ndarray:
    if x.shape[1] == 0:  # of vectors of one component the second half is empty
        return np.zeros((1, 0))
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(7)
    if len(distinct) <= k:
        return distinct
    centroids = distinct[rng.choice(len(distinct), k, replace=False)]
    for _ in range(ITERATIONS):
        own = _nearest(x, centroids)
        count = np.bincount(own, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        centroids = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centroids)
    return centroids


@dataclass(frozen=True)
class Index:
    """Centroids of both halves, and the number of rows in each cell."""

    halves: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray

    def cells(self, x: np.ndarray) -> np.ndarray:
        first, second = _cut(x)
        return _nearest(first, self.halves[0]) * len(self.halves[1]) + _nearest(second, self.halves[1])

    def visited(self, query: np.ndarray, enough: int) -> list[int]:
        """Cells in the order of summed distances until they hold ``enough`` rows."""
        near = [-(c @ h[0]) for c, h in zip(self.halves, _cut(query[None, :]))]
        order = [np.argsort(x, kind="stable") for x in near]
        a, b = (x[o].tolist() for x, o in zip(near, order))
        rows, columns = (o.tolist() for o in order)
        counts, width = self.counts.tolist(), len(b)
        # Of the next pairs in line, one at most per row: row i goes on from column done[i].
        heap, out, seen, opened = [(a[0] + b[0], 0, 0)], [], 0, 1
        while heap and seen < enough:
            _, i, j = heappop(heap)
            cell = rows[i] * width + columns[j]
            if counts[cell]:
                out.append(cell)
                seen += counts[cell]
            if j + 1 < width:
                heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and opened < len(a):
                heappush(heap, (a[opened] + b[0], opened, 0))
                opened += 1
        return out


    def rows_until(self, query: np.ndarray) -> np.ndarray:
        """For each cell, how many rows a query has seen once it has been through it."""
        a, b = (-(c @ h[0]) for c, h in zip(self.halves, _cut(query[None, :])))
        order = np.argsort((a[:, None] + b[None, :]).ravel(), kind="stable")
        seen = np.empty(len(order), np.int64)
        seen[order] = np.cumsum(self.counts[order])
        return seen


def build(rows: DataFrame, centroids: int, sample_rows: int) -> tuple[Index, DataFrame]:
    """The index and the table (vec_id, vector, cell) of all rows."""
    sample = stored(rows.orderBy(F.xxhash64("vec_id"), "vector").limit(sample_rows))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        half = int(part["half"].iloc[0])
        found = _k_means(_cut(_unpacked(part["vector"]))[half], centroids)
        return pd.DataFrame({"half": [half], "rows": [len(found)], "centroids": [found.tobytes()]})

    halves = sample.withColumn("half", F.explode(F.array(F.lit(0), F.lit(1)))).groupBy("half")
    fitted = {x["half"]: x for x in halves.applyInPandas(fit, "half int, rows int, centroids binary").collect()}
    both = tuple(np.frombuffer(fitted[i]["centroids"]).reshape(fitted[i]["rows"], -1 if fitted[i]["centroids"] else 0) for i in (0, 1))
    blank = Index(both, np.zeros(len(both[0]) * len(both[1]), np.int64))
    sent = rows.sparkSession.sparkContext.broadcast(blank)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cells = sent.value.cells(_unpacked(batch.column("vector").to_pylist()))
                yield batch.append_column("cell", pa.array(cells.astype(np.int32)))

    placed = stored(rows.mapInArrow(place, "vec_id long, vector binary, cell int"))
    counts = blank.counts.copy()
    for row in placed.groupBy("cell").count().collect():  # a row per cell at most
        counts[row["cell"]] = row["count"]
    return Index(both, counts), placed


class Block:
    """Rows of a block of cells. Equal vectors are scored once; of their ids, k + 1 small ones
    can be among the best, as one may be the query itself."""

    def __init__(self, ids: np.ndarray, vectors: list[bytes], cells: np.ndarray, k: int):
        distinct: dict[bytes, int] = {}
        owner = np.array([distinct.setdefault(x, len(distinct)) for x in vectors])
        cell = np.empty(len(distinct), np.int64)
        cell[owner] = cells
        by_cell = np.argsort(cell, kind="stable")
        place = np.empty(len(by_cell), np.int64)
        place[by_cell] = np.arange(len(by_cell))
        order = np.lexsort((ids, place[owner]))
        self.k, self.ids = k, ids[order]
        self.first = np.searchsorted(place[owner][order], np.arange(len(distinct) + 1))
        self.vectors = _unpacked(distinct)[by_cell]
        cell = cell[by_cell]
        borders = np.append(np.flatnonzero(np.append(True, cell[1:] != cell[:-1])), len(cell)).tolist()
        self.parts = [(int(cell[a]), a, b) for a, b in zip(borders, borders[1:])]

    def best(self, q_ids: np.ndarray, queries: np.ndarray, visits: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(query_id, vec_id, score) of the best ``k`` in the cells that each query visits."""
        scores = np.full((len(queries), len(self.vectors)), -np.inf)
        for cell, a, b in self.parts:
            who = np.flatnonzero(visits[:, cell])
            if len(who):
                scores[who, a:b] = queries[who] @ self.vectors[a:b].T
        take = min(self.k + 1, scores.shape[1])
        floor = np.partition(scores, scores.shape[1] - take, axis=1)[:, scores.shape[1] - take]
        for i, query in enumerate(queries):
            near = np.flatnonzero((scores[i] >= floor[i] - MARGIN) & (scores[i] > -np.inf))
            exact = np.zeros(len(near))
            for d in range(len(query)):  # one order for all, so that equal vectors tie
                exact += self.vectors[near, d] * query[d]
            listed = [self.ids[self.first[x] : min(self.first[x] + self.k + 1, self.first[x + 1])] for x in near]
            v = np.concatenate(listed) if listed else self.ids[:0]
            s = np.repeat(exact, [len(x) for x in listed])
            keep = v != q_ids[i]
            v, s = v[keep], s[keep]
            order = np.lexsort((v, -s))[: self.k]
            yield np.full(len(order), q_ids[i]), v[order], s[order]


def _found(rows: Iterable[tuple[np.ndarray, ...]], **same: int) -> pa.RecordBatch:
    q, v, s = (np.concatenate(x) for x in zip(*rows))
    extra = {name: pa.array(np.full(len(q), value, np.int32)) for name, value in same.items()}
    return pa.RecordBatch.from_pydict({"query_id": q, "vec_id": v, "score": s, **extra})


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query from (query_id, vec_id, score, part), with their rank."""
    order = [F.col("score").desc(), F.col("vec_id").asc()]
    for keys in (("query_id", "part"), ("query_id",)):
        # Rows that repeat an id and a vector come from one block or from several.
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        found = found.dropDuplicates(["query_id", "vec_id", "score", "part"] if "part" in keys else ["query_id", "vec_id", "score"])
        found = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def enough_rows(index: Index, placed: DataFrame, asked: DataFrame, k: int, queries: int, recall: float) -> int:
    """How many rows a walk has to see to come by the wanted share of the nearest, measured by
    exact answers for some queries: those with the smallest hash of the id."""
    sample = asked.orderBy(F.xxhash64("vec_id"), "vector").limit(queries).toArrow()
    ids, vectors = sample.column("vec_id").to_numpy(), sample.column("vector").to_pylist()
    if not len(ids):
        return 0
    sent = placed.sparkSession.sparkContext.broadcast((ids, _unpacked(vectors)))

    def exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = (TaskContext.get().partitionId() if TaskContext.get() else 0) % MERGES
        q_ids, q = sent.value
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                rows = batch.slice(at, BLOCK_ROWS)
                whole = Block(
                    rows.column("vec_id").to_numpy(), rows.column("vector").to_pylist(), np.zeros(len(rows), np.int64), k
                )
                yield _found(whole.best(q_ids, q, np.ones((len(q), 1), np.uint8)), part=part)

    found = placed.select("vec_id", "vector").mapInArrow(exact, "query_id long, vec_id long, score double, part int")
    near = stored(_merged(found, k))
    cells = placed.select("vec_id", "cell").join(F.broadcast(near.select("query_id", "vec_id")), "vec_id").collect()
    where = {int(i): n for n, i in enumerate(ids)}
    until = [index.rows_until(np.frombuffer(v)) for v in vectors]
    needed = np.sort([until[where[row.query_id]][row.cell] for row in cells])
    return int(needed[max(0, int(np.ceil(recall * len(needed))) - 1)]) if len(needed) else 0


def search(
    table: DataFrame,
    k: int = 20,
    every: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    centroids: int = CENTROIDS,
    sample_rows: int = SAMPLE_ROWS,
    recall: float = RECALL,
    measured_queries: int = MEASURED_QUERIES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, the
    ``k`` rows of largest inner product that the index finds, ties to smaller ids.

    The centroids come from a bounded sample, the index holds every row. Walks go as far as
    ``measured_queries`` exactly answered queries need for the share ``recall`` of their
    neighbours. Scores are inner products of the given vectors in double precision. A query is
    not its own neighbour; rows that share its id count as itself. Rows that take no part are
    named in ``vectors``. Vectors of other lengths are searched among their own, as there is no
    product of two lengths. An empty table gives no rows. Rows with the same id and vector are
    listed once.

    Rows are dealt to blocks of cells of bounded size; a cell with more rows, as around a
    vector that very many rows share, is dealt over several. A block lies in memory once, and
    the queries that visit one of its cells stream past it.
    """
    rows = stored(vectors(table, vec_id, embedding).distinct())
    length = F.octet_length("vector")
    found = table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for size in sorted(row.size for row in rows.select(length.alias("size")).distinct().collect()):
        own = rows.filter(length == size)
        found = found.unionByName(_search(own, k, every, centroids, sample_rows, recall, measured_queries, block_rows))
    return found


def _search(
    rows: DataFrame,
    k: int,
    every: int,
    centroids: int,
    sample_rows: int,
    recall: float,
    measured_queries: int,
    block_rows: int,
) -> DataFrame:
    spark = rows.sparkSession
    index, placed = build(rows, centroids, sample_rows)
    asked = placed.filter(F.col("vec_id") % every == 0).select("vec_id", "vector")
    enough = max(enough_rows(index, placed, asked, k, measured_queries, recall), k + 1)
    # Cells in a row fill a block; one that would overfill it gets blocks of its own.
    first, parts = np.zeros(len(index.counts), np.int64), np.ones(len(index.counts), np.int64)
    block, room = 0, block_rows
    for cell, count in enumerate(index.counts.tolist()):
        if count > room and room < block_rows:
            block, room = block + 1, block_rows
        first[cell], parts[cell] = block, max(1, -(-count // block_rows))
        if count > block_rows:
            block, room = block + parts[cell], block_rows
        else:
            room -= count
    sent = spark.sparkContext.broadcast((index, first, parts))
    layout = "block long, id long, vector binary, cell int, cells binary"

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, first, parts = sent.value
        for batch in batches:
            ids, blocks, packed, bits = [], [], [], []
            for i, raw in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()):
                cells = np.array(index.visited(np.frombuffer(raw), enough))
                mask = np.zeros(len(index.counts), np.uint8)
                mask[cells] = 1
                mask = np.packbits(mask).tobytes()
                for to in sorted({b for c in cells for b in range(first[c], first[c] + parts[c])}):
                    ids.append(i)
                    blocks.append(int(to))
                    packed.append(raw)
                    bits.append(mask)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(blocks, pa.int64()),
                    "id": pa.array(ids, pa.int64()),
                    "vector": pa.array(packed, pa.binary()),
                    "cell": pa.nulls(len(ids), pa.int32()),
                    "cells": pa.array(bits, pa.binary()),
                }
            )

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, first, parts = sent.value
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            own = first[cells] + batch.column("spread").to_numpy() % parts[cells]
            yield pa.RecordBatch.from_pydict(
                {
                    "block": own,
                    "id": batch.column("vec_id"),
                    "vector": batch.column("vector"),
                    "cell": batch.column("cell"),
                    "cells": pa.nulls(len(batch), pa.binary()),
                }
            )

    # Walking costs more than reading: queries are spread over all tasks first.
    questions = asked.repartition(max(8, shuffle_partitions(spark))).mapInArrow(ask, layout)
    spread = placed.withColumn("spread", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)))
    both = spread.mapInArrow(deal, layout).unionByName(questions)
    # The rows of a block, which have a cell, and then the queries.
    met = both.repartition(shuffle_partitions(spark), "block").sortWithinPartitions("block", F.col("cell").asc_nulls_last())

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = (TaskContext.get().partitionId() if TaskContext.get() else 0) % MERGES
        at, held, ready = -1, [], None
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            is_row = batch.column("cell").is_valid().to_numpy(zero_copy_only=False)
            change = np.flatnonzero((blocks[1:] != blocks[:-1]) | (is_row[1:] != is_row[:-1])) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), len(batch)]):
                if blocks[a] != at:
                    at, held, ready = blocks[a], [], None
                if is_row[a]:
                    held.append(batch.slice(a, b - a))
                    continue
                if ready is None and held:
                    own = pa.Table.from_batches(held)
                    ready = Block(
                        own.column("id").to_numpy(), own.column("vector").to_pylist(), own.column("cell").to_numpy(), k
                    )
                for start in range(a, b, BLOCK_QUERIES) if ready is not None else ():
                    some = batch.slice(start, min(b, start + BLOCK_QUERIES) - start)
                    visits = np.stack(
                        [np.unpackbits(np.frombuffer(x, np.uint8)) for x in some.column("cells").to_pylist()]
                    )
                    queries = _unpacked(some.column("vector").to_pylist())
                    yield _found(ready.best(some.column("id").to_numpy(), queries, visits), part=part)

    return _merged(met.mapInArrow(meet, "query_id long, vec_id long, score double, part int"), k)
