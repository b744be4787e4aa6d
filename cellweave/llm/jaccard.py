"""Documents with nearly the same word n-grams, and their groups.

A document's set holds its distinct 5-word shingles. Two documents link when the sets'
Jaccard similarity is at least 80 / 100. The steps, none of which drops a link:

1. Documents with equal sets are one node, known by a hash of the set.
2. Two sets that link share a shingle among the rarest fifth of each. How rare a shingle is
   says a table of counts of fixed size, so any two documents order shingles alike.
3. Nodes that share such a shingle, and are of a size that allows a link, form a tile: of
   one size band and the band above it. In every tile the node that shares most with others,
   over all tiles, is compared with the rest: among near copies, that is one with few changes
   of its own. Those that link merge, so most of a large group of near copies is one
   component from here on, at the cost of a comparison per member.
4. In tiles that still hold several components, nodes of different ones are compared.

A comparison begins with parity bitmaps of the sets (a bit is the parity of the number of
shingles that hash to it): the bits that differ bound the overlap from above. Pairs that
pass are settled by intersecting the sorted sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm import bitmaps
from cellweave.llm.batches import shuffle_partitions, stored
from cellweave.llm.components import components
from cellweave.llm.words import (
    SPACED_LOWER,
    U64,
    sequence_hashes,
    signed,
    slices,
    split_words,
    windows,
)

SHINGLE = 5
PERCENT = 80
#: Counts of shingles are kept for 2 ** COUNT_BITS hashes; a byte of each is broadcast.
COUNT_BITS = 21
COUNT_CHUNK = 1 << 15
#: Nodes of interest, as a bitmap.
NODE_BITS = 26
#: Rows of a tile that are compared in one task; larger tiles are cut into pairs of blocks.
BLOCK_ROWS = 1024
#: Bits of a set's bitmap: at least so many for each shingle, within these bounds.
BITS_EACH = 4
LEAST_WIDTH, MOST_WIDTH = 256, 1 << 17


def shingle_sets(column: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after the other, and their borders."""
    words = split_words(column, SPACED_LOWER)
    at, hashes = windows(words, shingle)
    borders = np.searchsorted(at, words.first)
    count = np.diff(words.first)
    # A text with fewer words is one shingle; the length is part of the hash.
    few = np.flatnonzero((count > 0) & (count < shingle))
    lone = np.zeros(len(few), U64)
    for i, text in enumerate(few):
        own = words.hashes[words.first[text] : words.first[text + 1]]
        lone[i] = sequence_hashes(own, np.array([0]), np.array([len(own)]))[0]
    sets = [np.unique(hashes[a:b]) for a, b in zip(borders, borders[1:])]
    for i, text in enumerate(few):
        sets[text] = lone[i : i + 1]
    ends = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=ends[1:])
    return (np.concatenate(sets) if sets else lone), ends


def nodes_of(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    return signed(sequence_hashes(flat, ends[:-1], ends[1:]))


def _classes(counts: np.ndarray) -> np.ndarray:
    return np.floor(2 * np.log2(1.0 + counts)).astype(np.uint8)


def _sets_and_counts(docs: DataFrame, shingle: int, bits: int) -> DataFrame:
    """A row per document with its size and node, and per task some rows of counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for part in slices(batches, "text"):
            flat, ends = shingle_sets(part.column("text"), shingle)
            np.add.at(counts, (flat >> U64(64 - bits)).astype(np.int64), np.uint32(1))
            n, none = np.diff(ends), np.zeros(len(part), bool)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": part.column("id"),
                    "n": pa.array(n),
                    "node": pa.array(nodes_of(flat, ends), mask=n == 0),
                    "chunk": pa.array(none.astype(np.int32), mask=~none),
                    "counts": pa.nulls(len(part), pa.binary()),
                }
            )
        for chunk in range((1 << bits) // COUNT_CHUNK):
            own = counts[chunk * COUNT_CHUNK : (chunk + 1) * COUNT_CHUNK]
            if own.any():
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": pa.nulls(1, pa.int64()),
                        "n": pa.nulls(1, pa.int64()),
                        "node": pa.nulls(1, pa.int64()),
                        "chunk": pa.array([chunk], pa.int32()),
                        "counts": [own.tobytes()],
                    }
                )

    return docs.mapInArrow(run, "id long, n long, node long, chunk int, counts binary")


def _rarity(found: DataFrame, bits: int) -> np.ndarray:
    """Of each hashed shingle, twice the logarithm of how often it occurs: 2 ** bits bytes."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
                own = sums.setdefault(chunk, np.zeros(COUNT_CHUNK, np.int64))
                own += np.frombuffer(counts.as_buffer(), np.uint32)
        for chunk, own in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"chunk": pa.array([chunk], pa.int32()), "classes": [_classes(own).tobytes()]}
            )

    out = np.zeros(1 << bits, np.uint8)
    rows = found.filter("chunk is not null").select("chunk", "counts").repartition("chunk")
    for row in rows.mapInArrow(add, "chunk int, classes binary").collect():
        out[row.chunk * COUNT_CHUNK : (row.chunk + 1) * COUNT_CHUNK] = np.frombuffer(row.classes, np.uint8)
    return out


def _rarest(docs: DataFrame, rarity: np.ndarray, shingle: int, percent: int) -> DataFrame:
    """(key, n, node): the shingles of each node that a node it links with must share one of.
    A task lists a node once, however many copies it reads."""
    sent = docs.sparkSession.sparkContext.broadcast(rarity)
    bits = len(rarity).bit_length() - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in slices(batches, "text"):
            flat, ends = shingle_sets(part.column("text"), shingle)
            rank = sent.value[(flat >> U64(64 - bits)).astype(np.int64)].astype(U64) << U64(56) | flat >> U64(8)
            nodes = nodes_of(flat, ends).tolist()
            keys, owner = [flat[:0]], []
            for i, (a, b) in enumerate(zip(ends.tolist(), ends[1:].tolist())):
                if a == b or nodes[i] in seen:
                    owner.append(0)
                    continue
                seen.add(nodes[i])
                n = b - a
                last = n - (-(-percent * n // 100))
                own = rank[a:b]
                # Should several have the rank of the last, all of them are taken.
                taken = flat[a:b][own <= np.partition(own, last)[last]]
                keys.append(taken)
                owner.append(len(taken))
            yield pa.RecordBatch.from_pydict(
                {
                    "key": signed(np.concatenate(keys)),
                    "n": np.repeat(np.diff(ends), owner).astype(np.int32),
                    "node": np.repeat(np.array(nodes, np.int64), owner),
                }
            )

    return docs.mapInArrow(run, "key long, n int, node long")


def band(n: Column) -> Column:
    """Sizes that allow a link are in one band or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100 / PERCENT))).cast("int")


def _shared(rarest: DataFrame, percent: int) -> DataFrame:
    """(key, band, n, node) for rows whose key another node of a fitting size has.

    Rows come sorted by key, size and node and are read as a stream, so a key that very many
    nodes have is never held as a whole.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "band", "n", "node")
        held = {x: np.zeros(0, np.int64) for x in names}
        fits = np.zeros(0, bool)  # whether the held row fits the one before it

        def emitted(rows, keep):
            return pa.RecordBatch.from_pydict(
                {x: pa.array(rows[x][keep].astype(np.int32 if x in ("n", "band") else np.int64)) for x in names}
            )

        for batch in batches:
            if not len(batch):
                continue
            new = {x: batch.column(x).to_numpy().astype(np.int64) for x in names}
            rows = {x: np.concatenate([held[x], new[x]]) for x in names}
            # The same node may come from several tasks.
            fresh = np.append(True, (np.diff(rows["key"]) != 0) | (np.diff(rows["node"]) != 0))
            rows = {x: v[fresh] for x, v in rows.items()}
            size = len(rows["key"])
            fit = (np.diff(rows["key"]) == 0) & (100 * rows["n"][:-1] >= percent * rows["n"][1:])
            before = np.append(fits if len(fits) else [False], fit)[:size]
            after = np.append(fit, False)
            keep = (before | after)[:-1]
            yield emitted(rows, np.flatnonzero(keep))
            held = {x: v[-1:] for x, v in rows.items()}
            fits = before[-1:]
        yield emitted(held, np.flatnonzero(fits))

    dealt = rarest.withColumn("band", band(F.col("n"))).repartition(shuffle_partitions(rarest.sparkSession), "key")
    ordered = dealt.sortWithinPartitions("key", "n", "node").select("key", "band", "n", "node")
    return ordered.mapInArrow(run, "key long, band int, n int, node long")


def _of_distinct_sets(shared: DataFrame) -> DataFrame:
    """Rows of one key only where several keys have the same nodes, as those of two near copies
    mostly do: they allow the same pairs. ``copies`` is the number of such keys."""
    folded = [F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"h{i}") for i in (1, 2)]
    keys = shared.groupBy("key").agg(*folded, F.count(F.lit(1)).alias("rows"))
    kept = keys.groupBy("h1", "h2", "rows").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"))
    return shared.join(kept.select("key", "copies"), "key")


def _placed(shared: DataFrame) -> DataFrame:
    """(key, tile, n, node, visits, copies): a row is in the tile of its band, and a visitor in
    that of the band below."""
    both = F.explode(F.array(*(F.struct((F.col("band") - i).alias("tile"), F.lit(bool(i)).alias("visits")) for i in (0, 1))))
    rows = _of_distinct_sets(stored(shared)).select("key", "n", "node", "copies", both.alias("t"))
    return rows.select("key", "t.tile", "n", "node", "t.visits", "copies")


def width_of(n: int) -> int:
    return min(MOST_WIDTH, max(LEAST_WIDTH, 1 << (BITS_EACH * n - 1).bit_length()))


def parity_bitmap(shingles: np.ndarray) -> bytes:
    width = width_of(len(shingles))
    odd = np.bincount((shingles & U64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _of_nodes(docs: DataFrame, nodes: DataFrame, shingle: int, make, kind: str) -> DataFrame:
    """(node, value) for the given nodes, ``make`` giving the value of a sorted set."""
    known = docs.sparkSession.sparkContext.broadcast(bitmaps.bitmap(nodes.select("node"), NODE_BITS))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in slices(batches, "text"):
            flat, ends = shingle_sets(part.column("text"), shingle)
            own = nodes_of(flat, ends)
            wanted = bitmaps.has(known.value, own.view(U64)) & (np.diff(ends) > 0)
            made: dict[int, bytes] = {}
            for i in np.flatnonzero(wanted):
                node = int(own[i])
                if node not in seen:
                    seen.add(node)
                    made[node] = make(flat[ends[i] : ends[i + 1]])
            yield pa.RecordBatch.from_pydict(
                {"node": pa.array(list(made), pa.int64()), "value": pa.array(list(made.values()), pa.binary())}
            )

    # Tasks that read copies of one text make the same value.
    return docs.mapInArrow(run, f"node long, value {kind}").dropDuplicates(["node"])


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """A parity bitmap as that of fewer bits."""
    while len(bits) * 8 > width:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


class Marks:
    """Bitmaps of several sets; ``cut(width, most)`` gives those of ``width`` to ``most`` bits
    at ``width`` bits, and where each set's is."""

    def __init__(self, values: list[bytes]):
        self.values = values
        self.widths = np.array([len(x) for x in values], np.int64) * 8
        self.made: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def cut(self, width: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        if (width, most) not in self.made:
            at = np.flatnonzero((self.widths >= width) & (self.widths <= most))
            where = np.full(len(self.values), -1)
            where[at] = np.arange(len(at))
            bits = np.stack([_folded(np.frombuffer(self.values[i], np.uint8), width) for i in at]).view(U64)
            self.made[width, most] = bits, where
        return self.made[width, most]


def may_link(marks: Marks, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and bitmaps allow that sets ``a`` and ``b`` (indices into ``marks``) link.
    Of two bitmaps, the longer is cut down to the shorter."""
    out = np.zeros(len(a), bool)
    shorter = np.minimum(marks.widths[a], marks.widths[b])
    longer = np.maximum(marks.widths[a], marks.widths[b])
    for width in np.unique(shorter).tolist():
        at = np.flatnonzero(shorter == width)
        bits, where = marks.cut(width, int(longer[at].max()))
        step = max(1, (1 << 24) // width)
        for i in range(0, len(at), step):
            some = at[i : i + step]
            out[some] = _bounded(bits[where[a[some]]], bits[where[b[some]]], n_a[some], n_b[some], percent)
    return out


def _bounded(x: np.ndarray, y: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    both = n_a.astype(np.int64) + n_b
    apart = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    most = np.minimum((both - apart) // 2, np.minimum(n_a, n_b))
    return 100 * most >= percent * (both - most)


def _verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (u, v) whose sorted sets really are similar enough."""
    pairs = stored(pairs)
    nodes = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    sets = stored(_of_nodes(docs, nodes, shingle, lambda x: x.tobytes(), "binary"))
    left = sets.select(F.col("node").alias("u"), F.col("value").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("value").alias("b"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a"), batch.column("b")):
                a, b = (np.frombuffer(x.as_buffer(), U64) for x in (a, b))
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _stars(placed: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """(u, v): each node with the leaders of its tiles that it may link with."""
    # What is summed up by a key is stored before it is joined by it: the join is then one of
    # two plain exchanges, and a node or a tile with very many rows can be split.
    weight = stored(placed.groupBy("node").agg(F.sum("copies").alias("shares")))
    most = F.max(F.struct("shares", "node", "n")).alias("most")
    leaders = placed.join(weight, "node").groupBy("key", "tile").agg(most)
    leaders = stored(leaders.select("key", "tile", F.col("most.node").alias("leader"), F.col("most.n").alias("leader_n")))
    small, large = F.least("n", "leader_n"), F.greatest("n", "leader_n")
    pairs = placed.join(leaders, ["key", "tile"]).filter((F.col("node") != F.col("leader")) & (100 * small >= percent * large))
    pairs = pairs.select(F.col("node").alias("u"), F.col("leader").alias("v"), "n", "leader_n").distinct()
    left = marks.select(F.col("node").alias("u"), F.col("value").alias("a"))
    right = marks.select(F.col("node").alias("v"), F.col("value").alias("b"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = Marks([x for name in ("a", "b") for x in batch.column(name).to_pylist()])
            n, m = (batch.column(x).to_numpy() for x in ("n", "leader_n"))
            at = np.arange(len(batch))
            keep = may_link(marks, at, at + len(batch), n, m, percent)
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep))

    return pairs.join(left, "u").join(right, "v").select("u", "v", "n", "leader_n", "a", "b").mapInArrow(run, "u long, v long")


def _across(placed: DataFrame, marks: DataFrame, merged: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """(u, v): nodes of different components that share a key and may link."""
    placed = stored(placed.join(merged, "node", "left").withColumn("component", F.coalesce("component", "node")))
    mixed = (
        placed.groupBy("key", "tile")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("component").alias("low"), F.max("component").alias("high"), F.min("visits").alias("v"))
        .filter("low < high and not v")
        .select("key", "tile", F.ceil(F.col("rows") / block_rows).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = (
        placed.join(stored(mixed), ["key", "tile"])
        .withColumn("block", block)
        .select("key", "tile", "n", "node", "component", "visits", "block", others)
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .join(marks.withColumnRenamed("value", "mark"), "node")
        .repartition(shuffle_partitions(placed.sparkSession), "key", "tile", "i", "j")
        .sortWithinPartitions("key", "tile", "i", "j", "n", "node")
    )
    names = ["key", "tile", "i", "j", "n", "node", "component", "visits", "block", "mark"]

    def pairs(rows: dict[str, np.ndarray], marks: Marks) -> pa.RecordBatch:
        size = len(rows["key"])
        new = np.append(True, np.any([np.diff(rows[x]) != 0 for x in ("key", "tile", "i", "j")], axis=0))[:size]
        run_id = np.cumsum(new)
        u, v, step = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 1
        first = np.arange(size - 1)
        while len(first):
            first = first[first + step < size]
            # Sizes rise within a tile: once a row is too small for one, it is for all after it.
            a, b = first, first + step
            ok = (run_id[a] == run_id[b]) & (100 * rows["n"][a] >= percent * rows["n"][b])
            first = first[ok]
            a, b = first, first + step
            here = (rows["component"][a] != rows["component"][b]) & ~(rows["visits"][a] & rows["visits"][b])
            # Of the pairs of a block with itself and with others, each is looked at in one tile.
            low, high = np.minimum(rows["block"][a], rows["block"][b]), np.maximum(rows["block"][a], rows["block"][b])
            here &= (low == rows["i"][a]) & (high == rows["j"][a])
            a, b = a[here], b[here]
            keep = may_link(marks, a, b, rows["n"][a], rows["n"][b], percent)
            u.append(rows["node"][a[keep]])
            v.append(rows["node"][b[keep]])
            step += 1
        u, v = np.concatenate(u), np.concatenate(v)
        found = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1), axis=0)
        return pa.RecordBatch.from_pydict({"u": found[:, 0].copy(), "v": found[:, 1].copy()})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole tiles at a time; a tile has about 2 * BLOCK_ROWS rows at most."""
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            if len(held) < 4 * block_rows:
                continue
            rows = {x: held.column(x).to_numpy() for x in names[:4]}
            change = np.flatnonzero(np.any([np.diff(x) != 0 for x in rows.values()], axis=0))
            if not len(change):
                continue
            cut = int(change[-1]) + 1
            yield pairs(*_columns(held.slice(0, cut), names))
            held = held.slice(cut)
        if held is not None and len(held):
            yield pairs(*_columns(held, names))

    return tiles.select(*names).mapInArrow(run, "u long, v long").distinct()


def _columns(table: pa.Table, names: list[str]) -> tuple[dict[str, np.ndarray], Marks]:
    return {x: table.column(x).to_numpy() for x in names[:-1]}, Marks(table.column(names[-1]).to_pylist())


def groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    count_bits: int = COUNT_BITS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``.

    Words are runs of bytes other than ASCII white space, with A-Z in lower case. A text of
    fewer than ``shingle`` words is one shingle; a null text or one without words has none
    and links with nothing. ``component_id`` is the smallest id that links lead to, the
    document's own included. Shingles and sets are equal if their 64-bit hashes are. Ids are
    whole numbers; a row with a null id takes part, and names a component only by others.
    Repeated rows give repeated results. ``percent`` is at least PERCENT.
    """
    if percent < PERCENT:
        raise ValueError(f"size bands are made for {PERCENT} percent and more")
    slim = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    found = stored(_sets_and_counts(slim, shingle, count_bits))
    base = found.filter("n is not null").select("id", "n", "node")
    shared = _shared(_rarest(slim, _rarity(found, count_bits), shingle, percent), percent)
    placed = stored(_placed(shared))
    marks = stored(_of_nodes(slim, placed.select("node").distinct(), shingle, parity_bitmap, "binary"))
    stars = stored(_verified(_stars(placed, marks, percent), slim, shingle, percent))
    merged = stored(components(stars))
    more = _verified(_across(placed, marks, merged, percent, block_rows), slim, shingle, percent)
    joined = stored(components(stars.unionByName(more)))
    # A component is named by the smallest id of any row in it.
    nodes = base.filter("node is not null").groupBy("node").agg(F.min("id").alias("lowest"))
    named = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("lowest").alias("component_id"))
    names = named.join(least, "component").select("node", "component_id")
    return base.join(names, "node", "left").select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that ``groups`` put with a smaller id.

    Texts of documents that stay are not moved: a bitmap of the others tells most of them,
    and only what it cannot tell is joined. Rows that repeat the smallest id of a group all
    stay. So do rows without an id, copies of others included, as ``found`` can not name them.
    """
    goes = stored(found.filter(F.col(doc_id) > F.col("component_id")).select(doc_id).distinct())
    hashed = F.xxhash64(F.col(doc_id).cast("long"))
    known = bitmaps.bitmap(goes.select(hashed.alias("h")), NODE_BITS)
    stays, unsure = bitmaps.apart(docs, hashed, known)
    return stays.unionByName(unsure.join(goes, doc_id, "left_anti"))


