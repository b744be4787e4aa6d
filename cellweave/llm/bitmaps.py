"""Sets of 64-bit hashes as bitmaps of a fixed size, made by Spark and sent to all tasks.

A bitmap says "maybe" or "surely not". Its size is fixed by the caller, so what is
broadcast does not grow with the data; a set that is large for it only lets more through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.batches import fresh, shuffle_partitions
from cellweave.llm.words import U64

CHUNK_BITS = 18


def position(column: Column, bits: int) -> Column:
    return F.shiftrightunsigned(column, 64 - bits)


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> U64(64 - bits)


def has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes may be in the set."""
    bits = (len(bitmap) * 8).bit_length() - 1
    at = positions(hashes, bits)
    return (bitmap[at >> U64(3)] >> (at & U64(7)).astype(np.uint8)) & 1 != 0


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the one column of 64-bit hashes, of 2 ** ``bits`` bits. Nulls are left out.

    Tasks first drop positions they have already, then each builds some chunks of the
    bitmap; at most 2 ** (bits - 3) bytes come to the driver in all.
    """
    spark, (name,) = hashes.sparkSession, hashes.columns
    bits = max(bits, CHUNK_BITS)

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column("at").to_numpy()
            for chunk in np.unique(at >> CHUNK_BITS).tolist():
                own = chunks.setdefault(chunk, np.zeros(1 << (CHUNK_BITS - 3), np.uint8))
                low = at[at >> CHUNK_BITS == chunk] & ((1 << CHUNK_BITS) - 1)
                np.bitwise_or.at(own, low >> 3, (1 << (low & 7)).astype(np.uint8))
        for chunk, own in chunks.items():
            yield pa.RecordBatch.from_pydict({"chunk": [chunk], "bits": [own.tobytes()]})

    made = (
        hashes.filter(F.col(name).isNotNull())
        .select(position(F.col(name), bits).alias("at"))
        .distinct()
        .repartition(shuffle_partitions(spark), F.shiftright("at", CHUNK_BITS))
        .mapInArrow(build, "chunk long, bits binary")
    )
    out = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (CHUNK_BITS - 3)
    for row in made.collect():
        out[row.chunk * size : (row.chunk + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return out


def apart(df: DataFrame, hashed: Column, known: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """Rows whose hash is surely not in the bitmap, and rows for which it may be."""
    return tuple(_only(df, *within(df, hashed, known, wanted)) for wanted in (False, True))


def within(df: DataFrame, hashed: Column, known: np.ndarray, wanted: bool) -> tuple[Column, Callable[[pa.Array], np.ndarray]]:
    """The hash, and which of its values may be in the bitmap, or surely are not."""
    sent = df.sparkSession.sparkContext.broadcast(known)
    return hashed, lambda column: has(sent.value, column.to_numpy().view(U64)) == wanted


def _only(df: DataFrame, hashed: Column, keep: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    (name,) = fresh(df.columns, "hash")
    keyed = df.withColumn(name, hashed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = keep(batch.column(name))
            if wanted.any():
                yield batch.filter(pa.array(wanted))

    return keyed.mapInArrow(run, keyed.schema).drop(name)
