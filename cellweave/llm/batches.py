"""Running a function over Arrow batches, and keeping what was computed once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from cellweave.llm.words import SLICE_BYTES, slices
from cellweave.session import shared_folder
from cellweave.sinks import to_be_removed

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def with_arrays(
    df: DataFrame,
    text: str,
    added: Mapping[str, T.DataType],
    compute: Callable[[pa.Array], Mapping[str, pa.Array]],
    drop: Sequence[str] = (),
    limit: int = SLICE_BYTES,
    keep: tuple[Column, Callable[[pa.Array], np.ndarray]] | None = None,
) -> DataFrame:
    """``df`` with columns that ``compute`` makes from a column of text.

    Columns of ``df`` that are named like a new one, in whatever case, are replaced. ``compute`` sees about
    ``limit`` bytes of text at a time, or one longer text. ``keep`` is an expression, and what
    tells from its values which rows there are to be; one pass through Python does both.
    """
    kept = [f for f in df.schema if f.name not in drop and not any(same_name(f.name, x) for x in added)]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, *(T.StructField(name, kind) for name, kind in added.items())])
    # The text goes in under a name of its own, so that a dropped or replaced one is still there.
    source, tested = fresh([*df.columns, *added], "text", "tested")

    tells = None if keep is None else keep[1]

    def left(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = tells(batch.column(tested))
            if wanted.any():
                yield batch.filter(pa.array(wanted))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches if tells is None else left(batches), source, limit):
            made = compute(part.column(source))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n) for n in names), *(made[n] for n in added)], names=[*names, *added]
            )

    given = [df[f"`{text}`"].alias(source)] + ([] if keep is None else [keep[0].alias(tested)])
    return df.select(*(f"`{n}`" for n in names), *given).mapInArrow(run, schema)


def stored(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """The same rows as a table in the shared folder: computed once, and not lost with an executor.
    Within ``sinks.scratch`` the table goes at its end.

    ``batch_rows`` bounds the rows that go to Python in one go while this runs. A batch lies in
    memory on both sides, and of whole texts the usual 10,000 are a lot.
    """
    path = to_be_removed(shared_folder(df.sparkSession))
    with _batches_of(df.sparkSession, batch_rows):
        df.write.option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _batches_of(spark: SparkSession, rows: int | None) -> Iterator[None]:
    before = spark.conf.get(BATCH_ROWS)
    if rows is not None:
        spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def same_name(a: str, b: str) -> bool:
    """Whether Spark takes two column names for one."""
    return a.lower() == b.lower()


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Names like those wanted that differ from all that are taken, in whatever case."""
    used = {name.lower() for name in taken}
    out = []
    for name in names:
        name = f"__{name}"
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
