"""Writers. All replace what is at the target and return the number of rows written.

A table is written to a draft beside its target and takes its place when it is whole. A write
that fails leaves the target as it was, and a table may be written over one it is made from.
Rows are counted by the writing tasks as they pass, so no second read is needed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from cellweave.schemas import DATE_PARTS, GEOHASH, PREFIX
from cellweave.session import beside, exists, move, remove, shared_folder, siblings

_scratch: list[list[str]] = []

#: Names beside a target; readers pass over what begins with "_".
_DRAFT, _OLD = "_cellweave-draft-", "_cellweave-old-"


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def recover(spark: SparkSession, path: str) -> bool:
    """Put a table back that was moved aside for a new one, if the new one never came; whether
    there was one. Tables that a new one has replaced, and were only not deleted, go."""
    # What follows the prefix is 32 digits and then the whole name.
    left = [x for x in siblings(spark, path, _OLD) if _name(x)[len(_OLD) + 32 :] == f"-{_name(path)}"]
    back = bool(left) and not exists(spark, path)
    if back:
        move(spark, left.pop(), path)
    for old in left:
        remove(spark, old)
    return back


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """Gives a draft to write to. Once that is done without an error, it replaces ``path``.

    The old table is moved aside, the draft moved in, the old table deleted. Where folders are
    renamed at once, as in HDFS, readers see the one or the other, or for a moment none; in a
    store that copies they may see part of the new one. A process that ends between the two
    moves leaves the old table aside, and the next write to this target, or ``recover``, puts
    it back. Two writers at a time are not kept apart.
    """
    recover(spark, path)
    own = f"{uuid.uuid4().hex}-{_name(path)}"
    draft, old = beside(spark, path, _DRAFT + own), beside(spark, path, _OLD + own)
    try:
        yield draft
        if exists(spark, path):
            move(spark, path, old)
        try:
            move(spark, draft, path)
        except BaseException:
            recover(spark, path)
            raise
    except BaseException:
        remove(spark, draft)
        raise
    remove(spark, old)


def _counted(df: DataFrame, codec: str) -> tuple[DataFrameWriter, Observation]:
    counted = Observation()
    df = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    return df.write.option("compression", codec), counted


def write_parquet(df: DataFrame, path: str, codec: str = "gzip") -> int:
    with replacing(df.sparkSession, path) as draft:
        writer, counted = _counted(df, codec)
        writer.parquet(draft)
    return counted.get["rows"]


def to_be_removed(path: str) -> str:
    """A folder that goes at the end of ``scratch``, if inside one."""
    if _scratch:
        _scratch[-1].append(path)
    return path


def written(df: DataFrame) -> DataFrame:
    """The same rows as a table in the shared folder.

    What was computed once is then neither repeated for a second use nor lost with an
    executor. Within ``scratch`` the table goes at its end.
    """
    path = to_be_removed(shared_folder(df.sparkSession))
    df.write.option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that ``written`` makes inside, once what needs them is done."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove(spark, path)


def write_by_geohash(
    df: DataFrame,
    path: str,
    codec: str = "gzip",
    max_records_per_file: int | None = None,
    only_these_cells: bool = False,
) -> int:
    """One folder per cell, few files in each.

    ``rebalance`` brings the rows of a cell together, so tasks do not each leave a file
    in every folder, and at run time splits a partition that turns out large (a hot
    cell, or all rows without a cell) over several tasks.

    ``only_these_cells`` replaces just the folders that ``df`` has rows for.
    """
    writer, counted = _counted(df.hint("rebalance", GEOHASH), codec)
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer = writer.partitionBy(GEOHASH)
    if only_these_cells:
        # Spark itself writes these folders aside and moves them in at the end.
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    else:
        with replacing(df.sparkSession, path) as draft:
            writer.parquet(draft)
    return counted.get["rows"]


#: Rows of one cell are dealt over so many ranges at most.
_SPREAD = 1024


def write_by_prefix(df: DataFrame, path: str, letters: int = 2, codec: str = "gzip", partitions: int | None = None) -> int:
    """One folder per geohash prefix of so many letters, at most ``32**letters`` and one for rows
    without a cell, however many cells there are.

    Rows are dealt out by ranges of cells, each task writing one range in order, so a file holds
    neighbouring cells and its row groups can be skipped by their smallest and largest. Ranges
    are cut where a sample says that they are even, within a very common cell too. There are
    about as many files as tasks and folders together.
    """
    if not 1 <= letters <= 4:
        raise ValueError("a prefix has one to four letters")
    if PREFIX in df.columns:
        raise ValueError(f"{PREFIX} names the folders and can not be a column")
    spread = "_spread"
    keyed = df.withColumns(
        {PREFIX: F.substring(GEOHASH, 1, letters), spread: F.pmod(F.xxhash64(*df.columns), F.lit(_SPREAD))}
    )
    order = (PREFIX, GEOHASH, spread)
    dealt = keyed.repartitionByRange(*order) if partitions is None else keyed.repartitionByRange(partitions, *order)
    writer, counted = _counted(dealt.sortWithinPartitions(PREFIX, GEOHASH).drop(spread), codec)
    with replacing(df.sparkSession, path) as draft:
        writer.partitionBy(PREFIX).parquet(draft)
    return counted.get["rows"]


def write_by_date(df: DataFrame, path: str, codec: str = "gzip", gather: bool = True) -> int:
    """One folder per ``year=/month=/day=``.

    ``gather`` brings the rows of a day together first (large days are split again at
    run time). Rows that already come a day at a time, as from archives, need no shuffle.
    """
    writer, counted = _counted(df.hint("rebalance", *DATE_PARTS) if gather else df, codec)
    with replacing(df.sparkSession, path) as draft:
        writer.partitionBy(*DATE_PARTS).parquet(draft)
    return counted.get["rows"]


def write_days(df: DataFrame, path: str, codec: str = "gzip") -> int:
    """Replace the folders of just those days that ``df`` has rows for."""
    writer, counted = _counted(df.hint("rebalance", *DATE_PARTS), codec)
    # Spark writes these folders aside and moves them in at the end.
    writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*DATE_PARTS).parquet(path)
    return counted.get["rows"]
