"""Parquet folders whose files differ in columns and types.

The files are grouped by the layout their footers state. A table over them has the columns of
all layouts, each in the least type that holds all its types. Spark scans each layout under
its own types, so filters and column choices reach every file, and the scans are widened and
put one under the other. A layout is read from the topmost folders in which it is alone, so
that few paths are named even where files are many.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.sinks import scratch, written

LAYOUT = "path string, layout binary"

_WHOLE: list[type[T.DataType]] = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_FRACTION: list[type[T.DataType]] = [T.FloatType, T.DoubleType]
#: Digits a whole number of each type can have.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_DATES = (T.DateType, T.TimestampNTZType, T.TimestampType)


class NothingInCommon(ValueError):
    """Two types that no type holds both of."""


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds both: whole numbers before fractions, days before times.

    Order and grouping do not matter, so layouts may be taken together in any way. A whole
    number of more than 53 bits loses its last digits among fractions, as in any engine.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if kinds <= {*_WHOLE, *_FRACTION}:
        return T.DoubleType()
    if T.DecimalType in kinds and kinds <= {T.DecimalType, *_WHOLE, *_FRACTION}:
        if kinds & set(_FRACTION):
            return T.DoubleType()
        precision, scale = zip(*((t.precision, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)))
        whole = max(p - s for p, s in zip(precision, scale))
        return T.DecimalType(whole + max(scale), max(scale)) if whole + max(scale) <= 38 else T.DoubleType()
    if kinds <= set(_DATES):
        return max(a, b, key=lambda t: _DATES.index(type(t)))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widest(a.keyType, b.keyType), widest(a.valueType, b.valueType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return together(a, b)
    raise NothingInCommon(f"{a.simpleString()} and {b.simpleString()}")


def together(a: T.StructType, b: T.StructType) -> T.StructType:
    """The columns of both, told apart without case, in the order they first come."""
    columns = {f.name.lower(): (f.name, f.dataType) for f in a}
    for field in b:
        name, kind = columns.get(field.name.lower(), (field.name, field.dataType))
        try:
            columns[field.name.lower()] = name, widest(kind, field.dataType)
        except NothingInCommon as error:
            raise NothingInCommon(f"{name}: {error}") from None
    return T.StructType([T.StructField(name, kind) for name, kind in columns.values()])


def _by_name(kind: T.StructType) -> dict[str, T.StructField]:
    return {f.name.lower(): f for f in kind}


def widened(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """A value of one type as another that holds it; fields that are missing become null."""
    if old == new:
        return value
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        own = _by_name(old)
        fields = [
            widened(value[own[f.name.lower()].name], own[f.name.lower()].dataType, f.dataType).alias(f.name)
            if f.name.lower() in own
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in new
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return F.transform(value, lambda x: widened(x, old.elementType, new.elementType))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        keys = F.transform(F.map_keys(value), lambda x: widened(x, old.keyType, new.keyType))
        return F.map_from_arrays(keys, F.transform(F.map_values(value), lambda x: widened(x, old.valueType, new.valueType)))
    return value.cast(new)


def fitted(value: Column, old: T.DataType, new: T.DataType, name: str) -> Column:
    """A value as the type asked for. One that does not fit is an error, also where only a
    fraction would be lost."""
    try:
        fits = widest(old, new) == new
    except NothingInCommon:
        fits = False
    if fits:
        return widened(value, old, new)
    if isinstance(new, tuple(_WHOLE)) and isinstance(old, (*_FRACTION, T.DecimalType)):
        whole = value.isNull() | (value == F.floor(value))
        message = F.concat(F.lit(f"{name} is to be {new.simpleString()}, but holds "), value.cast("string"))
        return F.when(whole, value.cast(new)).otherwise(F.raise_error(message).cast(new))
    return value.cast(new)


# Task code imports what it needs, so that executors can run it without this package.
def footers() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From paths as Spark lists them: each with the columns and types in its footer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re
        from urllib.parse import quote

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            paths = batch.column("path").to_pylist()
            layouts = []
            for listed in paths:
                store, path = fs.FileSystem.from_uri(quote(re.sub(r"^s3[an]:", "s3:", listed), safe="/:@"))
                with store.open_input_file(path) as file:
                    columns = pq.ParquetFile(file).schema_arrow
                layouts.append(pa.schema([f.remove_metadata() for f in columns]).serialize().to_pybytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(layouts, pa.binary())], names=["path", "layout"]
            )

    return run


def files_below(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modificationTime) of the files below a folder; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    # The scan would make a task of each 128 MB of files.
    return files.select("path", "length", "modificationTime").coalesce(4 * spark.sparkContext.defaultParallelism)


def with_layouts(files: DataFrame) -> DataFrame:
    """(path, layout) of files given by their paths. Only footers are read, by the tasks."""
    return files.select("path").mapInArrow(footers(), LAYOUT)


def listed(spark: SparkSession, root: str) -> DataFrame:
    return with_layouts(files_below(spark, root))


def places(files: DataFrame, part: bool = False) -> dict[int, list[str]]:
    """For each group in ``files`` (path, kind) the topmost folders or files it has to itself.

    A folder counts if it is the one of a file, or above folders named ``key=value`` only. Of
    ``files`` that are a ``part`` of what there is, in whole folders, only these folders count.
    ``files`` is looked at twice. A row per such a place comes to the driver.
    """
    # How many folders above a file are named key=value, from the file upwards.
    names = F.reverse(F.split("path", "/"))
    keyed = F.size(F.filter(names, lambda x, i: (i > 0) & F.forall(F.slice(names, F.lit(2), i), lambda y: y.contains("="))))

    def above(steps: Column) -> Column:
        return F.array_join(F.slice("names", F.lit(1), F.size("names") - steps), "/")

    folders = (
        files.select("kind", F.split("path", "/").alias("names"), (F.lit(0) if part else keyed).alias("keyed"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("keyed") + 1)).alias("up"))
        .select(
            "kind",
            above(F.col("up")).alias("place"),
            above(F.col("up") + 1).alias("above"),
            (F.col("up") == F.col("keyed") + 1).alias("top"),
        )
        .groupBy("place", "above", "top")
        .agg(F.min("kind").alias("kind"), (F.min("kind") == F.max("kind")).alias("alone"))
    )
    alone = folders.filter("alone")
    shared = folders.filter("not alone").select(F.col("place").alias("above"))
    topmost = alone.filter("top").select("kind", "place").unionByName(
        alone.filter("not top").join(shared, "above", "left_semi").select("kind", "place")
    )
    found: dict[int, list[str]] = {}
    for row in topmost.sort("place").collect():
        found.setdefault(row.kind, []).append(row.place)
    return found


def _compatible(a: T.StructType, b: T.StructType) -> bool:
    """Whether the columns that both have are of the same types."""
    own = _by_name(a)
    return all(own[f.name.lower()].dataType == f.dataType for f in b if f.name.lower() in own)


def scan(
    spark: SparkSession,
    base: str,
    files: DataFrame,
    keys: T.StructType,
    wanted: T.StructType | None = None,
    part: bool = False,
) -> DataFrame:
    """The rows of ``files`` (path, layout) below ``base``, with the folder keys ``keys``.
    These are all files there, or a ``part`` of them, in whole folders.

    Without ``wanted`` the columns are those of all layouts, in the order of the first file
    that has each; types with nothing in common are an error that names a file. With it they
    are the ones wanted, and a value that does not fit is an error.

    Layouts that differ in which columns they have, but not in types, are one scan.
    """
    taken = _by_name(keys)
    files = files.select("path", F.xxhash64("layout").alias("layout"))
    firsts = sorted((row.path, row.layout) for row in files.groupBy("layout").agg(F.min("path").alias("path")).collect())
    kinds: list[T.StructType] = []
    kind_of: dict[int, int] = {}
    columns = T.StructType()
    for path, layout in firsts:
        own = T.StructType([f for f in spark.read.parquet(path).schema if f.name.lower() not in taken])
        if wanted is None:
            try:
                columns = together(columns, own)
            except NothingInCommon as error:
                raise NothingInCommon(f"{path}: {error}") from None
        at = next((i for i, kind in enumerate(kinds) if _compatible(kind, own)), len(kinds))
        kinds[at : at + 1] = [together(kinds[at], own) if at < len(kinds) else own]
        kind_of[layout] = at
    if wanted is not None:
        columns = T.StructType([f for f in wanted if f.name.lower() not in taken])
    if not kinds:
        return spark.createDataFrame([], T.StructType([*columns, *keys]))
    paths: dict[int, list[str]] = {}
    whole = len(kinds) == 1 and not part
    if not whole:
        listing = spark.createDataFrame(list(kind_of.items()), "layout long, kind int")
        paths = places(files.join(F.broadcast(listing), "layout").select("path", "kind"), part)
    scans = []
    for i, kind in enumerate(kinds):
        reader = spark.read.schema(T.StructType([*kind, *keys]))
        rows = reader.parquet(base) if whole else reader.option("basePath", base).parquet(*paths[i])
        own = _by_name(kind)
        scans.append(
            rows.select(
                *(
                    fitted(F.col(f"`{own[f.name.lower()].name}`"), own[f.name.lower()].dataType, f.dataType, f.name).alias(f.name)
                    if f.name.lower() in own
                    else F.lit(None).cast(f.dataType).alias(f.name)
                    for f in columns
                ),
                *keys.names,
            )
        )
    return reduce(DataFrame.unionByName, scans)


def read(spark: SparkSession, root: str, keys: T.StructType | None = None) -> DataFrame:
    """A folder of Parquet files, in ``key=value`` folders or not, however they differ. The
    types of the keys are guessed from the folders' names unless ``keys`` states them."""
    if keys is None:
        keys = spark.read.schema(T.StructType()).parquet(root).schema
    with scratch(spark):
        return scan(spark, root, written(listed(spark, root)), keys)
