"""Readers for restaurant, weather and result tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cellweave.functions.geohash import ALPHABET
from cellweave.schemas import DATE_PARTS, GEOHASH, PREFIX, RESTAURANT
from cellweave.sources import csv_types, layouts


def restaurants_csv(
    spark: SparkSession,
    path: str,
    schema: StructType = RESTAURANT,
    check_header: bool = False,
    bad_line: str | None = None,
) -> DataFrame:
    """CSV with a header line under a fixed layout; a bad value becomes null.

    Fields bind by position and the header is skipped. ``check_header`` makes Spark
    compare the header with the layout and fail on a mismatch. ``bad_line`` names a column
    for the text of lines that do not fit the layout, in a value or in the number of fields;
    for all others it is null.
    """
    options = {}
    if bad_line is not None:
        schema = StructType([*schema, StructField(bad_line, StringType())])
        options["columnNameOfCorruptRecord"] = bad_line
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=not check_header, **options)


def csv_inferred(spark: SparkSession, path: str, types: str | None = None) -> DataFrame:
    """CSV with a header line; column types are found by an extra pass over the data. With
    ``types``, a folder where they are kept, only over files that are new, see ``csv_types``."""
    if types is not None:
        return spark.read.csv(path, header=True, schema=csv_types.schema(spark, path, types))
    return spark.read.csv(path, header=True, inferSchema=True)


def weather_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, types: str | None = None
) -> DataFrame:
    """Weather CSV. Give the schema (in file order) for large data to save a pass."""
    if schema is None:
        return csv_inferred(spark, path, types)
    return spark.read.csv(path, header=True, schema=schema)


def parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet as stored, or under a given schema (by name; an absent column is null)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def weather_parquet(
    spark: SparkSession,
    path: str,
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
) -> DataFrame:
    """Weather below ``year=/month=/day=`` folders, which become columns.

    Files may differ in columns and types, as deliveries do, see ``layouts``. The optional
    days (inclusive) are compared on the folder columns alone, so nothing but the footers of
    other folders is ever opened.
    """
    readings = layouts.read(spark, path)
    year, month, day = (F.col(part) for part in DATE_PARTS)
    number = year * 10000 + month * 100 + day
    if first_day is not None:
        readings = readings.filter(number >= int(first_day.strftime("%Y%m%d")))
    if last_day is not None:
        readings = readings.filter(number <= int(last_day.strftime("%Y%m%d")))
    return readings


def by_geohash(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table written in ``geohash=`` folders, with the geohash kept as text.

    Guessing the folder type would turn cells such as ``0123`` or ``12e4`` into
    numbers, so the text type is stated. Without ``schema`` (the columns inside the
    files) it is that of all files together, as folders may be replaced one by one.
    """
    if schema is None:
        files = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
        schema = files.parquet(path).schema
    fields = [f for f in schema.fields if f.name != GEOHASH]
    return spark.read.schema(StructType([*fields, StructField(GEOHASH, StringType())])).parquet(path)


def _within(column: str, cell: str) -> Column:
    """Texts that begin with the cell, as a range that statistics can be held against."""
    # No letter of a geohash comes after "~".
    return (F.col(column) >= cell) & (F.col(column) < cell + "~")


def by_prefix(
    spark: SparkSession, path: str, cells: Sequence[str] | None = None, schema: StructType | None = None
) -> DataFrame:
    """A table written in prefix folders; with ``cells``, the rows in any of these.

    A cell of fewer letters than the geohashes stands for all cells in it. Its letters choose
    folders, and a range of geohashes within their files, so neither other folders nor other
    row groups are read. ``schema`` names the columns inside the files; without it the files
    may differ, see ``layouts``.
    """
    keys = StructType([StructField(PREFIX, StringType())])
    if schema is None:
        rows = layouts.read(spark, path, keys)
    else:
        rows = spark.read.schema(StructType([*(f for f in schema if f.name != PREFIX), *keys])).parquet(path)
    if cells is not None:
        for cell in cells:
            if not cell or not set(cell) <= set(ALPHABET):
                raise ValueError(f"{cell!r} is no geohash")
        if not cells:
            return rows.filter("false").drop(PREFIX)
        # A folder can hold such cells if either of the two texts begins with the other.
        folders = [
            reduce(or_, [_within(PREFIX, cell)] + [F.col(PREFIX) == cell[:n] for n in range(1, len(cell))]) for cell in cells
        ]
        rows = rows.filter(reduce(or_, folders)).filter(reduce(or_, (_within(GEOHASH, cell) for cell in cells)))
    return rows.drop(PREFIX)
