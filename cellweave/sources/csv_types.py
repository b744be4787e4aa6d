"""Types of CSV columns, kept per file, so that only new files are read for them.

What a value looks like is one of a few kinds, and a file's state has, for each column, the set
of kinds seen in it, as bits. Sets are joined by "or" in any order, so the types of any files
together come from their states alone. They are those that Spark infers from all the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave import sinks
from cellweave.session import exists

INT, LONG, WIDE, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(8))

_STATE = "path string, size long, modified timestamp, columns array<string>, kinds array<int>, digits array<int>"


def kind(value: Column) -> Column:
    """What a text looks like: one of the bits, or 0 for none."""
    whole = value.rlike(r"^[+-]?[0-9]+$")
    day = value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull()
    time = value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ]") & value.try_cast("timestamp").isNotNull()
    return (
        F.when(value.isNull(), 0)
        .when(whole & value.try_cast("int").isNotNull(), INT)
        .when(whole & value.try_cast("long").isNotNull(), LONG)
        .when(whole, WIDE)
        .when(value.try_cast("double").isNotNull(), DOUBLE)
        .when(day, DATE)
        .when(time, TIMESTAMP)
        .when(F.lower(value).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def kind_type(kinds: int, digits: int) -> T.DataType:
    """The type for a set of kinds; ``digits`` is the length of the longest whole number too
    wide for 64 bits. Kinds that do not go together are text, and so is a column without values."""
    if kinds == INT:
        return T.IntegerType()
    if kinds and not kinds & ~(INT | LONG):
        return T.LongType()
    if kinds and not kinds & ~(INT | LONG | WIDE):
        digits = max(digits, 20 if kinds & LONG else 10 if kinds & INT else 0)
        return T.DecimalType(digits, 0) if digits <= 38 else T.DoubleType()
    if kinds and not kinds & ~(INT | LONG | WIDE | DOUBLE):
        return T.DoubleType()
    if kinds == DATE:
        return T.DateType()
    if kinds and not kinds & ~(DATE | TIMESTAMP):
        return T.TimestampType()
    return T.BooleanType() if kinds == BOOLEAN else T.StringType()


def _files(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.format("binaryFile").load(path)
    return found.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _seen(spark: SparkSession, paths: str | list[str], columns: list[str]) -> DataFrame:
    """(path, kinds, digits) of files, from one pass over them; a row per file comes out of each task."""
    text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))])
    rows = spark.read.csv(paths, header=True, schema=text, enforceSchema=True)
    kinds = [F.bit_or(kind(F.col(name))).alias(f"k_{name}") for name in text.names]
    wide = [
        F.max(F.when(kind(F.col(name)) == WIDE, F.length(F.regexp_replace(name, "^[+-]?0*", ""))).otherwise(0)).alias(f"d_{name}")
        for name in text.names
    ]
    grouped = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(*kinds, *wide)
    return grouped.select(
        "path",
        F.array(*(F.col(f"k_{n}") for n in text.names)).alias("kinds"),
        F.array(*(F.col(f"d_{n}") for n in text.names)).alias("digits"),
    )


def state_of(spark: SparkSession, state: str) -> DataFrame:
    if not exists(spark, state):
        return spark.createDataFrame([], _STATE)
    return spark.read.schema(_STATE).parquet(state)


def schema(spark: SparkSession, path: str, state: str) -> T.StructType:
    """Names and types of the columns of all CSV files at ``path``, with the state brought up to
    date: files it does not have, or not as they are, are read, and those gone are forgotten.

    The state is a small table with a row per file. A name that begins with ``_`` may lie in
    the folder of the files, as readers pass over it. Files must have the same header.
    """
    with sinks.scratch(spark):
        files = sinks.written(_files(spark, path))
        known = files.join(state_of(spark, state), ["path", "size", "modified"], "left_semi")
        known = sinks.written(state_of(spark, state).join(known, ["path", "size", "modified"], "left_semi"))
        new = [row.path for row in files.join(known, "path", "left_anti").select("path").sort("path").collect()]
        if new:
            every = known.isEmpty()
            columns = {tuple(spark.read.csv(new[0], header=True).columns), *(tuple(r.columns) for r in known.select("columns").distinct().collect())}
            if len(columns) > 1:
                raise ValueError(f"{new[0]} has other columns than the files before it")
            names = list(columns.pop())
            nothing = F.array(*(F.lit(0) for _ in names))
            seen = _seen(spark, path if every else new, names)
            added = files.join(seen, "path", "left").join(known, "path", "left_anti").select(
                "path", "size", "modified", F.array(*map(F.lit, names)).alias("columns"),
                F.coalesce("kinds", nothing).alias("kinds"), F.coalesce("digits", nothing).alias("digits"),
            )
            known = sinks.written(known.unionByName(added))
        if new or state_of(spark, state).count() != known.count():
            sinks.write_parquet(known, state)
        merged = (
            known.select("columns", F.posexplode("kinds").alias("at", "kinds"), "digits")
            .groupBy("at")
            .agg(F.any_value(F.get("columns", F.col("at"))).alias("name"), F.bit_or("kinds").alias("kinds"), F.max(F.get("digits", F.col("at"))).alias("digits"))
            .sort("at")
            .collect()
        )
    return T.StructType([T.StructField(row.name, kind_type(row.kinds, row.digits)) for row in merged])
