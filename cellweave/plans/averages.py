"""Averages that take a delivery: what a day adds to each cell is kept, and merged when asked for.

A state is a folder with two tables. ``cells`` has, in a folder per day, the sums and counts of
each cell on that day. ``days`` says what the files of each day were when it was summed up. A
new delivery is compared with that, so only days whose files are new or changed are read, and
only their folders are replaced. Means over any days are sums of sums, so they equal those of a
pass over all readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave import sinks
from cellweave.functions.geohash import DEFAULT_PRECISION, cell_id, cell_text
from cellweave.operators.weather import date_from_parts
from cellweave.schemas import DATE_PARTS, GEOHASH
from cellweave.session import exists, remove
from cellweave.sources import layouts

MEASURES = {"avg_tmpr_c": "avg_temp_c", "avg_tmpr_f": "avg_temp_f"}

_KEYS = T.StructType([T.StructField(part, T.IntegerType()) for part in DATE_PARTS])
_CELLS = T.StructType(
    [
        T.StructField("cell", T.LongType()),
        T.StructField("readings", T.LongType()),
        *(T.StructField(f"{kind}_{name}", kind_type) for name in MEASURES for kind, kind_type in (("sum", T.DoubleType()), ("n", T.LongType()))),
    ]
)
_DAYS = T.StructType([*_KEYS, *T.StructType().add("precision", T.IntegerType()).add("files", T.LongType()).add("content", T.LongType())])


def delivered(spark: SparkSession, weather: str) -> DataFrame:
    """(path, year, month, day, content) of the files in the dated folders; the content is told
    by path, size and time, without opening the file."""
    files = layouts.files_below(spark, weather)
    keys = {part: F.regexp_extract("path", rf"/{part}=(\d+)/", 1).try_cast("int") for part in DATE_PARTS}
    return files.select("path", F.xxhash64("path", "length", "modificationTime").alias("content")).withColumns(keys)


def day_sums(readings: DataFrame, precision: int = DEFAULT_PRECISION) -> DataFrame:
    """What readings add to each cell on each day; readings without a point form a null cell."""
    sums = []
    for name in MEASURES:
        value = F.col(name).cast("double")
        sums += [F.sum(value).alias(f"sum_{name}"), F.count(value).alias(f"n_{name}")]
    keyed = readings.withColumn("cell", cell_id("lat", "lng", precision))
    return keyed.groupBy("cell", *DATE_PARTS).agg(F.count(F.lit(1)).alias("readings"), *sums)


def days_of(spark: SparkSession, state: str) -> DataFrame:
    if not exists(spark, f"{state}/days"):
        return spark.createDataFrame([], _DAYS)
    return spark.read.schema(_DAYS).parquet(f"{state}/days")


def update(spark: SparkSession, weather: str, state: str, precision: int = DEFAULT_PRECISION) -> dict[str, int]:
    """Bring the state up to the weather there is now: days read, and days that are gone.

    Days whose files are as they were are not opened, not even their footers. A run that ends
    half way leaves the days it had not noted to be done again, with the same result. A state
    is made for one precision.
    """
    with sinks.scratch(spark):
        files = sinks.written(delivered(spark, weather))
        unknown = files.filter(" or ".join(f"{part} is null" for part in DATE_PARTS)).first()
        if unknown is not None:
            raise ValueError(f"{unknown.path} is not below year=, month= and day= folders")
        now = files.groupBy(*DATE_PARTS).agg(
            F.lit(precision).alias("precision"), F.count(F.lit(1)).alias("files"), F.bit_xor("content").alias("content")
        )
        before = sinks.written(days_of(spark, state))
        other = before.filter(F.col("precision") != precision).first()
        if other is not None:
            raise ValueError(f"{state} holds cells of precision {other.precision}, not {precision}")
        now = sinks.written(now)
        changed = sinks.written(now.join(before, now.columns, "left_anti").select(*DATE_PARTS))
        gone = before.join(now, list(DATE_PARTS), "left_anti").select(*DATE_PARTS)
        anew = files.join(changed, list(DATE_PARTS), "left_semi")
        readings = layouts.scan(spark, weather, sinks.written(layouts.with_layouts(anew)), _KEYS, part=True)
        count = changed.count()
        if count:
            # A day that has lost all its readings keeps a row that counts for nothing.
            blank = changed.withColumns({"readings": F.lit(0).cast("long")})
            rows = day_sums(readings, precision).unionByName(blank, allowMissingColumns=True)
            sinks.write_days(rows.select(*_CELLS.names, *DATE_PARTS), f"{state}/cells")
        lost = [f"year={r.year}/month={r.month}/day={r.day}" for r in gone.toLocalIterator()]
        for day in lost:
            remove(spark, f"{state}/cells/{day}")
        sinks.write_parquet(now, f"{state}/days")
    return {"days_read": count, "days_gone": len(lost)}


def _cells(spark: SparkSession, state: str) -> DataFrame:
    if not exists(spark, f"{state}/cells"):
        return spark.createDataFrame([], T.StructType([*_CELLS, *_KEYS]))
    return spark.read.schema(T.StructType([*_CELLS, *_KEYS])).parquet(f"{state}/cells").filter("readings > 0")


def precision_of(spark: SparkSession, state: str) -> int:
    row = days_of(spark, state).select("precision").first()
    return DEFAULT_PRECISION if row is None else row.precision


def _means(sums: DataFrame, precision: int, *keys: str) -> DataFrame:
    means = [
        (F.sum(f"sum_{name}") / F.nullif(F.sum(f"n_{name}"), F.lit(0))).alias(mean) for name, mean in MEASURES.items()
    ]
    grouped = sums.groupBy("cell", *keys).agg(*means)
    return grouped.select(cell_text("cell", precision).alias(GEOHASH), *keys, *MEASURES.values())


def by_cell(spark: SparkSession, state: str) -> DataFrame:
    """One row per cell over all days, as ``weather.by_cell`` gives it for all readings."""
    return _means(_cells(spark, state), precision_of(spark, state))


def by_cell_date(spark: SparkSession, state: str) -> DataFrame:
    """One row per cell and day, as ``weather.by_cell_date`` gives it; the date is text."""
    dated = _cells(spark, state).withColumn("w_date", date_from_parts())
    return _means(dated, precision_of(spark, state), "w_date")
