"""Mean temperatures per geohash cell.

Readings are grouped by the cell *number* and the text is made once per group, so
no text is built, hashed or shuffled per reading. A hot cell costs nothing extra:
each task folds its own readings to one row per cell before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.geohash import DEFAULT_PRECISION, cell_id, cell_text
from cellweave.schemas import DATE_PARTS, GEOHASH

_CELL = "_cell"


def _means() -> list[Column]:
    return [F.avg("avg_tmpr_c").alias("avg_temp_c"), F.avg("avg_tmpr_f").alias("avg_temp_f")]


def by_cell(readings: DataFrame, precision: int = DEFAULT_PRECISION) -> DataFrame:
    """One row per cell over all dates; readings without a point form a null cell."""
    return (
        readings.groupBy(cell_id("lat", "lng", precision).alias(_CELL))
        .agg(*_means())
        .select(cell_text(_CELL, precision).alias(GEOHASH), "avg_temp_c", "avg_temp_f")
    )


def by_cell_date(
    readings: DataFrame,
    precision: int = DEFAULT_PRECISION,
    date: str | Column = "w_date",
    date_name: str = "w_date",
) -> DataFrame:
    """One row per cell and date. ``date`` may be any column or expression."""
    day = F.col(date) if isinstance(date, str) else date
    return (
        readings.groupBy(cell_id("lat", "lng", precision).alias(_CELL), day.alias(date_name))
        .agg(*_means())
        .select(cell_text(_CELL, precision).alias(GEOHASH), date_name, "avg_temp_c", "avg_temp_f")
    )


def date_from_parts() -> Column:
    """``yyyy-MM-dd`` text from the ``year``, ``month`` and ``day`` columns; null where they
    are no date."""
    text = F.format_string("%04d-%02d-%02d", *(F.col(part).cast("int") for part in DATE_PARTS))
    return text.try_cast("date").cast("string")


def mean_per_cell(readings: DataFrame, column: str, cell: str = GEOHASH) -> DataFrame:
    """Mean of one column per cell, named by Spark itself: ``avg(<column>)``."""
    return readings.groupBy(cell).agg({column: "avg"})
