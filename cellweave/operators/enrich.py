"""Left join of restaurants with the weather of their cell.

Weather is averaged before the join, so a restaurant meets one row per cell (or per
cell and date). Three things keep the join even when data is uneven:

* per cell, a short geohash bounds the right side (``32**precision`` rows), so it is
  broadcast and restaurants are not shuffled at all;
* otherwise both sides are exchanged on the cell, in the plain sort-merge shape in
  which adaptive execution can split the rows of a hot cell over many tasks, or
  switch to a broadcast if the right side turns out to be small;
* restaurants without a cell get made-up keys that match nothing and differ by row,
  so they spread over all tasks rather than pile up under one null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.geohash import DEFAULT_PRECISION, cell_id, cell_of_text
from cellweave.operators import weather
from cellweave.schemas import GEOHASH

# 32**4 cells of about 100 bytes each.
BROADCAST_CELLS = 32**4
_KEY = "_cell_key"
_SPREAD = 2**20


def left_join_cells(restaurants: DataFrame, cells: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Keep every restaurant and add the columns of ``cells`` for its geohash.

    ``broadcast=True`` is for a right side whose size the caller has a bound for.
    ``None`` leaves the choice to adaptive execution, which measures the right side;
    ``False`` forces a sort-merge join.
    """
    added = [name for name in cells.columns if name != GEOHASH]
    kept = [name for name in restaurants.columns if name != GEOHASH]
    if broadcast:
        joined = restaurants.join(F.broadcast(cells), GEOHASH, "left")
    else:
        # A geohash holds no "-", so these keys cannot meet a cell.
        spread = F.concat(F.lit("none-"), F.pmod(F.xxhash64(*restaurants.columns), F.lit(_SPREAD)))
        left = restaurants.withColumn(_KEY, F.coalesce(F.col(GEOHASH), spread))
        right = cells.withColumnRenamed(GEOHASH, _KEY)
        if broadcast is False:
            right = right.hint("merge")
        joined = left.join(right, _KEY, "left")
    return joined.select(GEOHASH, *kept, *added)


def with_point(readings: DataFrame) -> DataFrame:
    """Readings that can meet a restaurant: the source skips all others."""
    return readings.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull())


def near_restaurants(
    readings: DataFrame, restaurants: DataFrame, precision: int = DEFAULT_PRECISION
) -> DataFrame:
    """Readings in a cell that has a restaurant; no others can reach the result.

    Most of a weather grid lies where no restaurant is. Those readings are dropped as
    they are scanned, so that neither the averages nor their shuffle grow with the grid.
    The occupied cells are broadcast as numbers, and only where the precision bounds
    them; for a longer geohash all readings are kept. Costs a pass over one column of
    ``restaurants``, so it is meant for a stored table.
    """
    if 32**precision > BROADCAST_CELLS:
        return readings
    # Numbers that no cell has stand for null, for the reason given in never_null.
    number = F.coalesce(cell_of_text(GEOHASH, precision), F.lit(-1))
    reading = F.coalesce(cell_id("lat", "lng", precision), F.lit(-2))
    # Distinct texts first, so that few are decoded; distinct numbers have the bound.
    occupied = restaurants.select(GEOHASH).distinct().select(number.alias(_KEY)).distinct()
    return (
        readings.withColumn(_KEY, reading)
        .join(F.broadcast(occupied), _KEY, "left_semi")
        .drop(_KEY)
    )


def never_null(cells: DataFrame) -> DataFrame:
    """State that no geohash is null (``with_point`` saw to that).

    A join would otherwise ask for ``geohash is not null``, which the planner carries
    down to the readings, so that the text would be built for every one of them.
    """
    return cells.withColumn(GEOHASH, F.coalesce(GEOHASH, F.lit("")))


def by_cell(
    restaurants: DataFrame,
    readings: DataFrame,
    precision: int = DEFAULT_PRECISION,
    broadcast: bool = True,
) -> DataFrame:
    """Every restaurant once, with the mean weather of its cell over all dates.

    ``restaurants`` carries a ``geohash`` of the same precision. The weather side is
    broadcast only where the precision itself keeps it under ``BROADCAST_CELLS``.
    """
    bounded = 32**precision <= BROADCAST_CELLS
    choice = False if not broadcast else (True if bounded else None)
    cells = never_null(weather.by_cell(with_point(readings), precision))
    return left_join_cells(restaurants, cells, choice)


def by_cell_date(
    restaurants: DataFrame,
    readings: DataFrame,
    precision: int = DEFAULT_PRECISION,
    date: str | Column = "w_date",
    date_name: str = "w_date",
    broadcast: bool = True,
) -> DataFrame:
    """Every restaurant once per date with weather in its cell, or once without.

    This multiplies restaurants by dates on purpose. The number of dates has no bound,
    so the weather side is never broadcast by hint; with ``broadcast`` allowed,
    adaptive execution does so if the averaged weather measures small.
    """
    cells = never_null(weather.by_cell_date(with_point(readings), precision, date, date_name))
    return left_join_cells(restaurants, cells, None if broadcast else False)
