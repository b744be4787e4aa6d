"""Fill in missing coordinates from a gazetteer table.

A lookup is a left join, done in the first of these ways that the sizes allow:

* a gazetteer that measures small is broadcast: rows are read once and never shuffled;
* beyond that, the rows that ask are written down once. A gazetteer cut down to the places
  they ask for is broadcast to them if it measures small;
* otherwise it is exchanged together with these rows. The join key is then a struct built
  after the gazetteer was made unique: the planner exchanges both sides anew, and adaptive
  execution can split the rows that ask for one very common place.

Sizes are measured on the gazetteer as given, so one that is itself computed should be
written down first (``sinks.written``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.geocoding import query_text, reply_point
from cellweave.operators.filters import lacks_coords
from cellweave.operators.sizing import BROADCAST_BYTES, fits_broadcast
from cellweave.schemas import PLACE_KEYS, TEXT_KEYS
from cellweave.sinks import written

FOUND_LAT, FOUND_LNG = "found_lat", "found_lng"
_KEY = "_place"


def key_values(keys: Sequence[str]) -> dict[str, Column]:
    """What a restaurant asks for under each key of a gazetteer."""
    if tuple(keys) == TEXT_KEYS:
        return {TEXT_KEYS[0]: query_text()}
    return {name: F.col(name) for name in keys}


def unique_places(gazetteer: DataFrame, keys: Sequence[str] = PLACE_KEYS) -> DataFrame:
    """One row per key: the smallest point among those with both coordinates."""
    return (
        gazetteer.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull())
        # Two steps with plain numbers rather than one with a struct, which would sort.
        .groupBy(*keys, "lat")
        .agg(F.min("lng").alias("lng"))
        .groupBy(*keys)
        .agg(F.min("lat").alias("_lat"), F.min_by("lng", "lat").alias("_lng"))
        .select(*keys, F.col("_lat").alias("lat"), F.col("_lng").alias("lng"))
    )


def lookup(
    rows: DataFrame,
    gazetteer: DataFrame,
    keys: Sequence[str] = PLACE_KEYS,
    asks: Column | None = None,
    broadcast: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All rows plus ``found_lat`` and ``found_lng``, null where nothing was found.

    ``asks`` says which rows are looked up (by default, those lacking a coordinate).
    A null in any key column finds nothing.
    """
    values = key_values(keys)
    wanted = lacks_coords() if asks is None else asks
    for value in values.values():
        wanted = wanted & value.isNotNull()
    key = F.struct(*(value.alias(name) for name, value in values.items()))

    places = gazetteer.select(*keys, "lat", "lng")
    answers = unique_places(places, keys)
    found = [F.struct(*keys).alias(_KEY), F.col("lat").alias(FOUND_LAT), F.col("lng").alias(FOUND_LNG)]
    if broadcast and fits_broadcast(places, broadcast_bytes):
        keyed = rows.withColumn(_KEY, F.when(wanted, key))
        return keyed.join(F.broadcast(answers.select(*found)), _KEY, "left").drop(_KEY)

    nothing = F.lit(None).cast("double")
    others = rows.filter(~F.coalesce(wanted, F.lit(False))).withColumns({FOUND_LAT: nothing, FOUND_LNG: nothing})
    asking = rows.filter(wanted).withColumn(_KEY, key)
    hinted = answers.select(*found).hint("merge")
    if broadcast:
        asking = written(asking)
        cut = written(answers.join(asking.select(f"{_KEY}.*").distinct(), list(keys), "left_semi"))
        small = fits_broadcast(cut, broadcast_bytes)
        hinted = F.broadcast(cut.select(*found)) if small else cut.select(*found).hint("merge")
    return others.unionByName(asking.join(hinted, _KEY, "left").drop(_KEY))


def replace_incomplete(
    rows: DataFrame,
    gazetteer: DataFrame,
    keys: Sequence[str] = PLACE_KEYS,
    broadcast: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """A row lacking either coordinate takes both from the gazetteer.

    If nothing is found both become null, so a coordinate known before is lost. Only
    a null city or country stops the lookup; empty text is looked up like any other.
    """
    asks = lacks_coords() & F.col("city").isNotNull() & F.col("country").isNotNull()
    broken = lacks_coords()
    return (
        lookup(rows, gazetteer, keys, asks, broadcast, broadcast_bytes)
        .withColumns(
            {
                "lat": F.when(broken, F.col(FOUND_LAT)).otherwise(F.col("lat")),
                "lng": F.when(broken, F.col(FOUND_LNG)).otherwise(F.col("lng")),
            }
        )
        .select(*rows.columns)
    )


def fill_gaps(
    rows: DataFrame,
    gazetteer: DataFrame,
    keys: Sequence[str] = PLACE_KEYS,
    broadcast: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """A row without a latitude takes that, and a missing longitude, from the gazetteer.

    Known values stay. A row that lacks only its longitude is not looked up, and
    neither is one whose city or country is null or empty.
    """
    asks = F.col("lat").isNull() & (F.col("city") != "") & (F.col("country") != "")
    return (
        lookup(rows, gazetteer, keys, asks, broadcast, broadcast_bytes)
        .withColumns(
            {
                # Nothing is found for rows that did not ask, so coalesce is enough.
                "lat": F.coalesce("lat", FOUND_LAT),
                "lng": F.coalesce("lng", FOUND_LNG),
            }
        )
        .select(*rows.columns)
    )


MODES = {"replace": replace_incomplete, "fill_gaps": fill_gaps}


def open_questions(rows: DataFrame) -> DataFrame:
    """Each place to be asked of a geocoder once, however many rows lack it."""
    return (
        rows.filter(lacks_coords() & F.col("city").isNotNull() & F.col("country").isNotNull())
        .select(*PLACE_KEYS)
        .distinct()
        .withColumn(TEXT_KEYS[0], query_text())
    )


def gazetteer_from_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Turn stored geocoder replies into a gazetteer: the JSON column becomes lat, lng.

    Replies without a result keep their row with null coordinates.
    """
    kept = [name for name in replies.columns if name != reply]
    return replies.withColumn("_point", reply_point(reply)).select(*kept, "_point.lat", "_point.lng")
