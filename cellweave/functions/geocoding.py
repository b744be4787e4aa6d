"""Column expressions around a geocoder: the question text and the stored replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the part of a geocoder reply that carries the coordinates.
REPLY_TYPE = "results array<struct<geometry:struct<lat:double,lng:double>>>"


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def query_text(
    franchise: Column | str = "franchise_name",
    city: Column | str = "city",
    country: Column | str = "country",
) -> Column:
    """``"franchise, city, country"``; an unknown franchise reads ``None``.

    Null when the city or the country is null, since then nothing is asked.
    """
    city, country = _as_column(city), _as_column(country)
    text = F.format_string("%s, %s, %s", F.coalesce(_as_column(franchise), F.lit("None")), city, country)
    return F.when(city.isNotNull() & country.isNotNull(), text)


def packed_lat(packed: Column | str) -> Column:
    """Latitude of a ``"lat,lng"`` text; null when missing or not a number."""
    return F.get(F.split(_as_column(packed), ","), 0).try_cast("double")


def packed_lng(packed: Column | str) -> Column:
    """Longitude of a ``"lat,lng"`` text; null when missing or not a number."""
    return F.get(F.split(_as_column(packed), ","), 1).try_cast("double")


def reply_point(reply: Column | str) -> Column:
    """First result of a JSON reply as ``struct<lat,lng>``; null without a result."""
    return F.get(F.from_json(_as_column(reply), REPLY_TYPE)["results"], 0)["geometry"]
