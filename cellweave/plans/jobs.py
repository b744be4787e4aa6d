"""The batch jobs: read tables, apply operators, write tables.

Every job writes its result once, answers with the number of rows written (and, as
attributes of it, of rows read and to be mended), and leaves previews to be taken from the
files, so nothing is computed twice. The next job starts from those files rather than from
lineage. Intermediate tables are removed when a job ends. Paths are arguments throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cellweave import sinks, sources
from cellweave.functions.geohash import DEFAULT_PRECISION, geohash
from cellweave.operators import aggregates, enrich, filters, forgiving
from cellweave.operators import geocode as geocoding
from cellweave.operators import weather as weather_ops
from cellweave.operators.sizing import fits_broadcast
from cellweave.plans import averages
from cellweave.schemas import CITY_KEYS, DATE_PARTS, GEOHASH, PLACE_KEYS, RESTAURANT, TEXT_KEYS
from cellweave.sources.weather_zip import copy_members

_MENDED = "_to_mend"
_BAD_LINE = "_bad_line"


class Rows(int):
    """Number of rows written; ``read``, ``to_mend`` and ``set_aside`` are None where a job does
    not tell."""

    read: int | None = None
    to_mend: int | None = None
    set_aside: int | None = None

    def __new__(cls, written: int, read: int | None = None, to_mend: int | None = None, set_aside: int | None = None):
        made = super().__new__(cls, written)
        made.read, made.to_mend, made.set_aside = read, to_mend, set_aside
        return made


def _tidy(job: Callable) -> Callable:
    @wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with sinks.scratch(spark):
            return job(spark, *args, **kwargs)

    return run


def _restaurants(spark: SparkSession, path: str, schema: StructType, set_aside: str | None) -> tuple[DataFrame, int | None]:
    """Restaurants from CSV and, with a place for them, the number of lines set aside.

    The CSV is then read once: all rows are stored with the text of lines that do not fit the
    layout, and counted on the way. Those lines go to ``set_aside``, as the column ``line``,
    and are no rows of the result. Row groups without any are skipped when they are looked for.
    """
    if set_aside is None:
        return sources.restaurants_csv(spark, path, schema), None
    seen = Observation()
    rows = sources.restaurants_csv(spark, path, schema, bad_line=_BAD_LINE)
    rows = sinks.written(rows.observe(seen, F.count(F.col(_BAD_LINE)).alias("bad")))
    bad = F.col(_BAD_LINE).isNotNull()
    sinks.write_parquet(rows.filter(bad).select(F.col(_BAD_LINE).alias("line")), set_aside)
    return rows.filter(~bad).drop(_BAD_LINE), seen.get["bad"]


def _write_mended(
    rows: DataFrame, mend: Callable[[DataFrame], DataFrame], wrong: Column, target: str, set_aside: int | None = None
) -> Rows:
    """Write what ``mend`` makes of each row, and count rows that were ``wrong`` on the way.

    A row in is a row out here, so both are counted where the result is written, however
    often a lookup reads its source.
    """
    seen = Observation()
    mended = mend(rows.withColumn(_MENDED, wrong))
    counted = mended.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(_MENDED).alias("to_mend"))
    return Rows(sinks.write_parquet(counted.drop(_MENDED), target), **seen.get, set_aside=set_aside)


PREVIEW_COLUMNS = ("franchise_name", "city", "lat", "lng", GEOHASH)


def gazetteer_keys(gazetteer: DataFrame) -> Sequence[str]:
    """The keys a gazetteer answers to, going by its columns."""
    for keys in (TEXT_KEYS, PLACE_KEYS, CITY_KEYS):
        if set(keys) <= set(gazetteer.columns):
            return keys
    raise ValueError(f"a gazetteer needs the columns {TEXT_KEYS}, {PLACE_KEYS} or {CITY_KEYS}")


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """A gazetteer, or stored geocoder replies (a ``reply`` column) turned into one, which is
    written down so that measuring and using it do not decode them twice."""
    table = sources.parquet(spark, path)
    return sinks.written(geocoding.gazetteer_from_replies(table)) if "reply" in table.columns else table


def with_geohash(rows: DataFrame, precision: int = DEFAULT_PRECISION) -> DataFrame:
    return rows.withColumn(GEOHASH, geohash("lat", "lng", precision))


def complete(
    restaurants: DataFrame,
    gazetteer: DataFrame,
    precision: int = DEFAULT_PRECISION,
    keys: Sequence[str] | None = None,
    broadcast: bool = True,
) -> DataFrame:
    """Gaps filled, geohash added."""
    keys = keys or gazetteer_keys(gazetteer)
    return with_geohash(geocoding.fill_gaps(restaurants, gazetteer, keys, broadcast), precision)


@_tidy
def count_restaurants(
    spark: SparkSession,
    restaurants: str,
    target: str,
    schema: StructType | None = None,
    types: str | None = None,
    set_aside: str | None = None,
) -> int:
    """Counts per franchise and city. Without a schema, column types are inferred, with
    ``types`` from new files alone. Under a schema, lines that do not fit it can be
    ``set_aside`` there."""
    bad = None
    if schema is None:
        rows = sources.csv_inferred(spark, restaurants, types)
    else:
        rows, bad = _restaurants(spark, restaurants, schema, set_aside)
    seen = Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("read"))
    return Rows(sinks.write_parquet(aggregates.restaurant_counts(rows), target), **seen.get, set_aside=bad)


@_tidy
def geocode(
    spark: SparkSession,
    restaurants: str,
    gazetteer: str,
    target: str,
    mode: str = "fill_gaps",
    most_edits: int | None = None,
    set_aside: str | None = None,
) -> int:
    """Coordinates from a gazetteer; ``mode`` is ``replace`` or ``fill_gaps``. With
    ``most_edits`` places may be written another way than in the gazetteer, see ``forgiving``.
    Lines that do not fit the layout can be ``set_aside`` there; without that their bad
    values are null."""
    places = read_gazetteer(spark, gazetteer)
    rows, bad = _restaurants(spark, restaurants, RESTAURANT, set_aside)
    if most_edits is not None:
        keys = gazetteer_keys(places)
        places = sinks.written(forgiving.answers(rows, places, keys, most_edits=most_edits).select(*keys, "lat", "lng"))
    mend = geocoding.MODES[mode]
    return _write_mended(rows, lambda x: mend(x, places, gazetteer_keys(places)), filters.lacks_coords(), target, bad)


def tag_geohash(
    spark: SparkSession,
    restaurants: str,
    target: str,
    schema: StructType | None = RESTAURANT,
    precision: int = DEFAULT_PRECISION,
) -> int:
    """Add the geohash to geocoded restaurants. ``schema=None`` keeps all stored columns."""
    return sinks.write_parquet(with_geohash(sources.parquet(spark, restaurants, schema), precision), target)


@_tidy
def complete_restaurants(
    spark: SparkSession,
    restaurants: str,
    gazetteer: str,
    target: str,
    precision: int = DEFAULT_PRECISION,
    set_aside: str | None = None,
) -> int:
    """Fill gaps and add the geohash in one pass over the CSV; lines that do not fit the layout
    can be ``set_aside`` there."""
    rows, bad = _restaurants(spark, restaurants, RESTAURANT, set_aside)
    places = read_gazetteer(spark, gazetteer)
    return _write_mended(rows, lambda x: complete(x, places, precision), filters.lacks_coords(), target, bad)


@_tidy
def unpack_weather(spark: SparkSession, archives: str, target: str) -> int:
    """Archives to ``year=/month=/day=`` folders, each member as the file it is.

    A later delivery adds to the target: only files of the same name and day are replaced.
    """
    return copy_members(spark, archives, target)


def recompress(spark: SparkSession, weather: str, target: str, codec: str = "gzip") -> bool:
    """Rewrite weather under another codec; the folder keys become stored columns.

    A failure is reported and not raised, and the answer is then False; the target is then
    as it was. It may be the folder that is read.
    """
    try:
        sinks.write_parquet(sources.weather_parquet(spark, weather), target, codec)
    except (PySparkException, Py4JJavaError) as error:
        print(f"could not convert {weather}: {error}")
        return False
    return True


def update_averages(spark: SparkSession, weather: str, state: str, precision: int = DEFAULT_PRECISION) -> dict[str, int]:
    """Take new and changed days of a weather folder into kept averages, see ``averages``."""
    return averages.update(spark, weather, state, precision)


def _kept_means(spark: SparkSession, state: str, grain: str, precision: int) -> DataFrame:
    kept = averages.precision_of(spark, state)
    if kept != precision:
        raise ValueError(f"{state} holds cells of precision {kept}, not {precision}")
    means = averages.by_cell(spark, state) if grain == "cell" else averages.by_cell_date(spark, state)
    return means.filter(F.col(GEOHASH).isNotNull())


GRAINS = ("cell", "cell_date")
WEATHER_FORMATS = ("parquet", "csv", "averages")


@_tidy
def enrich_restaurants(
    spark: SparkSession,
    restaurants: str,
    weather: str,
    target: str,
    grain: str = "cell",
    weather_format: str = "parquet",
    weather_schema: StructType | str | None = None,
    precision: int = DEFAULT_PRECISION,
    broadcast: bool = True,
    prefix_letters: int | None = None,
) -> int:
    """Join restaurants that carry a geohash with the weather, in ``geohash=`` folders or, with
    ``prefix_letters``, in folders of so many letters, which many or long geohashes ask for.

    ``grain="cell"`` keeps one row per restaurant. ``grain="cell_date"`` gives one row
    per restaurant and date. Restaurants may lie in ``geohash=`` folders; a geohash that is
    not of the given precision is an error, as it could meet no weather. Weather in CSV costs an
    extra pass to infer its types unless ``weather_schema`` states them. With the format
    ``averages``, ``weather`` is a state that ``update_averages`` keeps, and no reading is read.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    if weather_format not in WEATHER_FORMATS:
        raise ValueError(f"weather_format must be one of {WEATHER_FORMATS}")
    rows = sources.by_geohash(spark, restaurants)
    length = F.length(GEOHASH)
    other = rows.agg(F.min(F.nullif(length, F.lit(precision)))).first()[0]
    if other is not None:
        raise ValueError(f"a geohash of {other} characters among the restaurants; precision is {precision}")
    if weather_format == "averages":
        means = _kept_means(spark, weather, grain, precision)
    else:
        if weather_format == "csv":
            readings = sources.weather_csv(spark, weather, weather_schema)
        else:
            readings = sources.weather_parquet(spark, weather)
        readings = enrich.near_restaurants(enrich.with_point(readings), rows, precision)
        if grain == "cell":
            means = weather_ops.by_cell(readings, precision)
        else:
            stored = "w_date" in readings.columns or not set(DATE_PARTS) <= set(readings.columns)
            date = "w_date" if stored else weather_ops.date_from_parts()
            means = weather_ops.by_cell_date(readings, precision, date)
    # Written down, the averages are not computed again if an executor is lost, and
    # their size is known before the join is planned.
    means = sinks.written(means)
    choice = False if not broadcast else (True if fits_broadcast(means) else None)
    joined = enrich.left_join_cells(rows, means, choice)
    if prefix_letters is not None:
        return sinks.write_by_prefix(joined, target, prefix_letters)
    return sinks.write_by_geohash(joined, target)


def pipeline(spark: SparkSession, restaurants: str, gazetteer: str, archives: str, folder: str) -> str:
    """All steps, from CSV and archives to enriched restaurants; returns the last path."""
    weather = f"{folder}/weather"
    completed = f"{folder}/restaurants"
    enriched = f"{folder}/enriched"
    unpack_weather(spark, archives, weather)
    complete_restaurants(spark, restaurants, gazetteer, completed)
    enrich_restaurants(spark, completed, weather, enriched)
    return enriched


def show(rows: DataFrame, n: int = 20) -> None:
    """Print a few rows; of restaurants with a geohash, the best-known columns."""
    columns = PREVIEW_COLUMNS if set(PREVIEW_COLUMNS) <= set(rows.columns) else None
    filters.preview(rows, n, columns).show(n)
