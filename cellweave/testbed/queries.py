"""One query per operator and job over the provided tables.

The temperatures are such that sums are exact, so means are compared as they are. Round
trips write to the folder the cluster shares; what a query only prepares is written once
per session.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave import sinks, sources
from cellweave.functions import geohash, packed_lat, packed_lng, query_text
from cellweave.operators import aggregates, enrich, filters, forgiving, geocode, weather
from cellweave.plans import averages, jobs
from cellweave.schemas import CITY_KEYS, DATE_PARTS, RESTAURANT, TEXT_KEYS, WEATHER
from cellweave.session import shared_folder
from cellweave.testbed import archives, tables

Query = Callable[[SparkSession, str], DataFrame]

_prepared: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, folder: str, name: str, write: Callable[[str], object]) -> str:
    """Path of something that queries only prepare, written at the first use."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _prepared:
        path = shared_folder(spark)
        write(path)
        _prepared[key] = path
    return _prepared[key]


def _restaurants_csv(spark: SparkSession, folder: str) -> str:
    rows = tables.restaurants(spark, folder)
    return _once(spark, folder, "restaurants_csv", lambda path: rows.write.csv(path, header=True))


def _readings_csv(spark: SparkSession, folder: str) -> str:
    rows = tables.readings(spark, folder)
    return _once(spark, folder, "readings_csv", lambda path: rows.write.csv(path, header=True))


def _gazetteer(spark: SparkSession, folder: str) -> str:
    rows = tables.gazetteer(spark, folder)
    return _once(spark, folder, "gazetteer", lambda path: sinks.write_parquet(rows, path))


def _archives(spark: SparkSession, folder: str) -> str:
    rows = tables.dated_readings(spark, folder)
    return _once(spark, folder, "archives", lambda path: archives.write_archives(rows, path))


def _completed_restaurants(spark: SparkSession, folder: str) -> str:
    rows = _completed(spark, folder)
    return _once(spark, folder, "completed", lambda path: sinks.write_parquet(rows, path))


def _completed(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.complete(tables.restaurants(spark, folder), tables.gazetteer(spark, folder), keys=CITY_KEYS)


def restaurant_counts(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.restaurant_counts(tables.restaurants(spark, folder))


def restaurant_counts_top5(spark: SparkSession, folder: str) -> DataFrame:
    return filters.preview(aggregates.restaurant_counts(tables.restaurants(spark, folder)), 5)


def missing_coords(spark: SparkSession, folder: str) -> DataFrame:
    return filters.missing_coords(tables.restaurants(spark, folder))


def complete_coords(spark: SparkSession, folder: str) -> DataFrame:
    return filters.complete_coords(tables.restaurants(spark, folder))


def by_franchise(spark: SparkSession, folder: str) -> DataFrame:
    return filters.by_franchise(tables.restaurants(spark, folder), "F7")


def preview_geohash(spark: SparkSession, folder: str) -> DataFrame:
    rows = jobs.with_geohash(tables.restaurants(spark, folder))
    return filters.preview(rows, 10, ("id", *jobs.PREVIEW_COLUMNS), order_by=("id",))


def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return filters.row_count(tables.restaurants(spark, folder))


def query_texts(spark: SparkSession, folder: str) -> DataFrame:
    franchise = F.when(F.col("id") % 13 != 0, F.col("franchise_name"))
    return tables.restaurants(spark, folder).select("id", query_text(franchise).alias("query"))


def parse_packed_coords(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("id")
    both = F.concat(F.col("lat").cast("string"), F.lit(","), F.col("lng").cast("string"))
    packed = (
        F.when(key % 7 == 3, F.lit("abc,2"))
        .when(key % 7 == 4, F.col("lng").cast("string"))
        .when(key % 7 == 5, F.lit(""))
        .otherwise(both)
    )
    return (
        tables.restaurants(spark, folder)
        .select("id", packed.alias("packed"))
        .select("id", packed_lat("packed").alias("lat"), packed_lng("packed").alias("lng"))
    )


def gazetteer_from_replies(spark: SparkSession, folder: str) -> DataFrame:
    return geocode.gazetteer_from_replies(tables.replies(spark, folder))


def geocode_by_replies(spark: SparkSession, folder: str) -> DataFrame:
    # Made by joins, so it is written down before it is measured and used.
    answers = sinks.written(geocode.gazetteer_from_replies(tables.replies(spark, folder).drop("id")))
    return geocode.replace_incomplete(tables.restaurants(spark, folder), answers, TEXT_KEYS)


def open_questions(spark: SparkSession, folder: str) -> DataFrame:
    return geocode.open_questions(tables.restaurants(spark, folder))


def geocode_lookup(spark: SparkSession, folder: str) -> DataFrame:
    rows = filters.missing_coords(tables.restaurants(spark, folder))
    return geocode.lookup(rows, tables.gazetteer(spark, folder), CITY_KEYS)


def geocode_replace(spark: SparkSession, folder: str) -> DataFrame:
    return geocode.replace_incomplete(tables.restaurants(spark, folder), tables.gazetteer(spark, folder), CITY_KEYS)


def geocode_replace_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    rows, places = tables.restaurants(spark, folder), tables.gazetteer(spark, folder)
    return geocode.replace_incomplete(rows, places, CITY_KEYS, broadcast=False)


def geocode_fill_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return geocode.fill_gaps(tables.restaurants(spark, folder), tables.gazetteer(spark, folder), CITY_KEYS)


def geocode_fill_gaps_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    rows, places = tables.restaurants(spark, folder), tables.gazetteer(spark, folder)
    return geocode.fill_gaps(rows, places, CITY_KEYS, broadcast=False)


def geocode_asked_places(spark: SparkSession, folder: str) -> DataFrame:
    rows, places = tables.restaurants(spark, folder), tables.wide_gazetteer(spark, folder)
    # The gazetteer is above this limit, the places asked for are below it.
    return geocode.fill_gaps(rows, places, CITY_KEYS, broadcast_bytes=18_000)


def geocode_forgiving(spark: SparkSession, folder: str) -> DataFrame:
    """Which place each way to write a city is taken for."""
    found = forgiving.answers(
        tables.misspelt_restaurants(spark, folder), tables.gazetteer(spark, folder), CITY_KEYS, most_edits=2
    )
    place = F.concat_ws(", ", "place.city", "place.country")
    return found.select("city", "country", "lat", "lng", "edits", place.alias("place"))


def geocode_job_forgiving(spark: SparkSession, folder: str) -> DataFrame:
    rows, places = tables.misspelt_restaurants(spark, folder), _gazetteer(spark, folder)
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    source = _once(spark, folder, "misspelt_csv", lambda path: rows.write.csv(path, header=True, **blanks))
    return _job(spark, lambda target: jobs.geocode(spark, source, places, target, most_edits=1))


def geohash_restaurants(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.with_geohash(tables.restaurants(spark, folder))


def geohash_weather(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.with_geohash(tables.readings(spark, folder))


def geohash_edges(spark: SparkSession, folder: str) -> DataFrame:
    return tables.edge_points(spark, folder).select("id", geohash("lat", "lng").alias("geohash"))


def complete_restaurants(spark: SparkSession, folder: str) -> DataFrame:
    return _completed(spark, folder)


def weather_by_cell(spark: SparkSession, folder: str) -> DataFrame:
    return weather.by_cell(tables.readings(spark, folder))


def weather_by_cell_date(spark: SparkSession, folder: str) -> DataFrame:
    return weather.by_cell_date(tables.readings(spark, folder))


def weather_avg_auto_name(spark: SparkSession, folder: str) -> DataFrame:
    rows = jobs.with_geohash(tables.readings(spark, folder)).withColumnRenamed("avg_tmpr_c", "avg_temp")
    return weather.mean_per_cell(rows, "avg_temp")


def enrich_by_cell(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.by_cell(_completed(spark, folder), tables.readings(spark, folder))


def enrich_by_cell_merged(spark: SparkSession, folder: str) -> DataFrame:
    rows, readings = _completed(spark, folder), tables.readings(spark, folder)
    return enrich.by_cell(rows, readings, broadcast=False)


def enrich_by_cell_date(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.by_cell_date(_completed(spark, folder), tables.readings(spark, folder))


def csv_fixed_schema(spark: SparkSession, folder: str) -> DataFrame:
    return sources.restaurants_csv(spark, _restaurants_csv(spark, folder), RESTAURANT)


def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    return sources.csv_inferred(spark, _restaurants_csv(spark, folder))


def csv_inferred_types(spark: SparkSession, folder: str) -> DataFrame:
    inferred = sources.csv_inferred(spark, _restaurants_csv(spark, folder))
    named = F.explode(F.create_map(*(F.lit(x) for pair in inferred.dtypes for x in pair))).alias("name", "type")
    return inferred.limit(1).select(named)


def csv_types_of_new_files(spark: SparkSession, folder: str) -> DataFrame:
    """Types after a first delivery, and after a second one that has wider values."""
    path = shared_folder(spark)
    rows = tables.restaurants(spark, folder).withColumn("opened", F.lit("2017-08-01"))
    later = rows.select(
        F.col("id") + 10**10, "franchise_id", "franchise_name", F.col("restaurant_franchise_id") + 0.5,
        "country", "city", F.concat(F.lit("at "), "lat"), "lng", F.lit("2017-08-01 12:30:00"),
    ).toDF(*rows.columns)
    named = []
    for delivery, data in enumerate((rows, later), 1):
        data.write.mode("append").csv(path, header=True)
        kept = sources.csv_inferred(spark, path, f"{path}/_types")
        named += [(delivery, name, kind) for name, kind in kept.dtypes]
    return spark.createDataFrame(named, "delivery int, name string, type string")


def _csv_with_bad_values(spark: SparkSession, folder: str) -> str:
    """Restaurants of which some have a latitude, or a number, that is none."""
    lat = F.when(F.col("id") % 19 == 3, "north").otherwise(F.col("lat").cast("string"))
    number = F.when(F.col("id") % 23 == 5, "1.5").otherwise(F.col("franchise_id").cast("string"))
    rows = tables.restaurants(spark, folder).withColumns({"lat": lat, "franchise_id": number})
    return _once(spark, folder, "bad_csv", lambda path: rows.write.csv(path, header=True))


def geocode_job_set_aside(spark: SparkSession, folder: str) -> DataFrame:
    rows, places, aside = _csv_with_bad_values(spark, folder), _gazetteer(spark, folder), shared_folder(spark)
    return _job(spark, lambda target: jobs.geocode(spark, rows, places, target, set_aside=aside))


def csv_lines_set_aside(spark: SparkSession, folder: str) -> DataFrame:
    """The lines that do not fit the layout, and how many the job says there are."""
    rows, places, aside = _csv_with_bad_values(spark, folder), _gazetteer(spark, folder), shared_folder(spark)
    done = jobs.geocode(spark, rows, places, shared_folder(spark), set_aside=aside)
    return sources.parquet(spark, aside).withColumn("counted", F.lit(done.set_aside).cast("long"))


def weather_csv_by_cell_date(spark: SparkSession, folder: str) -> DataFrame:
    return weather.by_cell_date(sources.weather_csv(spark, _readings_csv(spark, folder), WEATHER))


def parquet_with_schema(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    # Stored without one column and in another order: the layout restores both.
    stored = [name for name in reversed(RESTAURANT.names) if name != "franchise_id"]
    sinks.write_parquet(tables.restaurants(spark, folder).select(*stored), path)
    return sources.parquet(spark, path, RESTAURANT)


def partitioned_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    completed = _completed(spark, folder)
    sinks.write_by_geohash(completed, path)
    return sources.by_geohash(spark, path, completed.schema)


def _prefix_folders(spark: SparkSession, folder: str) -> str:
    rows = _completed(spark, folder)
    return _once(spark, folder, "prefix_folders", lambda path: sinks.write_by_prefix(rows, path))


def prefix_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return sources.by_prefix(spark, _prefix_folders(spark, folder))


def prefix_some_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells shorter than, as long as and longer than the names of the folders, and a whole one."""
    return sources.by_prefix(spark, _prefix_folders(spark, folder), ("3", "s0", "7x5", "66c9", "th"))


def enrich_job_prefix_folders(spark: SparkSession, folder: str) -> DataFrame:
    restaurants, weather_csv, target = _completed_restaurants(spark, folder), _readings_csv(spark, folder), shared_folder(spark)
    jobs.enrich_restaurants(spark, restaurants, weather_csv, target, weather_format="csv", prefix_letters=1)
    return sources.by_prefix(spark, target)


def weather_by_date_read(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    sinks.write_by_date(tables.dated_readings(spark, folder), path)
    return sources.weather_parquet(spark, path)


def weather_date_from_parts(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.dated_readings(spark, folder)
    return weather.by_cell_date(rows, date=weather.date_from_parts())


def recompress(spark: SparkSession, folder: str) -> DataFrame:
    dated, plain = shared_folder(spark), shared_folder(spark)
    sinks.write_by_date(tables.dated_readings(spark, folder), dated, codec="snappy")
    jobs.recompress(spark, dated, plain)
    return sources.parquet(spark, plain)


def zip_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return sources.weather_zip(spark, _archives(spark, folder))


def _mixed_archives(spark: SparkSession, folder: str) -> str:
    """Deliveries ``odd`` and ``even``: members of odd days have whole degrees, those of even
    days fractions and a column more."""
    rows = tables.dated_readings(spark, folder)
    odd = rows.filter("day % 2 = 1").withColumn("avg_tmpr_c", F.floor("avg_tmpr_c"))
    even = rows.filter("day % 2 = 0").withColumn("note", F.concat(F.lit("n"), "month"))

    def write(path: str) -> None:
        archives.write_archives(odd, f"{path}/odd")
        archives.write_archives(even, f"{path}/even")

    return _once(spark, folder, "mixed_archives", write)


def zip_mixed_members(spark: SparkSession, folder: str) -> DataFrame:
    return sources.weather_zip(spark, _mixed_archives(spark, folder))


def _unpacked_mixed(spark: SparkSession, folder: str) -> str:
    deliveries, target = _mixed_archives(spark, folder), shared_folder(spark)
    for delivery in ("odd", "even"):
        jobs.unpack_weather(spark, f"{deliveries}/{delivery}", target)
    return target


def unpack_mixed_read(spark: SparkSession, folder: str) -> DataFrame:
    return sources.weather_parquet(spark, _unpacked_mixed(spark, folder))


def unpack_mixed_then_enrich(spark: SparkSession, folder: str) -> DataFrame:
    restaurants, target = _completed_restaurants(spark, folder), shared_folder(spark)
    jobs.enrich_restaurants(spark, restaurants, _unpacked_mixed(spark, folder), target, grain="cell_date")
    return sources.by_geohash(spark, target).withColumn("w_date", F.col("w_date").cast("string"))


def recompress_mixed(spark: SparkSession, folder: str) -> DataFrame:
    target = shared_folder(spark)
    jobs.recompress(spark, _unpacked_mixed(spark, folder), target)
    return sources.parquet(spark, target)


def _deliveries(spark: SparkSession, folder: str) -> str:
    """Archives ``first`` and ``second``. The later delivery brings some days anew, in members
    of the same names: both deal days to archives alike, and members are numbered within a day."""

    def by_day(rows: DataFrame) -> DataFrame:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return rows.repartition(parts, *DATE_PARTS).sortWithinPartitions(*DATE_PARTS)

    rows = tables.dated_readings(spark, folder)
    later = rows.filter("day <= 10").withColumn("avg_tmpr_c", F.col("avg_tmpr_c") + 1.0)

    def write(path: str) -> None:
        archives.write_archives(by_day(rows), f"{path}/first")
        archives.write_archives(by_day(later), f"{path}/second")

    return _once(spark, folder, "deliveries", write)


def unpack_second_delivery(spark: SparkSession, folder: str) -> DataFrame:
    deliveries, target = _deliveries(spark, folder), shared_folder(spark)
    jobs.unpack_weather(spark, f"{deliveries}/first", target)
    jobs.unpack_weather(spark, f"{deliveries}/second", target)
    return sources.weather_parquet(spark, target)


def _kept_averages(spark: SparkSession, folder: str) -> str:
    """Averages after the first delivery, brought up to date after the second."""
    deliveries, weather_folder, state = _deliveries(spark, folder), shared_folder(spark), shared_folder(spark)
    for delivery in ("first", "second"):
        jobs.unpack_weather(spark, f"{deliveries}/{delivery}", weather_folder)
        jobs.update_averages(spark, weather_folder, state)
    return state


def averages_second_delivery(spark: SparkSession, folder: str) -> DataFrame:
    return averages.by_cell_date(spark, _kept_averages(spark, folder))


def enrich_job_from_averages(spark: SparkSession, folder: str) -> DataFrame:
    restaurants, target = _completed_restaurants(spark, folder), shared_folder(spark)
    jobs.enrich_restaurants(spark, restaurants, _kept_averages(spark, folder), target, weather_format="averages")
    return sources.by_geohash(spark, target)


def _job(spark: SparkSession, run: Callable[[str], object]) -> DataFrame:
    target = shared_folder(spark)
    run(target)
    return sources.parquet(spark, target)


def counts_job(spark: SparkSession, folder: str) -> DataFrame:
    return _job(spark, lambda target: jobs.count_restaurants(spark, _restaurants_csv(spark, folder), target))


def geocode_job_replace(spark: SparkSession, folder: str) -> DataFrame:
    rows, places = _restaurants_csv(spark, folder), _gazetteer(spark, folder)
    return _job(spark, lambda target: jobs.geocode(spark, rows, places, target, "replace"))


def geocode_job_fill_gaps(spark: SparkSession, folder: str) -> DataFrame:
    rows, places = _restaurants_csv(spark, folder), _gazetteer(spark, folder)
    return _job(spark, lambda target: jobs.geocode(spark, rows, places, target, "fill_gaps"))


def geocode_job_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What the job says of itself: rows read, to be mended and written."""
    rows, places, target = _restaurants_csv(spark, folder), _gazetteer(spark, folder), shared_folder(spark)
    done = jobs.geocode(spark, rows, places, target)
    values = (done.read, done.to_mend, int(done))
    return spark.createDataFrame([values], "rows_read long, rows_to_mend long, rows_written long")


def gzip_codec(spark: SparkSession, folder: str) -> DataFrame:
    """The codec that the footers of a written table name, per column."""
    path = shared_folder(spark)
    sinks.write_parquet(tables.restaurants(spark, folder), path)

    def footers(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            for content in batch.column("content"):
                whole = pq.ParquetFile(pa.BufferReader(content.as_py())).metadata
                chunks = [whole.row_group(g).column(i) for g in range(whole.num_row_groups) for i in range(whole.num_columns)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "name": pa.array([c.path_in_schema for c in chunks], pa.string()),
                        "codec": pa.array([c.compression for c in chunks], pa.string()),
                    }
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("content")
    return files.mapInArrow(footers, "name string, codec string").distinct()


def enrich_without_doubling(spark: SparkSession, folder: str) -> DataFrame:
    """Readings of a cell are averaged first, so a restaurant stays one row."""
    means = weather.mean_per_cell(jobs.with_geohash(tables.readings(spark, folder)), "avg_tmpr_c")
    joined = enrich.left_join_cells(_completed(spark, folder), means.filter("geohash is not null"))
    return joined.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("avg(avg_tmpr_c)").alias("mean"))


def tag_geohash_job(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.restaurants(spark, folder)
    source = _once(spark, folder, "restaurants", lambda path: sinks.write_parquet(rows, path))
    return _job(spark, lambda target: jobs.tag_geohash(spark, source, target))


def enrich_job_by_cell_date(spark: SparkSession, folder: str) -> DataFrame:
    restaurants, weather_csv, target = _completed_restaurants(spark, folder), _readings_csv(spark, folder), shared_folder(spark)
    jobs.enrich_restaurants(spark, restaurants, weather_csv, target, grain="cell_date", weather_format="csv")
    return sources.by_geohash(spark, target).withColumn("w_date", F.col("w_date").cast("string"))


def enrich_job_from_cell_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Restaurants and weather near one corner of the map, where cells are all digits."""

    def corner(rows: DataFrame, key: str) -> DataFrame:
        return rows.withColumns({"lat": F.lit(-89.9) + (F.col(key) % 2) * 0.25, "lng": F.lit(-179.9) + (F.col(key) % 4) * 0.125})

    rows = jobs.with_geohash(corner(tables.restaurants(spark, folder), "id"))
    stored = _once(spark, folder, "cell_folders", lambda path: sinks.write_by_geohash(rows, path))
    near = tables.dated_readings(spark, folder).withColumn("key", (F.col("month") + F.col("day")))
    near = corner(near, "key").drop("key")
    days = _once(spark, folder, "corner_weather", lambda path: sinks.write_by_date(near, path))
    target = shared_folder(spark)
    jobs.enrich_restaurants(spark, stored, days, target)
    return sources.by_geohash(spark, target)


def end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    rows, places, zips = (f(spark, folder) for f in (_restaurants_csv, _gazetteer, _archives))
    return sources.by_geohash(spark, jobs.pipeline(spark, rows, places, zips, shared_folder(spark)))


QUERIES: dict[str, Query] = {
    "restaurant_counts": restaurant_counts,
    "restaurant_counts_top5": restaurant_counts_top5,
    "missing_coords": missing_coords,
    "complete_coords": complete_coords,
    "by_franchise": by_franchise,
    "preview_geohash": preview_geohash,
    "row_count": row_count,
    "query_text": query_texts,
    "parse_packed_coords": parse_packed_coords,
    "gazetteer_from_replies": gazetteer_from_replies,
    "geocode_by_replies": geocode_by_replies,
    "open_questions": open_questions,
    "geocode_lookup": geocode_lookup,
    "geocode_replace": geocode_replace,
    "geocode_replace_shuffled": geocode_replace_shuffled,
    "geocode_fill_gaps": geocode_fill_gaps,
    "geocode_fill_gaps_shuffled": geocode_fill_gaps_shuffled,
    "geocode_asked_places": geocode_asked_places,
    "geocode_forgiving": geocode_forgiving,
    "geocode_job_forgiving": geocode_job_forgiving,
    "geohash_restaurants": geohash_restaurants,
    "geohash_weather": geohash_weather,
    "geohash_edges": geohash_edges,
    "complete_restaurants": complete_restaurants,
    "weather_by_cell": weather_by_cell,
    "weather_by_cell_date": weather_by_cell_date,
    "weather_avg_auto_name": weather_avg_auto_name,
    "weather_date_from_parts": weather_date_from_parts,
    "enrich_by_cell": enrich_by_cell,
    "enrich_by_cell_merged": enrich_by_cell_merged,
    "enrich_by_cell_date": enrich_by_cell_date,
    "csv_fixed_schema": csv_fixed_schema,
    "csv_inferred": csv_inferred,
    "csv_inferred_types": csv_inferred_types,
    "csv_types_of_new_files": csv_types_of_new_files,
    "geocode_job_set_aside": geocode_job_set_aside,
    "csv_lines_set_aside": csv_lines_set_aside,
    "weather_csv_by_cell_date": weather_csv_by_cell_date,
    "parquet_with_schema": parquet_with_schema,
    "partitioned_roundtrip": partitioned_roundtrip,
    "prefix_roundtrip": prefix_roundtrip,
    "prefix_some_cells": prefix_some_cells,
    "enrich_job_prefix_folders": enrich_job_prefix_folders,
    "weather_by_date_read": weather_by_date_read,
    "recompress": recompress,
    "zip_ingest": zip_ingest,
    "zip_mixed_members": zip_mixed_members,
    "unpack_mixed_read": unpack_mixed_read,
    "unpack_mixed_then_enrich": unpack_mixed_then_enrich,
    "recompress_mixed": recompress_mixed,
    "unpack_second_delivery": unpack_second_delivery,
    "averages_second_delivery": averages_second_delivery,
    "enrich_job_from_averages": enrich_job_from_averages,
    "counts_job": counts_job,
    "geocode_job_replace": geocode_job_replace,
    "geocode_job_fill_gaps": geocode_job_fill_gaps,
    "geocode_job_counts": geocode_job_counts,
    "gzip_codec": gzip_codec,
    "enrich_without_doubling": enrich_without_doubling,
    "enrich_job_from_cell_folders": enrich_job_from_cell_folders,
    "tag_geohash_job": tag_geohash_job,
    "enrich_job_by_cell_date": enrich_job_by_cell_date,
    "end_to_end": end_to_end,
}
