"""Restaurants, weather readings and a gazetteer derived from the provided tables.

Coordinates and temperatures are binary fractions, so any engine computes the same doubles,
and the same means in whatever order it adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.geocoding import query_text


# The columns used here; stating them saves a job that would read a footer for them.
COLUMNS = {
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, value double",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def restaurants(spark: SparkSession, folder: str) -> DataFrame:
    """One restaurant per customer; of every ten, one lacks both coordinates, one its
    latitude and one its longitude."""
    key, nation = F.col("c_custkey"), F.col("n_nationkey")
    branch = (key % 4).cast("double")
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == nation)
        .select(
            key.alias("id"),
            (key % 50).cast("int").alias("franchise_id"),
            F.concat(F.lit("F"), key % 50).alias("franchise_name"),
            (key % 1000).cast("int").alias("restaurant_franchise_id"),
            F.when(key % 17 != 0, F.col("n_name")).alias("country"),
            F.concat("n_name", F.lit("_C"), key % 4).alias("city"),
            F.when(~(key % 10).isin(0, 1), -60 + nation * 5 + branch * 0.25).alias("lat"),
            F.when(~(key % 10).isin(0, 2), -150 + nation * 12 + branch * 0.5).alias("lng"),
        )
    )


def _sixty_fourths(value: Column) -> Column:
    return F.floor(value * 64.0).cast("double") / 64.0


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """One weather reading per event; every 97th has no latitude."""
    event, user = F.col("event_id"), F.col("user_id")
    near = (event % 8).cast("double")
    celsius = _sixty_fourths(F.col("value"))
    return table(spark, folder, "events").select(
        F.when(event % 97 != 0, -60 + (user % 25) * 5 + near * 0.125).alias("lat"),
        (-150 + (user % 25) * 12 + near * 0.25).alias("lng"),
        celsius.alias("avg_tmpr_c"),
        _sixty_fourths(celsius * 9.0 / 5.0 + 32.0).alias("avg_tmpr_f"),
        F.col("ts").cast("date").cast("string").alias("w_date"),
    )


def dated_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings with ``year``, ``month`` and ``day`` in place of the date text."""
    day = F.col("w_date").cast("date")
    return readings(spark, folder).select(
        "lat",
        "lng",
        "avg_tmpr_c",
        "avg_tmpr_f",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
    )


def gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """Four cities per nation, less a few so that some lookups find nothing."""
    nation, city = F.col("n_nationkey"), F.col("k")
    return (
        table(spark, folder, "nation")
        .select("n_name", nation, F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
        .filter(~((nation % 7 == 3) & (city == 3)))
        .select(
            F.col("n_name").alias("country"),
            F.concat("n_name", F.lit("_C"), city).alias("city"),
            (-60 + nation * 5 + city * 0.25).cast("double").alias("lat"),
            (-150 + nation * 12 + city * 0.5).cast("double").alias("lng"),
        )
    )


def wide_gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """The gazetteer and, for each customer, a place where no restaurant is."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    elsewhere = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), nation == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("country"),
            F.concat("n_name", F.lit("_X"), key).alias("city"),
            (key % 90).cast("double").alias("lat"),
            (key % 180).cast("double").alias("lng"),
        )
    )
    return gazetteer(spark, folder).unionByName(elsewhere)


def replies(spark: SparkSession, folder: str) -> DataFrame:
    """A stored geocoder reply per restaurant: good, empty, broken or null."""
    key = F.col("id")
    places = gazetteer(spark, folder).withColumnsRenamed({"lat": "g_lat", "lng": "g_lng"})
    point = F.struct(F.col("g_lat").alias("lat"), F.col("g_lng").alias("lng"))
    good = F.to_json(F.struct(F.array(F.struct(point.alias("geometry"))).alias("results")))
    return (
        restaurants(spark, folder)
        .join(places, ["country", "city"], "left")
        .select(
            "id",
            query_text().alias("query"),
            F.when(key % 11 == 5, F.lit("junk"))
            .when(key % 11 == 7, F.lit(None))
            .when(F.col("g_lat").isNull(), F.lit('{"results":[]}'))
            .otherwise(good)
            .alias("reply"),
        )
    )


def misspelt_restaurants(spark: SparkSession, folder: str) -> DataFrame:
    """Restaurants without coordinates whose city is written in one of eleven ways: as it is,
    in other case, with accents or blanks, with a letter missing, doubled, replaced, or two
    swapped, with two missing, with another number, and as nothing but signs."""
    way, city = F.col("id") % 11, F.col("city")
    first, second, rest = F.substring(city, 1, 1), F.substring(city, 2, 1), F.substr(city, F.lit(3))
    return (
        restaurants(spark, folder)
        .drop("lat", "lng")
        .withColumns({"lat": F.lit(None).cast("double"), "lng": F.lit(None).cast("double")})
        .withColumn(
            "city",
            F.when(way == 1, F.lower(city))
            .when(way == 2, F.concat(F.lit(" "), F.translate(city, "AEIOU_", "ÁÈÎÕÜ-"), F.lit(" !")))
            .when(way == 3, F.concat(first, rest))
            .when(way == 4, F.concat(first, first, second, rest))
            .when(way == 5, F.concat(first, F.lit("q"), rest))
            .when(way == 6, F.concat(second, first, rest))
            .when(way == 7, F.substr(city, F.lit(3)))
            .when(way == 8, F.concat(city, F.lit("7")))
            .when(way == 9, F.lit("?!"))
            .when(way == 10, F.concat(city, F.lit(" city")))
            .otherwise(city),
        )
    )


def edge_points(spark: SparkSession, folder: str) -> DataFrame:
    """Points on, just above and just below cell borders, outside the ranges, NaN,
    infinite and null, one per event."""
    event, user = F.col("event_id"), F.col("user_id")
    near = (event % 3 - 1) * F.lit(2.0**-30)
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.when(event % 31 == 1, F.lit(None))
        .when(event % 31 == 2, F.lit(float("nan")))
        .when(event % 31 == 3, F.lit(float("inf")))
        .when(event % 31 == 4, F.lit(95.0))
        .when(event % 31 == 5, F.lit(-95.0))
        .otherwise(-90.0 + (event % 1025) * F.lit(180.0 / 1024) + near)
        .alias("lat"),
        F.when(user % 29 == 1, F.lit(None))
        .when(user % 29 == 2, F.lit(float("nan")))
        .when(user % 29 == 3, F.lit(float("-inf")))
        .when(user % 29 == 4, F.lit(200.0))
        .otherwise(-180.0 + ((event * 7 + user) % 1025) * F.lit(360.0 / 1024) - near)
        .alias("lng"),
    )
