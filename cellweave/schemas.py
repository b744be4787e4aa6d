"""Table layouts shared by the readers, the operators and the jobs."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Column names and types of the restaurant files.
RESTAURANT = StructType(
    [
        StructField("id", LongType()),
        StructField("franchise_id", IntegerType()),
        StructField("franchise_name", StringType()),
        StructField("restaurant_franchise_id", IntegerType()),
        StructField("country", StringType()),
        StructField("city", StringType()),
        StructField("lat", DoubleType()),
        StructField("lng", DoubleType()),
    ]
)

WEATHER = StructType(
    [
        StructField("lat", DoubleType()),
        StructField("lng", DoubleType()),
        StructField("avg_tmpr_c", DoubleType()),
        StructField("avg_tmpr_f", DoubleType()),
        StructField("w_date", StringType()),
    ]
)

GAZETTEER = StructType(
    [
        StructField("franchise_name", StringType()),
        StructField("city", StringType()),
        StructField("country", StringType()),
        StructField("lat", DoubleType()),
        StructField("lng", DoubleType()),
    ]
)

# A place is looked up by all three names; a gazetteer of cities uses PLACE_KEYS[1:].
PLACE_KEYS = ("franchise_name", "city", "country")
CITY_KEYS = ("city", "country")
# A gazetteer keyed by the text that would be sent to a geocoder.
TEXT_KEYS = ("query",)

DATE_PARTS = ("year", "month", "day")
GEOHASH = "geohash"
#: Folder key of tables in prefix folders: the first letters of the geohash.
PREFIX = "cell_prefix"
