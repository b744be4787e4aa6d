import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from cellweave.functions import geohash
from cellweave.operators import aggregates, enrich, filters, weather

READING = "lat double, lng double, avg_tmpr_c double, avg_tmpr_f double, w_date string"


def test_two_readings_do_not_double_restaurants(spark):
    restaurants = spark.createDataFrame([("Trattoria", "xn76"), ("Diner", "xn76"), ("Bar", "xn77")], ["name", "geohash"])
    readings = spark.createDataFrame(
        [("xn76", 3.5, "2019-06-30"), ("xn76", -1.5, "2019-07-01"), ("xn76", 7.0, "2019-07-01")],
        ["geohash", "avg_temp", "w_date"],
    )
    means = weather.mean_per_cell(readings, "avg_temp")
    for broadcast in (True, None, False):
        joined = enrich.left_join_cells(restaurants, means, broadcast)
        assert joined.columns == ["geohash", "name", "avg(avg_temp)"]
        assert values(joined) == [("xn76", "Diner", 3.0), ("xn76", "Trattoria", 3.0), ("xn77", "Bar", None)]


@pytest.fixture
def readings(spark):
    return spark.createDataFrame(
        [
            (48.85, 2.35, 10.0, 50.0, "2025-01-01"),
            (48.86, 2.36, 20.0, 68.0, "2025-01-01"),
            (48.85, 2.35, 30.0, None, "2025-01-02"),
            (None, 2.35, 99.0, 99.0, "2025-01-01"),
            (None, None, 97.0, 99.0, "2025-01-03"),
            (-10.0, 100.0, None, None, "2025-01-01"),
        ],
        READING,
    )


@pytest.fixture
def restaurants(spark):
    rows = spark.createDataFrame(
        [(1, 48.85, 2.35), (2, 48.85, 2.35), (3, None, 2.35), (4, 0.0, 0.0), (5, -10.0, 100.0)],
        "id long, lat double, lng double",
    )
    return rows.withColumn("geohash", geohash("lat", "lng"))


def test_weather_by_cell(readings):
    got = {row.geohash: (row.avg_temp_c, row.avg_temp_f) for row in weather.by_cell(readings).collect()}
    assert got["u09t"] == (20.0, 59.0)
    assert got[None] == (98.0, 99.0)
    assert len(got) == 3


def test_weather_by_cell_date(readings):
    got = {(r.geohash, r.w_date): (r.avg_temp_c, r.avg_temp_f) for r in weather.by_cell_date(readings).collect()}
    assert got["u09t", "2025-01-01"] == (15.0, 59.0)
    assert got["u09t", "2025-01-02"] == (30.0, None)
    assert got[None, "2025-01-03"] == (97.0, 99.0)
    assert len(got) == 5


@pytest.mark.parametrize("broadcast", [True, False])
def test_by_cell_keeps_every_restaurant_once(restaurants, readings, broadcast):
    got = enrich.by_cell(restaurants, readings, broadcast=broadcast)
    assert got.columns == ["geohash", "id", "lat", "lng", "avg_temp_c", "avg_temp_f"]
    # Restaurant 3 has no cell: the readings without one must not reach it.
    assert values(got, "id", "avg_temp_c", "avg_temp_f") == [
        (1, 20.0, 59.0),
        (2, 20.0, 59.0),
        (3, None, None),
        (4, None, None),
        (5, None, None),
    ]


@pytest.mark.parametrize("broadcast", [True, False])
def test_by_cell_date_gives_a_row_per_date(restaurants, readings, broadcast):
    got = enrich.by_cell_date(restaurants, readings, broadcast=broadcast)
    assert values(got, "id", "w_date", "avg_temp_c") == [
        (1, "2025-01-01", 15.0),
        (1, "2025-01-02", 30.0),
        (2, "2025-01-01", 15.0),
        (2, "2025-01-02", 30.0),
        (3, None, None),
        (4, None, None),
        (5, "2025-01-01", None),
    ]


def test_date_may_come_from_parts(spark, restaurants):
    readings = spark.createDataFrame(
        [(48.85, 2.35, 1.0, 2.0, 2016, 10, 1), (48.85, 2.35, 3.0, 4.0, 2016, 10, 1)],
        "lat double, lng double, avg_tmpr_c double, avg_tmpr_f double, year int, month int, day int",
    )
    got = enrich.by_cell_date(restaurants, readings, date=weather.date_from_parts()).filter("id = 1")
    assert values(got, "w_date", "avg_temp_c") == [("2016-10-01", 2.0)]


def big(spark):
    """A third of the restaurants in one cell, a third of the rest without a cell."""
    n = F.col("id")
    lat = F.when(n % 3 == 0, F.lit(10.0)).when(n % 3 == 1, (n % 170 - 85).cast("double"))
    lat = F.when(n % 9 == 2, F.lit(None)).otherwise(F.coalesce(lat, F.lit(50.0)))
    restaurants = spark.range(0, 30000, 1, 8).select("id", lat.alias("lat"), (n % 40).cast("double").alias("lng"))
    restaurants = restaurants.withColumn("lng", F.when(n % 3 == 0, 10.0).otherwise(F.col("lng")))
    readings = spark.range(0, 5000, 1, 4).select(
        (n % 170 - 85).cast("double").alias("lat"),
        (n % 40).cast("double").alias("lng"),
        (n % 30).cast("double").alias("avg_tmpr_c"),
        (n % 90).cast("double").alias("avg_tmpr_f"),
        F.concat(F.lit("2025-01-0"), n % 4 + 1).alias("w_date"),
    )
    return restaurants.withColumn("geohash", geohash("lat", "lng")), readings


def without_broadcast(settings):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="16KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
    )


@pytest.mark.parametrize("grain", ["cell", "cell_date"])
def test_hot_cell_is_split(spark, settings, grain):
    without_broadcast(settings)
    restaurants, readings = big(spark)
    if grain == "cell":
        got = enrich.by_cell(restaurants, readings, broadcast=False)
        cells = weather.by_cell(readings)
    else:
        got = enrich.by_cell_date(restaurants, readings)
        cells = weather.by_cell_date(readings)
    want = values(restaurants.join(cells, "geohash", "left").select(*got.columns))
    assert values(got) == want
    got.collect()
    assert "skew=true" in plan_of(got)
    assert "BroadcastHashJoin" not in plan_of(got)


def test_restaurants_without_cell_are_spread(spark, settings):
    without_broadcast(settings)
    rows = spark.range(0, 4000, 1, 4).select("id", F.lit(None).cast("string").alias("geohash"))
    cells = spark.createDataFrame([("u09t", 1.0)], "geohash string, avg_temp_c double")
    settings(adaptive__enabled="false")
    joined = enrich.left_join_cells(rows, cells, None)
    sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4
    assert max(r["count"] for r in sizes) < 2000


def test_bounded_weather_is_broadcast_and_restaurants_stay(spark, settings):
    without_broadcast(settings)
    restaurants, readings = big(spark)
    plan = plan_of(enrich.by_cell(restaurants, readings))
    assert "BroadcastHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the averages, not the restaurants
    assert "BroadcastHashJoin" not in plan_of(enrich.by_cell(restaurants, readings, precision=5))


def test_readings_away_from_restaurants_are_dropped_in_the_scan(spark, restaurants, readings, tmp_path):
    readings.write.parquet(f"{tmp_path}/w")
    stored = spark.read.parquet(f"{tmp_path}/w")
    near = enrich.near_restaurants(stored, restaurants.filter("id = 1"))
    assert near.columns == readings.columns
    assert values(near, "avg_tmpr_c") == [(10.0,), (20.0,), (30.0,)]
    for make in (enrich.by_cell, enrich.by_cell_date):
        near = enrich.near_restaurants(stored, restaurants)
        assert values(make(restaurants, near)) == values(make(restaurants, stored))
    plan = plan_of(weather.by_cell(near))
    assert plan.index("BroadcastHashJoin") > plan.index("partial_avg")
    assert enrich.near_restaurants(stored, restaurants, precision=5) is stored


def test_text_is_made_per_cell_not_per_reading(spark, tmp_path):
    _, readings = big(spark)
    readings.write.parquet(f"{tmp_path}/w")
    restaurants = spark.createDataFrame([(1, "u09t")], "id int, geohash string")
    plan = plan_of(enrich.by_cell(restaurants, spark.read.parquet(f"{tmp_path}/w")))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PushedFilters: [IsNotNull(lat), IsNotNull(lng)]" in scan
    assert "ReadSchema: struct<lat:double,lng:double,avg_tmpr_c:double,avg_tmpr_f:double>" in scan
    assert "concat" not in plan.split("HashAggregate")[-1]


def test_restaurant_counts(spark):
    rows = spark.createDataFrame(
        [
            (1, "A", "x", "N"),
            (2, "A", "x", "N"),
            (None, "A", "x", "N"),
            (3, "B", None, "N"),
            (4, None, "x", "N"),
            (5, "A", "x", None),
            (6, "B", "a", "N"),
            (None, "C", "c", "N"),
        ],
        "id long, franchise_name string, city string, country string",
    )
    got = [tuple(r) for r in aggregates.restaurant_counts(rows).collect()]
    assert got == [("A", "x", 2), (None, "x", 1), ("B", None, 1), ("B", "a", 1), ("C", "c", 0)]


def test_filters(spark):
    rows = spark.createDataFrame(
        [(1, None, None), (2, 1.0, None), (3, None, 1.0), (4, 1.0, 1.0), (5, float("nan"), 1.0)],
        "id int, lat double, lng double",
    )
    assert values(filters.missing_coords(rows), "id") == [(1,), (2,), (3,)]
    assert values(filters.complete_coords(rows), "id") == [(4,), (5,)]
    assert filters.row_count(rows).first().row_count == 5
    assert [r.id for r in filters.preview(rows, 2, ["id"], [F.col("id").desc()]).collect()] == [5, 4]
