"""Lookups and enrichment against plain loops over random rows."""

from collections import defaultdict

import pytest
from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cellweave.operators import enrich, geocode, sizing
from cellweave.schemas import CITY_KEYS, RESTAURANT
from cellweave.session import session, shared_folder

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

names = st.sampled_from([None, "", "a", "b", "c"])
halves = st.one_of(st.none(), st.integers(-4, 4).map(float))


@FEW
@given(
    st.lists(st.tuples(names, names, halves, halves), min_size=1, max_size=60),
    st.dictionaries(st.tuples(names, names), st.tuples(halves, halves), max_size=12),
)
def test_geocode_modes(spark, rows, places):
    restaurants = spark.createDataFrame(
        [(i, 1, "F", 1, country, city, lat, lng) for i, (country, city, lat, lng) in enumerate(rows)], RESTAURANT
    )
    gazetteer = spark.createDataFrame(
        [(*key, *point) for key, point in places.items()], "country string, city string, lat double, lng double"
    )

    def find(country, city):
        point = places.get((country, city), (None, None))
        known = country is not None and city is not None and None not in point
        return point if known else (None, None)

    replaced, filled = [], []
    for i, (country, city, lat, lng) in enumerate(rows):
        found = find(country, city)
        replaced.append((i, *(found if lat is None or lng is None else (lat, lng))))
        asks = lat is None and country and city
        filled.append((i, found[0] if asks else lat, found[1] if asks and lng is None else lng))
    for broadcast, limit in ((True, 10**6), (True, 0), (False, 0)):
        got = geocode.replace_incomplete(restaurants, gazetteer, CITY_KEYS, broadcast, limit)
        assert values(got, "id", "lat", "lng") == sorted(replaced, key=repr)
        got = geocode.fill_gaps(restaurants, gazetteer, CITY_KEYS, broadcast, limit)
        assert values(got, "id", "lat", "lng") == sorted(filled, key=repr)


cells = st.sampled_from([None, "u09t", "u09w", "xn76", "7zzz"])


@FEW
@given(
    st.lists(cells, min_size=1, max_size=60),
    st.lists(st.tuples(cells, st.sampled_from(["d1", "d2"]), st.integers(0, 9)), max_size=60),
)
def test_left_join(spark, restaurants, weather):
    left = spark.createDataFrame(list(enumerate(restaurants)), "id long, geohash string")
    right = spark.createDataFrame(weather, "geohash string, w_date string, avg_temp_c long")
    by_cell = defaultdict(list)
    for cell, date, value in weather:
        by_cell[cell].append((date, value))
    want = []
    for i, cell in enumerate(restaurants):
        matches = by_cell[cell] if cell is not None and by_cell[cell] else [(None, None)]
        want.extend((cell, i, *match) for match in matches)
    for broadcast in (True, None, False):
        assert values(enrich.left_join_cells(left, right, broadcast)) == sorted(want, key=repr)


def test_measured_bytes_grows_with_rows_and_text(spark):
    few = spark.createDataFrame([("a", 1.0), (None, 2.0)], "t string, x double")
    assert sizing.measured_bytes(few) == 2 * (64 + 2 * 8) + 1
    assert sizing.measured_bytes(few.filter("x > 9")) == 0
    assert sizing.fits_broadcast(few)
    assert not sizing.fits_broadcast(few, 100)


def test_shared_folder_is_the_one_the_session_names(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, other = shared_folder(spark), shared_folder(spark)
    assert one.startswith(f"{base}/cellweave-")
    assert one != other


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://somewhere:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_session_settings(spark):
    """Options reach the session; the running one is reused."""
    keys = ("files.maxPartitionBytes", "adaptive.advisoryPartitionSizeInBytes", "shuffle.partitions")
    before = {f"spark.sql.{key}": spark.conf.get(f"spark.sql.{key}") for key in keys}
    try:
        same = session("again", shuffle_partitions=7, split_bytes=1000000, advisory_bytes=2000000)
        assert [same.conf.get(key) for key in before] == ["1000000", "2000000", "7"]
        assert same.conf.get("spark.sql.parquet.compression.codec") == "gzip"
        assert same.conf.get("spark.sql.broadcastTimeout") in ("600", "600s")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
