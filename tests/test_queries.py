"""Every registered query against its SQL, on the smallest data."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="needs the provided tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def sorted_rows(rows, columns):
    order = [columns.index(name) for name in sorted(columns)]
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_its_sql():
    assert registered.QUERIES.keys() == registered.ORACLE.keys()
    assert registered.oracle_sql().keys() <= registered.queries().keys()


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = registered.queries()[name](spark, FOLDER)
    want = duck.sql(registered.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(row) for row in got.collect()]
    assert sorted_rows(rows, got.columns) == sorted_rows(want.fetchall(), want.columns)


def test_entry(spark):
    rows = registered.entry(spark).collect()
    assert len(rows) == 150
    assert sum(row.avg_temp_c is not None for row in rows) == 75


def test_known_numbers(spark):
    """Counts known beforehand for sf0.001."""
    queries = registered.queries()
    if Path(FOLDER).name != "sf0.001":
        pytest.skip("numbers are for sf0.001")
    sizes = {
        "missing_coords": 45,
        "restaurant_counts": 139,
        "weather_by_cell": 114,
        "weather_by_cell_date": 876,
        "enrich_by_cell_date": 672,
    }
    assert {name: queries[name](spark, FOLDER).count() for name in sizes} == sizes
    replaced = queries["geocode_replace"](spark, FOLDER)
    filled = queries["geocode_fill_gaps"](spark, FOLDER)
    assert replaced.filter("lat is not null").count() == 146
    assert filled.filter("lat is not null").count() == 147
    assert filled.filter("lng is not null").count() == 134
    assert queries["complete_restaurants"](spark, FOLDER).filter("geohash is not null").count() == 132
