"""Types of CSV columns kept per file, and lines that do not fit a layout."""

import datetime as dt
import os
from pathlib import Path

import pytest
from conftest import plan_of, values
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave import sinks, sources
from cellweave.plans import jobs
from cellweave.schemas import RESTAURANT
from cellweave.sources import csv_types

VALUES = [
    "", "1", "-7", "+3", "2147483648", "-9223372036854775808", "9223372036854775808", "12345678901234567890123",
    "1.5", ".5", "-1e3", "NaN", "Infinity", "2017-08-01", "2017-08-01 12:30:00", "2017-08-01T12:30:00", "2017-13-01",
    "true", "FALSE", "x", " 1", "1 ", "0x1", "1,5", "-", "007",
]


def put(folder, name, *rows, header="a"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *(f'"{x}"' if "," in x and header == "a" else x for x in rows)]) + "\n")


def test_types_are_those_spark_infers(spark, tmp_path):
    """Every pair of values, each a column of one file."""
    pairs = [(a, b) for i, a in enumerate(VALUES) for b in VALUES[i:]]
    quoted = [[f'"{v}"' if v else "" for v in side] for side in zip(*pairs)]
    header = ",".join(f"c{i}" for i in range(len(pairs)))
    for n, row in enumerate(quoted):
        put(tmp_path / "in", f"{n}.csv", ",".join(row), header=header)
    want = spark.read.csv(str(tmp_path / "in"), header=True, inferSchema=True).dtypes
    got = sources.csv_inferred(spark, str(tmp_path / "in"), f"{tmp_path}/state").dtypes
    assert [(pair, g, w) for pair, (_, g), (_, w) in zip(pairs, got, want) if g != w] == []


@hypothesis_settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 255), min_size=1, max_size=4), st.integers(20, 40))
def test_any_order_of_files_gives_the_same(kinds, digits):
    joined = 0
    for k in kinds:
        joined |= k
    back = 0
    for k in reversed(kinds):
        back |= k
    assert csv_types.kind_type(joined, digits) == csv_types.kind_type(back, digits)


def test_only_new_files_are_read(spark, tmp_path):
    folder, state = tmp_path / "in", str(tmp_path / "in/_types")
    put(folder, "1.csv", "1", "2")
    put(folder, "2.csv", "3")
    assert csv_types.schema(spark, str(folder), state) == T.StructType([T.StructField("a", T.IntegerType())])
    # Files known could not even be read as they were.
    for name in ("1.csv", "2.csv"):
        info = (folder / name).stat()
        (folder / name).write_text("a\nx" + "\n" * (info.st_size - 3))
        os.utime(folder / name, ns=(info.st_atime_ns, info.st_mtime_ns))
    put(folder, "3.csv", "4.5")
    assert csv_types.schema(spark, str(folder), state)[0].dataType == T.DoubleType()
    put(folder, "4.csv", "", "")
    assert csv_types.schema(spark, str(folder), state)[0].dataType == T.DoubleType()
    assert csv_types.state_of(spark, state).count() == 4


def test_changed_and_lost_files_count_no_more(spark, tmp_path):
    folder, state = tmp_path / "in", str(tmp_path / "in/_types")
    put(folder, "1.csv", "1")
    put(folder, "2.csv", "text")
    put(folder, "3.csv", "2.5")
    assert csv_types.schema(spark, str(folder), state)[0].dataType == T.StringType()
    (folder / "2.csv").unlink()
    assert csv_types.schema(spark, str(folder), state)[0].dataType == T.DoubleType()
    put(folder, "3.csv", "255")
    os.utime(folder / "3.csv", (1, 1))
    assert csv_types.schema(spark, str(folder), state)[0].dataType == T.IntegerType()
    assert csv_types.state_of(spark, state).count() == 2


def test_files_without_rows_and_other_headers(spark, tmp_path):
    folder, state = tmp_path / "in", str(tmp_path / "in/_types")
    put(folder, "1.csv", header="a,b")
    assert sources.csv_inferred(spark, str(folder), state).dtypes == [("a", "string"), ("b", "string")]
    put(folder, "2.csv", "1,x", header="a,b")
    assert sources.csv_inferred(spark, str(folder), state).dtypes == [("a", "int"), ("b", "string")]
    put(folder, "3.csv", "1", header="a")
    with pytest.raises(ValueError, match="3.csv has other columns"):
        sources.csv_inferred(spark, str(folder), state)


def test_weather_with_kept_types(spark, tmp_path):
    put(tmp_path / "in", "1.csv", "1.5,2.5,10,50,2017-08-01", header="lat,lng,avg_tmpr_c,avg_tmpr_f,w_date")
    assert sources.weather_csv(spark, str(tmp_path / "in"), types=str(tmp_path / "in/_types")).first().w_date == dt.date(2017, 8, 1)


HEADER = ",".join(RESTAURANT.names)


def test_lines_that_do_not_fit_are_set_aside(spark, tmp_path):
    lines = ["1,2,A,3,N,x,1.5,2.5", "2,2,A,3,N,x,north,2.5", "3,2.5,A,3,N,x,1.5,2.5", "4,2,A,3,N,x,,", "5,2,A,3,N,x", "6,2,A,3,N,x,1,2,9", "7,,,,,,,"]
    put(tmp_path / "in", "1.csv", *lines, header=HEADER)
    gazetteer = spark.createDataFrame([("x", "N", 7.0, 8.0)], "city string, country string, lat double, lng double")
    sinks.write_parquet(gazetteer, f"{tmp_path}/g")
    for name, job in (("geocode", jobs.geocode), ("complete", jobs.complete_restaurants)):
        done = job(spark, str(tmp_path / "in"), f"{tmp_path}/g", f"{tmp_path}/{name}", set_aside=f"{tmp_path}/bad")
        assert (done, done.set_aside, done.read) == (3, 4, 3)
        assert values(spark.read.parquet(f"{tmp_path}/bad")) == [(x,) for x in (lines[1], lines[2], lines[4], lines[5])]
        assert values(spark.read.parquet(f"{tmp_path}/{name}"), "id", "lat") == [(1, 1.5), (4, 7.0), (7, None)]
    counted = jobs.count_restaurants(spark, str(tmp_path / "in"), f"{tmp_path}/c", RESTAURANT, set_aside=f"{tmp_path}/bad")
    assert (counted, counted.read, counted.set_aside) == (1, 3, 4)
    # Without a place for them, as ever.
    done = jobs.geocode(spark, str(tmp_path / "in"), f"{tmp_path}/g", f"{tmp_path}/all")
    assert (done, done.set_aside) == (7, None)


def test_the_csv_is_read_once(spark, tmp_path, monkeypatch):
    put(tmp_path / "in", "1.csv", "1,2,A,3,N,x,1.5,2.5", "2,2,A,3,N,x,north,2.5", header=HEADER)
    rows, bad = jobs._restaurants(spark, str(tmp_path / "in"), RESTAURANT, f"{tmp_path}/bad")
    assert bad == 1 and rows.schema == RESTAURANT
    assert "FileScan csv" not in plan_of(rows) and "IsNull(_bad_line)" in plan_of(rows)
