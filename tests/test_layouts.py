"""Folders of Parquet files that differ in columns and types."""

import datetime as dt
import itertools
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import plan_of, values
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from cellweave import sources
from cellweave.plans import jobs
from cellweave.sources import layouts


def put(root, place, **columns):
    folder = root / place
    folder.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), folder)


KINDS = [
    T.NullType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
    T.DecimalType(10, 2), T.DecimalType(38, 0), T.DateType(), T.TimestampNTZType(), T.TimestampType(), T.StringType(),
    T.ArrayType(T.IntegerType()), T.ArrayType(T.DoubleType()), T.MapType(T.StringType(), T.LongType()),
    T.StructType().add("a", T.IntegerType()), T.StructType().add("A", T.DoubleType()).add("b", T.StringType()),
]


def joined(*kinds):
    out = kinds[0]
    for kind in kinds[1:]:
        try:
            out = layouts.widest(out, kind)
        except layouts.NothingInCommon:
            return None
    return out


def folded(kind):
    """A type without the case and order of its field names."""
    if isinstance(kind, T.StructType):
        return tuple(sorted((f.name.lower(), folded(f.dataType)) for f in kind))
    return str(kind)


@hypothesis_settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(KINDS), min_size=1, max_size=4))
def test_order_of_types_does_not_matter(kinds):
    # A number too wide for any decimal becomes a fraction, so decimals go on their own.
    kinds = [k for k in kinds if not isinstance(k, T.DecimalType)] or kinds[:1]
    assert len({folded(joined(*order)) for order in itertools.permutations(kinds)}) == 1
    assert joined(kinds[0], kinds[0]) == kinds[0]


def test_types_that_hold_both():
    assert layouts.widest(T.IntegerType(), T.FloatType()) == T.DoubleType()
    assert layouts.widest(T.LongType(), T.ShortType()) == T.LongType()
    assert layouts.widest(T.DecimalType(10, 2), T.IntegerType()) == T.DecimalType(12, 2)
    assert layouts.widest(T.DecimalType(38, 0), T.DecimalType(4, 4)) == T.DoubleType()
    assert layouts.widest(T.DateType(), T.TimestampType()) == T.TimestampType()
    with pytest.raises(layouts.NothingInCommon):
        layouts.widest(T.StringType(), T.LongType())


@pytest.fixture
def mixed(tmp_path):
    root = tmp_path / "w"
    put(root, "year=2016/month=10/day=01/a.parquet", lat=[1], lng=[1.5])
    put(root, "year=2016/month=10/day=02/a.parquet", lat=[2], lng=[2.5])
    put(root, "year=2016/month=11/day=01/a.parquet", lat=[3.5], lng=[3.5], Note=["x"])
    put(root, "year=2016/month=11/day=01/b.parquet", lat=[4], lng=pa.array([4], pa.int32()), note=["y"])
    put(root, "year=2017/month=01/day=01/a.parquet", lat=[5.5], lng=[None])
    put(root, "year=2017/month=01/day=01/_draft", lat=["no"])
    return root


def test_rows_of_all_layouts(spark, mixed):
    rows = sources.weather_parquet(spark, str(mixed))
    assert rows.dtypes == [("lat", "double"), ("lng", "double"), ("Note", "string"), ("year", "int"), ("month", "int"), ("day", "int")]
    assert values(rows) == [
        (1.0, 1.5, None, 2016, 10, 1),
        (2.0, 2.5, None, 2016, 10, 2),
        (3.5, 3.5, "x", 2016, 11, 1),
        (4.0, 4.0, "y", 2016, 11, 1),
        (5.5, None, None, 2017, 1, 1),
    ]
    some = sources.weather_parquet(spark, str(mixed), dt.date(2016, 10, 2), dt.date(2016, 11, 30))
    assert values(some, "lat", "day") == [(2.0, 2), (3.5, 1), (4.0, 1)]


def test_filters_and_columns_reach_every_scan(spark, mixed):
    rows = sources.weather_parquet(spark, str(mixed)).filter("month = 10 and lng > 1").select("lat")
    scans = [line for line in plan_of(rows).splitlines() if "FileScan" in line]
    assert len(scans) > 1
    assert all("PartitionFilters: [isnotnull(month" in line for line in scans)
    assert all("IsNotNull(lng)" in line and "note" not in line.lower() for line in scans)


def test_a_layout_is_read_from_its_topmost_folders(spark, mixed):
    files = layouts.listed(spark, str(mixed))
    kinds = files.selectExpr("path", "cast(path like '%month=11%b.parquet' as int) kind")
    found = {kind: [p.split("/w/", 1)[-1] for p in paths] for kind, paths in layouts.places(kinds).items()}
    assert found == {
        0: ["year=2016/month=10", "year=2016/month=11/day=01/a.parquet", "year=2017"],
        1: ["year=2016/month=11/day=01/b.parquet"],
    }


def test_files_that_differ_in_columns_are_one_scan(spark, tmp_path):
    put(tmp_path, "p/a.parquet", lat=[1.0])
    put(tmp_path, "p/b.parquet", lat=[2.0], more=[1])
    rows = layouts.read(spark, f"{tmp_path}/p")
    assert plan_of(rows).count("FileScan") == 1
    assert values(rows) == [(1.0, None), (2.0, 1)]


def test_nested_columns_are_widened(spark, tmp_path):
    put(tmp_path, "p/a.parquet", s=[{"a": 1}, None], l=[[1], None], m=pa.array([[("k", 1)], None], pa.map_(pa.string(), pa.int32())))
    put(tmp_path, "p/b.parquet", s=[{"a": 1.5, "b": "x"}], l=[[2.5]], m=pa.array([[("k", 1.5)]], pa.map_(pa.string(), pa.float64())))
    rows = layouts.read(spark, f"{tmp_path}/p").selectExpr("s.a", "s.b", "s is null", "l", "m['k'] k")
    assert values(rows) == [(1.0, None, False, [1.0], 1.0), (1.5, "x", False, [2.5], 1.5), (None, None, True, None, None)]


def test_types_with_nothing_in_common_name_a_file(spark, tmp_path):
    put(tmp_path, "p/a.parquet", lat=[1.0])
    put(tmp_path, "p/b.parquet", lat=["north"])
    with pytest.raises(ValueError, match=r"b\.parquet: lat: double and string"):
        layouts.read(spark, f"{tmp_path}/p")


def test_tables_of_footers_are_removed(spark, mixed):
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.iterdir())
    assert layouts.read(spark, str(mixed)).count() == 5
    assert set(shared.iterdir()) == before


def test_recompressed_folders_are_of_one_layout(spark, mixed, tmp_path):
    assert jobs.recompress(spark, str(mixed), f"{tmp_path}/out")
    rows = sources.parquet(spark, f"{tmp_path}/out")
    assert rows.count() == 5 and dict(rows.dtypes)["lat"] == "double" and "Note" in rows.columns
