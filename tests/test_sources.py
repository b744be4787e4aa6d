import datetime as dt
import importlib
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cellweave import sources
from cellweave.plans import jobs
from cellweave.schemas import RESTAURANT, WEATHER
from cellweave.sources.weather_zip import members
from cellweave.testbed.archives import write_archives

# The package has a function of the module's name.
archive_reader = importlib.import_module("cellweave.sources.weather_zip")
HEADER = ",".join(RESTAURANT.names)


def write_text(folder, text):
    (folder / "part.csv").write_text(text)
    return str(folder)


def test_csv_binds_by_position_and_bad_values_become_null(spark, tmp_path):
    path = write_text(tmp_path, f"{HEADER}\n1,2,A,3,N,x,1.5,2.5\n2,2,A,3,,,bad,\n")
    rows = sources.restaurants_csv(spark, path)
    assert rows.schema == RESTAURANT
    assert values(rows) == [(1, 2, "A", 3, "N", "x", 1.5, 2.5), (2, 2, "A", 3, None, None, None, None)]


def test_csv_header_is_checked_on_request(spark, tmp_path):
    swapped = HEADER.replace("lat,lng", "lng,lat")
    path = write_text(tmp_path, f"{swapped}\n1,2,A,3,N,x,1.5,2.5\n")
    assert sources.restaurants_csv(spark, path).first().lat == 1.5
    with pytest.raises(Exception, match="(?i)header"):
        sources.restaurants_csv(spark, path, check_header=True).collect()


def test_csv_types_are_inferred(spark, tmp_path):
    path = write_text(tmp_path, f"{HEADER}\n1,2,A,3,N,x,1.5,2.5\n")
    assert dict(sources.csv_inferred(spark, path).dtypes)["lat"] == "double"


def test_weather_csv(spark, tmp_path):
    path = write_text(tmp_path, "lat,lng,avg_tmpr_c,avg_tmpr_f,w_date\n1.5,2.5,10,50,2017-08-01\n")
    assert sources.weather_csv(spark, path).first().w_date == dt.date(2017, 8, 1)
    assert sources.weather_csv(spark, path, WEATHER).first().w_date == "2017-08-01"


def test_parquet_under_a_schema(spark, tmp_path):
    spark.range(1).selectExpr("'x' city", "1.5D lat", "id").write.parquet(f"{tmp_path}/p")
    assert sources.parquet(spark, f"{tmp_path}/p").columns == ["city", "lat", "id"]
    row = sources.parquet(spark, f"{tmp_path}/p", RESTAURANT).first()
    assert tuple(row) == (0, None, None, None, None, "x", 1.5, None)


def test_days_select_folders(spark, tmp_path):
    days = spark.range(60).select(F.date_add(F.lit("2016-12-15").cast("date"), F.col("id").cast("int")).alias("d"))
    days.selectExpr("1.0D lat", "year(d) year", "month(d) month", "day(d) day").write.partitionBy(
        "year", "month", "day"
    ).parquet(f"{tmp_path}/w")
    some = sources.weather_parquet(spark, f"{tmp_path}/w", dt.date(2016, 12, 30), dt.date(2017, 1, 2))
    assert values(some, "year", "month", "day") == [(2016, 12, 30), (2016, 12, 31), (2017, 1, 1), (2017, 1, 2)]
    scan = next(line for line in plan_of(some).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull" in scan or "PartitionFilters: [((" in scan
    assert "DataFilters: []" in scan
    assert sources.weather_parquet(spark, f"{tmp_path}/w").count() == 60


@pytest.mark.parametrize("cells", [["0123", "12e4", "7777"], ["0123", "123d"], ["u09t", None, "0123"]])
def test_geohash_folders_stay_text(spark, tmp_path, cells):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "id long, geohash string")
    rows.write.partitionBy("geohash").parquet(f"{tmp_path}/t")
    for schema in (None, rows.schema):
        back = sources.by_geohash(spark, f"{tmp_path}/t", schema)
        assert back.schema["geohash"].dataType == StringType()
        assert values(back, "id", "geohash") == values(rows)
        one = back.filter(F.col("geohash") == "0123")
        assert one.count() == 1
        assert "PartitionFilters: [isnotnull(geohash" in plan_of(one)


def parquet_bytes(**columns):
    sink = pa.BufferOutputStream()
    pq.write_table(pa.table(columns), sink)
    return sink.getvalue().to_pybytes()


def make_zip(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)


def reading(value):
    return parquet_bytes(
        lat=[value], lng=[value], avg_tmpr_c=[value], avg_tmpr_f=pa.array([value], pa.float32()), extra=["e"]
    )


@pytest.fixture
def zips(tmp_path):
    make_zip(
        tmp_path / "in/one.zip",
        {
            "weather/year=2016/month=10/day=01/a.parquet": reading(1.0),
            "weather/year=2016/month=10/day=02/a.parquet": reading(2.0),
            "weather/year=2016/month=10/day=02/b.parquet": reading(3.0),
            "weather/year=2016/month=10/day=02/notes.txt": b"no",
            "weather/readme.parquet": b"not below a year",
        },
    )
    make_zip(
        tmp_path / "in/deeper still/é#%20/two.zip",
        {
            "top/weather/old/weather/year=2017/month=09/day=30/a.parquet": reading(4.0),
            "weather/year=2016/month=10/day=01/a.parquet": reading(5.0),
        },
    )
    make_zip(tmp_path / "in/three.ZIP", {"weather/year=2018/month=01/day=01/a.parquet": reading(6.0)})
    (tmp_path / "in/other.txt").write_text("no archive")
    return str(tmp_path / "in")


def test_members_listed(spark, zips):
    listed = members(spark, zips)
    assert values(listed, "place", "file", "year", "month", "day") == [
        ("year=2016/month=10/day=01", "a.parquet", "2016", "10", "01"),
        ("year=2016/month=10/day=02", "a.parquet", "2016", "10", "02"),
        ("year=2016/month=10/day=02", "b.parquet", "2016", "10", "02"),
        ("year=2017/month=09/day=30", "a.parquet", "2017", "09", "30"),
    ]


def test_zip_rows_and_keys(spark, zips):
    rows = sources.weather_zip(spark, zips)
    assert rows.columns == ["lat", "lng", "avg_tmpr_c", "avg_tmpr_f", "extra", "year", "month", "day"]
    # The same file of the same day is in both archives; the last by path counts.
    assert values(rows, "lat", "avg_tmpr_f", "extra", "year", "month", "day") == [
        (1.0, 1.0, "e", 2016, 10, 1),
        (2.0, 2.0, "e", 2016, 10, 2),
        (3.0, 3.0, "e", 2016, 10, 2),
        (4.0, 4.0, "e", 2017, 9, 30),
    ]


@pytest.mark.parametrize("comment", [b"", b"nothing to report"])
def test_archives_without_members(spark, zips, tmp_path, comment):
    rows = values(sources.weather_zip(spark, zips))
    # "a" and "z": before and after the others by path.
    for path in ("in/a.zip", "in/z.zip", "alone/a.zip"):
        make_zip(tmp_path / path, {})
        with zipfile.ZipFile(tmp_path / path, "a") as archive:
            archive.comment = comment
    assert values(sources.weather_zip(spark, zips)) == rows
    assert archive_reader.copy_members(spark, zips, f"{tmp_path}/out") == len(rows)
    nothing = sources.weather_zip(spark, f"{tmp_path}/alone")
    assert nothing.count() == 0
    assert nothing.columns[-3:] == ["year", "month", "day"]
    assert archive_reader.copy_members(spark, f"{tmp_path}/alone", f"{tmp_path}/out") == 0


def grouped(rows, groups):
    """A Parquet file of so many row groups."""
    sink = pa.BufferOutputStream()
    numbers = [float(i * 7 % 1000) for i in range(rows)]
    table = pa.table({"lat": numbers, "lng": numbers, "text": [f"t{i}" for i in range(rows)]})
    pq.write_table(table, sink, row_group_size=rows // groups)
    return sink.getvalue().to_pybytes()


@pytest.mark.parametrize("packing", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
@pytest.mark.parametrize("groups", [1, 2, 40])
def test_members_of_any_number_of_row_groups(spark, tmp_path, packing, groups):
    with zipfile.ZipFile(tmp_path / "one.zip", "w", packing) as archive:
        for day in (1, 2):
            archive.writestr(f"weather/year=2016/month=10/day={day}/a.parquet", grouped(4000, groups))
    rows = sources.weather_zip(spark, str(tmp_path))
    assert rows.count() == 8000
    assert values(rows.filter("day = 2"), "lat", "text") == sorted(
        ((float(i * 7 % 1000), f"t{i}") for i in range(4000)), key=repr
    )


@pytest.mark.parametrize("groups", [2, 40])
def test_a_member_is_unpacked_once(tmp_path, monkeypatch, groups):
    content = grouped(200_000, groups)
    path = tmp_path / "one.zip"
    make_zip(path, {"weather/year=2016/month=10/day=1/a.parquet": content})
    unpacked = []
    plain = zipfile.ZipExtFile.read

    def read(self, n=-1):
        got = plain(self, n)
        unpacked.append(len(got))
        return got

    monkeypatch.setattr(zipfile.ZipExtFile, "read", read)
    row = {"archive": [str(path)], "position": [0], "place": ["year=2016/month=10/day=1"], "file": ["a.parquet"]}
    copied = next(archive_reader._copy_members(f"{tmp_path}/out")(iter([pa.RecordBatch.from_pydict(row)]))).to_pylist()
    assert [x["rows"] for x in copied] == [200_000]
    assert (tmp_path / "out/year=2016/month=10/day=1/a.parquet").read_bytes() == content
    assert sum(unpacked) == len(content)


def test_a_member_is_read_by_several_tasks_and_pruned(spark, tmp_path, settings):
    make_zip(
        tmp_path / "one.zip",
        {f"weather/year=2016/month=10/day={day}/a.parquet": grouped(200_000, 40) for day in (1, 2)},
    )
    settings(files__maxPartitionBytes="64k", files__openCostInBytes="1k")
    some = sources.weather_zip(spark, str(tmp_path)).filter("day = 2 and lat > 500").select("lng")
    assert some.groupBy(F.spark_partition_id()).count().count() > 4
    plan = plan_of(some)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1
    assert "day#" in scans[0].split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "GreaterThan(lat,500.0)" in scans[0]
    assert "ReadSchema: struct<lat:double,lng:double>" in scans[0]


def test_a_member_that_is_no_parquet_is_named_and_leaves_nothing(spark, tmp_path):
    make_zip(tmp_path / "in/one.zip", {"weather/year=2016/month=10/day=02/odd.parquet": b"PAR1 or so"})
    with pytest.raises(Exception, match=r"day=02/odd\.parquet"):
        jobs.unpack_weather(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert [x for x in (tmp_path / "out").rglob("*") if x.is_file()] == []


def test_a_value_that_does_not_fit_is_an_error(spark, tmp_path):
    make_zip(tmp_path / "one.zip", {"weather/year=2016/month=10/day=02/a.parquet": parquet_bytes(lat=[1.0, 2.5])})
    whole = sources.weather_zip(spark, str(tmp_path), StructType([StructField("lat", LongType())]))
    with pytest.raises(Exception, match="lat is to be bigint, but holds 2.5"):
        whole.collect()


def test_members_of_one_name_from_different_places(spark, tmp_path):
    make_zip(
        tmp_path / "one.zip",
        {
            "weather/a/year=2016/month=10/day=01/x.parquet": reading(1.0),
            "weather/b/year=2016/month=10/day=01/x.parquet": reading(2.0),
            "weather/year=2016/x.parquet": reading(3.0),
        },
    )
    assert values(sources.weather_zip(spark, str(tmp_path)), "lat", "year", "month", "day") == [
        (1.0, 2016, 10, 1),
        (2.0, 2016, 10, 1),
        (3.0, 2016, None, None),
    ]


def test_columns_and_types_of_all_members(spark, tmp_path):
    make_zip(
        tmp_path / "one.zip",
        {
            "weather/year=2016/month=10/day=01/a.parquet": parquet_bytes(lat=[1], lng=[1.5]),
            "weather/year=2016/month=10/day=02/a.parquet": parquet_bytes(lat=[2.5], lng=[3], wind=["n"]),
            "weather/year=2016/month=10/day=03/a.parquet": parquet_bytes(lat=pa.array([4], pa.int32())),
        },
    )
    rows = sources.weather_zip(spark, str(tmp_path))
    assert [t for _, t in rows.dtypes[:3]] == ["double", "double", "string"]
    assert values(rows, "lat", "lng", "wind", "day") == [
        (1.0, 1.5, None, 1),
        (2.5, 3.0, "n", 2),
        (4.0, None, None, 3),
    ]


def test_members_that_do_not_go_together_are_named(spark, tmp_path):
    make_zip(
        tmp_path / "one.zip",
        {
            "weather/year=2016/month=10/day=01/a.parquet": parquet_bytes(lat=[1.0]),
            "weather/year=2016/month=10/day=02/odd.parquet": parquet_bytes(lat=["north"]),
        },
    )
    with pytest.raises(ValueError, match=r"day=02/odd\.parquet"):
        sources.weather_zip(spark, str(tmp_path))


def test_uneven_members_make_even_tasks(spark, tmp_path):
    small = {f"weather/year=2016/month=10/day={d:02d}/a.parquet": grouped(200, 1) for d in range(1, 25)}
    large = {f"weather/year=2016/month=11/day={d:02d}/a.parquet": grouped(4000, 1) for d in range(1, 5)}
    make_zip(tmp_path / "a.zip", small)
    make_zip(tmp_path / "b.zip", large)
    dealt = archive_reader._dealt(members(spark, str(tmp_path)), archive_reader.TASK_BYTES)
    sizes = sorted(row.all for row in dealt.groupBy(F.spark_partition_id()).agg(F.sum("bytes").alias("all")).collect())
    assert len(sizes) == 4
    assert sizes[-1] <= 2 * sum(sizes) / 4
    assert sources.weather_zip(spark, str(tmp_path)).count() == 24 * 200 + 4 * 4000


def test_second_delivery_replaces_files_of_the_same_name(spark, tmp_path):
    first, second, target = tmp_path / "1", tmp_path / "2", str(tmp_path / "out")
    day = "weather/year=2016/month=10/day=0"
    make_zip(first / "a.zip", {f"{day}1/a.parquet": reading(1.0), f"{day}1/b.parquet": reading(2.0), f"{day}2/a.parquet": reading(3.0)})
    make_zip(second / "a.zip", {f"x/{day}1/b.parquet": reading(4.0), f"{day}3/a.parquet": reading(5.0)})
    assert jobs.unpack_weather(spark, str(first), target) == 3
    untouched = tmp_path / "out/year=2016/month=10/day=02/a.parquet"
    before = untouched.stat().st_mtime_ns
    assert jobs.unpack_weather(spark, str(second), target) == 2
    assert untouched.stat().st_mtime_ns == before
    assert values(sources.weather_parquet(spark, target), "lat", "day") == [(1.0, 1), (3.0, 2), (4.0, 1), (5.0, 3)]
    assert sorted(p.name for p in (tmp_path / "out/year=2016/month=10/day=01").iterdir()) == ["a.parquet", "b.parquet"]


def test_zip_under_a_schema(spark, zips):
    rows = sources.weather_zip(spark, zips, WEATHER, key_type="string")
    assert values(rows, "avg_tmpr_f", "w_date", "day") == [
        (1.0, None, "01"),
        (2.0, None, "02"),
        (3.0, None, "02"),
        (4.0, None, "30"),
    ]


def test_no_archives(spark, tmp_path):
    assert sources.weather_zip(spark, str(tmp_path)).count() == 0


def test_one_archive_is_read_by_several_tasks(spark, tmp_path):
    make_zip(
        tmp_path / "one.zip",
        {f"weather/year=2016/month=10/day={day:02d}/a.parquet": reading(float(day)) for day in range(1, 9)},
    )
    rows = sources.weather_zip(spark, str(tmp_path))
    tasks = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 4
    assert values(rows, "day") == [(day,) for day in range(1, 9)]


def test_archives_made_from_readings(spark, tmp_path):
    days = spark.range(500).selectExpr(
        "cast(id as double) lat",
        "2.0D lng",
        "1.0D avg_tmpr_c",
        "1.0D avg_tmpr_f",
        "2016 year",
        "cast(1 + id % 12 as int) month",
        "cast(1 + id % 28 as int) day",
    )
    write_archives(days, str(tmp_path))
    assert values(sources.weather_zip(spark, str(tmp_path))) == values(days)
