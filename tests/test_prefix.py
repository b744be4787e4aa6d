"""Tables in folders of geohash prefixes."""

import os
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from cellweave import sinks, sources
from cellweave.functions import geohash


def tagged(spark, rows=4000, precision=6):
    points = spark.range(rows).selectExpr("id", "(id * 7919) % 180 - 90.5 lat", "(id * 104729) % 360 - 180.5 lng")
    return points.withColumn("geohash", F.when(F.col("id") % 50 != 0, geohash("lat", "lng", precision)))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("prefix") / "t")
    assert sinks.write_by_prefix(tagged(spark), path) == 4000
    return path


def test_folders_are_bounded_and_rows_come_back(spark, table):
    folders = [x for x in os.listdir(table) if x.startswith("cell_prefix=")]
    assert len(folders) <= 32**2 + 1
    assert "cell_prefix=__HIVE_DEFAULT_PARTITION__" in folders
    assert values(sources.by_prefix(spark, table)) == values(tagged(spark))
    assert values(sources.by_prefix(spark, table, schema=tagged(spark).schema)) == values(tagged(spark))


@pytest.mark.parametrize("cells", [["u"], ["u", "6"], ["6g"], ["6gy", "k"], ["zzzzzz"], ["0"], [], ["u0", "u09", "u09tvw1"]])
def test_some_cells(spark, table, cells):
    want = tagged(spark).filter(F.coalesce(F.col("geohash").rlike("^(" + "|".join([*cells, "none"]) + ")"), F.lit(False)))
    assert values(sources.by_prefix(spark, table, cells)) == values(want)


def test_both_filters_are_in_the_plan(spark, table):
    scan = next(x for x in plan_of(sources.by_prefix(spark, table, ["6gy"]).select("id")).splitlines() if "FileScan" in x)
    partition, pushed = scan.split("PartitionFilters: ")[1].split("PushedFilters: ")
    assert "cell_prefix" in partition and "6gy" in partition
    assert "GreaterThanOrEqual(geohash,6gy)" in pushed and "LessThan(geohash,6gy~)" in pushed
    assert "ReadSchema: struct<id:bigint,geohash:string>" in pushed


def test_files_hold_neighbouring_cells(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_by_prefix(tagged(spark), path, letters=1, partitions=6)
    files = [f for f in Path(path).rglob("*.parquet") if "HIVE_DEFAULT" not in str(f)]
    assert len(files) <= 6 + 32
    for prefix in {f.parent for f in files}:
        spans = []
        for file in prefix.glob("*.parquet"):
            column = pq.read_table(file, columns=["geohash"], partitioning=None)["geohash"].to_pylist()
            assert column == sorted(column)
            spans.append((column[0], column[-1]))
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_a_very_common_cell_is_written_by_several_tasks(spark, tmp_path, settings):
    settings(adaptive__coalescePartitions__enabled="false")
    rows = tagged(spark, 20_000).withColumn("geohash", F.when(F.col("id") % 3 == 0, F.lit("u09tvw")).otherwise(F.col("geohash")))
    sinks.write_by_prefix(rows, f"{tmp_path}/t", partitions=8)
    sizes = [pq.read_metadata(f).num_rows for f in Path(f"{tmp_path}/t/cell_prefix=u0").glob("*.parquet")]
    assert len(sizes) >= 3 and max(sizes) < 20_000 / 4


def test_what_is_refused(spark, tmp_path, table):
    with pytest.raises(ValueError):
        sinks.write_by_prefix(tagged(spark), f"{tmp_path}/t", letters=5)
    with pytest.raises(ValueError):
        sinks.write_by_prefix(tagged(spark).withColumn("cell_prefix", F.lit(1)), f"{tmp_path}/t")
    with pytest.raises(ValueError):
        sources.by_prefix(spark, table, ["u0a"])


def test_rows_without_a_cell_alone_and_no_rows(spark, tmp_path):
    for n, rows in enumerate((tagged(spark).filter("geohash is null"), tagged(spark).filter("false"))):
        sinks.write_by_prefix(rows, f"{tmp_path}/t{n}")
        back = sources.by_prefix(spark, f"{tmp_path}/t{n}", schema=rows.schema)
        assert values(back) == values(rows)
