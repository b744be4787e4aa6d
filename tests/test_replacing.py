"""A table at a target is replaced by a whole one or not at all."""

import os

import pytest
from conftest import values
from pyspark.sql import functions as F

from cellweave import sinks, sources
from cellweave.plans import jobs


def half(spark):
    """Rows of which the second partition can not be computed."""
    broken = F.when(F.col("id") == 7, F.raise_error(F.lit("no more rows"))).otherwise(F.col("id"))
    return spark.range(0, 10, 1, 2).select(broken.cast("long").alias("id"))


WRITERS = {
    "plain": lambda df, path: sinks.write_parquet(df, path),
    "cells": lambda df, path: sinks.write_by_geohash(df.withColumn("geohash", F.concat(F.lit("u09"), F.col("id") % 2)), path),
    "these cells": lambda df, path: sinks.write_by_geohash(
        df.withColumn("geohash", F.concat(F.lit("u09"), F.col("id") % 2)), path, only_these_cells=True
    ),
    "days": lambda df, path: sinks.write_by_date(df.selectExpr("id", "2016 year", "10 month", "cast(id % 3 as int) day"), path),
}


@pytest.mark.parametrize("name", WRITERS)
def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, tmp_path, name):
    write, path = WRITERS[name], f"{tmp_path}/t"
    assert write(spark.range(100, 104), path) == 4
    with pytest.raises(Exception, match="no more rows"):
        write(half(spark), path)
    assert values(spark.read.parquet(path), "id") == [(i,) for i in range(100, 104)]
    assert [x for x in os.listdir(tmp_path) if x.startswith("_")] == []
    assert write(spark.range(3), path) == 3
    left = values(spark.read.parquet(path), "id")
    assert left[:3] == [(0,), (1,), (2,)]
    assert len(left) == 3 or name == "these cells"
    assert os.listdir(tmp_path) == ["t"]


def test_the_first_write_that_fails_leaves_nothing(spark, tmp_path):
    with pytest.raises(Exception, match="no more rows"):
        sinks.write_parquet(half(spark), f"{tmp_path}/t")
    assert os.listdir(tmp_path) == []


def test_a_table_is_written_over_itself(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_parquet(spark.range(5), path)
    assert sinks.write_parquet(spark.read.parquet(path).filter("id > 1"), path) == 3
    assert values(spark.read.parquet(path)) == [(2,), (3,), (4,)]


def test_weather_is_recompressed_in_place(spark, tmp_path):
    path = f"{tmp_path}/w"
    sinks.write_by_date(spark.range(5).selectExpr("id", "2016 year", "10 month", "cast(id as int) day"), path, codec="snappy")
    assert jobs.recompress(spark, path, path)
    assert values(sources.parquet(spark, path), "id", "day") == [(i, i) for i in range(5)]


def test_recompress_that_fails_leaves_the_target(spark, tmp_path):
    sinks.write_parquet(spark.range(5), f"{tmp_path}/t")
    (tmp_path / "w/year=2016").mkdir(parents=True)
    (tmp_path / "w/year=2016/a.parquet").write_bytes(b"PAR1 and no more")
    assert not jobs.recompress(spark, f"{tmp_path}/w", f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 5


def test_a_swap_that_was_cut_short_is_undone(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    sinks.write_parquet(spark.range(5), path)

    class Killed(BaseException):
        pass

    moves = []
    plain = sinks.move

    def move(spark, source, target):
        moves.append(target)
        if len(moves) == 2:
            raise Killed
        plain(spark, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "move", move)
        # Nor is there time to tidy up.
        patch.setattr(sinks, "recover", lambda *args: None)
        with pytest.raises(Killed):
            sinks.write_parquet(spark.range(9), path)
    assert not os.path.exists(path)
    assert sinks.recover(spark, path)
    assert spark.read.parquet(path).count() == 5
    assert not sinks.recover(spark, path)
    assert os.listdir(tmp_path) == ["t"]


def test_names_that_begin_alike_are_told_apart(spark, tmp_path):
    sinks.write_parquet(spark.range(1), f"{tmp_path}/t")
    sinks.write_parquet(spark.range(2), f"{tmp_path}/t-2")
    os.rename(f"{tmp_path}/t-2", f"{tmp_path}/_cellweave-old-{'0' * 32}-t-2")
    sinks.write_parquet(spark.range(3), f"{tmp_path}/t")
    assert sinks.recover(spark, f"{tmp_path}/t-2")
    assert spark.read.parquet(f"{tmp_path}/t-2").count() == 2
