import math
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from cellweave.llm import sharding


def spark_hash(*values):
    out = 42
    for value in values:
        out = xxhash.xxh64_intdigest(struct.pack("<q", value), out)
    return out - (1 << 64) if out >= 1 << 63 else out


def place(number, total, seed, rounds=sharding.ROUNDS):
    """The same permutation, by hand."""
    width = math.isqrt(total - 1) + 1
    height = -(-total // width)
    x = number
    while True:
        left, right = divmod(x, width)
        for i in range(rounds):
            shift = spark_hash(seed, i, right if i % 2 == 0 else left)
            if i % 2 == 0:
                left = (left + shift % height) % height
            else:
                right = (right + shift % width) % width
        x = left * width + right
        if x < total:
            return x


@pytest.mark.parametrize("total", [1, 2, 3, 5, 10, 97, 1000])
def test_the_permutation(spark, total):
    rows = spark.range(total).select("id", sharding.permuted("id", F.lit(total).cast("long"), 5, walk=64).alias("to"))
    got = {row.id: row.to for row in rows.collect()}
    assert sorted(got.values()) == list(range(total))
    assert got == {i: place(i, total, 5) for i in range(total)}


@pytest.fixture
def docs(spark):
    rows = [(i % 90, f"text {i % 7}", i % 3) for i in range(200)] + [(None, None, 0), (None, None, 0), (5, None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, slot int")


def test_shards_are_even_and_slots_have_no_gaps(docs):
    rows = sharding.shard_rows(docs, ["doc_id", "text"], 24, seed=3).collect()
    assert len(rows) == 203
    sizes = Counter(row.shard for row in rows)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(24):
        assert sorted(row.slot for row in rows if row.shard == shard) == list(range(sizes[shard]))
    assert sorted(row.row_number for row in rows) == list(range(203))
    for row in rows:
        assert divmod(place(row.row_number, 203, 3), 24) == (row.slot, row.shard)


def test_the_result_does_not_depend_on_the_layout(docs):
    def result(df):
        rows = sharding.shard_rows(df, ["doc_id", "text"], 5).select("doc_id", "text", "shard", "slot").collect()
        return sorted(rows, key=lambda row: (row.shard, row.slot))

    assert result(docs) == result(docs.repartition(7)) == result(docs.orderBy(F.rand(1)))
    other = sharding.shard_rows(docs, ["doc_id", "text"], 5, seed=1).select("doc_id", "shard", "slot").collect()
    assert sorted(other, key=lambda row: (row.shard, row.slot)) != [(r.doc_id, r.shard, r.slot) for r in result(docs)]


def test_a_short_walk_is_made_longer(docs, monkeypatch):
    monkeypatch.setattr(sharding, "WALK", 1)
    rows = sharding.shard_rows(docs.limit(3), ["doc_id", "text"], 2).collect()
    assert sorted((row.shard, row.slot) for row in rows) == [(0, 0), (0, 1), (1, 0)]


def test_no_rows(docs):
    assert sharding.shard_rows(docs.limit(0), ["doc_id"], 3).count() == 0


def test_rows_that_are_alike_are_numbered_in_many_tasks(spark, settings):
    settings(adaptive__enabled="false", autoBroadcastJoinThreshold="-1")
    rows = spark.range(5000).select(
        F.when(F.col("id") % 5 == 0, F.col("id")).alias("doc_id"), F.lit("one text").alias("text")
    )
    numbered = sharding.number_rows(rows, ["doc_id", "text"]).withColumn("task", F.spark_partition_id()).collect()
    assert sorted(row.row_number for row in numbered) == list(range(5000))
    alike = [row for row in numbered if row.doc_id is None]
    assert max(Counter(row.task for row in alike).values()) < 0.7 * len(alike)
    numbers = [row.row_number for row in alike]
    assert max(numbers) - min(numbers) == len(alike) - 1


def test_no_python_in_the_plan(docs):
    plan = sharding.shard_rows(docs, ["doc_id", "text"], 3)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_names_that_the_operator_uses_are_kept(spark):
    rows = spark.range(50).selectExpr("id", "id as __salt", "'b' as __BUCKET", "1 as __place", "2 as __key0")
    got = sharding.shard_rows(rows, ["id"], 3)
    assert got.columns[:5] == rows.columns and len(got.columns) == 9
    assert got.filter("__salt = id and __BUCKET = 'b' and __place = 1 and __key0 = 2").count() == 50
    assert sorted(row.slot * 3 + row.shard for row in got.collect()) == list(range(50))
