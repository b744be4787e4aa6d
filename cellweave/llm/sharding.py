"""Reproducible shuffle into shards: a Feistel permutation of global row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.batches import fresh, shuffle_partitions, stored

#: Rows are numbered in the order of so many hash buckets, and by key within each. The
#: table of where the buckets begin has one row for each, which bounds what is broadcast.
BUCKETS = 4096
#: Rows alike in all keys are split into so many parts for each shuffle partition.
SALTS = 4
ROUNDS = 6
#: Repeated applications tried at first to come back below the number of rows.
WALK = 8

NUMBER, TOTAL = "row_number", "total_rows"


def number_rows(df: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``row_number`` (0, 1, ... without gaps) and ``total_rows``.

    The number depends on the values of ``keys`` and the other rows alone, not on files or
    tasks; rows alike in all ``keys`` take neighbouring numbers in any order, and are numbered
    in as many parts as there are salts, however many they are. Nulls count as values.
    Existing columns of these names are replaced.
    """
    names = ("bucket", "salt", "rows", "start", "of", "part", "before", "place")
    own = dict(zip(names, fresh([*df.columns, NUMBER, TOTAL], *names)))
    salt = F.floor(F.rand(0) * (SALTS * shuffle_partitions(df.sparkSession))).cast("int")
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    # Written down, as a row needs the same salt where it is counted and where it is numbered.
    df = stored(df.drop(NUMBER, TOTAL).withColumns({own["bucket"]: bucket, own["salt"]: salt}))
    sizes = df.groupBy(own["bucket"]).agg(F.count(F.lit(1)).alias(own["rows"]))
    # One row per bucket, so one task is enough for the running sum.
    upto = Window.orderBy(own["bucket"]).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        own["bucket"],
        F.coalesce(F.sum(own["rows"]).over(upto), F.lit(0)).alias(own["start"]),
        F.sum(own["rows"]).over(Window.partitionBy(F.lit(0))).alias(TOTAL),
    )
    # Rows before those of each (keys, salt) in its bucket.
    alike = dict(zip(fresh([*df.columns, *own.values()], *(f"key{i}" for i in range(len(keys)))), keys))
    parts = df.groupBy(own["bucket"], *(F.col(key).alias(name) for name, key in alike.items()), own["salt"]).agg(
        F.count(F.lit(1)).alias(own["rows"])
    )
    within = Window.partitionBy(own["bucket"]).orderBy(*alike, own["salt"]).rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        F.col(own["bucket"]).alias(own["of"]),
        *alike,
        F.col(own["salt"]).alias(own["part"]),
        F.coalesce(F.sum(own["rows"]).over(within), F.lit(0)).alias(own["before"]),
    )
    same = (F.col(own["bucket"]) == F.col(own["of"])) & (F.col(own["salt"]) == F.col(own["part"]))
    for name, key in alike.items():
        same &= F.col(key).eqNullSafe(F.col(name))
    place = F.row_number().over(Window.partitionBy(own["bucket"], *keys, own["salt"]).orderBy(own["salt"]))
    return (
        df.withColumn(own["place"], place)
        .join(before, same)
        .join(F.broadcast(starts), own["bucket"])
        .withColumn(NUMBER, F.col(own["start"]) + F.col(own["before"]) + F.col(own["place"]) - 1)
        .drop(own["bucket"], own["salt"], own["of"], own["part"], own["place"], own["before"], own["start"], *alike)
    )


def whole(x: Column, by: Column) -> Column:
    """Whole part of a quotient, in whole numbers throughout."""
    return F.call_function("div", x, by)


def _once(x: Column, width: Column, height: Column, seed: int, rounds: int) -> Column:
    """A permutation of 0 .. width * height - 1: a Feistel network over (row, column) of a
    grid, in which each round shifts one coordinate by a hash of the other."""
    start = F.struct(whole(x, width).alias("l"), F.pmod(x, width).alias("r"))

    def turn(at: Column, i: Column) -> Column:
        other = F.when(i % 2 == 0, at["r"]).otherwise(at["l"])
        shift = F.xxhash64(F.lit(seed).cast("long"), i.cast("long"), other)
        left = F.when(i % 2 == 0, F.pmod(at["l"] + F.pmod(shift, height), height)).otherwise(at["l"])
        right = F.when(i % 2 == 0, at["r"]).otherwise(F.pmod(at["r"] + F.pmod(shift, width), width))
        return F.struct(left.alias("l"), right.alias("r"))

    steps = F.sequence(F.lit(0), F.lit(rounds - 1))
    return F.aggregate(steps, start, turn, lambda at: at["l"] * width + at["r"])


def permuted(
    number: str | Column, total: str | Column, seed: int = 0, rounds: int = ROUNDS, walk: int = WALK
) -> Column:
    """Where row ``number`` of ``total`` goes. The grid holds hardly more places than there
    are rows; a place beyond them is permuted again, ``walk`` times at most. A result that is
    still beyond says that ``walk`` was too small."""
    number, total = (F.col(c) if isinstance(c, str) else c for c in (number, total))
    root = F.ceil(F.sqrt(total)).cast("long")
    width = F.when(root * root < total, root + 1).otherwise(root)
    height = whole(total + width - 1, width)
    first = _once(number, width, height, seed, rounds)
    again = F.sequence(F.lit(1), F.lit(walk))
    return F.aggregate(
        again, first, lambda x, _: F.when(x < total, x).otherwise(_once(x, width, height, seed, rounds))
    )


def shard_rows(
    df: DataFrame, keys: list[str], shards: int, seed: int = 0, rounds: int = ROUNDS, buckets: int = BUCKETS
) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (0, 1, ... in each shard).

    The law is ``rows``: shards differ by one row at most, however rows look, so hot
    sources, equal texts and long texts need no care. Same rows and seed, same result.
    Rows alike in all ``keys`` are exchangeable. An empty table gives none; nulls are
    ordinary values. Shard and slot of any row number follow from ``permuted`` alone: the
    place modulo, and divided by, the number of shards. Existing columns ``shard``, ``slot``,
    ``row_number`` and ``total_rows`` are replaced.
    """
    numbered = stored(number_rows(df.drop("shard", "slot"), keys, buckets))
    walk, (place,) = WALK, fresh(numbered.columns, "place")
    while True:
        placed = numbered.withColumn(place, permuted(NUMBER, TOTAL, seed, rounds, walk))
        # Ends: a walk has no more steps than the grid has places beyond the rows, plus one.
        if placed.filter(F.col(place) >= F.col(TOTAL)).isEmpty():
            break
        walk *= 4
    return placed.select(
        *numbered.columns,
        F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
        whole(F.col(place), F.lit(shards)).alias("slot"),
    )
