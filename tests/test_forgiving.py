"""Lookups of places that are not written as in the gazetteer."""

import random

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from cellweave.operators import forgiving, geocode
from cellweave.schemas import CITY_KEYS, TEXT_KEYS

PLACES = [
    ("Köln", "Germany", 1.0, 1.0),
    ("Bonn", "Germany", 2.0, 2.0),
    ("Born", "Germany", 3.0, 3.0),
    ("Saint-Étienne", "France", 4.0, 4.0),
    ("District 9", "France", 5.0, 5.0),
    ("District 8", "France", 6.0, 6.0),
    ("Ulm", "Germany", 7.0, 7.0),
    ("Ulm", "Germany", 7.0, 6.0),
    ("??", "Germany", 8.0, 8.0),
    ("Łódź", None, 9.0, 9.0),
    ("Nowhere", "France", None, 1.0),
    ("x" * 100, "Germany", 10.0, 10.0),
]


@pytest.fixture
def places(spark):
    return spark.createDataFrame(PLACES, "city string, country string, lat double, lng double")


def asked(spark, *pairs):
    rows = [(i, *pair, None, None) for i, pair in enumerate(pairs)]
    return spark.createDataFrame(rows, "id int, city string, country string, lat double, lng double")


@pytest.mark.parametrize(
    "city,country,edits,found",
    [
        ("Köln", "Germany", 0, 1.0),
        (" KOLN ", "germany", 0, 1.0),
        ("Kölln", "Germany", 1, 1.0),
        ("Kol", "Germany", 1, 1.0),
        ("saint etienne", "FRANCE", 0, 4.0),
        ("Saint Etiene", "Frence", 2, 4.0),
        ("St Etienne", "France", None, None),
        ("District 7", "France", None, None),
        ("Distrikt 8", "France", 1, 6.0),
        ("District 89", "France", None, None),
        # One edit from both: the first by its keys.
        ("Bohn", "Germany", 1, 2.0),
        ("Ulm", "Germany", 0, 7.0),
        ("!!", "Germany", None, None),
        ("??", "Germany", 0, 8.0),
        ("Nowhere", "France", None, None),
        ("Lodz", None, None, None),
        ("", "", None, None),
        ("x" * 100, "germany", 0, 10.0),
        ("x" * 99, "Germany", None, None),
    ],
)
def test_what_is_forgiven(spark, places, city, country, edits, found):
    rows = forgiving.answers(asked(spark, (city, country)), places, CITY_KEYS, most_edits=2).collect()
    assert [(r.edits, r.lat) for r in rows] == ([] if found is None else [(edits, found)])


def test_short_names_are_not_forgiven(spark):
    places = spark.createDataFrame([("Ab", "", 1.0, 1.0), ("Abcd", "", 2.0, 2.0)], "city string, country string, lat double, lng double")
    rows = asked(spark, ("Ac", "z"), ("Abce", ""))
    assert values(forgiving.answers(rows, places, CITY_KEYS), "city") == []


def test_questions_as_one_text(spark):
    places = spark.createDataFrame([("f abcd x", 3.0, 3.0)], "query string, lat double, lng double")
    rows = asked(spark, ("Abce", "x"), ("Abcd", None)).withColumn("franchise_name", F.lit("F"))
    found = forgiving.answers(rows, places, TEXT_KEYS)
    assert values(found, "query", "lat", "place.query") == [("F, Abce, x", 3.0, "f abcd x")]
    filled = geocode.fill_gaps(rows, found.select("query", "lat", "lng"), TEXT_KEYS)
    assert values(filled, "city", "lat") == [("Abcd", None), ("Abce", 3.0)]


def test_all_within_reach_are_found(spark):
    """Against comparing every pair."""
    rng = random.Random(4)
    names = sorted({"".join(rng.choice("abé1 ") for _ in range(rng.randint(3, 9))) for _ in range(120)})
    rows = [(n, rng.choice(["aab", "aba"]), float(i), 1.0) for i, n in enumerate(names)]
    places = spark.createDataFrame(rows[::2], "city string, country string, lat double, lng double")
    questions = asked(spark, *[(r[0], r[1]) for r in rows])
    got = forgiving.answers(questions, places, CITY_KEYS, most_edits=2, letters_per_edit=3)
    a = questions.select(F.col("city").alias("c"), F.col("country").alias("k"))
    plain = [(forgiving.plain(F.col(x)), forgiving.plain(F.col(y))) for x, y in (("c", "city"), ("k", "country"))]
    edits = sum((F.levenshtein(x, y) for x, y in plain), F.lit(0))
    text = F.concat(plain[0][0], plain[1][0])
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    digits = [F.regexp_replace(F.concat_ws("|", *side), r"\P{N}+", " ") for side in zip(*plain)]
    same = (F.col("c") == F.col("city")) & (F.col("k") == F.col("country"))
    near = (plain[0][0] != "") & (plain[0][1] != "") & (digits[0] == digits[1]) & (edits <= F.least(F.lit(2), F.floor(letters / 3)))
    every = a.crossJoin(places).filter(same | near).withColumn("edits", F.when(same, 0).otherwise(edits))
    want = every.groupBy("c", "k").agg(F.min(F.struct(~same, "edits", "city", "country")).alias("best"))
    assert values(got.select("city", "country", "edits", "place.city")) == values(want.select("c", "k", "best.edits", "best.city"))
    assert got.filter("edits > 0").count() > 10


def test_pairs_are_found_by_an_equal_join(spark, places, settings):
    settings(autoBroadcastJoinThreshold="-1")
    plan = plan_of(forgiving.answers(asked(spark, ("Koln", "Germany")), places, CITY_KEYS, most_edits=2))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "SortMergeJoin [rest#" in plan


def test_rests_of_long_names_are_few(spark):
    row = spark.range(1).select(F.size(forgiving.rests(F.lit("a" * 200), 2)), F.size(forgiving.rests(F.lit("abcd"), 2)), F.size(forgiving.rests(F.lit("a1|2"), 2))).first()
    assert tuple(row) == (1, 1 + 4 + 6, 1 + 3 + 3)
