import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from cellweave.functions import packed_lat, packed_lng, query_text
from cellweave.operators import filters, geocode
from cellweave.schemas import CITY_KEYS, GAZETTEER, PLACE_KEYS, RESTAURANT, TEXT_KEYS

PLACES = "country string, city string, lat double, lng double"

#        id country city   lat   lng    replace        fill_gaps
CASES = [
    (0, "X", "c1", None, None, (40.0, 50.0), (40.0, 50.0)),
    (1, "X", "c1", None, 5.0, (40.0, 50.0), (40.0, 5.0)),
    (2, "X", "c1", 4.0, None, (40.0, 50.0), (4.0, None)),
    (3, "X", "c1", 4.0, 5.0, (4.0, 5.0), (4.0, 5.0)),
    (4, None, "c1", None, None, (None, None), (None, None)),
    (5, "X", "zz", None, None, (None, None), (None, None)),
    (6, "X", "zz", None, 7.0, (None, None), (None, 7.0)),
    (7, "", "c1", None, None, (1.0, 2.0), (None, None)),
    (8, "X", "", None, None, (3.0, 4.0), (None, None)),
    (9, "X", None, None, None, (None, None), (None, None)),
    (10, None, None, 4.0, 5.0, (4.0, 5.0), (4.0, 5.0)),
]


def restaurants(spark, cases, franchise="F"):
    rows = [(i, 1, franchise, 1, country, city, lat, lng) for i, country, city, lat, lng in cases]
    return spark.createDataFrame(rows, RESTAURANT)


@pytest.fixture
def rows(spark):
    return restaurants(spark, [case[:5] for case in CASES])


@pytest.fixture
def places(spark):
    return spark.createDataFrame([("X", "c1", 40.0, 50.0), ("", "c1", 1.0, 2.0), ("X", "", 3.0, 4.0)], PLACES)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize(("mode", "column"), [("replace", 5), ("fill_gaps", 6)])
def test_both_modes(rows, places, mode, column, broadcast):
    got = geocode.MODES[mode](rows, places, CITY_KEYS, broadcast=broadcast)
    assert got.columns == RESTAURANT.names
    assert {r.id: (r.lat, r.lng) for r in got.collect()} == {case[0]: case[column] for case in CASES}
    assert got.count() == len(CASES)


def test_broadcast_depends_on_the_size(spark, rows, places, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    others = spark.range(500).selectExpr("'Y' country", "concat('d', id) city", "1.0D lat", "1.0D lng")
    everywhere = places.unionByName(others)
    want = values(geocode.fill_gaps(rows, places, CITY_KEYS))

    small = geocode.fill_gaps(rows, everywhere, CITY_KEYS)
    # The whole gazetteer is too large, the places asked for are not.
    cut = geocode.fill_gaps(rows, everywhere, CITY_KEYS, broadcast_bytes=1000)
    large = geocode.fill_gaps(rows, everywhere, CITY_KEYS, broadcast_bytes=10)
    for got, join in ((small, "BroadcastHashJoin"), (cut, "BroadcastHashJoin"), (large, "SortMergeJoin")):
        assert [name for name in ("BroadcastHashJoin", "SortMergeJoin") if name in plan_of(got)] == [join]
        assert values(got) == want
    assert "Exchange hashpartitioning" not in plan_of(cut)
    # Written down: the rows that ask (with all their columns), and the places they ask for.
    stored = [spark.read.parquet(f) for f in cut.inputFiles() if "cellweave-" in f]
    assert sum(df.count() for df in stored if "id" not in df.columns) == 1


def test_only_asking_rows_are_exchanged(spark, places, tmp_path, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    restaurants(spark, [(i, "X", "c1", None if i % 4 == 0 else 1.0, 1.0) for i in range(40)]).write.parquet(
        f"{tmp_path}/rows"
    )
    rows = spark.read.parquet(f"{tmp_path}/rows")
    plan = plan_of(geocode.fill_gaps(rows, places, CITY_KEYS, broadcast=False))
    assert "PushedFilters: [IsNull(lat)" in plan


@pytest.mark.parametrize("broadcast", [True, False])
def test_repeated_places_do_not_repeat_rows(spark, rows, broadcast):
    repeated = spark.createDataFrame(
        [("X", "c1", 41.0, 1.0), ("X", "c1", 40.0, 50.0), ("X", "c1", 40.0, 60.0), ("X", "c1", None, 0.0)], PLACES
    )
    got = geocode.fill_gaps(rows, repeated, CITY_KEYS, broadcast=broadcast)
    assert got.count() == len(CASES)
    found = got.filter("id = 0").first()
    assert (found.lat, found.lng) == (40.0, 50.0)


def test_keys_with_the_franchise(spark):
    rows = restaurants(spark, [(0, "X", "c1", None, None)]).unionByName(
        restaurants(spark, [(1, "X", "c1", None, None)], "G").unionByName(
            restaurants(spark, [(2, "X", "c1", None, None)], None)
        )
    )
    places = spark.createDataFrame([("F", "c1", "X", 1.0, 2.0), (None, "c1", "X", 3.0, 4.0)], GAZETTEER)
    got = geocode.replace_incomplete(rows, places, PLACE_KEYS)
    assert values(got, "id", "lat", "lng") == [(0, 1.0, 2.0), (1, None, None), (2, None, None)]


def test_keys_as_question_text(spark):
    rows = restaurants(spark, [(0, "X", "c1", None, None)], None)
    places = spark.createDataFrame([("None, c1, X", 1.0, 2.0)], "query string, lat double, lng double")
    for broadcast in (True, False):
        got = geocode.fill_gaps(rows, places, TEXT_KEYS, broadcast=broadcast)
        assert values(got, "lat", "lng") == [(1.0, 2.0)]


def test_lookup_keeps_rows_and_adds_columns(rows, places):
    found = geocode.lookup(filters.missing_coords(rows), places, CITY_KEYS)
    assert found.columns == [*RESTAURANT.names, "found_lat", "found_lng"]
    assert found.count() == 9
    known = geocode.lookup(rows, places, CITY_KEYS).filter("id = 3").first()
    assert known.found_lat is None


@pytest.mark.parametrize("mode", ["replace", "fill_gaps"])
def test_hot_place_is_split(spark, settings, mode):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="8KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="8KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    n = F.col("id")
    hot = n % 3 == 0
    rows = spark.range(0, 20000, 1, 8).select(
        "id",
        F.lit(1).alias("franchise_id"),
        F.lit("F").alias("franchise_name"),
        F.lit(1).alias("restaurant_franchise_id"),
        F.lit("X").alias("country"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), n % 500)).alias("city"),
        F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("double").alias("lng"),
    )
    places = spark.range(500).selectExpr(
        "'X' country", "if(id = 0, 'hot', concat('c', id)) city", "cast(id as double) lat", "cast(id as double) lng"
    )
    got = geocode.MODES[mode](rows, places, CITY_KEYS, broadcast=False)
    found = {r.id: r.lat for r in got.collect()}
    assert "skew=true" in plan_of(got)
    # City c0 is the hot one's row in the gazetteer, so its own rows find nothing.
    want = {i: 0.0 if i % 3 == 0 else (None if i % 500 == 0 else float(i % 500)) for i in range(20000)}
    assert found == want


def test_open_questions_are_distinct(spark):
    rows = restaurants(spark, [(i, "X", "c1", None, 1.0) for i in range(5)] + [(9, None, "c1", None, None)])
    assert values(geocode.open_questions(rows)) == [("F", "c1", "X", "F, c1, X")]


def test_replies(spark):
    replies = spark.createDataFrame(
        [
            ("a", '{"results":[{"geometry":{"lat":1.5,"lng":-2}},{"geometry":{"lat":9,"lng":9}}],"rate":{}}'),
            ("b", '{"results":[]}'),
            ("c", "junk"),
            ("d", None),
            ("e", '{"status":{"code":402}}'),
        ],
        "query string, reply string",
    )
    assert values(geocode.gazetteer_from_replies(replies)) == [
        ("a", 1.5, -2.0),
        ("b", None, None),
        ("c", None, None),
        ("d", None, None),
        ("e", None, None),
    ]


def test_packed_coordinates(spark):
    texts = ["1.5,2.5", "1", "abc,2", None, "", "1,2,3", " 4 , 5 "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in rows.select(packed_lat("t"), packed_lng("t")).collect()]
    assert got == [
        (1.5, 2.5),
        (1.0, None),
        (None, 2.0),
        (None, None),
        (None, None),
        (1.0, 2.0),
        (4.0, 5.0),
    ]


def test_query_text(spark):
    rows = spark.createDataFrame(
        [("F", "c", "X"), (None, "c", "X"), ("F", None, "X"), ("F", "c", None), ("F", "", "")],
        "franchise_name string, city string, country string",
    )
    got = [r[0] for r in rows.select(query_text()).collect()]
    assert got == ["F, c, X", "None, c, X", None, None, "F, , "]
