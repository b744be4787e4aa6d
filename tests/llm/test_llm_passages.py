import random

import pytest
from conftest import values
from plain import hits, removed, without_shared_lines

from cellweave.llm import decontaminate, linededup, substring


def corpus(seed, count=50):
    """Documents that share passages at other places, overlapping ones included."""
    rng = random.Random(seed)
    words = ["a", "b", "c"] + [f"w{i}é" for i in range(200)]
    passages = [[rng.choice(words) for _ in range(rng.choice([20, 49, 50, 51, 75, 120]))] for _ in range(8)]
    docs = []
    for i in range(count):
        own = []
        for _ in range(rng.randrange(4)):
            own += [rng.choice(words) for _ in range(rng.choice([0, 3, 40]))]
            if rng.random() < 0.7:
                passage = rng.choice(passages)
                at = rng.randrange(20)
                own += passage[at : at + rng.choice([10, 50, 60, 200])]
        docs.append((i * 3 % count, rng.choice([" ", "\n", "\t "]).join(own)))
    return docs


def checked(spark, docs, **options):
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in docs], "doc_id long, text string, n_words int, hash string")
    got = substring.remove_repeats(df.repartition(4), filter_bits=18, **options)
    assert got.columns == ["doc_id", "hash", "kept_text", "n_words", "n_removed"]
    window = options.get("window", 50)
    want = [(i, n, gone, kept) for i, n, gone, kept in removed(docs, window)]
    assert values(got, "doc_id", "n_words", "n_removed", "kept_text") == sorted(want, key=repr)


def test_repeats_are_removed_as_by_hand(spark):
    docs = corpus(1)
    docs += [(500, docs[3][1]), (501, docs[3][1]), (None, docs[4][1]), (None, None), (600, None), (601, ""), (602, " \n")]
    docs += [(700, "a " * 200), (701, "a " * 99), (702, "a " * 49), (703, "b " * 30000), (704, "b " * 60000)]
    docs += docs[5:7] + [(docs[8][0], docs[9][1])]
    checked(spark, docs)


@pytest.mark.parametrize(("window", "block"), [(9, 5), (10, 5), (20, 4)])
def test_other_lengths(spark, window, block):
    checked(spark, corpus(2, 30), window=window, block=block)


def test_blocks_too_long_are_refused(spark):
    with pytest.raises(ValueError):
        substring.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), window=50, block=26)


def test_nothing_repeats_in_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substring.remove_repeats(none, filter_bits=18).count() == 0


def test_the_text_can_stay(spark):
    df = spark.createDataFrame([(1, "a  b")], "doc_id long, text string")
    row = substring.remove_repeats(df, filter_bits=18, keep_text=True).first()
    assert (row.text, row.kept_text) == ("a  b", "a b")


ITEMS = [
    (1, "the quick brown fox jumps over the lazy dog and then it runs far away from here"),
    (2, "The QUICK, brown fox; jumps over the lazy dog and then! something else happens to them all"),
    (10, "short item here"),
    (11, "short ITEM, here"),
    (3, "one"),
    (4, ""),
    (5, None),
    (None, "a nameless item of four"),
    (6, "zäh é 漢字 ok"),
    (7, "x " * 40),
    (1, "the quick brown fox jumps over the lazy dog and then it runs far away from here"),
]
DOCS = [
    (1, "Look: the quick brown fox jumps over the lazy dog and then it runs far away from here."),
    (2, "brown fox jumps over the lazy dog and then it runs"),
    (3, "brown fox jumps over the lazy dog and then it"),
    (4, "short item  here short item short item here"),
    (5, "one thing; this one"),
    (6, None),
    (7, ""),
    (8, "some a nameless item of four, zäh É 漢字 ok zäh é 漢字 ok"),
    (9, "x " * 15 + "y " + "x " * 9 + "z " + "x " * 3000),
    (None, "the quick brown fox jumps over the lazy dog and then it"),
    (2, "brown fox jumps over the lazy dog and then it runs"),
    (2, "short item here, with another text under the same id"),
    (12, "nothing of interest " * 4000),
    (13, "quick brown fox jumps over the lazy dog and then the quick brown fox jumps over the lazy dog and"),
]


@pytest.mark.parametrize("filter_bits", [18, 24])
def test_hits_are_those_of_all_windows(spark, filter_bits):
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in DOCS], "doc_id long, text string, items string, n_hit int")
    items = spark.createDataFrame([(i, t, "s") for i, t in ITEMS], "item_id long, text string, doc_id string")
    got = decontaminate.find(docs.repartition(3), items, filter_bits=filter_bits)
    want = [(i, *hits(t, ITEMS)) for i, t in DOCS]
    assert values(got, "doc_id", "n_words", "n_hit", "items") == sorted(want, key=repr)
    for row in got.collect():
        assert row.n_hit == sum(span.end - span.start for span in row.spans)
        assert all(a.end < b.start for a, b in zip(row.spans, row.spans[1:]))


def test_random_texts_and_items(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(6)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 9, 10, 11, 30])))) for i in range(12)]
    docs = []
    for i in range(40):
        own = [rng.choice(words) for _ in range(rng.choice([0, 5, 10, 80]))]
        part = rng.choice(items)[1].split()
        docs.append((i, " ".join(own + part[rng.randrange(3) :][:14] + own[:7])))
    docs = [(i, t.replace("w5", "w9")) if i % 2 else (i, t) for i, t in docs]
    got = decontaminate.find(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert values(got, "doc_id", "n_words", "n_hit", "items") == sorted(((i, *hits(t, items)) for i, t in docs), key=repr)


def test_no_items_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert values(decontaminate.find(docs, items.limit(0)), "doc_id", "n_words", "n_hit", "items") == [(1, 2, 0, [])]
    assert decontaminate.find(docs.limit(0), items).count() == 0
    assert decontaminate.find(docs, items, keep_text=True).first().text == "a b"


def pages():
    rng = random.Random(5)
    frame = [f"frame {i}" for i in range(4)]
    rows = []
    for i in range(120):
        own = [f"own line {i} {j} with some words of its own" for j in range(rng.randrange(1, 5))]
        lines = [*rng.sample(frame, rng.randrange(4)), *own, " ", *rng.sample(frame, rng.randrange(2))]
        rows.append(("\n".join(lines), f"s{rng.randrange(12)}"))
    few = [(f"on few sites\nand more of page {i} than that", f"s{i % 7}") for i in range(30)]
    edge = [(f"  on eight sites \nand more of page {i} than that", f"s{i % 8}") for i in range(30)]
    copies = [("a copied page\nof two lines", f"s{i}") for i in range(12)]
    odd = [(None, "s1"), ("", "s1"), ("\n\n", "s2"), ("frame 1\nlong " + "word " * 20000, "s3"), ("frame 1\n" + "x" * 40, None)]
    return rows + few + edge + copies + odd + odd[:2] + [("no site line\n" + "y" * 30, None)] * 12


@pytest.mark.parametrize("near", [1.0, 2.0, 4.0])
def test_lines_of_many_sites_go(spark, near):
    rows = pages()
    df = spark.createDataFrame(
        [(i, t, s, "kept") for i, (t, s) in enumerate(rows)], "doc_id long, text string, source string, line string"
    )
    got = linededup.remove_shared_lines(df.repartition(4), near=near)
    assert got.columns == ["doc_id", "text", "source", "line", "n_lines", "n_removed"]
    want = [(i, *x) for i, x in enumerate(without_shared_lines(rows))]
    assert values(got, "doc_id", "text", "n_lines", "n_removed") == sorted(want, key=repr)
    assert sum(row.n_removed for row in got.collect()) > 100


def test_a_document_of_shared_lines_alone_stays_whole(spark):
    """However little a line of its own is."""
    frame = "a long line that very many sites have in common, as often in the frame of a page"
    rows = [(i, f"{frame}\n own {i} \n\n{frame}", f"s{i}") for i in range(9)]
    rows += [(20, f"{frame}\n \n{frame}", "s1"), (21, frame, None), (22, f"{frame}\nx", None)]
    docs = spark.createDataFrame([(*row, "k", 1) for row in rows], "doc_id long, text string, source string, __KEY string, __hash int")
    got = linededup.remove_shared_lines(docs)
    assert got.columns == ["doc_id", "text", "source", "__KEY", "__hash", "n_lines", "n_removed"]
    want = [(i, f" own {i} \n", "k", 1, 4, 2) for i in range(9)]
    want += [(20, rows[9][1], "k", 1, 3, 0), (21, frame, "k", 1, 1, 0), (22, "x", "k", 1, 2, 1)]
    assert values(got, "doc_id", "text", "__KEY", "__hash", "n_lines", "n_removed") == sorted(want, key=repr)


def test_rows_that_repeat_very_often_are_split(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", shuffle__partitions="8",
             adaptive__skewJoin__skewedPartitionThresholdInBytes="4k", adaptive__skewJoin__skewedPartitionFactor="1.1",
             adaptive__advisoryPartitionSizeInBytes="2k")
    rows = [(i, f"shared line\nown line {i}", f"s{i % 9}") for i in range(800)] + [(1, "shared line\nthe same", "s")] * 800
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8)
    got = linededup.remove_shared_lines(docs)
    assert got.filter("n_removed = 1").count() == 1600
    got.collect()
    assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()


def test_an_id_that_very_many_rows_have(spark):
    """Each window counts once for an id; names that the operator uses itself are kept."""
    words = " ".join(f"w{i}" for i in range(200))
    rows = [(7, words, "a", "b")] * 1000 + [(1, words, "a", "b"), (7, "short", "a", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id string, __gone string").repartition(4)
    got = substring.remove_repeats(docs)
    assert got.columns == ["doc_id", "__id", "__gone", "kept_text", "n_words", "n_removed"]
    assert values(got.groupBy("doc_id", "n_words", "n_removed").count()) == [(1, 200, 0, 1), (7, 1, 0, 1), (7, 200, 200, 1000)]


def test_no_lines(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert linededup.remove_shared_lines(none).count() == 0


def test_a_window_that_very_many_documents_have_is_split(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", shuffle__partitions="8",
             adaptive__skewJoin__skewedPartitionThresholdInBytes="4k", adaptive__skewJoin__skewedPartitionFactor="1.1",
             adaptive__advisoryPartitionSizeInBytes="2k")
    passage = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(i, f"{passage} own{i}") for i in range(3000)] + [(9000, "none")], "doc_id long, text string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    found = decontaminate.find(docs.withColumn("__key", docs.doc_id).repartition(8), items)
    assert values(found.groupBy("n_hit", "items").count()) == [(0, [], 1), (12, ["1"], 3000)]
    assert found.filter("__key <> doc_id").count() == 0
