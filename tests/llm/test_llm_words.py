"""Token ids from shared chunks, spelling variants and ranked search, against plain versions."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import ALPHANUMERIC, LOWER
from tokenizers import Tokenizer

from cellweave.llm import chunkbpe, lexical, spelling

MODEL = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(MODEL)


def library_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


SHARED = "".join(f"Passage number {i * i}, which isn't alone: naïve 漢字 é 😀.\n" for i in range(120))
ODD = [
    None,
    "",
    "  \n",
    SHARED,
    "something else first" + SHARED[15:4000] + "and after it",
    SHARED[1:3001],
    "<|startoftext|>" + SHARED[:2000] + "<|endoftext|>x<|endof text|>",
    "a" * 90_000,
    "word " * 40_000,
    "İΣς ﬁ ́a \x1c\x85 " * 300,
    "x" + " " * 5000 + SHARED,
]


@pytest.fixture
def odd(spark):
    rows = [(i, text, f"k{i}", i) for i, text in enumerate(ODD)] + [(None, "no id", None, 1), (3, SHARED, "x", 0), (3, SHARED, "x", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, IDS string, __key int")


def test_chunked_ids_are_those_of_the_library(odd, library):
    coded = chunkbpe.encode(odd, MODEL)
    assert coded.columns == ["doc_id", "text", "__key", "ids"]
    rows = coded.collect()
    assert sorted(((r.doc_id, r.text, r["__key"]) for r in rows), key=repr) == sorted(
        ((r.doc_id, r.text, r["__key"]) for r in odd.collect()), key=repr
    )
    for row in rows:
        assert row.ids == library_ids(library, row.text)


def test_chunked_ids_decode_as_in_the_library(odd, library):
    for packed in (True, False):
        at_once = chunkbpe.encode(odd, MODEL, packed=packed, decoded="decoded")
        rows = chunkbpe.decode(chunkbpe.encode(odd, MODEL, packed=packed), MODEL).collect()
        assert rows and sorted(map(repr, rows)) == sorted(map(repr, at_once.select(*rows[0].__fields__).collect()))
        for row in rows:
            assert row.decoded == library.decode(library_ids(library, row.text), skip_special_tokens=False)


def test_chunks_are_encoded_once_and_joined(odd, spark):
    texts = odd.select("text").filter("text <> ''")
    known = spark.sparkContext.broadcast(chunkbpe.shared_chunks(texts, 26))
    coded = chunkbpe.encoded_chunks(texts, known, MODEL)
    assert coded.count() == coded.select("key").distinct().count() > 5


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert chunkbpe.decode(chunkbpe.encode(none, MODEL), MODEL).count() == 0
    assert spelling.variants(none).count() == 0
    assert lexical.search(none, items).count() == 0
    assert lexical.search(items.withColumnRenamed("item_id", "doc_id"), none.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_cuts_depend_on_nearby_bytes_alone():
    alone = chunkbpe.cut(pa.array([SHARED]))
    within = chunkbpe.cut(pa.array([None, "before " * 50 + SHARED, "", SHARED]))
    parts = {SHARED.encode()[a:b] for a, b in zip(alone.begin, alone.end)}
    data = within.data.tobytes()
    moved = [data[a:b] for a, b in zip(within.begin, within.end)]
    assert b"".join(moved) == data
    assert len(parts) > 5 and len(parts & set(moved[:-1])) >= len(parts) - 2
    assert set(within.text.tolist()) == {1, 3}


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.text(alphabet=st.sampled_from("abI's 1!\n\t é́漢😀 <|endoftext|>"), max_size=60), min_size=1, max_size=4),
    st.randoms(use_true_random=False),
)
def test_joins_of_any_chunks_are_repaired(library, texts, random):
    """Chunks anywhere, shared or not, give the ids of the whole text."""
    coder = chunkbpe.encoder(MODEL)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    begin, end, owner, at = [], [], [], 0
    for i, text in enumerate(texts):
        size = len(text.encode())
        cuts = [c for c in range(1, size) if data[at + c] & 0xC0 != 0x80 and random.random() < 0.2]
        if size:
            begin += [at, *(at + c for c in cuts)]
            end += [*(at + c for c in cuts), at + size]
            owner += [i] * (len(cuts) + 1)
        at += size
    chunks = chunkbpe.Chunks(data, np.array(begin, np.int64), np.array(end, np.int64), np.array(owner, np.int64))
    keys = [str(i).encode() for i in range(len(begin))]
    first, last = chunkbpe._inner(chunks)
    inner = {k: coder.whole(data[a:b].tobytes()) for k, a, b in zip(keys, first, last)}
    shared = np.array([random.random() < 0.7 for _ in begin], bool)
    for text, own in zip(texts, chunkbpe.pieces(coder, chunks, shared, keys, len(texts))):
        ids = [x for piece in own for x in (inner[piece.key] if piece.ids is None else piece.ids).tolist()]
        assert ids == library_ids(library, text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aBI'sLt1!.,;:?#*~ \n\téÉß÷́İ漢<|>"), max_size=25), min_size=1, max_size=3))
def test_words_give_the_ids_of_the_text(library, texts):
    coder = chunkbpe.encoder(MODEL)
    assert coder.one_case and coder.apart and coder.plain_words
    special = [x + "<|endoftext|>" + x + "<|EndOfText|>." for x in texts]
    for some in (texts, special):
        assert [x.tolist() for x in coder.encode([x.encode() for x in some])] == [library_ids(library, x) for x in some]


def test_a_chunk_that_does_not_agree_is_given_up(library):
    class Wary(chunkbpe.Encoder):
        """Says that two texts never have the ids that each has by itself."""

        def _agree(self, left, right):
            return False

    chunks = chunkbpe.cut(pa.array([SHARED, "", SHARED[:200]]))
    shared = chunks.text == 0
    own = chunkbpe.pieces(Wary(MODEL), chunks, shared, [b""] * len(shared), 3)
    assert [x for piece in own[0] for x in piece.ids.tolist()] == library_ids(library, SHARED)
    assert own[1] == [] and len(own[2]) == 1


def test_what_is_remembered_is_bounded(library, monkeypatch):
    monkeypatch.setattr(chunkbpe, "REMEMBERED_WORDS", 40)
    coder = chunkbpe.Encoder(MODEL)
    texts = [" ".join(f"W{i * j}x" for j in range(30)) + " End. END? 'S, 'll; it's: 3. b!. é. a</w>. <|STARTOFTEXT|>. a\x0bb\x0cc\x1cd\x85e\xa0f" for i in range(50)]
    for i in range(0, 50, 5):
        assert [x.tolist() for x in coder.encode([t.encode() for t in texts[i : i + 5]])] == [library_ids(library, t) for t in texts[i : i + 5]]
        assert len(coder.place) <= 40 + 5 * 60
    often = [b"again"] * 9
    for i in range(20):
        coder.encode([b" ".join([*often, *(b"x%d_%d" % (i, j) for j in range(45))])])
    assert b"again" in coder.place and len(coder.place) < 100


def test_a_chunk_that_very_many_texts_have_is_split(spark, settings, library):
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", shuffle__partitions="8",
             adaptive__skewJoin__skewedPartitionThresholdInBytes="4k", adaptive__skewJoin__skewedPartitionFactor="1.1",
             adaptive__advisoryPartitionSizeInBytes="2k")
    rows = [(i, f"text {i} " + SHARED) for i in range(600)]
    coded = chunkbpe.encode(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), MODEL)
    want = library_ids(library, SHARED)
    assert all(r.ids[-len(want):] == want for r in coded.collect())
    assert "skew=true" in coded._jdf.queryExecution().executedPlan().toString()


def plain_variants(docs):
    counts = Counter()
    for doc, text in docs:
        for word in spelling.RUN.findall((text or "").translate(LOWER)):
            check = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            at = check % len(word)
            counts[word[:at] + word[at + 1 :] if check % 97 == 0 else word] += 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()), key=repr)


def variant_rows(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=repr)


def test_variants_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(5)
    words = ["colour", "color", "colours", "colr", "Straße", "Strasse", "Àrvore", "àrvore", "aaaaa", "aaaab", "abaaa", "listen", "silent"]
    words += ["".join(rng.choice(list("abcé"), 5 + i % 3)) for i in range(250)]
    weight = 1 / np.arange(1, len(words) + 1)
    rows = [(i, " ".join(rng.choice(words, 60, p=weight / weight.sum())) + "-x1", "k") for i in range(150)]
    rows += [(None, "colour colour", "k"), (1, None, "k"), (2, "", None), (3, "colour", "k"), (3, "colour", "k"), (4, "letters" * 9000 + " ", "k")]
    rows += [(9, ("q" * 70_000 + " ") * 2 + "q" * 69_999 + " ", "k"), (10, ("q" * 70_000 + " ") * 4 + ("q" * 69_999 + " ") * 2, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    want = plain_variants([row[:2] for row in rows])
    assert sum(form is not None for _, form, *_ in want) > 20
    assert variant_rows(spelling.variants(docs)) == want


def test_variants_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 3)
    monkeypatch.setattr(spelling, "GATHERED", 50)
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("ab"), 5 + i % 3)) for i in range(120)]
    rows = [(i, " ".join(rng.choice(words, 80))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert variant_rows(spelling.variants(docs)) == plain_variants(rows)


def test_forms_must_not_lead_in_a_circle(spark):
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "doc_id long, text string"), form_factor=1)


def plain_search(docs, items, k=20):
    words = [(doc, ALPHANUMERIC.findall((text or "").translate(LOWER))) for doc, text in docs]
    total, n_docs = sum(len(w) for _, w in words), sum(bool(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in items:
        found = []
        for doc, own in words:
            tf = Counter(own)
            score = 0
            for t in ALPHANUMERIC.findall((text or "").translate(LOWER)):
                if tf[t]:
                    m = 75 + 25 * len(own) * n_docs // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc if doc is not None else 0))
        for rank, (score, null, doc) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if null else doc, -score))
    return sorted(out, key=repr)


def search_cases():
    rng = np.random.default_rng(7)
    words = np.array([f"w{i}" for i in range(300)] + ["É", "漢字", "the"])
    weight = 1 / np.arange(1, len(words) + 1)
    weight /= weight.sum()
    docs = [(int(i), " ".join(rng.choice(words, rng.integers(0, 80), p=weight))) for i in range(400)]
    docs += [(1000 + i, "W1 w2 tie") for i in range(60)] + [(None, "w1 w2 tie"), (None, None), (5000, ""), (5001, None)]
    docs += [(2000, "w5 w5 w7"), (2000, "w5 w5 w7"), (7000, "w3 " * 30_000), (8000, "lone")]
    items = [(f"i{i}", " ".join(rng.choice(words, rng.integers(1, 40), p=weight))) for i in range(25)]
    items += [("tie", "tie w1"), ("null", None), ("empty", " . "), ("twice", "w5 w5 w9 É"), ("twice", "w5 w5 w9 É"), (None, "lone lone the"), ("none", "absent")]
    return docs, items


@pytest.mark.parametrize("at_once", [50, 200, 10**6])
def test_search_finds_the_best_of_all(spark, at_once):
    docs, items = search_cases()
    plain = plain_search(docs, items)
    rows = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, score string")
    asked = spark.createDataFrame([(*x, 1) for x in items], "item_id string, text string, rank int")
    got = lexical.search(rows, asked, query_terms_at_once=at_once)
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()), key=repr) == plain


@pytest.mark.parametrize("short,window,block", [(1 / 32, 1024, 8192), (0.02, 16, 100), (2.0, 64, 50), (0.0, 8, 10**6), (0.1, 4, 7)])
def test_blocks_are_ranked_alike_however_cut(monkeypatch, short, window, block):
    for name, value in (("SHORT", short), ("WINDOW_DOCS", window), ("BLOCK_DOCS", block)):
        monkeypatch.setattr(lexical, name, value)
    docs, items = search_cases()
    items = [x for x in items if x[0] != "twice" and x[0] is not None]
    words = [ALPHANUMERIC.findall((text or "").translate(LOWER)) for _, text in docs]
    n_docs, n_terms = sum(map(bool, words)), sum(map(len, words))
    df = Counter(t for w in words for t in set(w))
    hashes = {}
    for t in {t for _, x in items for t in ALPHANUMERIC.findall((x or "").translate(LOWER))} | set(df):
        hashes[t] = int(lexical.split_words(pa.array([t]), lexical.ALPHANUMERIC).hashes.view(np.int64)[0])
    rows = defaultdict(list)
    for number, (_, text) in enumerate(items):
        for t, n in Counter(ALPHANUMERIC.findall((text or "").translate(LOWER))).items():
            weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            if df[t] and weight:
                for name, value in (("item", number), ("hash", hashes[t]), ("n", n), ("weight", weight)):
                    rows[name].append(value)
    queries = lexical.queries_of(pa.table(dict(rows)))
    parts = [
        pa.RecordBatch.from_pydict({"doc_id": pa.array([d for d, _ in docs[i : i + 30]], pa.int64()), "text": pa.array([t for _, t in docs[i : i + 30]], pa.string())})
        for i in range(0, len(docs), 30)
    ]
    got = []
    for number, best in lexical.rank_docs(parts, queries, n_docs, n_terms, 20).items():
        for rank, (score, doc, null) in enumerate(zip(best.score.tolist(), best.doc.tolist(), best.null.tolist()), 1):
            got.append((items[number][0], rank, None if null else doc, score))
    assert sorted(got, key=repr) == plain_search(docs, items)
