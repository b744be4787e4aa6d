import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cellweave.llm import bpe, tokencount

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None,
    "",
    " ",
    "   \n\t  ",
    "It's the 3rd  day,\r\nisn't it? ",
    "naïve 漢字 😀  　x",
    "<|endoftext|><s></s><unk><0x0A>",
    "▁ ▁▁x▁",
    "a" * 3000,
    " " * 3000,
    "word " * 30000,
    "ab1!\n" * 20000,
]


@pytest.fixture
def odd(spark):
    rows = [(i, text, "kept", i) for i, text in enumerate(ODD)] + [(None, "no id", None, 1), (3, "a b", "x", 0), (3, "a b", "x", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens long")


def test_ids_are_those_of_the_library(odd):
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    rows = bpe.encode(odd, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == odd.count()
    for row in rows:
        assert row.ids == enc.encode_ordinary(row.text or "")


def test_ids_decode_to_bytes(odd):
    coded = bpe.round_trip(odd, RANKS, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    again = bpe.decode(coded, RANKS, public_tokenizers.PATTERN)
    for rows in (coded.collect(), again.collect()):
        assert all(bytes(row.decoded) == (row.text or "").encode() for row in rows)


def test_ids_cut_within_a_character_decode(spark):
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    ids = enc.encode_ordinary("\U0001f9ff")
    assert len(ids) > 1
    part = bpe.decode(spark.createDataFrame([(ids[:1],), (None,)], "ids array<int>"), RANKS, public_tokenizers.PATTERN)
    assert [bytes(x.decoded) for x in part.collect()] == [enc.decode_single_token_bytes(ids[0]), b""]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert tokencount.count_tokens(none, PIECES).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab 'sLté漢1!\n\t 😀"), max_size=60), st.integers(1, 9))
def test_parts_encode_as_the_whole(text, limit):
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    parts = list(bpe.safe_parts(text, limit))
    assert "".join(parts) == text
    assert [i for part in parts for i in enc.encode_ordinary(part)] == enc.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("a1!' \n\t　\x1c"), max_size=40), st.integers(2, 5))
def test_runs_of_white_space_encode_as_in_the_library(text, limit):
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    assert list(bpe.encode_part(enc, text, limit)) == enc.encode_ordinary(text)


def test_very_long_white_space(spark):
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    for space in (" " * 200_000, "\n \t" * 50_000):
        for text in (f"x{space}y", f"{space}!", f"x{space}", f"a b{space}c{space}"):
            assert bpe.encode_text(enc, text) == enc.encode_ordinary(text)
    # Beyond what the library itself takes.
    texts = [f"x{' ' * 1_200_000}y z", "\n " * 600_000]
    coded = bpe.round_trip(spark.createDataFrame([(t,) for t in texts], "text string"), RANKS, public_tokenizers.PATTERN)
    assert all(bytes(row.decoded) == row.text.encode() for row in coded.collect())


def test_counts_are_those_of_the_library(odd):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = tokencount.count_tokens(odd, PIECES).collect()
    assert len(rows) == odd.count()
    for row in rows:
        assert row.n_tokens == len(library.encode(row.text or ""))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abeinst ▁\n\t.é漢 😀<>0x"), max_size=40), max_size=8))
def test_counts_of_any_texts(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = tokencount.counter(PIECES).texts(pa.array(texts, pa.string()))
    assert got.tolist() == [len(library.encode(x)) for x in texts]


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(tokencount, "REMEMBERED", 50)
    counter = tokencount.Counter(PIECES)
    texts = [hashlib.sha256(bytes([i])).hexdigest()[:9] for i in range(200)]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for i in range(0, 200, 7):
        assert counter.texts(pa.array(texts[: i + 1])).tolist() == [len(x) for x in library.encode(texts[: i + 1])]
        assert len(counter.keys) <= 50


def test_other_models_are_refused(tmp_path):
    with open(PIECES, "rb") as file:
        content = file.read()
    unigram = tmp_path / "unigram.model"
    # Field 3 of the trainer's settings is the kind of model.
    unigram.write_bytes(content.replace(b"\x18\x02\x20\x80\xfa\x01", b"\x18\x01\x20\x80\xfa\x01"))
    if unigram.read_bytes() == content:
        pytest.skip("the file is laid out another way")
    with pytest.raises(ValueError):
        tokencount.PieceModel(str(unigram))


def test_columns_are_told_apart_without_case(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, N_TOKENS int, __text string")
    row = tokencount.count_tokens(docs, PIECES).first()
    assert row.asDict() == {"doc_id": 1, "text": "a b", "__text": "x", "n_tokens": 2}
