"""Registered queries on the smallest tables, against SQL or plain versions."""

import os
import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from plain import groups, hits, sha256, without_shared_lines
from test_llm_words import plain_variants, variant_rows
from tokenizers import Tokenizer

import __spark_entry__ as registered
import corpus_pipeline
from cellweave.llm import bpe, toxicity
from cellweave.llm.queries import ORACLE, QUERIES, table

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="needs the provided tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return duck.sql("select doc_id, text, lang, source, n_chars from documents order by doc_id").fetchall()


def result(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    return sorted(rows, key=lambda row: tuple(row)[:2])


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(registered.queries())
    assert set(ORACLE) <= set(registered.oracle_sql())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    got, want = QUERIES[name](spark, FOLDER), duck.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    mine = sorted((tuple(row[c] for c in order) for row in got.collect()), key=repr)
    theirs = want.project(", ".join(order)).fetchall()
    assert mine == sorted(theirs, key=repr)


def test_op1(spark, documents):
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    want = []
    for doc, text, *_ in documents:
        ids = enc.encode_ordinary(text)
        want.append((doc, len(ids), sha256(",".join(map(str, ids))), sha256(text)))
    assert [tuple(row) for row in result(spark, "op1_bpe")] == want


def test_op10(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    counts = [len(x) for x in library.encode([text for _, text, *_ in documents])]
    want = [(d[0], len(d[1].encode()), n, n > 4096) for d, n in zip(documents, counts)]
    assert [tuple(row) for row in result(spark, "op10_token_counts")] == want


def test_op13(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for doc, text, *_ in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc, len(ids), sha256(np.array(ids, "<u4").tobytes()), sha256(decoded)))
    assert [tuple(row) for row in result(spark, "op13_chunk_bpe")] == want


def test_op11(spark, documents):
    got = variant_rows(QUERIES["op11_spelling_variants"](spark, FOLDER))
    assert got == plain_variants([d[:2] for d in documents])


def test_op6(spark, duck):
    vectors = duck.sql("select vec_id, embedding from embeddings order by vec_id").fetchnumpy()
    ids, x = vectors["vec_id"], np.stack(vectors["embedding"]).astype(float)
    found = total = 0
    got = {}
    for row in result(spark, "op6_nearest_neighbours"):
        got.setdefault(row.query_id, []).append(row)
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    for at in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[at]
        scores[at] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        rows = got[int(ids[at])]
        assert [row["rank"] for row in rows] == list(range(1, len(best) + 1))
        assert np.allclose([row.score for row in rows], scores[np.searchsorted(ids, [row.vec_id for row in rows])])
        found, total = found + len(set(best.tolist()) & {row.vec_id for row in rows}), total + len(best)
    assert found >= 0.9 * total


def test_op7(spark, documents):
    rows = result(spark, "op7_sharding")
    want = [(d[0], len(d[1].encode()) + 8, zlib.crc32(d[1].encode()), "rows", None) for d in documents]
    assert [(r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in rows] == want
    places = sorted(row.slot * 24 + row.shard for row in rows)
    assert places == list(range(len(documents)))


def test_op8(spark, duck):
    got = {row.doc_id: row for row in result(spark, "op8_toxicity")}
    assert len(got) == duck.sql("select count(*) from documents").fetchall()[0][0]
    labels = duck.sql("select doc_id, toxic from labels").fetchall()
    assert sum(got[doc].is_toxic == bool(toxic) for doc, toxic in labels) >= 0.95 * len(labels)


def test_pipeline(spark, duck, documents):
    chain = toxicity.train(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    kept = [d for d in documents if chain.score(pa.array([d[1]]))[0, 1] <= chain.thresholds[1]]
    assert 0.7 * len(documents) < len(kept) < len(documents)
    cut = without_shared_lines([(d[1], d[3]) for d in kept])
    kept = [(d[0], text, *d[2:4]) for d, (text, _, _) in zip(kept, cut)]
    kept = [d for d, (i, _, component) in zip(kept, groups([d[:2] for d in kept])) if i == component]
    items = duck.sql("select item_id, text from benchmark").fetchall()
    kept = [d for d in kept if not hits(d[1], items)[1]]
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    want = [(doc, lang, source, enc.encode_ordinary(text), True) for doc, text, lang, source in kept]
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r.doc_id, r.lang, r.source, r.ids, r.decodes) for r in rows) == want
    assert all(row.n_tokens == len(row.ids) for row in rows)


def test_stages_take_odd_documents(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "a text", "en", "s", 6), (1, "a text", "en", "s", 6), (2, None, None, None, None), (None, "x", "en", "s", 1)]
    rows += [(3, "", "en", "s", 0), (4, "long " * 60000, "en", "s", 300000)]
    for docs in (spark.createDataFrame(rows, columns), spark.createDataFrame([], columns)):
        for name, stage in corpus_pipeline.STAGES:
            done = stage(spark, docs, FOLDER)
            if name != "bpe":
                assert done.columns == docs.columns
            assert done.count() == docs.count(), name
