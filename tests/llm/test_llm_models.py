import random

import numpy as np
import pyarrow as pa
import pytest

from cellweave.llm import multiindex, toxicity

BAD = ["wretch", "scoundrel", "vermin", "rotter", "lowlife"]


def labelled(seed=1, count=600):
    """(id, text, poor, toxic): poor texts repeat a symbol, toxic ones name-call."""
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(count):
        own = [rng.choice(words) for _ in range(rng.choice([5, 40, 200]))]
        poor, toxic = int(rng.random() < 0.2), int(rng.random() < 0.15)
        if poor:
            own += ["zzz"] * 3
        if toxic:
            for _ in range(2):
                own.insert(rng.randrange(len(own)), rng.choice(BAD) + rng.choice(["", "s", "ly"]))
        rows.append((i, " ".join(own), poor, toxic))
    return rows


@pytest.fixture(scope="module")
def chain(spark):
    rows = labelled()
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, p, t) for i, _, p, t in rows if i < 400], "doc_id long, poor int, toxic int")
    labels = labels.unionByName(spark.createDataFrame([(1, None, 1), (None, 1, 1), (9999, 1, 1)], labels.schema))
    return toxicity.train(docs, labels, ("poor", "toxic"), rows_per_class=150)


def test_held_out_documents_are_told_apart(spark, chain):
    rows = [row for row in labelled() if row[0] >= 400]
    docs = spark.createDataFrame([(i, t, True) for i, t, _, _ in rows], "doc_id long, text string, is_toxic boolean")
    got = {row.doc_id: row for row in toxicity.score(docs.repartition(3), chain).collect()}
    for name, column in (("is_poor", 2), ("is_toxic", 3)):
        right = [got[row[0]][name] == bool(row[column]) for row in rows]
        assert sum(right) >= 0.98 * len(right)


def test_later_models_see_earlier_probabilities(chain):
    assert [len(link.earlier) for link in chain.links] == [0, 1]


def test_a_label_that_follows_another_is_learnt_through_it(spark):
    # No word tells the second label; it is the first one, and that has words.
    rows = labelled(2)
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t, t) for i, _, _, t in rows], "doc_id long, toxic int, again int")
    chain = toxicity.train(docs, labels, ("toxic", "again"))
    assert chain.links[1].earlier[0] > 0
    got = {row.doc_id: row.is_again for row in toxicity.score(docs, chain).collect()}
    assert sum(got[i] == bool(t) for i, _, _, t in rows) >= 0.99 * len(rows)


def test_scores_are_those_of_each_text_alone(spark, chain):
    texts = [None, "", "!!", "wretch", "word1 " * 50000 + "wretch rotter", *(t for _, t, _, _ in labelled(3, 20))]
    together = chain.score(pa.array(texts, pa.string()))
    for text, row in zip(texts, together):
        score, probabilities = [], []
        found = np.unique(toxicity.features(pa.array([text or ""]))[1]) if text else np.zeros(0, np.uint32)
        for link in chain.links:
            weights = dict(zip(link.words.tolist(), link.weights.tolist()))
            score = sum(weights.get(int(x), 0.0) for x in found) + link.intercept
            score += float(np.dot(probabilities, link.earlier)) if probabilities else 0.0
            probabilities.append(1 / (1 + np.exp(-score)))
        assert np.allclose(row, probabilities)
    docs = spark.createDataFrame([(None, t) for t in texts] * 2, "doc_id long, text string")
    rows = toxicity.score(docs, chain).collect()
    assert len(rows) == 2 * len(texts)
    assert not any(row.is_toxic for row in rows if not row.text)


def test_without_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "a wretch"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    alike = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, alike):
        rows = toxicity.train_and_score(docs, labels).collect()
        assert [row.is_toxic for row in rows] == [False, False]
    assert toxicity.train_and_score(docs.limit(0), alike).count() == 0


def test_repeated_documents_are_learnt_from_once(spark):
    rows = [(1, "b text")] * 50 + [(1, "a text")] * 50 + [(2, "other")] * 3 + [(3, None)] * 2 + [(None, "no id")] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    taken = toxicity.sample(docs, labels, toxicity.CATEGORIES, "doc_id", "text", 3000, 3)
    assert sorted((r.quality, r.toxic, len(r.features) // 4) for r in taken.collect()) == [(0, 0, 1), (0, 1, 0), (1, 0, 2)]
    assert toxicity.train_and_score(docs, labels).count() == len(rows)


def nearest(rows, k, every):
    """By hand: [(query, rank, id, score)]."""
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v) and len(v) == 6:
            kept.setdefault((i, tuple(np.float32(v).tolist())), np.float64(np.float32(v)))
    out = []
    for (q, _), x in kept.items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for (i, _), y in kept.items() if i != q)
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def vectors(count=300, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(size=6).astype(float).tolist()) for i in rng.permutation(1000)[:count]]
    same = rng.normal(size=6).tolist()
    rows += [(2000 + i, same) for i in range(120)]
    rows += [(None, same), (3000, None), (3020, [0.0] * 6), (3040, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (3060, [float("nan")] * 6)]
    rows += [(3080, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (3100, [1.0, 2.0]), (3120, [])]
    return rows + rows[:3]


@pytest.mark.parametrize("block_rows", [50, 8192])
def test_all_cells_give_the_exact_answer(spark, block_rows):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = multiindex.search(df.repartition(5), k=7, recall=1.0, centroids=8, block_rows=block_rows)
    got = sorted(map(tuple, got.collect()))
    want = nearest(rows, 7, 20)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want])


def test_cells_are_left_out_and_enough_is_found(spark, monkeypatch):
    """Fewer rows are seen than there are, as many as the measured recall takes."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(60, 12))
    x = (centres[rng.integers(0, 60, 20_000)] + 0.35 * rng.normal(size=(20_000, 12))).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    seen = []
    plain = multiindex.enough_rows

    def enough_rows(*args):
        seen.append(plain(*args))
        return seen[-1]

    monkeypatch.setattr(multiindex, "enough_rows", enough_rows)
    got = {}
    for row in multiindex.search(df, k=20, centroids=32, measured_queries=100).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    assert len(seen) == 1 and seen[0] < 0.5 * len(rows)
    y = x.astype(float)
    found = 0
    for query in range(0, 20_000, 20):
        scores = y @ y[query]
        scores[query] = -np.inf
        found += len(got[query] & set(np.argpartition(-scores, 20)[:20].tolist()))
    assert 0.9 * 20_000 <= found < 20_000


def test_vectors_of_each_length_are_searched_among_their_own(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4 + i % 2 * 3).tolist()) for i in range(100)] + [(1000, [1.0])]
    got = multiindex.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=5, every=5, recall=1.0)
    found = {(r.query_id, r["rank"]): r.vec_id for r in got.collect()}
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for query in range(0, 100, 5):
        own = sorted((i for i in x if i != query and len(x[i]) == len(x[query])), key=lambda i: -(x[i] @ x[query]))
        assert [found[query, n] for n in range(1, 6)] == own[:5]
    assert len(found) == 100


def test_fewer_candidates_than_asked_for(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (40, [0.5, 0.5]), (41, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in multiindex.search(df).collect())
    assert got == [(20, 1, 40), (20, 2, 41), (40, 1, 20), (40, 2, 41)]


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert multiindex.search(none).count() == 0
    assert multiindex.search(spark.createDataFrame([(1, None)], none.schema)).count() == 0


def test_cells_come_in_the_order_of_summed_distances():
    rng = np.random.default_rng(3)
    halves = (rng.normal(size=(5, 3)), rng.normal(size=(7, 3)))
    counts = rng.integers(0, 4, 35)
    index = multiindex.Index(halves, counts)
    query = rng.normal(size=6)
    distance = (-(halves[0] @ query[:3])[:, None] - halves[1] @ query[3:]).ravel()
    order = [c for c in np.argsort(distance).tolist() if counts[c]]
    assert index.visited(query, 10**9) == order
    some = index.visited(query, 9)
    assert some == order[: len(some)] and counts[some].sum() >= 9 and counts[some[:-1]].sum() < 9
