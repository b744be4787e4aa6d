"""Toxicity by a chain of linear models.

Categories are label columns, in order. A model for a category sees the words of a text and
the probabilities of the categories before it. In training those come from models that did
not see the row (out of fold), as they will for new documents; afterwards a model over all
rows of the sample is kept for each category.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.llm.batches import stored, with_arrays
from cellweave.llm.words import ALPHANUMERIC, byte_hashes, split_words

CATEGORIES = ("quality", "toxic")
#: Labelled rows taken for each combination of labels: those with the smallest hash of the id.
ROWS_PER_CLASS = 3000
FOLDS = 3
#: Words are also known by so many first bytes, so that unseen endings count.
PREFIX_BYTES = 5
#: Words less telling than this (standard deviations) are left out of a model.
TELLING = 3.0
PENALTY = 2e-4
STEPS = 400


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, 32-bit feature) of each word and each prefix, with repetitions."""
    words = split_words(column, ALPHANUMERIC, places=True)
    owner = np.repeat(np.arange(len(column)), np.diff(words.first))
    long = np.flatnonzero(words.end - words.start > PREFIX_BYTES)
    begin = words.start[long]
    prefixes = byte_hashes(words.data, begin, begin + PREFIX_BYTES, ALPHANUMERIC.value) ^ np.uint64(1 << 40)
    found = np.concatenate([words.hashes, prefixes]) >> np.uint64(32)
    return np.concatenate([owner, owner[long]]), found.astype(np.uint32)


def _distinct(owner: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(owner.astype(np.uint64) << np.uint64(32) | found)
    return (pairs >> np.uint64(32)).astype(np.int64), pairs.astype(np.uint32)


@dataclass(frozen=True)
class Link:
    """One model of the chain: sorted features, their weights, the weights of the earlier
    probabilities, and the intercept."""

    words: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float

    def probabilities(self, owner: np.ndarray, found: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """For texts whose distinct features are ``found``; a row of ``earlier`` for each."""
        at = np.searchsorted(self.words, found)
        at[at == len(self.words)] = 0
        hit = np.flatnonzero(self.words[at] == found) if len(self.words) else at[:0]
        score = np.bincount(owner[hit], self.weights[at[hit]], minlength=len(earlier))
        return 1 / (1 + np.exp(-(score + earlier @ self.earlier + self.intercept)))


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    links: tuple[Link, ...]
    thresholds: tuple[float, ...]

    def score(self, column: pa.Array) -> np.ndarray:
        """A probability per text and category."""
        owner, found = features(column)
        telling = np.unique(np.concatenate([link.words for link in self.links]))
        at = np.searchsorted(telling, found)
        at[at == len(telling)] = 0
        keep = telling[at] == found if len(telling) else np.zeros(len(found), bool)
        owner, found = _distinct(owner[keep], found[keep])
        out = np.zeros((len(column), len(self.links)))
        for i, link in enumerate(self.links):
            out[:, i] = link.probabilities(owner, found, out[:, :i])
        return out


def _telling(owner: np.ndarray, found: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which entries of ``found`` belong to groups of features that go with ``y``."""
    bits = 20
    group = found >> np.uint32(32 - bits)
    positive = max(1, int(y.sum()))
    negative = max(1, len(y) - positive)
    yes = np.bincount(group, y[owner], minlength=1 << bits)
    no = np.bincount(group, minlength=1 << bits) - yes
    share = (yes + no) / len(y)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / positive + 1 / negative))
    return (np.abs(yes / positive - no / negative) > TELLING * spread)[group]


def fit(owner: np.ndarray, found: np.ndarray, earlier: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Link:
    """L1-penalised logistic regression by accelerated proximal steps. Features are distinct
    per row. Labels that are all alike give a constant."""
    weight = weight / max(weight.sum(), 1e-12)
    base = float(np.clip((weight * y).sum(), 1e-6, 1 - 1e-6))
    start = float(np.log(base / (1 - base)))
    none = np.zeros(0)
    if len(y) == 0 or y.min() == y.max():
        return Link(none.astype(np.uint32), none, np.zeros(earlier.shape[1]), start)
    keep = _telling(owner, found, y)
    owner, found = owner[keep], found[keep]
    words, column = np.unique(found, return_inverse=True)
    dims, chained = len(words), earlier.shape[1]
    # A bound on the curvature: rows are non-negative, so the largest row sum serves.
    per_row = np.bincount(owner, minlength=len(y)) + earlier.sum(1) + 1
    step = 4 / float(per_row.max())
    w = np.zeros(dims + chained + 1)
    w[-1] = start
    ahead, last, t = w.copy(), w, 1.0
    for _ in range(STEPS):
        score = np.bincount(owner, ahead[:dims][column], minlength=len(y)) + earlier @ ahead[dims:-1] + ahead[-1]
        error = weight * (1 / (1 + np.exp(-score)) - y)
        slope = np.concatenate([np.bincount(column, error[owner], minlength=dims), earlier.T @ error, [error.sum()]])
        w = ahead - step * slope
        w[:dims] = np.sign(w[:dims]) * np.maximum(np.abs(w[:dims]) - step * PENALTY, 0)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if (ahead - w) @ (w - last) > 0:  # it overshoots: begin anew from here
            after, t = 1.0, 1.0
        ahead, last, t = w + (t - 1) / after * (w - last), w, after
    kept = np.flatnonzero(w[:dims])
    return Link(words[kept], w[:dims][kept], w[dims:-1], float(w[-1]))


def sample(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str], doc_id: str, text: str, rows_per_class: int, folds: int
) -> DataFrame:
    """Labelled documents with distinct features, fold and weight, at most ``rows_per_class``
    for each combination of labels. Weights undo that choice. Equal texts share a fold. Of rows
    with one ``doc_id`` a single text is taken, the one with the smallest hash."""
    labels = labels.groupBy(doc_id).agg(*(F.max(c).cast("int").alias(c) for c in categories)).dropna()
    labels = stored(labels.withColumn("__class", F.concat_ws(",", *categories)))
    chosen = None
    for row in labels.groupBy("__class").count().collect():  # 2 ** categories rows
        part = labels.filter(F.col("__class") == row["__class"]).orderBy(F.xxhash64(doc_id)).limit(rows_per_class)
        part = part.withColumn("weight", F.lit(row["count"] / min(row["count"], rows_per_class)))
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        chosen = labels.withColumn("weight", F.lit(1.0))

    def compute(column: pa.Array) -> dict[str, pa.Array]:
        owner, found = _distinct(*features(column))
        borders = np.searchsorted(owner, np.arange(len(column) + 1))
        return {"features": pa.array([found[a:b].tobytes() for a, b in zip(borders, borders[1:])], pa.binary())}

    joined = docs.select(doc_id, text).join(F.broadcast(chosen.drop("__class")), doc_id)
    alike = [doc_id, *categories, "weight"]
    joined = joined.groupBy(*alike).agg(F.min_by(text, F.xxhash64(text)).alias(text))
    placed = joined.withColumn("fold", F.pmod(F.xxhash64(text), F.lit(folds)).cast("int"))
    placed = placed.withColumn("row", F.monotonically_increasing_id())
    return with_arrays(placed, text, {"features": T.BinaryType()}, compute, (text, doc_id))


FITTED = "model int, row long, probability double, words binary, weights binary, earlier binary, intercept double"


def _fitter(category: str, before: Sequence[str], folds: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        model = int(rows["model"].iloc[0])
        rows = rows.sort_values("row")
        parts = [np.frombuffer(x, np.uint32) for x in rows["features"]]
        owner = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        found = np.concatenate(parts)
        del parts
        y = rows[category].to_numpy(float)
        earlier = rows[[f"p_{c}" for c in before]].to_numpy(float).reshape(len(rows), len(before))
        train = rows["fold"].to_numpy() != model
        renumbered = np.cumsum(train) - 1
        mine = train[owner]
        link = fit(renumbered[owner[mine]], found[mine], earlier[train], y[train], rows["weight"].to_numpy()[train])
        columns = [c.split()[0] for c in FITTED.split(", ")]
        if model == folds:
            whole = (model, None, None, link.words.tobytes(), link.weights.tobytes(), link.earlier.tobytes(), link.intercept)
            return pd.DataFrame([whole], columns=columns)
        p = link.probabilities(owner, found, earlier)[~train]
        empty = [None] * len(p)
        made = (np.full(len(p), model), rows["row"].to_numpy()[~train], p, empty, empty, empty, empty)
        return pd.DataFrame(dict(zip(columns, made)))

    return run


def _threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Where the harmonic mean of precision and recall is best, halfway to the next value."""
    if not len(p) or not y.any():
        return 1.1  # nothing is known to be in this category
    order = np.argsort(-p, kind="stable")
    p, right, all_ = p[order], np.cumsum((weight * y)[order]), np.cumsum(weight[order])
    ends = np.append(p[1:] != p[:-1], True)
    score = np.where(ends, 2 * right / (all_ + (weight * y).sum()), -1)
    best = int(np.argmax(score))
    return float((p[best] + (p[best + 1] if best + 1 < len(p) else 0)) / 2)


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    doc_id: str = "doc_id",
    text: str = "text",
    rows_per_class: int = ROWS_PER_CLASS,
    folds: int = FOLDS,
) -> Chain:
    """A chain fitted on a bounded sample of the labelled documents.

    ``categories`` are 0/1 columns of ``labels``; rows with a null among them, or without
    a document, teach nothing. Of repeated labels the larger counts. Where no row is labelled,
    or all alike, the category has a constant probability, and without a positive row no
    document is put into it. The models of a category are fitted side by side, one per task;
    the sample, with its bound, is all that such a task or the driver ever holds.
    """
    rows = stored(sample(docs, labels, categories, doc_id, text, rows_per_class, folds))
    if rows.isEmpty():
        none = np.zeros(0)
        links = [Link(none.astype(np.uint32), none, np.zeros(i), -20.0) for i in range(len(categories))]
        return Chain(tuple(categories), tuple(links), (1.1,) * len(categories))
    links, thresholds = [], []
    for i, category in enumerate(categories):
        before = list(categories[:i])
        models = F.explode(F.sequence(F.lit(0), F.lit(folds))).alias("model")
        fitted = stored(rows.select("*", models).groupBy("model").applyInPandas(_fitter(category, before, folds), FITTED))
        full = fitted.filter(F.col("row").isNull()).first()
        links.append(
            Link(
                np.frombuffer(full["words"], np.uint32),
                np.frombuffer(full["weights"]),
                np.frombuffer(full["earlier"]),
                full["intercept"],
            )
        )
        held_out = fitted.filter(F.col("row").isNotNull()).select("row", F.col("probability").alias(f"p_{category}"))
        rows = rows.join(F.broadcast(held_out), "row")
        judged = rows.select(f"p_{category}", category, "weight").toPandas()
        thresholds.append(_threshold(*(judged[c].to_numpy(float) for c in judged.columns)))
    return Chain(tuple(categories), tuple(links), tuple(thresholds))


def score(docs: DataFrame, chain: Chain, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``p_<category>`` and a boolean ``is_<category>`` for each category.

    Every text is read as a whole. A null or empty text has no words and gets what the
    intercepts say; rows are judged alone. Existing columns of the new names are replaced.
    """
    known = docs.sparkSession.sparkContext.broadcast(chain)
    added: dict[str, T.DataType] = {}
    for category in chain.categories:
        added |= {f"p_{category}": T.DoubleType(), f"is_{category}": T.BooleanType()}

    def compute(column: pa.Array) -> dict[str, pa.Array]:
        p = known.value.score(column)
        out = {}
        for i, category in enumerate(known.value.categories):
            out[f"p_{category}"] = pa.array(p[:, i])
            out[f"is_{category}"] = pa.array(p[:, i] > known.value.thresholds[i])
        return out

    return with_arrays(docs, text, added, compute, drop)


def train_and_score(docs: DataFrame, labels: DataFrame, drop: tuple[str, ...] = (), **options) -> DataFrame:
    return score(docs, train(docs, labels, **options), drop=drop)

