"""Grouping of words with their spelling variants, by blocked Gram matrices.

Words one edit apart have letter counts at a squared distance of at most two, and lengths at
most one apart. So words lie in tiles of equal length and equal counts of eight classes of
letters; one edit leads to the same tile or to one of 36 others, whose keys are listed. Tiles
are cut into blocks of bounded size, blocks of such tiles meet by an equal key, and for each
pair of blocks a product of their letter count matrices gives all squared distances at once.
Pairs at two or less are then compared letter by letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.batches import stored
from cellweave.llm.words import slices

#: Every so many runs of letters lose one, by the checksum of document and run.
NOISE = 97
LEAST_LETTERS = 5
LEAST_COUNT = 3
#: A form occurs at least so many times as often as its variant.
FORM_FACTOR = 2

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: All letters a word can have; each fits one byte of ISO 8859-1.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
CLASSES = 8
PLACE = np.zeros(256, np.int64)
PLACE[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))

#: Distinct words a task gathers before it hands their counts on.
GATHERED = 200_000
#: Words and bytes of a block.
BLOCK_WORDS = 1024
BLOCK_BYTES = 1 << 18


def _misspelt(word: str, doc: object, noise: int) -> str:
    """The run as it counts: some lose a letter, the same one wherever a document has the run."""
    check = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
    if check % noise:
        return word
    at = check % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    noise: int = NOISE,
) -> DataFrame:
    """(word, n): words with enough letters and occurrences in whole texts.

    Runs of letters (ASCII and U+00C0 to U+00FF) are taken with A-Z in lower case. A null id
    is written as nothing in the checksum; null and empty texts have no words; repeated rows
    count each. Tasks sum before they shuffle, and hold ``GATHERED`` words at most, or those
    of one document.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            long = {w: n for w, n in counts.items() if len(w) >= least_letters}
            return pa.RecordBatch.from_arrays(
                [pa.array(long.keys(), pa.string()), pa.array(long.values(), pa.int64())], names=["word", "n"]
            )

        for part in slices(batches, "text"):
            for doc, own in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                if own:
                    for word, n in Counter(RUN.findall(own.translate(LOWER))).items():
                        counts[_misspelt(word, doc, noise)] += n
                if len(counts) >= GATHERED:
                    yield handed()
                    counts.clear()
        yield handed()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def tile(word: Column) -> Column:
    """How many letters of each class a word has."""
    own = [LETTERS_OF[c] for c in range(CLASSES)]
    return F.array(
        *((F.length(word) - F.length(F.translate(word, letters, ""))).cast("int") for letters in own)
    )


LETTERS_OF = {c: "".join(x for x in LETTERS if ord(x) % CLASSES == c) for c in range(CLASSES)}


def reached(own: Column) -> Column:
    """Tiles to compare a tile with: itself, those with a letter more, and those with a letter
    of one class replaced by one of a later class, so that each pair of tiles comes up once."""

    def changed(less: int | None, more: int | None) -> Column:
        return F.array(
            *(own[c] + F.lit((c == more) - (c == less)).cast("int") for c in range(CLASSES))
        )

    ways = [own]
    ways += [changed(None, more) for more in range(CLASSES)]
    ways += [changed(less, more) for less in range(CLASSES) for more in range(less + 1, CLASSES)]
    return F.filter(F.array(*ways), lambda way: F.array_min(way) >= 0)


def blocks(words: DataFrame) -> DataFrame:
    """(tile, block, letters, size, n): words of a tile in blocks of about ``BLOCK_WORDS``, as one
    run of ISO 8859-1 bytes each; ``size`` is the length of a word, ``n`` its occurrences."""
    laid = stored(words.select("word", "n", tile(F.col("word")).alias("tile"), F.length("word").alias("size")))
    sizes = laid.groupBy("tile").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_WORDS, F.sum("size") / BLOCK_BYTES)).alias("blocks")
    )
    dealt = laid.join(stored(sizes), "tile").select(
        "tile", "size", "n", F.encode("word", "ISO-8859-1").alias("word"),
        F.pmod(F.xxhash64("word"), F.col("blocks")).alias("block"),
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [b"".join(x) for x in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tile"), batch.column("block"), pa.array(words, pa.binary()), batch.column("size"), batch.column("n")],
                names=["tile", "block", "letters", "size", "n"],
            )

    gathered = dealt.groupBy("tile", "size", "block").agg(F.collect_list(F.struct("word", "n")).alias("both"))
    listed = gathered.select("tile", "block", "size", F.col("both.word").alias("words"), F.col("both.n").alias("n"))
    return listed.mapInArrow(pack, "tile array<int>, block long, letters binary, size int, n array<long>")


def letter_counts(words: np.ndarray) -> np.ndarray:
    """Rows of byte codes to rows of letter counts."""
    out = np.zeros((len(words), len(LETTERS)), np.float32)
    rows = np.arange(len(words))
    for column in PLACE[words].T:
        out[rows, column] += 1
    return out


def near(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of words, rows of byte codes, that are one edit apart; ``b`` is as
    long as ``a`` or one longer. ``same``: both are one block, where a pair counts once.

    Counts go into products as single floats, exact up to some 4,000 equal letters; longer
    words are multiplied in doubles.
    """
    left, right = letter_counts(a), letter_counts(b)
    if b.shape[1] > 4000:
        left, right = left.astype(np.float64), right.astype(np.float64)
    apart = (left * left).sum(axis=1)[:, None] + (right * right).sum(axis=1)[None, :] - 2 * (left @ right.T)
    i, j = np.nonzero(apart <= 2)
    if same:
        i, j = i[i < j], j[i < j]
    step = max(1, (1 << 22) // b.shape[1])
    good = np.zeros(len(i), bool)
    for at in range(0, len(i), step):
        good[at : at + step] = _one_edit(a[i[at : at + step]], b[j[at : at + step]])
    return i[good], j[good]


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one letter replaced, or inserted in ``b``."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    # Equal up to some place, and from there on with the letter there left out of b.
    front = np.ones((len(a), b.shape[1]), bool)
    np.logical_and.accumulate(a == b[:, :-1], axis=1, out=front[:, 1:])
    back = np.ones((len(a), b.shape[1]), bool)
    back[:, :-1] = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1)[:, ::-1]
    return (front & back).any(axis=1)


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, other_n) for all pairs of words one edit apart, both ways round."""
    packed = stored(blocks(words))
    left = packed.select(
        F.explode(reached(F.col("tile"))).alias("key"), F.col("tile").alias("own"), *(F.col(c).alias(f"{c}_a") for c in ("block", "letters", "size", "n"))
    )
    right = packed.select(F.col("tile").alias("key"), *(F.col(c).alias(f"{c}_b") for c in ("block", "letters", "size", "n")))
    met = left.join(right, "key").filter("own <> key or block_a <= block_b")
    met = met.withColumn("same", F.expr("own = key and block_a = block_b"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}
            for r in range(len(batch)):
                a, b = (
                    np.frombuffer(column[f"letters_{x}"][r].as_py(), np.uint8).reshape(-1, column[f"size_{x}"][r].as_py())
                    for x in "ab"
                )
                i, j = near(a, b, column["same"][r].as_py())
                if not len(i):
                    continue
                n_a, n_b = (column[f"n_{x}"][r].values.to_numpy() for x in "ab")
                first = [x.tobytes().decode("latin-1") for x in a[i]]
                second = [x.tobytes().decode("latin-1") for x in b[j]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first + second, pa.string()),
                        pa.array(second + first, pa.string()),
                        pa.array(np.concatenate([n_b[j], n_a[i]])),
                    ],
                    names=["word", "other", "other_n"],
                )

    # Few words are a lot of work: pairs of blocks go to all tasks alike.
    pairs = met.drop("key", "own", "block_a", "block_b")
    return pairs.mapInArrow(compare, "word string, other string, other_n long")


def with_forms(words: DataFrame, form_factor: int = FORM_FACTOR) -> DataFrame:
    """(word, form, n, n_near, form_n) from (word, n): how many words are near each, and the
    most frequent of them if it occurs ``form_factor`` times as often (ties: the first)."""
    best = (
        near_words(words)
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("rank"), "other")).alias("best"))
    )
    is_form = -F.col("best.rank") >= form_factor * F.col("n")
    return words.join(stored(best), "word", "left").select(
        "word",
        F.when(is_form, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("best.rank")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) for words that have a form: the last word that forms lead to.

    Each round makes every step twice as long. A form occurs more often than its variant, at
    least twice by default, so the way is no longer than a count has bits and six rounds do.
    """
    steps = stored(formed.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = steps.join(ahead, "root", "left")
        if further.filter("next is not null").isEmpty():
            return steps
        steps = stored(further.select("word", F.coalesce("next", "root").alias("root")))


def variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    form_factor: int = FORM_FACTOR,
    noise: int = NOISE,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the words of all texts, see ``word_counts``.

    Two words are near if exactly one letter is inserted, deleted or replaced. A word's form
    is its near word with the most occurrences (ties: the first in code point order) if these
    are at least ``form_factor`` times its own, which has to be 2 or more; else null. Its root
    is where forms lead to in the end, or itself. No texts give no words. Columns of ``docs``
    other than the two named are not looked at.

    Words are few beside texts, and only they are compared. A tile of M words costs M * M
    products in blocks of 1,024 and moves M * M / 1,024 words; eight classes of letters keep
    tiles small (see README), and a tile of any size is worked off block by block.
    """
    if form_factor < 2:
        raise ValueError("forms must occur at least twice as often, or they may lead in a circle")
    words = stored(word_counts(docs, doc_id, text, least_letters, least_count, noise))
    formed = stored(with_forms(words, form_factor))
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
