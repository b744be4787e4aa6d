"""Removal of lines that many sites share, judged by how many distinct sites hold a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm import bitmaps
from cellweave.llm.batches import fresh, stored

#: A line on so many distinct sites is boilerplate.
MIN_SITES = 8
#: log2 of the registers of a sketch.
LG_K = 10
#: Lines whose estimate is within this factor of the threshold, either way, are counted exactly.
NEAR = 2.0
#: Bitmap of the documents that have a shared line: 8 MB. Too small a one moves more texts, no fewer lines.
CHANGED_BITS = 26


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def line_hash(line: Column) -> Column:
    """Null for a line of blanks only, which is no line for this purpose."""
    bare = F.trim(line)
    return F.when(bare != "", F.xxhash64(bare))


def shared_lines(occurrences: DataFrame, min_sites: int = MIN_SITES, near: float = NEAR, lg_k: int = LG_K) -> DataFrame:
    """Hashes of the lines on ``min_sites`` distinct sites or more, from (line, site).

    A HyperLogLog sketch per line is built in every task and merged in the shuffle, so a
    line that is everywhere costs one small row per task. An estimate that is ``near`` times
    the threshold or more is trusted (the error is some hundredths); lines between that and
    the threshold divided by ``near`` are counted exactly. Null sites count for nothing.
    """
    spread = occurrences.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
    estimated = stored(
        spread.select("line", F.hll_sketch_estimate("sketch").alias("sites")).filter(
            F.col("sites") >= int(min_sites / near)
        )
    )
    sure = estimated.filter(F.col("sites") >= min_sites * near).select("line")
    close = estimated.filter(F.col("sites") < min_sites * near).select("line")
    exact = (
        occurrences.join(close, "line", "left_semi")
        .select("line", "site")
        .distinct()
        .groupBy("line")
        .agg(F.count("site").alias("sites"))
        .filter(F.col("sites") >= min_sites)
        .select("line")
    )
    return sure.unionByName(exact)


def remove_shared_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    near: float = NEAR,
    lg_k: int = LG_K,
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and ``n_lines`` and ``n_removed``.

    Lines end at line feeds and are compared without outer blanks, by 64-bit hash. A line
    on at least ``min_sites`` distinct values of ``site`` goes, wherever it stands, unless all
    lines of the document that are not blank are such lines: it has no text of its own then,
    is a copy rather than a page with a common frame, and stays whole for a stage that
    compares documents. Blank lines stay. A null text stays null and has no lines; a null site
    counts for none; rows are judged alone, so repeated rows stay equal. Existing columns of
    the new names are replaced, all others may have any name.

    Texts move only for documents that have a shared line. The shared lines of each document
    are stored before the texts join them, so rows that very often repeat are split.
    """
    docs = docs.drop("n_lines", "n_removed")
    own_key, gone, kept = fresh(docs.columns, "key", "shared", "kept")
    # Should two rows share this key, each still only loses lines that are boilerplate.
    key = F.xxhash64(doc_id, text)
    occurrences = stored(
        docs.select(key.alias("key"), F.col(site).alias("site"), F.explode(lines_of(F.col(text))).alias("line"))
        .select("key", "site", line_hash(F.col("line")).alias("line"))
        .filter("line is not null")
    )
    shared = stored(shared_lines(occurrences.select("line", "site"), min_sites, near, lg_k))
    found = stored(
        occurrences.select("key", "line")
        .join(shared, "line", "left_semi")
        .groupBy(F.col("key").alias(own_key))
        .agg(F.collect_set("line").alias(gone))
    )
    same, touched = bitmaps.apart(docs, key, bitmaps.bitmap(found.select(own_key), CHANGED_BITS))
    every = lines_of(F.col(text))
    n_lines = F.when(F.col(text).isNotNull(), F.size(every)).otherwise(0).cast("long")
    whole = same.select("*", n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    left = F.filter(every, lambda line: ~F.coalesce(F.array_contains(gone, line_hash(line)), F.lit(False)))
    met = (
        touched.withColumn(own_key, key)
        .join(found.hint("shuffle_hash"), own_key, "left")
        .withColumn(kept, F.when(F.col(gone).isNotNull(), left))
    )
    # Without a shared line (the bitmap may err) or a line of its own a document stays as it is.
    cut = F.coalesce(F.exists(kept, lambda line: line_hash(line).isNotNull()), F.lit(False))
    less = met.select(
        *(
            F.when(cut, F.array_join(kept, "\n")).otherwise(F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`")
            for c in docs.columns
        ),
        n_lines.alias("n_lines"),
        F.when(cut, n_lines - F.size(kept)).otherwise(0).cast("long").alias("n_removed"),
    )
    return whole.unionByName(less)
