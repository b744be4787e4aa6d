"""Cleaning a corpus: five stages, each over all documents that the one before it kept.

Every stage takes (spark, docs, folder) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes the result of each stage to the shared folder and
reads it again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import bpe, decontaminate, jaccard, linededup, toxicity
from cellweave.llm.batches import stored
from cellweave.llm.queries import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier chain does not reject. It learns from all labelled
    documents given; those without a label are judged like the others."""
    scored = toxicity.train_and_score(docs.select(*COLUMNS), table(spark, folder, "labels"))
    return scored.filter(~F.col("is_toxic")).select(*COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without lines that many sources share. n_chars follows the text."""
    cut = linededup.remove_shared_lines(docs.select(*COLUMNS))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id."""
    return jaccard.keep_one(docs.select(*COLUMNS), jaccard.groups(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    found = decontaminate.find(docs.select(*COLUMNS), table(spark, folder, "benchmark"), keep_text=True)
    return found.filter("n_hit = 0").select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    coded = bpe.round_trip(
        docs.select("doc_id", "lang", "source", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        drop=("text",),
    )
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("decodes"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: A fitted classifier is not SQL; tests compare ``run`` with a plain version.
ORACLE_SQL = None
