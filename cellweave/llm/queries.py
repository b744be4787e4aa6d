"""Queries over the provided tables, one per operator, and the SQL to check them with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import (
    bpe,
    chunkbpe,
    decontaminate,
    jaccard,
    lexical,
    linededup,
    multiindex,
    sharding,
    spelling,
    substring,
    tokencount,
    toxicity,
    warc,
)
from cellweave.llm.oracle import ORACLE  # noqa: F401
from cellweave.session import shared_folder

COLUMNS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.round_trip(
        table(spark, folder, "documents").select("doc_id", "text"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        drop=("text",),
    )
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.train_and_score(docs, table(spark, folder, "labels"), drop=("text",))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return linededup.remove_shared_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = tokencount.count_tokens(
        table(spark, folder, "documents").select(
            "doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")
        ),
        public_tokenizers.path("piece_bpe_32k.model"),
        drop=("text",),
    )
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    warc.write(table(spark, folder, "pages"), path)
    found = warc.join_revisits(warc.read(spark, path, payloads=False))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.groups(table(spark, folder, "documents"))


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return multiindex.search(table(spark, folder, "embeddings"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    return sharding.shard_rows(rows, ["doc_id", "text_hash", "size", "text_crc32"], 24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_chunk_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = chunkbpe.encode(docs, path, drop=("text",), packed=True, decoded="decoded")
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_warc": op2_warc,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_sharding": op7_sharding,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_lexical_search": op12_lexical_search,
    "op13_chunk_bpe": op13_chunk_bpe,
}
