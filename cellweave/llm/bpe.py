"""Byte-level BPE encoding and decoding with tiktoken and a local file of ranks."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cellweave.llm.batches import with_arrays

#: Texts of more characters are split before they are encoded.
LONG_TEXT = 1 << 16
#: Runs of so much white space are not left to the library, whose matching fails at some 1,000,000.
LONG_SPACE = 100_000
#: How a pattern must end for that: nothing else in it takes white space but one blank before something else.
SPACE_RULE = r" ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

IDS = T.ArrayType(T.IntegerType(), False)


@lru_cache(maxsize=2)
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """Built once per process."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, limit: int = LONG_TEXT) -> Iterator[str]:
    """Parts of about ``limit`` characters, cut only where a character that is not white
    space is followed by white space.

    No match of a pattern of this family goes across such a place (a match is white space
    alone, or at most one blank and then no white space), and its look-ahead sees only
    white space that comes before another cut. So the parts encode as the whole does.
    """
    cut = regex.compile(r"\S(?=\s)")
    at = 0
    while len(text) - at > limit:
        found = cut.search(text, at + limit - 1)
        if found is None:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


def encode_part(enc: tiktoken.Encoding, part: str, limit: int = LONG_SPACE) -> Iterator[int]:
    """Ids of a part, with runs of ``limit`` and more white space cut out and encoded as they
    match: up to the last character, which goes with what follows, or whole at the end.

    Patterns that do not end with SPACE_RULE may match such a run otherwise and are left to
    the library.
    """
    at = 0
    if len(part) >= limit and enc._pat_str.endswith(SPACE_RULE):
        for run in regex.finditer(rf"(?<!\s)\s{{{limit},}}+", part):
            end = run.end() if run.end() == len(part) else run.end() - 1
            yield from enc.encode_ordinary(part[at : run.start()])
            yield from enc._encode_single_piece(part[run.start() : end])
            at = end
    yield from enc.encode_ordinary(part[at:])


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= LONG_TEXT:
        return enc.encode_ordinary(text)
    return [i for part in safe_parts(text) for i in encode_part(enc, part)]


def _id_arrays(column: pa.Array, ranks_path: str, pattern: str) -> pa.Array:
    enc = encoding(ranks_path, pattern)
    ids = [np.array(encode_text(enc, text or ""), np.int32) for text in column.to_pylist()]
    borders = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=borders[1:])
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(flat))


def _bytes(ids: pa.Array, ranks_path: str, pattern: str) -> pa.Array:
    enc = encoding(ranks_path, pattern)
    decoded = [enc.decode_bytes(x) if x is not None else b"" for x in ids.to_pylist()]
    return pa.array(decoded, pa.binary())


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of its texts, as tiktoken gives them without special tokens.

    A null or empty text has no ids. Every row is encoded alone, so repeated rows repeat.
    A column already named ``ids`` is replaced. ``ranks_path`` names a file that every
    executor has.
    """
    return with_arrays(df, text, {ids: IDS}, lambda column: {ids: _id_arrays(column, ranks_path, pattern)})


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes its ids stand for; they are not made into text, as ids cut
    anywhere need not be whole characters. Null ids give no bytes."""
    schema = T.StructType([f for f in df.schema if f.name != decoded]).add(decoded, T.BinaryType())
    names = [name for name in schema.names if name != decoded]

    def run(batches):
        for batch in batches:
            made = _bytes(batch.column(ids), ranks_path, pattern)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), made], names=[*names, decoded])

    return df.select(*(f"`{n}`" for n in names)).mapInArrow(run, schema)


def round_trip(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``encode`` and then ``decode``, in one pass through Python."""

    def compute(column: pa.Array) -> dict[str, pa.Array]:
        arrays = _id_arrays(column, ranks_path, pattern)
        return {ids: arrays, decoded: _bytes(arrays, ranks_path, pattern)}

    return with_arrays(df, text, {ids: IDS, decoded: T.BinaryType()}, compute, drop)


