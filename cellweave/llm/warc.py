"""WARC archives with revisit records for payloads that repeat, written and read by Spark.

Headers alone are shuffled, by the digest of the payload, and say which records are stored.
Payloads stay with the task that reads them, but for those that a bitmap of the revisits can
not tell from one. Every record is a gzip member of its own, as is usual, and an index says where
it begins, so single records can be read; whole files are read as streams.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.llm import bitmaps
from cellweave.llm.batches import fresh, stored
from cellweave.llm.words import slices
from cellweave.session import qualified, remove

#: Shorter payloads are always stored.
LEAST_BYTES = 1000
#: Bytes after which an archive file ends and another begins.
FILE_BYTES = 1 << 30
#: Payload bytes that a reader hands on at a time, and bytes it takes from a file at a time.
READ_BYTES, CHUNK_BYTES = 4 << 20, 1 << 20
#: Bitmap of the revisit records: 8 MB. Too small a one moves more payloads, and changes no role.
REVISIT_BITS = 26
#: Pages that go to Python in one go.
BATCH_PAGES = 1000

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END_OF_RECORD = "\r\n\r\n"

#: Where a record is: file, first byte and number of bytes.
INDEX = "file string, offset long, length long, record_id string, record_type string, page_id long"

RECORD = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to_record", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def headers(pages: DataFrame, payload: str = "html") -> DataFrame:
    """Size and digest of each page's payload. A null payload counts as empty."""
    body = F.coalesce(F.col(payload), F.lit(""))
    return pages.withColumns(
        {
            "payload_bytes": F.octet_length(body).cast("long"),
            "payload_digest": F.sha1(F.encode(body, "UTF-8")),
        }
    )


def resolve(head: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """``head`` (page_id, payload_digest, payload_bytes) with ``refers_to``.

    Of records with equal payloads of ``least`` bytes or more, the one with the largest
    page_id is stored and the others refer to it; ``refers_to`` is null for stored ones.
    Only headers move. The largest id is found by partial aggregation, so a payload that a
    third of the pages share costs one row per task, and stored, so that the join back is one of
    two plain exchanges, which adaptive execution splits. Rows repeated with the same page_id
    stay equal to each other. A null page_id is below all others; where a payload has no
    other, it is stored.
    """
    last, copies = fresh(head.columns, "stored", "copies")
    winners = (
        head.filter(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias(last), F.count(F.lit(1)).alias(copies))
        .filter(F.col(copies) > 1)
        .drop(copies)
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col(last)), F.col(last))
    return head.join(stored(winners), "payload_digest", "left").withColumn("refers_to", refers).drop(last)


def _record_id(page_id: Column, digest: Column) -> Column:
    made = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), digest))
    parts = [F.substring(made, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(pages: DataFrame, written_at: datetime, payload: str = "html") -> DataFrame:
    """``value``, each page as a whole WARC record, and what an index has of it.

    ``pages`` has page_id, url, ``payload``, payload_bytes, payload_digest, record_id and
    refers_to. Of revisits the payload is not looked at.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    revisit = F.col("refers_to").isNotNull()
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, body))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    optional = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    digest = F.col("payload_digest")
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.lit(written_at.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))),
        optional("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(
            revisit,
            F.concat(
                F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\n"),
                line("WARC-Refers-To", _record_id(F.col("refers_to"), digest)),
            ),
        ).otherwise(F.lit("")),
        optional("X-Page-ID", F.col("page_id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return pages.select(
        F.concat(head, block, F.lit(END_OF_RECORD)).alias("value"), "record_id", kind.alias("record_type"), "page_id"
    )


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    """Spark lists plain text, Arrow wants a URI and its own name for S3."""
    return fs.FileSystem.from_uri(quote(re.sub(r"^s3[an]:", "s3:", uri), safe="/:@"))


def _write_files(folder: str, file_bytes: int):
    """Tasks write records as gzip members to files of their own, and say where each is."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, base = _place(folder)
        store.create_dir(base, recursive=True)
        nth, out, at, name = 0, None, 0, ""
        try:
            for batch in slices(batches, "value"):
                files, offsets, lengths = [], [], []
                for value in batch.column("value").cast(pa.binary()).to_pylist():
                    if out is None:
                        # An attempt that is lost leaves a file that no index names.
                        name = f"{task.partitionId():06d}-{nth:04d}-{task.taskAttemptId()}.warc.gz"
                        out, at, nth = store.open_output_stream(f"{base}/{name}", compression=None), 0, nth + 1
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = packer.compress(value) + packer.flush()
                    out.write(member)
                    files.append(name)
                    offsets.append(at)
                    lengths.append(len(member))
                    at += len(member)
                    if at >= file_bytes:
                        out.close()
                        out = None
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(files, pa.string()),
                        pa.array(offsets, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        *(batch.column(c) for c in ("record_id", "record_type", "page_id")),
                    ],
                    names=["file", "offset", "length", "record_id", "record_type", "page_id"],
                )
        finally:
            if out is not None:
                out.close()

    return run


def _move_files(draft: str, target: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, source = _place(draft)
        _, folder = _place(target)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                # Should this run twice, the file is there already.
                if store.get_file_info(f"{source}/{name}").type != fs.FileType.NotFound:
                    store.move(f"{source}/{name}", f"{folder}/{name}")
            yield batch

    return run


def write(
    pages: DataFrame, path: str, payload: str = "html", least: int = LEAST_BYTES, file_bytes: int = FILE_BYTES
) -> None:
    """Write a record per page of ``pages`` (page_id, url, ``payload``) into archives at ``path``,
    a new folder, and an index of them, see ``index``.

    Headers are stored and resolved on their own; revisit records are made of them alone. Pages
    that surely are no revisit are written by the tasks that read them. Of the others, those
    that a bitmap of the revisits lets through, payloads are exchanged to tell which to leave
    out. There are as many files as tasks, about ``file_bytes`` or a record more at most, and
    tasks are no more than four for each core unless the payloads fill more files. Columns
    beyond these three are not written. No pages, no archives. Control characters in a url
    become %20, a null url is left out of the record.

    Only files of attempts that succeeded are moved to ``path``, once all are written.
    """
    spark = pages.sparkSession
    record_id = _record_id(F.col("page_id"), F.col("payload_digest"))
    pages = headers(pages.select("page_id", "url", payload), payload).withColumn("record_id", record_id)
    head = stored(pages.drop(payload))
    revisits = stored(resolve(head, least).filter("refers_to is not null"))
    again = stored(revisits.select("record_id").distinct())
    known = bitmaps.bitmap(again.select(F.xxhash64("record_id").alias("hash")), REVISIT_BITS)
    sure, maybe = bitmaps.apart(pages, F.xxhash64("record_id"), known)
    responses = sure.unionByName(maybe.join(again, "record_id", "left_anti").select(*sure.columns))
    now = datetime.now(timezone.utc)
    made = records(responses.withColumn("refers_to", F.lit(None).cast("long")), now, payload).unionByName(
        records(revisits.withColumn(payload, F.lit(None).cast("string")), now, payload)
    )
    total = head.agg(F.sum("payload_bytes")).first()[0] or 0
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-total // file_bytes))
    target = qualified(spark, path)
    draft = f"{target}/_{uuid.uuid4().hex}"
    written = stored(made.coalesce(tasks).mapInArrow(_write_files(draft, file_bytes), INDEX), BATCH_PAGES)
    written.write.parquet(f"{path}/_index")
    written.select("file").distinct().mapInArrow(_move_files(draft, target), "file string").count()
    remove(spark, draft)


def index(spark: SparkSession, path: str) -> DataFrame:
    """Where each record of the archives at ``path`` is: file, first byte and number of bytes."""
    return spark.read.schema(INDEX).parquet(f"{path}/_index")


def parse(chunks: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record in a stream of bytes.

    A record ends where its Content-Length says, whatever its block contains. No more than one
    record and a chunk are held.
    """
    held, at, chunks = b"", 0, iter(chunks)

    def more() -> bool:
        nonlocal held, at
        chunk = next(chunks, None)
        if chunk is not None:
            held, at = held[at:] + chunk, 0
        return chunk is not None

    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if at < len(held):
                    raise ValueError("the last record is cut short")
                return
        first, *lines = held[at:end].decode().split("\r\n")
        if first != VERSION:
            raise ValueError(f"no WARC record where one should begin: {first[:40]!r}")
        named = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
        begin, size = end + 4 - at, int(named["content-length"])
        parts, have = [held[at:]], len(held) - at
        while have < begin + size + len(END_OF_RECORD):
            chunk = next(chunks, None)
            if chunk is None:
                raise ValueError("the last record is cut short")
            parts.append(chunk)
            have += len(chunk)
        held, at = b"".join(parts), begin + size + len(END_OF_RECORD)
        yield named, held[begin : begin + size]


def unpacked(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """Content of gzip members one after the other, or of a file that is not packed."""
    chunks, begin = iter(chunks), b""
    while len(begin) < 2 and (chunk := next(chunks, None)) is not None:
        begin += chunk
    if begin[:2] != b"\x1f\x8b":
        yield begin
        yield from chunks
        return
    unpacker = zlib.decompressobj(31)
    for chunk in chain([begin], chunks):
        while chunk:
            yield unpacker.decompress(chunk)
            chunk = b""
            if unpacker.eof:
                chunk, unpacker = unpacker.unused_data, zlib.decompressobj(31)


def _chunks(file, size: int = CHUNK_BYTES) -> Iterator[bytes]:
    while chunk := file.read(size):
        yield chunk


def record_at(uri: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Headers and block of the one record that an index names; no other byte is read."""
    store, path = _place(uri)
    with store.open_input_file(path) as file:
        (record,) = parse(unpacked(iter([file.read_at(length, offset)])))
    return record


def _hex(digest: str) -> str:
    """Of a labelled digest in base 16 or, as others write it, base 32."""
    value = digest.partition(":")[2]
    return value.lower() if len(value) == 40 else base64.b32decode(value).hex()


def _row(named: dict[str, str], block: bytes, with_payload: bool) -> dict:
    page = named.get("x-page-id")
    row = {
        "page_id": int(page) if page is not None else None,
        "record_id": named["warc-record-id"],
        "record_type": named["warc-type"],
        "refers_to_record": named.get("warc-refers-to"),
        "payload_digest": _hex(named["warc-payload-digest"]),
        "payload_bytes": None,
        "url": named.get("warc-target-uri"),
        "payload": None,
    }
    if row["record_type"] == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if hashlib.sha1(payload).hexdigest() != row["payload_digest"]:
            raise ValueError(f"payload of {row['record_id']} does not have the digest its header names")
        row["payload_bytes"], row["payload"] = len(payload), payload if with_payload else None
    return row


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record of the archives at ``path``, as ``RECORD``; payload only in stored
    ones, and only if ``payloads``. A file is read by one task, as a stream."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(f.name, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.dataType.typeName()]) for f in RECORD]
        )
        for uri in (uri for batch in batches for uri in batch.column("path").to_pylist()):
            rows, size = [], 0
            store, place = _place(uri)
            with store.open_input_stream(place, compression=None) as file:
                for named, block in parse(unpacked(_chunks(file))):
                    rows.append(_row(named, block, payloads))
                    size += len(block) if payloads else 256
                    if size >= READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)

    # Without their content files are listed only, and dealt out by size.
    return spark.read.format("binaryFile").load(path).select("path").mapInArrow(run, RECORD)


def join_revisits(found: DataFrame) -> DataFrame:
    """``found``, as read, with the size of the payload and the page each revisit refers to.

    Only headers are joined, and the archives are read once for that. Stored records are made
    unique and stored, so that many revisits of one of them are split by adaptive execution.
    Repeated stored records count once.
    """
    slim = stored(
        found.select("page_id", "record_id", "record_type", "refers_to_record", "payload_digest", "payload_bytes", "url")
    )
    originals = stored(
        slim.filter("record_type = 'response'")
        .groupBy(F.col("record_id").alias("refers_to_record"))
        .agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("original_bytes"))
    )
    plain = slim.filter("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    again = (
        slim.filter("record_type = 'revisit'")
        .join(originals, "refers_to_record", "left")
        .withColumn("payload_bytes", F.col("original_bytes"))
        .drop("original_bytes")
    )
    return plain.unionByName(again)
