import gzip
import hashlib

import pytest
from conftest import values

from cellweave.llm import warc

LONG = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 60


@pytest.fixture
def pages(spark):
    rows = [
        (1, "http://a/1", LONG, "x"),
        (2, "http://a/2", LONG, "x"),
        (7, None, LONG, "x"),
        (7, None, LONG, "x"),
        (3, "http://a/3\r\nWARC-Type: warcinfo", "short", "x"),
        (4, "http://a/4", "short", "x"),
        (5, "http://a/5", None, "x"),
        (6, "http://a/6", "", "x"),
        (None, "http://a/n", LONG, "x"),
        (8, "http://a/8", "y" * 2000, "x"),
        (None, "http://a/n", "z" * 1000, "x"),
        (9, "http://a/9", "q" * 3_000_000, "x"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, refers_to string")


@pytest.mark.parametrize("file_bytes", [1 << 22, 500])
def test_records_come_back(spark, tmp_path, pages, file_bytes):
    path = f"{tmp_path}/warc"
    warc.write(pages, path, file_bytes=file_bytes)
    found = warc.read(spark, path)
    assert found.count() == pages.count()
    for row in found.collect():
        if row.record_type == "response":
            assert hashlib.sha1(row.payload).hexdigest() == row.payload_digest
        else:
            assert row.payload is None and row.refers_to_record
    got = warc.join_revisits(found).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want = []
    for row in pages.collect():
        body = (row.html or "").encode()
        last = 7 if row.html == LONG and row.page_id != 7 else None
        kind = "revisit" if last else "response"
        want.append((row.page_id, len(body), hashlib.sha1(body).hexdigest(), kind, last))
    assert values(got) == sorted(want, key=repr)


def test_repeated_rows_stay_with_their_tasks(spark, tmp_path):
    rows = [(1, "http://a/1", LONG)] * 300 + [(2, "http://a/2", LONG)] + [(None, None, "z" * 1500)] * 300
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    path = f"{tmp_path}/warc"
    warc.write(pages, path, file_bytes=3_000)
    sizes = warc.index(spark, path).groupBy("file").agg({"length": "sum", "*": "count"}).collect()
    assert max(row["sum(length)"] for row in sizes) < 3_000 + 2_000 and len(sizes) > 10
    got = warc.join_revisits(warc.read(spark, path)).groupBy("page_id", "record_type", "refers_to").count()
    assert values(got) == sorted([(1, "revisit", 2, 300), (2, "response", None, 1), (None, "response", None, 300)], key=repr)


def test_files_do_not_follow_from_the_shuffle(spark, tmp_path, settings):
    settings(shuffle__partitions="64", adaptive__coalescePartitions__enabled="false")
    rows = [(i, "http://a", LONG if i % 2 else f"{i}" * 900) for i in range(500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    warc.write(pages, f"{tmp_path}/warc")
    files = list((tmp_path / "warc").glob("*.warc.gz"))
    assert 1 <= len(files) <= 4 * spark.sparkContext.defaultParallelism
    assert [x for x in (tmp_path / "warc").rglob("*.warc.gz") if x not in files] == []


def test_a_single_record_is_read_by_its_place(spark, tmp_path, pages):
    path = f"{tmp_path}/warc"
    warc.write(pages, path)
    places = warc.index(spark, path).collect()
    assert len(places) == pages.count()
    for row in places:
        named, block = warc.record_at(f"{path}/{row.file}", row.offset, row.length)
        assert (named["warc-record-id"], named["warc-type"]) == (row.record_id, row.record_type)
        assert len(block) == int(named["content-length"])
    # Each is a gzip file by itself.
    whole = (tmp_path / "warc" / places[0].file).read_bytes()
    part = whole[places[0].offset : places[0].offset + places[0].length]
    assert gzip.decompress(part).startswith(b"WARC/1.1")


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_streams_of_any_chunks(size):
    blocks = [b"", b"a", b"\r\n\r\nWARC/1.1\r\n" * 9, bytes(range(256)) * 40]
    records = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (len(x), x) for x in blocks]
    for data in (b"".join(records), gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        chunks = (data[i : i + size] for i in range(0, len(data), size))
        assert [block for _, block in warc.parse(warc.unpacked(chunks))] == blocks
    with pytest.raises(ValueError, match="cut short"):
        list(warc.parse([records[1][:-3]]))
    assert list(warc.parse([])) == []


def test_a_page_that_very_many_rows_repeat_is_split(spark, tmp_path, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", shuffle__partitions="8",
             adaptive__skewJoin__skewedPartitionThresholdInBytes="4k", adaptive__skewJoin__skewedPartitionFactor="1.1",
             adaptive__advisoryPartitionSizeInBytes="2k")
    rows = [(i, f"http://a/{i}", LONG) for i in range(3000)] + [(10_000 + i, "http://b", f"{i}" * 1000) for i in range(300)]
    pages = warc.headers(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8))
    resolved = warc.resolve(warc.stored(pages.drop("html")))
    resolved.collect()
    assert "skew=true" in resolved._jdf.queryExecution().executedPlan().toString()


def test_headers_can_not_be_smuggled_in(spark, tmp_path, pages):
    warc.write(pages.filter("page_id = 3"), f"{tmp_path}/warc")
    row = warc.read(spark, f"{tmp_path}/warc").first()
    assert row.record_type == "response"
    assert row.url == "http://a/3%20%20WARC-Type:%20warcinfo"


def test_no_pages(spark, tmp_path, pages):
    warc.write(pages.filter("page_id < 0"), f"{tmp_path}/warc")
    assert warc.join_revisits(warc.read(spark, f"{tmp_path}/warc")).count() == 0


def test_a_damaged_payload_is_noticed():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <r>\r\nWARC-Payload-Digest: sha1:" + b"0" * 40
    record += b"\r\nContent-Length: 7\r\n\r\nH\r\n\r\nab\r\n\r\n"
    ((named, block),) = warc.parse([record])
    assert block == b"H\r\n\r\nab"
    with pytest.raises(ValueError, match="digest"):
        warc._row(named, block, True)


def test_digests_in_either_base():
    assert warc._hex("sha1:VL2MMHO4YXUKFWV63YHTWSBM3GXKSQ2N") == "aaf4c61ddcc5e8a2dabede0f3b482cd9aea9434d"
    assert warc._hex("sha1:AAF4C61DDCC5E8A2DABEDE0F3B482CD9AEA9434D") == "aaf4c61ddcc5e8a2dabede0f3b482cd9aea9434d"
