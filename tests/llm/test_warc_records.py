"""Operator 12: records written and read back, against plain Python."""

import gzip
import hashlib
import io
import os

import pytest
from helpers import collected
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from crawlweave.llm import warc_records as wr
from crawlweave.session import local_path, scratch_dir

BIG = "<p>" + "0123456789é" * 300_000
SAME = "<html>" + "same " * 300
PAGES = [
    (1, "http://a/", SAME), (2, "http://b/", SAME), (9, "http://c/ü\r\nX-Evil: 1", SAME), (3, None, None),
    (4, "http://d/", ""), (5, "http://e/", "short"), (6, "http://f/", "short"), (7, "http://g/", BIG),
    (8, "http://h/", BIG), (10, "http://i/", "x" * 999), (11, "http://j/", "x" * 999),
    (12, "http://k/", "y" * 1000), (13, "http://l/", "y" * 1000), (14, "http://m/", "é" * 500),
    # a row repeated, a row without an id, copies none of which has an id
    (9, "http://c/", SAME), (None, "http://n/", SAME), (None, None, "z" * 2000), (None, None, "z" * 2000),
    (15, "nul\x00", "nul\x00" * 400), (16, "http://o/", "line\r\n\r\nline" * 100),
]
SCHEMA = "page_id long, url string, html string, record_type string, digest string, last string"


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA).repartition(3)


def expected(rows=PAGES):
    groups = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= 1000 and i is not None:
            groups[html] = max(i, groups.get(html, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        largest = groups.get(html) if len(data) >= 1000 else None
        revisit = largest is not None and i != largest
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    largest if revisit else None))
    return sorted(map(repr, out))


def listed(df):
    return sorted(repr(tuple(r)) for r in df.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


def test_round_trip(spark):
    assert listed(wr.round_trip(pages(spark))) == expected()


def test_payloads_in_chunks_and_plain_readers(spark):
    """Small chunks and archives; payloads, running digests and files as another reader sees them."""
    folder = scratch_dir(spark, "warc-test")
    records = wr.records_of(pages(spark))
    index = wr.write_archives(wr.chunk_table(records, chunk_bytes=1000), folder, archive_bytes=5000)
    back = collected(wr.read_archives(spark, folder, chunk_bytes=700))
    by_record = {}
    for r in sorted(back, key=lambda r: (r["file"], r["offset"], r["chunk_no"])):
        assert len(r["data"]) <= 700
        held = by_record.setdefault((r["file"], r["offset"]), [])
        assert r["chunk_no"] == len(held)
        held.append(r)
    assert len(by_record) == len(PAGES)
    html = {(i, hashlib.sha1((h or "").encode()).hexdigest()): (h or "").encode() for i, _, h in PAGES}
    for chunks in by_record.values():
        data, last = b"".join(r["data"] for r in chunks), chunks[-1]
        assert [r["last"] for r in chunks] == [False] * (len(chunks) - 1) + [True]
        assert all(r["payload_digest"] is None for r in chunks[:-1])
        for r in chunks:
            assert r["sha1_so_far"] == hashlib.sha1(data[:r["bytes_so_far"]]).hexdigest()
        own = html[(None if last["record_id"] is None else int(last["record_id"]), last["payload_digest"])]
        assert last["payload_bytes"] == len(own)
        assert data == (b"" if last["record_type"] == "revisit" else own)
    files = {r.file for r in index.select("file").distinct().collect()}
    assert len(files) > 3
    for row in index.collect():
        with open(os.path.join(local_path(folder), "archives", row.file), "rb") as f:
            f.seek(row.offset)
            text = gzip.GzipFile(fileobj=io.BytesIO(f.read(row.length))).read()
        head, body = text.split(b"\r\n\r\n", 1)
        names = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert b"X-Evil" not in names
        assert len(body) == int(names[b"Content-Length"]) + 4 and body.endswith(b"\r\n\r\n")


def test_only_committed_files_are_read(spark):
    folder = scratch_dir(spark, "warc-test")
    wr.write_archives(wr.chunk_table(wr.records_of(pages(spark))), folder)
    with open(os.path.join(local_path(folder), "archives", "000000-999-00000.warc.gz"), "wb") as f:
        f.write(b"left by a lost task")
    assert wr.read_archives(spark, folder).filter("last").count() == len(PAGES)


def test_damage_is_an_error(spark):
    folder = scratch_dir(spark, "warc-test")
    index = wr.write_archives(wr.chunk_table(wr.records_of(pages(spark).coalesce(1))), folder)
    name = os.path.join(local_path(folder), "archives", index.orderBy(F.desc("length")).first().file)
    with open(name, "r+b") as f:
        f.truncate(os.path.getsize(name) - 20)
    with pytest.raises(PythonException, match="member"):
        wr.read_archives(spark, folder).collect()


@pytest.mark.parametrize("spoil", ["chunk_no <> 1", "NOT last"])
def test_missing_chunks_are_an_error(spark, spoil):
    chunks = wr.chunk_table(wr.records_of(pages(spark)), chunk_bytes=1000).filter(spoil)
    with pytest.raises(PythonException, match="chunk"):
        wr.write_archives(chunks, scratch_dir(spark, "warc-test"))


def test_copies_of_a_third_of_the_rows(spark):
    rows = [(i, f"http://{i}/", SAME if i % 3 == 0 else f"{i} " * 400) for i in range(600)]
    assert listed(wr.round_trip(pages(spark, rows))) == expected(rows)


def test_other_ids_and_empty_table(spark):
    rows = spark.createDataFrame([("a:b/ü", "q" * 1500), ("", "q" * 1500), (None, "x")], "k string, body string")
    out = wr.round_trip(rows, "k", "body", None)
    assert sorted((repr(r.k), r.record_type, repr(r.refers_to)) for r in out.collect()) == [
        ("''", "revisit", "'a:b/ü'"), ("'a:b/ü'", "response", "None"), ("None", "response", "None")]
    assert wr.round_trip(pages(spark, [])).collect() == []
