"""Counters kept by signed changes, and compactions that rewrite touched buckets only."""

import json

from pyspark.sql import functions as F

from crawlweave import commands as C
from crawlweave.operators import metrics as M
from crawlweave.plans import fixtures as FX
from crawlweave.session import scratch_dir
from crawlweave.sources import warc as W
from crawlweave.streaming import ingest_stream as IS

SNAP = "CC-MAIN-2031-07"


def rec(url):
    return json.dumps({"warc_headers": {"warc-target-uri": url, "warc-date": "2031-07-01T00:00:00Z"}})


def crawl(spark, meta, index, archives, first, n, name):
    """A shard of URLs, an archive with most of their pages, an index of those."""
    urls = [f"http://a/{i}" for i in range(first, first + n)]
    lines = [(f"{SNAP}/tt_meta_{name}.jsonl.zst", i, rec(u)) for i, u in enumerate(urls)]
    FX.write_zstd_files(spark.createDataFrame(lines, "rel string, seq long, value string"), meta).count()
    pages = [(f"{name}.warc.gz", i, u, bytearray(b"<p>x"), False, False, u + "?other" if i % 5 == 1 else None)
             for i, u in enumerate(urls) if i % 4]
    loc = W.write_archives(spark.createDataFrame(
        pages, "archive string, seq long, url string, html binary, gzip_body boolean, chunked boolean, target string"),
        archives).collect()
    cdx = [(f"k 20310701000000 {json.dumps(dict(url=r.url, filename=r.archive, offset=str(r.offset), length=str(r.length)))}",)
           for r in loc]
    (spark.createDataFrame(cdx, "value string").coalesce(1).write.mode("append").option("compression", "gzip")
     .text(f"{index}/{SNAP}/{name}"))


def check(spark, state):
    """The kept counters are there and are those of the whole state."""
    assert C.kept_changes(spark, state) is not None
    full = C.current_state(spark, state)
    assert C.stats(spark, state).collect() == M.progress_stats(full).collect()
    by = [C.stats(spark, state, by_snapshot=True), M.progress_by_snapshot(full)]
    assert by[0].dtypes == by[1].dtypes
    assert sorted(map(str, by[0].collect())) == sorted(map(str, by[1].collect()))
    return C.stats(spark, state).first()


def test_changes_add_up_after_every_command(spark):
    meta, index, archives, state = (scratch_dir(spark, n) for n in ("meta", "index", "warc", "state"))
    assert check(spark, state).total == 0
    crawl(spark, meta, index, archives, 0, 12, "a")
    C.ingest(spark, meta, state)
    assert check(spark, state).total == 12
    C.resolve_local(spark, state, index)
    assert check(spark, state).resolved == 9
    C.extract_html(spark, state, archives)
    s = check(spark, state)
    assert s.downloaded + s.errors == 9 and s.errors > 0
    C.compact(spark, state)
    crawl(spark, meta, index, archives, 100, 5, "b")
    C.ingest(spark, meta, state)
    C.ingest(spark, meta, state, force=True)
    C.extract_ranges(spark, state, archives)          # error rows are read again, now without the target check
    s = check(spark, state)
    assert s.total == 17 and s.errors == 0 and s.downloaded == 9
    C.resolve_local(spark, state, index)
    assert check(spark, state).resolved == 12
    # a run whose changes are missing: counted from the state
    C._append_events(C.events(spark, state).limit(0).drop("run"), state, C._next_seq(state))
    assert C.kept_changes(spark, state) is None and C.stats(spark, state).first().total == 17


def test_compaction_rewrites_touched_buckets(spark):
    meta, index, archives, state = (scratch_dir(spark, n) for n in ("meta", "index", "warc", "state"))
    crawl(spark, meta, index, archives, 0, 40, "a")
    C.ingest(spark, meta, state)
    first = C.compact(spark, state, buckets=16)
    held = {r.b for r in C.url_rows(spark, state).select(C.bucket_of(16).alias("b")).distinct().collect()}
    assert set(IS.folders(f"{state}/compact/v={first}", "bucket")) == held
    # nothing new: nothing is written, the state is the same
    second = C.compact(spark, state)
    assert IS.folders(f"{state}/compact/v={second}", "bucket") == []
    assert C.current_state(spark, state).count() == 40
    # one new URL and an event for another one, and an event for a URL that is not there
    crawl(spark, meta, index, archives, 70, 1, "b")
    C.ingest(spark, meta, state)
    key = C.url_rows(spark, state).where("url_raw = 'http://a/3'").first().hf_path
    seq = C._next_seq(state)
    C._append_events(spark.createDataFrame(
        [(key, "http://a/3", seq, "matched", "f", 1, 2, None, None), ("none", "none", seq, "missing", None, None, None, None, None)],
        "hf_path string, url_raw string, seq long, kind string, filename string, offset long, length long, "
        "saved_path string, message string"), state, seq)
    before = sorted(map(str, C.current_state(spark, state).select(*C.KEY, "status", "filename").collect()))
    third = C.compact(spark, state)
    touched = {r.b for r in C.url_rows(spark, state).where("url_raw IN ('http://a/3', 'http://a/70')").select(
        C.bucket_of(16).alias("b")).collect()}
    assert touched <= set(IS.folders(f"{state}/compact/v={third}", "bucket")) and len(touched) <= 2
    assert len(IS.folders(f"{state}/compact/v={third}", "bucket")) <= 3
    assert sorted(map(str, C.current_state(spark, state).select(*C.KEY, "status", "filename").collect())) == before
    assert C.current_state(spark, state).where(F.col("filename") == "f").first().url_raw == "http://a/3"
    assert C.current_state(spark, state).count() == 41
