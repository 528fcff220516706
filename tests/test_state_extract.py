"""State folding, selections, stats, archive extraction."""

from pyspark.sql import functions as F

from crawlweave.operators import extract as X
from crawlweave.operators import metrics as M
from crawlweave.operators import state as ST
from crawlweave.sources import warc as W

STATE = ("snapshot_name string, hf_path string, url_raw string, digest string, offset long, length long, "
         "filename string, status string, saved_path string, last_error string, ord long")
EVENTS = ("ord long, seq long, kind string, filename string, offset long, length long, saved_path string, "
          "message string")


def test_error_cut_and_cleared(spark):
    state = spark.createDataFrame([("S", "p", "u", None, 1, 2, "f", "matched", None, None, 1)], STATE)
    ev = spark.createDataFrame([(1, 1, "error", None, None, None, None, "x" * 900)], EVENTS)
    s1 = ST.fold_events(state, ev, ["ord"]).first()
    assert s1.status == "error" and len(s1.last_error) == 500 and s1.filename == "f"
    ev2 = ev.unionByName(spark.createDataFrame([(1, 2, "downloaded", None, None, None, "/tmp/out.html", None)], EVENTS))
    s2 = ST.fold_events(state, ev2, ["ord"]).first()
    assert (s2.status, s2.saved_path, s2.last_error) == ("downloaded", "/tmp/out.html", None)


def test_missing_keeps_location_matched_sets_it(spark):
    state = spark.createDataFrame([("S", "p", "u", None, None, None, None, "pending", None, None, 1)], STATE)
    ev = spark.createDataFrame([(1, 1, "matched", "a", 1, 2, None, None), (1, 2, "missing", None, None, None, None, None)], EVENTS)
    r = ST.fold_events(state, ev, ["ord"]).first()
    assert (r.status, r.filename, r.offset, r.length) == ("missing", "a", 1, 2)


def test_ready_excludes_saved_and_stats(spark):
    state = spark.createDataFrame([
        ("S", "p", "a", None, 1, 2, "f1", "matched", None, None, 1),
        ("S", "p", "b", None, 1, 2, "f1", "downloaded", "/x", None, 2),
        ("S", "p", "c", None, None, None, None, "pending", None, None, 3),
        ("T", "p", "d", None, 1, 2, "f2", "error", None, "boom", 4)], STATE)
    assert sorted(r.url_raw for r in ST.ready(state).collect()) == ["a", "d"]
    assert ST.count_ready(state, "S") == 1
    assert tuple(M.progress_stats(state).first()) == (4, 3, 1, 1)
    assert tuple(M.progress_stats(state.limit(0)).first()) == (0, 0, 0, 0)
    assert [r.filename for r in X.ready_archives(state).orderBy("filename").collect()] == ["f1", "f2"]


def test_decode_record_variants():
    html = "<html>décodé</html>".encode()
    assert W.decode_record(W.encode_record("u", html)) == html
    assert W.decode_record(W.encode_record("u", html, gzip_body=True)) == html
    assert W.decode_record(W.encode_record("u", html * 500, chunked=True)) == html * 500
    try:
        W.decode_record(W.encode_record("u", html, target="other"), "u")
        raise AssertionError("mismatch not detected")
    except ValueError as e:
        assert str(e) == W.TARGET_MISMATCH
    assert W.decode_record(W.encode_record("u", html, target="other"), "u", check_target=False) == html


def test_read_ranges_round_trip(spark, tmp_root):
    recs = spark.createDataFrame(
        [("a/x.warc.gz", i, f"https://e/{i}", bytearray(f"<p>{i}</p>".encode()), i % 2 == 0, False,
          "https://other" if i == 3 else None) for i in range(6)],
        "archive string, seq long, url string, html binary, gzip_body boolean, chunked boolean, target string")
    loc = W.write_archives(recs, tmp_root).withColumn("url_raw", F.col("url"))
    bad = spark.createDataFrame([("a/missing.warc.gz", 0, 10, "z"), ("a/x.warc.gz", 0, 0, "y")],
                                "archive string, offset long, length long, url_raw string")
    rows = loc.select("archive", "offset", "length", "url_raw").unionByName(bad)
    got = {r.url_raw: r for r in X.extract_html(rows, tmp_root, ["url_raw"]).collect()}
    assert got["https://e/0"].html == "<p>0</p>" and got["https://e/5"].html == "<p>5</p>"
    assert got["https://e/3"].error == W.TARGET_MISMATCH
    assert got["z"].error is not None and got["y"].error is not None
    assert [r.archive for r in W.list_archives(spark, tmp_root).collect()] == ["a/x.warc.gz"]


def test_decode_payloads_from_bytes(spark):
    body = W.encode_record("u", b"<b>hi</b>", gzip_body=True)
    df = spark.createDataFrame([(1, bytearray(body)), (2, bytearray(b"junk"))], "id long, body binary")
    got = {r.id: r for r in W.decode_payloads(df).collect()}
    assert bytes(got[1].payload) == b"<b>hi</b>" and got[2].error


def test_write_path_file(spark, tmp_root):
    state = spark.createDataFrame([
        ("S", "p", "a", None, 1, 2, "b.warc.gz", "matched", None, None, 1),
        ("S", "p", "b", None, 3, 2, "a.warc.gz", "matched", None, None, 2),
        ("S", "p", "c", None, 5, 2, "a.warc.gz", "matched", None, None, 3),
        ("S", "p", "d", None, 5, 2, "c.warc.gz", "downloaded", "/x", None, 4)], STATE)
    X.write_path_file(state.repartition(3), tmp_root)
    import glob
    import os

    from crawlweave.session import local_path

    lines = []
    for f in sorted(glob.glob(os.path.join(local_path(tmp_root), "part-*"))):
        lines += open(f).read().splitlines()
    assert lines == ["a.warc.gz", "b.warc.gz"]


def test_coalesce_ranges():
    reads = W.coalesce_ranges([(0, 10), (10, 5), (2000, 10), (2_000_000, 1)], gap=100, span=1000)
    assert reads == [(0, 15, [0, 1]), (2000, 2010, [2]), (2_000_000, 2_000_001, [3])]
    assert W.coalesce_ranges([(0, 600), (650, 600)], gap=100, span=1000) == [(0, 600, [0]), (650, 1250, [1])]


def test_aggregates_on_empty_input(spark):
    from crawlweave.operators import resolve as R

    state = spark.createDataFrame([], STATE)
    assert tuple(M.progress_stats(state).first()) == (0, 0, 0, 0)
    assert [tuple(r) for r in M.progress_by_snapshot(state).collect()] == [(None, 0, 0, 0, 0)]
    assert M.saved_counts(state, 5).count() == 0
    assert [tuple(r) for r in R.resolution_summary(state).collect()] == [(None, 0, 0)]
    ev = spark.createDataFrame([], EVENTS)
    assert ST.fold_events(state, ev, ["ord"]).count() == 0
    one = spark.createDataFrame([("S", "p", "u", None, None, None, None, "pending", None, None, 1)], STATE)
    assert ST.fold_events(one, ev, ["ord"]).first().status == "pending"


def test_coalesce_ranges_properties():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.tuples(st.integers(0, 10_000), st.integers(1, 500)), max_size=40),
           st.integers(0, 300), st.integers(1, 2_000))
    def check(raw, gap, span):
        ranges = sorted(raw)
        reads = W.coalesce_ranges(ranges, gap=gap, span=span)
        seen = sorted(m for _, _, members in reads for m in members)
        assert seen == list(range(len(ranges)))                     # each record in exactly one read
        for start, end, members in reads:
            for m in members:
                off, ln = ranges[m]
                assert start <= off and off + ln <= end               # the read covers the record
            assert end - start <= span or len(members) == 1           # span bound unless one big record
        for (s0, e0, _), (s1, _, _) in zip(reads, reads[1:]):
            assert s1 >= s0                                           # reads stay in offset order
    check()


def test_bodies_that_deviate_from_their_headers():
    import zlib

    import pytest

    html = b"<html>" + b"page " * 500
    for variant in ("deflate", "raw-deflate", "chunked-plain", "gzip-plain"):
        assert W.decode_record(W.encode_record("u", html, variant=variant)) == html, variant
    for variant, message in (("brotli", "content encoding br is not supported"), ("short", "record ends early")):
        with pytest.raises(ValueError, match=message):
            W.decode_record(W.encode_record("u", html, variant=variant))
    whole = W.encode_record("u", html)
    with pytest.raises(W.CutShort):
        W.decode_record(whole[:len(whole) // 2])
    plain = zlib.decompress(whole, 31)
    with pytest.raises(W.CutShort):
        W.decode_record(plain[:-300])
    assert W.decode_record(plain) == html


def test_a_length_that_is_too_small_costs_nothing(spark, tmp_root):
    import os

    pages = [os.urandom(3000 + 40_000 * i) for i in range(5)]
    recs = spark.createDataFrame([("x.warc.gz", i, f"u{i}", bytearray(p), False, False, None) for i, p in enumerate(pages)],
                                 "archive string, seq long, url string, html binary, gzip_body boolean, chunked boolean, "
                                 "target string")
    loc = W.write_archives(recs, tmp_root).withColumn("length", F.greatest(F.lit(1), F.floor(F.col("length") / 7)))
    got = W.read_ranges(loc.withColumnRenamed("url", "url_raw"), tmp_root, ["url_raw"]).collect()
    assert {r.url_raw: bytes(r.payload) for r in got} == {f"u{i}": p for i, p in enumerate(pages)}


def test_byte_reading_is_spread(spark, tmp_root):
    from crawlweave.sources import metadata as MD

    n = 100_000
    rows = spark.range(n).select(F.format_string("a%02d", F.col("id") % 100).alias("archive"),
                                 (F.col("id") * 1000).alias("offset"), F.lit(4000).cast("long").alias("length"),
                                 F.lit("u").alias("url_raw"))
    tasks = W.read_ranges(rows, tmp_root, ["archive", "offset"]).select(F.spark_partition_id().alias("t"))
    assert tasks.distinct().count() >= 4
    shards = spark.range(2000).select(F.concat(F.lit(tmp_root + "/s"), "id").alias("file_path"),
                                      F.format_string("s%04d", "id").alias("hf_path"))
    assert shards.repartitionByRange(2000, "hf_path").rdd.getNumPartitions() > 1500
    plan = MD.stream_lines(shards)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(hf_path" in plan and ", 2000)" in plan
