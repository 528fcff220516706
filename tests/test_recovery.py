"""Runs that stop half way, paths with odd characters, incomplete indexes."""

import json
import os

import pytest
from pyspark.sql import functions as F

from crawlweave import commands as C
from crawlweave.plans import fixtures as FX
from crawlweave.session import local_path, scratch_dir
from crawlweave.sources import cdx
from crawlweave.sources import metadata as MD
from crawlweave.sources import warc as W
from crawlweave.streaming import ingest_stream as IS

SF = "/root/testdata/sf0.001"


def rec(url):
    return json.dumps({"warc_headers": {"warc-target-uri": url, "warc-date": "2031-07-01T00:00:00Z"}})


def shard(spark, root, name, lines, **kw):
    df = spark.createDataFrame([(name, i, x) for i, x in enumerate(lines)], "rel string, seq long, value string")
    FX.write_zstd_files(df, root, **kw).count()


def located(spark, state, meta, archives, n=4):
    """A state of ``n`` rows that point at records of one archive."""
    shard(spark, meta, "CC-MAIN-2031-07/tt_meta_0.jsonl.zst", [rec(f"http://a/{i}") for i in range(n)])
    C.ingest(spark, meta, state)
    records = spark.createDataFrame([("x.warc.gz", i, f"http://a/{i}", bytearray(b"<p>page %d</p>" % i), False, False, None)
                                     for i in range(n)], "archive string, seq long, url string, html binary, "
                                    "gzip_body boolean, chunked boolean, target string")
    loc = W.write_archives(records, archives)
    (C.url_rows(spark, state).select("hf_path", "url_raw").join(loc, F.col("url_raw") == F.col("url"))
     .select("hf_path", "url_raw", F.lit(1).cast("long").alias("seq"), F.lit("matched").alias("kind"),
             F.col("archive").alias("filename"), "offset", "length", F.lit(None).cast("string").alias("saved_path"),
             F.lit(None).cast("string").alias("message")).write.parquet(f"{state}/events/run=1"))


def folders(spark, *names):
    return [scratch_dir(spark, n) for n in names]


def test_a_stop_between_pages_and_events_loses_nothing(spark, monkeypatch):
    state, meta, archives, out = folders(spark, "state", "meta", "warc", "export")
    located(spark, state, meta, archives)
    with monkeypatch.context() as m:
        m.setattr(C, "_append_events", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            C.extract_html(spark, state, archives)
    assert C.stats(spark, state).first().downloaded == 0 and C.saved_html(spark, state).count() == 0
    assert {r.kind: r.rows for r in C.extract_html(spark, state, archives).collect()} == {"downloaded": 4}
    assert C.saved_html(spark, state).count() == 4
    C.export_parquet(spark, state, out)
    assert sorted(r.html for r in spark.read.parquet(out).collect()) == [f"<p>page {i}</p>" for i in range(4)]


def test_an_extraction_that_saves_nothing_then_an_export(spark):
    state, meta, archives, out = folders(spark, "state", "meta", "warc", "export")
    located(spark, state, meta, archives)
    bad = local_path(archives) + "/x.warc.gz"
    size = os.path.getsize(bad)
    with open(bad, "wb") as f:
        f.write(b"?" * size)
    assert {r.kind for r in C.extract_html(spark, state, archives).collect()} == {"error"}
    assert C.extract_html(spark, state, archives).count() == 1      # error rows are tried again
    assert C.saved_html(spark, state).count() == 0
    saved = C.ST.saved(C.current_state(spark, state))
    assert saved.count() == 0


def test_an_empty_state_folder_and_a_half_written_batch(spark):
    state, meta = folders(spark, "state", "meta")
    for part in ("urls", "shards", "events/run=7", "html/run=7", "urls/batch=0"):
        os.makedirs(f"{local_path(state)}/{part}")
    assert C.stats(spark, state).first().total == 0
    shard(spark, meta, "S/tt_meta_0.jsonl.zst", [rec("u1"), rec("u2")])
    C.ingest(spark, meta, state)
    assert C.stats(spark, state).first().total == 2
    # rows without shard rows: the batch did not end
    spark.read.parquet(f"{state}/urls/batch=0").write.parquet(f"{state}/urls/batch=99")
    assert C.stats(spark, state).first().total == 2


def test_a_half_written_compaction_is_passed_over(spark):
    state, meta = folders(spark, "state", "meta")
    shard(spark, meta, "S/tt_meta_0.jsonl.zst", [rec("u1"), rec("u2")])
    C.ingest(spark, meta, state)
    seq = C.compact(spark, state)
    os.makedirs(f"{local_path(state)}/compact/v={seq + 10}/_temporary/0")
    assert C.stats(spark, state).first().total == 2
    shard(spark, meta, "S/tt_meta_1.jsonl.zst", [rec("u3")])
    C.ingest(spark, meta, state)
    assert C.stats(spark, state).first().total == 3


@pytest.mark.parametrize("name", ["with space", "per%20cent", "a+b", "c%d"])
def test_odd_characters_in_a_root(spark, name):
    base = scratch_dir(spark, "odd")
    plain = FX.write_cdx_fixture(spark, SF)
    odd = f"{base}/{name}"
    os.makedirs(os.path.dirname(local_path(odd)), exist_ok=True)
    import shutil

    shutil.copytree(local_path(plain), local_path(odd))
    columns = ["snapshot_name", "url", "offset", "capture_ts"]
    want = sorted(map(tuple, cdx.read_captures(spark, plain).select(*columns).collect()), key=str)
    assert sorted(map(tuple, cdx.read_captures(spark, odd).select(*columns).collect()), key=str) == want
    meta, state = f"{base}/{name}/meta", scratch_dir(spark, "state")
    shard(spark, meta, "S/tt_meta_0.jsonl.zst", [rec("u1"), rec("u2")])
    C.ingest(spark, meta, state)
    assert C.stats(spark, state).first().total == 2
    other = scratch_dir(spark, "state")
    C.ingest(spark, meta, other, stream=False)
    assert C.stats(spark, other).first().total == 2


def test_only_pending_files_are_opened(spark):
    meta, state = folders(spark, "meta", "state")
    for i in range(3):
        shard(spark, meta, f"S/tt_meta_{i}.jsonl.zst", [rec(f"u{i}")])
    C.ingest(spark, meta, state)
    shard(spark, meta, "S/tt_meta_new.jsonl.zst", [rec("u9")])
    todo = IS.IG.pending_shards(MD.list_shards(spark, meta), IS.shard_table(spark, f"{state}/shards"))
    files = MD.read_records(spark, meta, shards=todo).inputFiles()
    assert [os.path.basename(f) for f in files] == ["tt_meta_new.jsonl.zst"]
    assert IS.known_rows(spark, f"{state}/urls", f"{state}/shards", todo, 5) is None


def test_resolve_leaves_snapshots_without_a_whole_index(spark):
    meta, index, state, lists = folders(spark, "meta", "index", "state", "lists")
    cap = {"filename": "f.warc.gz", "offset": "1", "length": "2", "timestamp": "20310701000000"}
    for s in ("07", "08", "09"):
        shard(spark, meta, f"CC-MAIN-2031-{s}/tt_meta_0.jsonl.zst", [rec(f"http://{s}/")])
        os.makedirs(f"{local_path(index)}/CC-MAIN-2031-{s}")
    import gzip

    for s in ("07", "08"):
        with gzip.open(f"{local_path(index)}/CC-MAIN-2031-{s}/cdx-00000.gz", "wt") as f:
            f.write(f"k 20310701000000 {json.dumps(dict(cap, url=f'http://{s}/'))}\n")
        os.makedirs(f"{local_path(lists)}/CC-MAIN-2031-{s}")
        with gzip.open(f"{local_path(lists)}/CC-MAIN-2031-{s}/paths.gz", "wt") as f:
            f.write("i/cdx-00000.gz\n" + ("i/cdx-00001.gz\n" if s == "08" else ""))
    C.ingest(spark, meta, state)
    C.resolve_local(spark, state, index, manifest_root=lists)
    status = {r.snapshot_name[-2:]: r.status for r in C.current_state(spark, state).collect()}
    assert status == {"07": "matched", "08": "pending", "09": "pending"}
    C.resolve_local(spark, state, index)          # no manifests: an empty folder is still no index
    status = {r.snapshot_name[-2:]: r.status for r in C.current_state(spark, state).collect()}
    assert status == {"07": "matched", "08": "matched", "09": "pending"}


def test_long_windows_through_the_command(spark):
    meta, state = folders(spark, "meta", "state")
    shard(spark, meta, "S/tt_meta_0.jsonl.zst", [rec(f"u{i}") for i in range(20)], window_log=29)
    C.ingest(spark, meta, state, reader="stream")
    assert C.stats(spark, state).first().total == 20
