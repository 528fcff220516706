"""The command-level API end to end: ingest -> resolve -> extract -> export -> stats."""

import time

from pyspark.sql import functions as F

from crawlweave import commands as C
from crawlweave.plans import fixtures as FX
from crawlweave.session import scratch_dir

SF = "/root/testdata/sf0.001"


def test_end_to_end(spark):
    meta = FX.write_meta_fixture(spark, SF)
    index = FX.write_cdx_fixture(spark, SF)
    state = scratch_dir(spark, "state")

    C.ingest(spark, meta, state)
    C.ingest(spark, meta, state)                       # nothing new
    n = C.current_state(spark, state).count()
    assert n > 0 and C.url_rows(spark, state).count() == n

    summary = {r.snapshot_name: (r.matched, r.missing) for r in C.resolve_local(spark, state, index).collect()}
    matched, missing = summary[None]
    assert matched + missing == n and matched > 0
    st = C.current_state(spark, state)
    assert st.where(F.col("filename").isNotNull()).count() == matched
    assert st.where(F.col("status") == "missing").count() == missing
    # a second run retries only the rows still missing
    again = {r.snapshot_name: (r.matched, r.missing) for r in C.resolve_local(spark, state, index).collect()}
    assert sum(again.get(None, (0, 0))) == missing

    # point the state at real archive records, then extract and export
    archives, locations = FX.write_warc_fixture(spark, SF)
    loc = spark.read.parquet(locations)
    relocate = (C.url_rows(spark, state).select("hf_path", "url_raw").join(loc, F.col("url_raw") == F.col("url"))
                .select("hf_path", "url_raw", F.lit(1).cast("long").alias("seq"), F.lit("matched").alias("kind"),
                        F.col("archive").alias("filename"), "offset", "length",
                        F.lit(None).cast("string").alias("saved_path"), F.lit(None).cast("string").alias("message")))
    relocate.write.parquet(f"{state}/events/run=1")   # older than the resolve runs: they still win
    now = time.time_ns()                               # newer than the resolve runs, older than extraction
    relocate.withColumn("seq", F.lit(now)).write.parquet(f"{state}/events/run={now}")

    paths = scratch_dir(spark, "paths")
    assert C.write_paths(spark, state, paths) > 0
    first = {r.kind: r.rows for r in C.extract_ranges(spark, state, archives, limit=5).collect()}
    assert sum(first.values()) == 5 and first.get("downloaded", 0) > 0    # row budget, not archives
    kinds = {r.kind: r.rows for r in C.extract_html(spark, state, archives).collect()}
    assert kinds.get("downloaded", 0) > 0
    kinds["downloaded"] += first.get("downloaded", 0)
    again = C.extract_html(spark, state, archives).collect()   # saved rows are not extracted twice
    assert sum(r.rows for r in again) == kinds.get("error", 0)

    out = scratch_dir(spark, "export")
    counts = {r.snapshot: r.rows for r in C.export_parquet(spark, state, out, split_mb=0.01).collect()}
    assert sum(counts.values()) == kinds["downloaded"]
    back = spark.read.parquet(out)
    assert back.where(F.col("markdown").isNull() & F.col("html").isNotNull() & (F.col("html") != "")).count() == 0

    s = C.stats(spark, state).first()
    assert s.total == n and s.downloaded == kinds["downloaded"] and s.errors == kinds.get("error", 0)

    # compaction keeps the state; later events and new URL batches still apply
    before = sorted(map(tuple, C.current_state(spark, state).select(*C.KEY, "status", "saved_path").collect()))
    C.compact(spark, state)
    after = sorted(map(tuple, C.current_state(spark, state).select(*C.KEY, "status", "saved_path").collect()))
    assert before == after
    C.extract_html(spark, state, archives)            # retries the error rows after the compaction
    assert C.stats(spark, state).first().errors == kinds.get("error", 0)
    C.compact(spark, state)
    assert C.stats(spark, state).first().total == n


def test_resolve_budget_skips_snapshot_without_index(spark):
    import json

    from crawlweave.session import scratch_dir

    def rec(url):
        return json.dumps({"warc_headers": {"warc-target-uri": url, "warc-date": "2020-01-01T00:00:00Z"}})

    meta, index, state = (scratch_dir(spark, n) for n in ("meta", "index", "state"))
    lines = [("CC-MAIN-2020-01/tt_meta_0.jsonl.zst", i, rec(f"http://a/{i}")) for i in range(3)] + \
            [("CC-MAIN-2020-02/tt_meta_0.jsonl.zst", i, rec(f"http://b/{i}")) for i in range(3)]
    FX.write_zstd_files(spark.createDataFrame(lines, "rel string, seq long, value string"), meta).count()
    cap = {"filename": "f.warc.gz", "offset": "1", "length": "2", "timestamp": "20200101000000"}
    cdx_lines = [f"k 20200101000000 {json.dumps(dict(cap, url=f'http://b/{i}'))}" for i in range(3)]
    (spark.createDataFrame([(x,) for x in cdx_lines], "value string").coalesce(1)
     .write.option("compression", "gzip").text(f"{index}/CC-MAIN-2020-02/s0"))
    C.ingest(spark, meta, state)

    # budget 4: snapshot 01 (no index) takes 3, snapshot 02 gets 1
    out = {r.snapshot_name: (r.matched, r.missing) for r in C.resolve_local(spark, state, index, limit=4).collect()}
    assert out["CC-MAIN-2020-02"] == (1, 0) and out[None] == (1, 0) and "CC-MAIN-2020-01" not in out
    st = {r.url_raw: r.status for r in C.current_state(spark, state).collect()}
    assert [st[f"http://a/{i}"] for i in range(3)] == ["pending"] * 3
    assert sorted(st[f"http://b/{i}"] for i in range(3)) == ["matched", "pending", "pending"]


def test_compaction_then_new_batches(spark):
    import json

    from crawlweave.session import scratch_dir

    def rec(url):
        return json.dumps({"warc_headers": {"warc-target-uri": url}})

    meta, state = scratch_dir(spark, "meta"), scratch_dir(spark, "state")

    def shard(name, urls):
        df = spark.createDataFrame([(name, i, rec(u)) for i, u in enumerate(urls)], "rel string, seq long, value string")
        FX.write_zstd_files(df, meta).count()

    shard("S/tt_meta_0.jsonl.zst", ["u1", "u2"])
    C.ingest(spark, meta, state)
    C.compact(spark, state)
    shard("S/tt_meta_1.jsonl.zst", ["u2", "u3"])
    C.ingest(spark, meta, state)                        # stream batch after the compaction
    shard("S/tt_meta_2.jsonl.zst", ["u4"])
    C.ingest(spark, meta, state, force=True)            # forced batch (large batch id)
    got = sorted((r.hf_path, r.url_raw) for r in C.current_state(spark, state).collect())
    assert got == [("S/tt_meta_0.jsonl.zst", "u1"), ("S/tt_meta_0.jsonl.zst", "u2"),
                   ("S/tt_meta_1.jsonl.zst", "u2"), ("S/tt_meta_1.jsonl.zst", "u3"),
                   ("S/tt_meta_2.jsonl.zst", "u4")]
    C.compact(spark, state)
    assert C.stats(spark, state).first().total == 5
