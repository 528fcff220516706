"""Ingest: first-wins dedupe, insert-or-ignore, skip/force, zstd readers, streaming re-runs."""

import json

import pytest
from pyspark.sql import functions as F

from crawlweave.operators import ingest as IG
from crawlweave.plans import fixtures as FX
from crawlweave.sources import metadata as MD
from crawlweave.streaming import ingest_stream as IS


def rec(url, date="2020-01-02T03:04:05Z", rid="r", block="sha1:b", payload="sha1:p"):
    h = {"warc-target-uri": url, "warc-date": date, "warc-record-id": rid}
    if block is not None:
        h["warc-block-digest"] = block
    if payload is not None:
        h["warc-payload-digest"] = payload
    return json.dumps({"warc_headers": h})


def write_shard(spark, root, rel, lines, window_log=None):
    df = spark.createDataFrame([(rel, i, v) for i, v in enumerate(lines)], "rel string, seq long, value string")
    FX.write_zstd_files(df, root, window_log=window_log).count()


LINES = [rec("https://example.com/a", rid="a1"), "", "not json", "[1, 2]", rec("https://example.com/a", rid="a2"),
         rec("", rid="empty"), rec("https://example.com/b", date="bad", block="", rid="b1"),
         rec("https://example.com/c", block=None, payload=None, rid="c1"), "   "]


def test_first_wins_and_quirks(spark, tmp_root):
    write_shard(spark, tmp_root, "meta/CC-MAIN-2014-42/tt_meta_0.jsonl.zst", LINES)
    write_shard(spark, tmp_root, "meta/CC-MAIN-2014-42/other.jsonl.zst", [rec("https://x/")])
    recs = MD.read_records(spark, tmp_root)
    assert recs.count() == 4
    got = {r.url_raw: r for r in IG.ingest(recs).collect()}
    assert sorted(got) == ["https://example.com/a", "https://example.com/b", "https://example.com/c"]
    a, b, c = got["https://example.com/a"], got["https://example.com/b"], got["https://example.com/c"]
    assert a.warc_record_id == "a1" and a.warc_date == 1577934245 and a.digest == "sha1:b"
    assert b.warc_date is None and b.digest == "sha1:p"
    assert c.digest is None
    assert a.snapshot_name == "CC-MAIN-2014-42" and a.status == "pending"
    counts = IG.shard_rows(recs.select("hf_path"), IG.first_wins(recs), "2024-01-01 00:00:00").first()
    assert counts.total_urls == 4 and counts.imported


def test_insert_or_ignore_keeps_existing(spark):
    schema = "hf_path string, line_ord long, snapshot_name string, url_raw string, url_norm string, " \
             "warc_date long, warc_record_id string, digest string"
    existing = spark.createDataFrame([("s", 0, "S", "u1", "u1", 1, "old", None)], schema)
    new = spark.createDataFrame([("s", 0, "S", "u1", "u1", 2, "new", None), ("s", 1, "S", "u2", "u2", 2, "x", None),
                                 ("s", 2, "S", "u2", "u2", 3, "y", None)], schema)
    out = IG.ingest(new, existing).collect()
    assert [(r.url_raw, r.warc_record_id) for r in out] == [("u2", "x")]


def test_same_url_in_two_shards_kept_twice(spark, tmp_root):
    write_shard(spark, tmp_root, "S/tt_meta_0.jsonl.zst", [rec("u")])
    write_shard(spark, tmp_root, "S/tt_meta_1.jsonl.zst", [rec("u")])
    assert IG.ingest(MD.read_records(spark, tmp_root)).count() == 2


def test_large_window_needs_stream_reader(spark, tmp_root):
    lines = [rec(f"https://example.com/{i}") for i in range(50)]
    write_shard(spark, tmp_root, "S/tt_meta_0.jsonl.zst", lines, window_log=29)
    assert MD.read_records(spark, tmp_root, reader="stream").count() == 50
    with pytest.raises(Exception):
        MD.read_records(spark, tmp_root).count()


def test_stream_rerun_and_force(spark, tmp_root):
    from crawlweave.session import scratch_dir

    state, shards, ckpt = (scratch_dir(spark, n) for n in ("st", "sh", "ck"))
    write_shard(spark, tmp_root, "S/tt_meta_0.jsonl.zst", [rec("u1"), rec("u2")])
    IS.run_ingest_stream(spark, tmp_root, state, shards, ckpt)
    assert spark.read.parquet(state).count() == 2
    write_shard(spark, tmp_root, "S/tt_meta_1.jsonl.zst", [rec("u1"), rec("u3")])
    IS.run_ingest_stream(spark, tmp_root, state, shards, ckpt)
    IS.run_ingest_stream(spark, tmp_root, state, shards, ckpt)
    assert spark.read.parquet(state).count() == 4
    IS.ingest_batch(spark, tmp_root, state, shards)                 # nothing pending
    IS.ingest_batch(spark, tmp_root, state, shards, force=True)     # re-read, no new keys
    assert spark.read.parquet(state).count() == 4
    table = {r.hf_path: r for r in IS.shard_table(spark, shards).collect()}
    assert table["S/tt_meta_1.jsonl.zst"].total_urls == 2 and all(r.imported for r in table.values())


def test_upsert_shards(spark):
    old = spark.createDataFrame([("a", "X", True, None, 3)], "hf_path string, snapshot_name string, imported boolean, imported_at timestamp, total_urls long")
    new = spark.createDataFrame([("a", "Y", True, None, 5), ("b", "Z", True, None, 1)], old.schema)
    got = {r.hf_path: (r.snapshot_name, r.total_urls) for r in IG.upsert_shards(old, new).collect()}
    assert got == {"a": ("Y", 5), "b": ("Z", 1)}


def test_list_shards_filter(spark, tmp_root):
    write_shard(spark, tmp_root, "x/tt_meta/a.jsonl.zst", [rec("u")])
    write_shard(spark, tmp_root, "x/other/b.jsonl.zst", [rec("u")])
    assert [r.hf_path for r in MD.list_shards(spark, tmp_root).collect()] == ["x/tt_meta/a.jsonl.zst"]


def test_batch_rerun_is_idempotent(spark, tmp_root):
    """A micro-batch replayed after a failure writes the same rows again (exactly once)."""
    from crawlweave.session import scratch_dir

    write_shard(spark, tmp_root, "S/tt_meta_0.jsonl.zst", [rec("u1"), rec("u2"), rec("u1")])
    state, shards = scratch_dir(spark, "st"), scratch_dir(spark, "sh")
    IS.ingest_records(spark, MD.read_records(spark, tmp_root), state, shards, batch_id=0)
    IS.ingest_records(spark, MD.read_records(spark, tmp_root), state, shards, batch_id=0)   # replay
    assert sorted(r.url_raw for r in spark.read.parquet(state).collect()) == ["u1", "u2"]
    IS.ingest_records(spark, MD.read_records(spark, tmp_root), state, shards, batch_id=1)   # later batch
    assert spark.read.parquet(state).count() == 2


def test_forced_batch_then_stream_sees_its_rows(spark, tmp_root):
    """A shard first read by a forced re-ingest is not inserted again by the stream."""
    from crawlweave.session import scratch_dir

    state, shards, ckpt = (scratch_dir(spark, n) for n in ("st", "sh", "ck"))
    write_shard(spark, tmp_root, "S/tt_meta_0.jsonl.zst", [rec("u1")])
    IS.run_ingest_stream(spark, tmp_root, state, shards, ckpt)
    write_shard(spark, tmp_root, "S/tt_meta_1.jsonl.zst", [rec("u2"), rec("u3")])
    IS.ingest_batch(spark, tmp_root, state, shards, force=True)      # picks up the new shard first
    IS.run_ingest_stream(spark, tmp_root, state, shards, ckpt)         # then the stream sees it as new
    rows = [(r.hf_path, r.url_raw) for r in spark.read.parquet(state).collect()]
    assert sorted(rows) == [("S/tt_meta_0.jsonl.zst", "u1"), ("S/tt_meta_1.jsonl.zst", "u2"),
                            ("S/tt_meta_1.jsonl.zst", "u3")]


def test_files_outside_the_pattern_do_not_grow_with_the_pages(spark, tmp_root):
    n = 10 * FX.META_ROWS_PER_FILE
    spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("https://x/"), "id").alias("url")).write.parquet(
        f"{tmp_root}/pages.parquet")
    lines = FX.meta_lines(spark, tmp_root).where(F.col("rel").contains("other_"))
    sizes = [r["count"] for r in lines.groupBy("rel").count().collect()]
    assert sum(sizes) == n // 50 and max(sizes) <= FX.META_ROWS_PER_FILE // 50


def test_a_micro_batch_does_not_read_the_shard_rows_of_all_batches_before(spark, tmp_root, monkeypatch):
    state, shards, ckpt = f"{tmp_root}-state", f"{tmp_root}-shards", f"{tmp_root}-ckpt"
    read = []
    real = IS.read_batches

    def counted(session, path, batches, *rest, **more):
        read.extend(batches if path == shards else [])
        return real(session, path, batches, *rest, **more)

    for i in range(4):
        write_shard(spark, tmp_root, f"meta/2014-42/tt_meta_{i}.jsonl.zst", [rec(f"https://x/{i}")])
    monkeypatch.setattr(IS, "read_batches", counted)
    IS.run_ingest_stream(spark, tmp_root, state, shards, ckpt, max_files_per_trigger=1)
    assert len(read) <= 4          # the shard table at the end
    assert sorted(r.url_raw for r in IS.read_state(spark, state, shards).collect()) == [
        f"https://x/{i}" for i in range(4)]
    read.clear()
    for i in range(4, 7):
        write_shard(spark, tmp_root, f"meta/2014-42/tt_meta_{i}.jsonl.zst", [rec(f"https://x/{i}")])
    IS.run_ingest_stream(spark, tmp_root, state, shards, ckpt, max_files_per_trigger=1)
    assert len(read) <= 4 + 7      # the earlier batches once at the start, all at the end
    assert IS.read_state(spark, state, shards).count() == 7


def test_shards_before_sees_batches_of_before_and_of_meanwhile_but_not_its_own(spark, tmp_root):
    state, shards = f"{tmp_root}-state", f"{tmp_root}-shards"
    write_shard(spark, tmp_root, "S/tt_meta_0.jsonl.zst", [rec("u"), rec("v")])
    write_shard(spark, tmp_root, "S/tt_meta_1.jsonl.zst", [rec("w")])
    recs = MD.read_records(spark, tmp_root)
    of = {i: recs.where(F.col("hf_path").endswith(f"_{i}.jsonl.zst")) for i in range(2)}
    assert IS.ShardsBefore(spark, shards).batches(spark, recs, 0) == []
    IS.ingest_records(spark, of[0], state, shards, 3)
    before = IS.ShardsBefore(spark, shards)
    assert before.batches(spark, of[0], 4) == [3] and before.batches(spark, of[1], 4) == []
    assert before.batches(spark, of[0], 3) == []                    # a batch run again does not see itself
    IS.ingest_records(spark, of[1], state, shards, IS.next_forced_batch(shards))
    assert before.batches(spark, recs, 4) == [3, IS.FORCE_BATCH_BASE]
    IS.ingest_records(spark, recs, state, shards, 4, before=before)  # nothing is entered twice
    assert IS.read_state(spark, state, shards).count() == 3
