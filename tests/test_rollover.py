"""Size rollover by composed maps, scratch folders and commit marks."""

import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crawlweave import commands as C
from crawlweave import session
from crawlweave.operators import export as E
from crawlweave.operators import rollover as RO
from crawlweave.operators import sequence as Q
from crawlweave.session import local_path, scratch_dir
from crawlweave.streaming import ingest_stream as IS


def greedy(sizes, limit):
    out, part, held = [], 0, 0
    for size in sizes:
        out.append(part)
        held += size
        if held >= limit:
            part, held = part + 1, 0
    return out, part, held


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=60), st.integers(1, 80), st.integers(1, 9))
def test_maps_compose_to_the_fold(sizes, limit, chunk):
    state, parts = (0, 0), []
    for at in range(0, len(sizes), chunk):
        own = np.array(sizes[at:at + chunk], np.int64)
        parts += RO.numbered(own, *state, limit).tolist()
        state = RO.step(state, *RO.transfer_map(own, limit), limit)
    want, part, held = greedy(sizes, limit)
    assert parts == want and state == (part, held)


def test_parts_of_batches(spark):
    rnd = random.Random(1)
    groups = {g: [rnd.randrange(0, 50) for _ in range(n)] for g, n in (("a", 500), ("b", 1), ("c", 64), ("d", 65))}
    rows = [(g, i, s) for g, sizes in groups.items() for i, s in enumerate(sizes)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "group string, batch long, bytes long")
    for limit in (1, 120, 10**6):
        got = RO.parts_of_batches(df, limit, chunk=16, n_parts=3).collect()
        for g, sizes in groups.items():
            assert [r.part for r in sorted((r for r in got if r.group == g), key=lambda r: r.batch)] == greedy(
                sizes, limit)[0]
    assert RO.parts_of_batches(df.limit(0), 5).collect() == []


def test_split_export_jobs_and_scratch(spark, tmp_root):
    """Parts by a few bounds and by a join are the same; nothing stays in the scratch folder."""
    rows = spark.createDataFrame(
        [("s" + str(i % 2), (i // 7, i), f"u{i}", i, 1, "f", "x" * (i % 90), None) for i in range(900)],
        "snapshot string, ord struct<b: long, l: long>, url string, offset long, length long, filename string, "
        "html string, markdown string")
    before = set(os.listdir(local_path(session.checkpoint_root(spark))))
    found = []
    for bounds, out in ((200_000, f"{tmp_root}/a"), (1, f"{tmp_root}/b")):
        old, E.MAX_BOUNDS = E.MAX_BOUNDS, bounds
        try:
            E.write_export(rows, out, max_bytes=700, batch_rows=10)
        finally:
            E.MAX_BOUNDS = old
        found.append({r.url: (r.snapshot, r.part) for r in spark.read.parquet(out).collect()})
    assert found[0] == found[1] and len(found[0]) == 900
    for s in (0, 1):
        sizes = [i % 90 for i in range(s, 900, 2)]
        batches = [sum(sizes[b:b + 10]) for b in range(0, len(sizes), 10)]
        parts = greedy(batches, 700)[0]
        assert [found[0][f"u{i}"][1] for i in range(s, 900, 2)] == [parts[j // 10] for j in range(len(sizes))]
    left = set(os.listdir(local_path(session.checkpoint_root(spark)))) - before
    assert not {x for x in left if not x.startswith("test-")}


def test_spread_by_range(spark):
    """Even ranges in order, the wide column not computed for the sample."""
    calls = spark.sparkContext.accumulator(0)

    def seen(x):
        calls.add(1)
        return x

    wide = F.udf(seen, "string")
    df = spark.range(20_000).repartition(6).select(
        F.col("id").alias("b"), (F.col("id") % 3).cast("string").alias("a")).withColumn("w", wide(F.lit("w")))
    out = Q.spread_by_range(df, ["a", "b"], 5).withColumn("p", F.spark_partition_id())
    rows = out.collect()
    assert calls.value == 20_000 and len(rows) == 20_000
    sizes = [sum(r.p == p for r in rows) for p in range(5)]
    assert min(sizes) > 2_000
    assert [(r.a, r.b) for r in rows] == sorted((r.a, r.b) for r in rows)
    assert Q.spread_by_range(df.limit(0), ["a"], 3).collect() == []


def test_commands_leave_no_scratch(spark, tmp_root):
    from test_recovery import located

    state, meta, archives = (scratch_dir(spark, n) for n in ("test-state", "test-meta", "test-warc"))
    root = local_path(session.checkpoint_root(spark))
    located(spark, state, meta, archives)
    before = set(os.listdir(root))
    assert {r.kind: r.rows for r in C.extract_html(spark, state, archives).collect()} == {"downloaded": 4}
    assert C.extract_ranges(spark, state, archives).collect() == []
    C.ingest(spark, meta, state, force=True)
    C.export_parquet(spark, state, f"{state}/out", split_mb=1).collect()
    assert {r.snapshot_name: r.missing for r in C.resolve_local(spark, state, f"{state}/none").collect()} == {None: 0}
    assert set(os.listdir(root)) == before


def test_scopes_nest(spark):
    with session.scratch_scope():
        outer = session.cut_lineage(spark.range(3).toDF("id"), "outer")
        with session.scratch_scope():
            inner = scratch_dir(spark, "inner")
            os.makedirs(local_path(inner))
        assert not os.path.exists(local_path(inner)) and outer.count() == 3
        path = local_path(outer.inputFiles()[0])
    assert not os.path.exists(path)


def test_writes_without_marks_are_an_error(spark):
    """With success marks switched off nothing is taken for an empty state."""
    folder = scratch_dir(spark, "test-marks")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        with pytest.raises(RuntimeError, match="mark"):
            IS.write_batch(spark.range(3).toDF("id"), f"{folder}/batch=1")
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    with pytest.raises(RuntimeError, match="mark"):
        IS.committed(folder, "batch")
    IS.write_batch(spark.range(3).toDF("id"), f"{folder}/batch=2")
    assert IS.committed(folder, "batch") == [2]  # the other one is a write that stopped
    os.makedirs(f"{local_path(folder)}/../test-marks-2/batch=1/_temporary", exist_ok=True)
    assert IS.committed(f"{folder}/../test-marks-2", "batch") == []


def test_a_batch_that_ends_during_a_compaction_counts_once(spark, monkeypatch):
    from test_recovery import rec, shard

    state, meta = scratch_dir(spark, "test-state"), scratch_dir(spark, "test-meta")
    shard(spark, meta, "S/tt_meta_0.jsonl.zst", [rec("u1"), rec("u2")])
    C.ingest(spark, meta, state)
    write = IS.write_batch

    def late(df, path, *partition):
        write(df, path, *partition)
        if "covered=" in path:  # another ingest ends between the list and the fold
            shard(spark, meta, "S/tt_meta_1.jsonl.zst", [rec("u3")])
            with monkeypatch.context() as m:
                m.setattr(IS, "write_batch", write)
                C.ingest(spark, meta, state)

    with monkeypatch.context() as m:
        m.setattr(IS, "write_batch", late)
        C.compact(spark, state)
    assert sorted(r.url_raw for r in C.current_state(spark, state).collect()) == ["u1", "u2", "u3"]
