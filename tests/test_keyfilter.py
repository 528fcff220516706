"""Per-batch key filters: no key missed, few mistakes, exact ingest, batches passed over."""

from pyspark.sql import functions as F

from crawlweave import commands as C
from crawlweave.operators import keyfilter as KF
from crawlweave.session import scratch_dir
from crawlweave.streaming import ingest_stream as IS


def keys(spark, start, end, step=1):
    return spark.range(start, end, step).select(F.lit("s").alias("hf_path"), F.concat(F.lit("u"), "id").alias("url_raw"))


def test_filters_of_many_sizes(spark):
    key = ["hf_path", "url_raw"]
    filters = None
    for batch, (a, b) in enumerate([(0, 1), (0, 100), (0, 20_000), (50_000, 50_010)]):
        own = KF.build(keys(spark, a, b), key, b - a).withColumn("batch", F.lit(batch).cast("long"))
        filters = own if filters is None else filters.unionByName(own)
    found = {r.batch: r.found for r in KF.may_hold(filters, keys(spark, 0, 20_000), key).collect()}
    assert found[0] >= 1 and found[1] >= 100 and found[2] == 20_000          # nothing is missed
    assert found[1] <= 100 + 200 and found[0] <= 40                          # and little is taken for held
    absent = {r.batch: r.found for r in KF.may_hold(filters, keys(spark, 100_000, 120_000), key).collect()}
    assert absent.get(2, 0) < 200
    assert KF.may_hold(filters, keys(spark, 0, 0), key).collect() == []
    assert KF.may_hold(filters.limit(0), keys(spark, 0, 5), key).collect() == []
    assert [KF.block_count(n) for n in (0, 1, 24, 25, 49, 24 * 1024, 24 * 1024 + 1)] == [1, 1, 1, 2, 4, 1024, 2048]


def test_a_forced_ingest_reads_colliding_batches_only(spark, monkeypatch):
    from test_recovery import rec, shard

    state, meta = scratch_dir(spark, "state"), scratch_dir(spark, "meta")
    name = "S/tt_meta_0.jsonl.zst"
    read = []
    real = IS.read_batches

    def seen(spark_, path, batches, schema, name_="batch"):
        if path.endswith("/urls"):
            read.append(list(batches))
        return real(spark_, path, batches, schema, name_)

    for urls in (["a1", "a2"], ["b1", "b2", "b3"], ["a1", "c1"]):
        shard(spark, meta, name, [rec(u) for u in urls])
        with monkeypatch.context() as m:
            m.setattr(IS, "read_batches", seen)
            read.clear()
            C.ingest(spark, meta, state, force=True)
    base = IS.FORCE_BATCH_BASE
    # the third one: the first batch holds a1, the second none of its keys; then its own rows, for filter and counters
    assert read == [[base], [base + 2], [base + 2]]
    rows = sorted((r.url_raw, r.batch) for r in C.url_rows(spark, state).collect())
    assert rows == [("a1", base), ("a2", base), ("b1", base + 1), ("b2", base + 1), ("b3", base + 1), ("c1", base + 2)]


def test_a_batch_without_a_filter_is_read(spark):
    state = scratch_dir(spark, "state") + "/urls"
    probe = keys(spark, 0, 3)
    assert IS.batches_with_keys(spark, state, [1, 2], probe) == [1, 2]
    IS.write_batch(KF.build(keys(spark, 10, 20), ["hf_path", "url_raw"], 10), f"{IS.filters_path(state)}/batch=1")
    assert IS.batches_with_keys(spark, state, [1, 2], probe) == [2]
    IS.write_batch(KF.build(keys(spark, 0, 1), ["hf_path", "url_raw"], 1), f"{IS.filters_path(state)}/batch=2")
    assert IS.batches_with_keys(spark, state, [1, 2], probe) == [2]
