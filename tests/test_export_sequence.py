"""Export (size split, per-snapshot limit) and the distributed scan primitives."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from crawlweave.operators import export as E
from crawlweave.operators import sequence as Q
from crawlweave.sources import cdx

ROWS = "snapshot string, ord long, url string, offset long, length long, filename string, html string, markdown string"


def export_df(spark, n, snapshot="2025-01", size=5000):
    return spark.createDataFrame(
        [(snapshot, i, f"https://e/{i}", i, 10, "f.warc.gz", "x" * size, None) for i in range(n)], ROWS)


def greedy(sizes, batch, limit):
    parts, acc, part = [], 0, 0
    for b in range(0, len(sizes), batch):
        chunk = sizes[b:b + batch]
        parts += [part] * len(chunk)
        acc += sum(chunk)
        if acc >= limit:
            part, acc = part + 1, 0
    return parts


def test_split_keeps_every_row_and_batch(spark, tmp_root):
    E.write_export(export_df(spark, 740, size=300), tmp_root, max_bytes=1000, batch_rows=64)
    back = spark.read.parquet(tmp_root)
    assert back.count() == 740 and back.select("url").distinct().count() == 740
    assert {r["part"]: r["count"] for r in back.groupBy("part").count().collect()} == {
        p: 64 if p < 11 else 36 for p in range(12)}


def test_export_again_replaces_the_snapshot(spark, tmp_root):
    rows = export_df(spark, 100, "2031-07", size=100).unionByName(export_df(spark, 30, "2031-08", size=100))
    for max_bytes, parts in ((900, 10), (2500, 4), (None, None), (900, 10)):
        E.write_export(rows.where("snapshot = '2031-07'") if max_bytes == 2500 else rows, tmp_root, max_bytes=max_bytes,
                       batch_rows=10)
        back = spark.read.option("mergeSchema", "true").option("basePath", tmp_root).parquet(
            f"{tmp_root}/snapshot=2031-07")
        assert back.count() == 100 and back.select("url").distinct().count() == 100
        if parts:
            assert back.select("part").distinct().count() == parts


def test_whole_export_has_one_folder_per_snapshot(spark, tmp_root):
    E.write_export(export_df(spark, 9, "2031-07"), tmp_root)
    back = spark.read.parquet(tmp_root)
    assert {r.snapshot for r in back.select("snapshot").collect()} == {"2031-07"}
    assert set(back.columns) == {"snapshot", *E.EXPORT_COLUMNS}


def test_split_must_be_positive(spark):
    with pytest.raises(ValueError):
        E.assign_parts(export_df(spark, 3).withColumn("bytes", E.row_bytes()), 0)


def test_greedy_parts_match_a_sequential_fold(spark):
    rnd = random.Random(3)
    rows = []
    for snap in ("a", "b"):
        for i in range(300):
            rows.append((snap, i, "u", 0, 0, "f", "x" * rnd.randrange(0, 200), None))
    df = spark.createDataFrame(rows, ROWS).withColumn("bytes", E.row_bytes())
    got = E.assign_parts(df, max_bytes=900, batch_rows=7, n_parts=5).collect()
    for snap in ("a", "b"):
        sizes = [len(r[6]) for r in rows if r[0] == snap]
        want = greedy(sizes, 7, 900)
        have = [r.part for r in sorted((r for r in got if r.snapshot == snap), key=lambda r: r.ord)]
        assert have == want


def test_first_rows(spark):
    rnd = random.Random(5)
    data = [(rnd.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(data, "a int, b int").repartition(7)
    for n in (0, 1, 1200, 5000):
        got = Q.first_rows(df, ["a", "b"], n, n_parts=9)
        assert sorted((r.a, r.b) for r in got.collect()) == sorted(data)[:n]
    kept = Q.first_rows(df, ["a", "b"], 2500, n_parts=9)
    assert len({r[0] for r in kept.select(F.spark_partition_id()).collect()}) > 1
    assert "SinglePartition" not in kept.select("a")._jdf.queryExecution().executedPlan().toString().split("Window")[0]


def test_limit_per_snapshot(spark):
    df = export_df(spark, 5, "a").unionByName(export_df(spark, 2, "b"))
    got = E.limit_per_snapshot(df, 3).groupBy("snapshot").agg(F.max("ord").alias("m"), F.count("*").alias("n")).collect()
    assert {(r.snapshot, r.m, r.n) for r in got} == {("a", 2, 3), ("b", 1, 2)}


def test_segmented_scans_match_pandas(spark):
    rnd = random.Random(11)
    data = [(rnd.choice("xyz"), i, rnd.choice([None, None, rnd.randrange(100)])) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, o long, v long")
    pdf = pd.DataFrame(data, columns=["k", "o", "v"]).sort_values(["k", "o"])
    pdf["cum"] = pdf.groupby("k")["v"].transform(lambda s: s.fillna(0).cumsum() - s.fillna(0))
    pdf["ff"] = pdf.groupby("k")["v"].ffill()
    cum = {r.o: r.cum for r in Q.segmented_cumsum(df, ["k"], ["o"], "v", "cum", n_parts=7).collect()}
    ff = {r.o: r.ff for r in Q.segmented_ffill(df, ["k"], ["o"], "v", "ff", n_parts=7).collect()}
    idx = {r.o: r.idx for r in Q.row_index(df, ["k"], ["o"], n_parts=7).collect()}
    pdf["idx"] = pdf.groupby("k").cumcount()
    for r in pdf.itertuples():
        assert cum[r.o] == int(r.cum)
        assert (ff[r.o] is None and pd.isna(r.ff)) or ff[r.o] == r.ff
        assert idx[r.o] == r.idx


def test_manifest_filter_and_missing(spark, tmp_root):
    listed = ["data/commoncrawl/idx/a/cdx-00417.gz", "idx/a/cdx-00033.gz", "idx/a/cdx-00033.gz.tmp", "idx/a/cluster.idx",
              "", "idx/a/cdx-77.gz"]
    entries = cdx.manifest_entries(spark.createDataFrame([("N", x) for x in listed],
                                                         "snapshot_name string, value string"))
    assert {(r.basename, r.rel_path) for r in entries.collect()} == {
        ("cdx-00417.gz", "idx/a/cdx-00417.gz"), ("cdx-00033.gz", "idx/a/cdx-00033.gz")}
    present = spark.createDataFrame([("N", "cdx-00417.gz"), ("M", "cdx-00033.gz")],
                                    "snapshot_name string, basename string")
    assert [r.basename for r in cdx.missing_shards(entries, present).collect()] == ["cdx-00033.gz"]
