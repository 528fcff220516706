"""Budgets by distributed selection, against a plain sort."""

import random

import pytest
from pyspark.sql import functions as F

from crawlweave.operators import selection as SEL
from crawlweave.operators import state as ST

SCHEMA = "snap string, name string, o struct<b: long, l: long>"


def rows(n, seed=7):
    rnd = random.Random(seed)
    return [(rnd.choice(["x", "x", "x", "y", None]), rnd.choice([None, "a", "ä", "b", "\U0001f600", "z" * 5]), (i // 50, i))
            for i in rnd.sample(range(10 * n), n)]


def key(r):
    """Spark's order: nulls first, strings by their bytes."""
    return tuple((v is not None, v.encode() if isinstance(v, str) else v) for v in r)


@pytest.mark.parametrize(("last", "sample"), [(10_000, 2_000), (5, 30), (1, 3)])
def test_first_rows(spark, last, sample):
    data = rows(2000)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    in_order = sorted(data, key=lambda r: (key([r[1]]), r[2]))
    for n in (1, 3, 777, 1999, 2000, 5000):
        got = SEL.first_rows(df, ["name", "o"], n, last, sample, top=SEL.TOP if last > 100 else 0)
        assert sorted((key([r.name]), tuple(r.o)) for r in got.collect()) == [(key([r[1]]), r[2]) for r in in_order[:n]]
    assert SEL.first_rows(df, ["name", "o"], 0).collect() == []
    assert SEL.first_rows(df.limit(0), ["name", "o"], 3).collect() == []


@pytest.mark.parametrize(("last", "sample"), [(10_000, 2_000), (5, 30)])
def test_first_rows_of_each_group(spark, last, sample):
    data = rows(2000)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    for n in (1, 150, 400, 5000):
        want = []
        for g in (None, "x", "y"):
            want += sorted((r for r in data if r[0] == g), key=lambda r: r[2])[:n]
        got = SEL.first_rows_of_each(df, ["snap"], ["o"], n, last, sample).collect()
        assert sorted(tuple(r.o) for r in got) == sorted(r[2] for r in want)
    assert SEL.first_rows_of_each(df, ["snap"], ["o"], 0).collect() == []


def test_ties_end(spark):
    """An order that is not unique gives all rows of the last key, and an end."""
    df = spark.range(3000).select((F.col("id") * 0).alias("k"), "id").repartition(3)
    assert SEL.first_rows(df, ["k"], 10, last=5, sample=20, top=0).count() == 3000
    two = spark.range(3000).select((F.col("id") % 2).alias("k")).repartition(3)
    assert SEL.first_rows(two, ["k"], 1500, last=5, sample=20).count() == 1500


def test_budgets_neither_sort_nor_shuffle_the_rows(spark):
    """The plan of a budget is a filter on the state; the order's first column reaches the reader."""
    state = spark.range(6000).select(
        F.lit("s").alias("snapshot_name"), F.concat(F.lit("f"), F.col("id") % 40).alias("filename"),
        F.col("id").alias("offset"), F.lit(1).alias("length"), F.lit(None).cast("string").alias("saved_path"),
        F.col("id").alias("ord"))
    from crawlweave.session import scratch_dir
    folder = scratch_dir(spark, "state")
    state.write.parquet(folder)
    stored = spark.read.parquet(folder)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    for n in (25, 5000):
        kept = ST.ready(stored, limit=n)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan and "Checkpoint" not in plan
        assert "LessThanOrEqual(filename" in plan
        want = sorted((f"f{i % 40}", i) for i in range(6000))[:n]
        assert sorted((r.filename, r.offset) for r in kept.collect()) == want
