"""Pruned index lookups: keys, blocks opened, results equal to a whole scan."""

import json
import random

from pyspark.sql import functions as F

from crawlweave.session import scratch_dir
from crawlweave.sources import cdx
from crawlweave.sources import zipnum as Z


def test_sort_keys(spark):
    cases = {
        "http://www.Example.com:80/A?B=1#f": "com,example)/a?b=1", "https://user:pw@Ex.org": "org,ex)/",
        "http://a.b.c:8080?x": "c,b,a:8080)/?x", "http://www2.d.e/": "e,d)/", "http://www.": ",www)/",
        "mailto:x@y": "mailto:x@y", "plain": "plain", "http://[::1]/": None,
    }
    rows = spark.createDataFrame([(u,) for u in cases], "u string").select("u", Z.sort_key("u").alias("k")).collect()
    assert {r.u: r.k for r in rows if cases[r.u]} == {u: k for u, k in cases.items() if k}


def index(spark, urls, block_lines, n=4):
    """An index with the given (snapshot, url) captures; returns its root."""
    data = [(s, u, f"2024010100{i % 6000:04d}", json.dumps(
        {"url": u, "filename": f"f{i}", "offset": str(i), "length": "7", "mime": "text/html"})) for i, (s, u) in enumerate(urls)]
    df = spark.createDataFrame(data, "snapshot string, url string, stamp string, json string")
    root = scratch_dir(spark, "blocks")
    Z.write_blocks(df.select("snapshot", Z.sort_key("url").alias("key"), "stamp",
                             F.concat_ws(" ", Z.sort_key("url"), "stamp", "json").alias("value")), root, block_lines, n)
    return root


def test_lookups_equal_a_scan_and_open_few_blocks(spark):
    rnd = random.Random(3)
    urls = [("S1", f"http://h{rnd.randrange(60)}.org/p{rnd.randrange(40)}") for _ in range(3000)]
    urls += [("S1", "http://hot.org/one")] * 700          # one key over many blocks
    urls += [("S2", f"http://h{i}.org/") for i in range(500)]
    root = index(spark, urls, 50)
    blocks = Z.read_sidecar(spark, root)
    everything = blocks.count()
    assert blocks.agg(F.sum("lines")).first()[0] == len(urls)
    wanted = [("S1", "http://h7.org/p3"), ("S1", "http://hot.org/one"), ("S1", "http://absent.org/"), ("S2", "http://h499.org/"),
              ("S2", "http://0.first/"), ("S2", "http://z.zz/"), ("S3", "http://h7.org/p3"), ("S1", "HTTP://H8.ORG/p1"),
              ("S1", None)]
    df = spark.createDataFrame(wanted, "snapshot_name string, url string")
    found = Z.captures_of(spark, root, df)
    whole = cdx.read_captures(spark, root).join(df, ["snapshot_name", "url"], "left_semi")
    cols = ["snapshot_name", "url", "filename", "offset", "capture_ts"]
    got = sorted(map(tuple, found.select(*cols).collect()))
    assert got == sorted(map(tuple, whole.select(*cols).collect())) and len(got) > 700
    # brute force: blocks that hold a line with a wanted key
    opened = Z.matching_blocks(blocks, df.where("url IS NOT NULL").withColumn("key", Z.sort_key("url")))
    keys = {(r.s, r.k) for r in df.select(F.col("snapshot_name").alias("s"), Z.sort_key("url").alias("k")).collect()}
    holding = {(r.snapshot_name, r.file_path, r.block_start) for r in Z.read_block_lines(spark, root, blocks).collect()
               if (r.snapshot_name, bytes(r.value).decode().split(" ")[0]) in keys}
    names = {(r.snapshot_name, r.file, r.offset) for r in opened.collect()}
    assert holding <= names and len(names) <= len(holding) + len(wanted) < everything / 3
    # the order of a whole scan
    first = found.where("url = 'http://hot.org/one'").orderBy("scan_ord").select("offset").collect()
    scan = whole.where("url = 'http://hot.org/one'").orderBy("scan_ord").select("offset").collect()
    assert first == scan


def test_no_index_and_nothing_wanted(spark):
    root = index(spark, [("S1", "http://a.org/")], 5)
    none = spark.createDataFrame([], "snapshot_name string, url string")
    assert Z.captures_of(spark, root, none).collect() == []
    assert Z.read_sidecar(spark, root, ["S9"]).collect() == []
    one = spark.createDataFrame([("S1", "http://a.org/")], "snapshot_name string, url string")
    assert Z.captures_of(spark, root, one, ["S1"]).count() == 1
