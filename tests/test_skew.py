"""A hot URL: many captures and many rows of one key, checked against a numpy as-of."""

import time

import numpy as np

from crawlweave.operators import resolve as R
from crawlweave.sources import cdx

N_CAPS, N_ROWS = 50_000, 5_000
BASE = 1577836800


def test_hot_url_nearest(spark, tmp_root):
    rng = np.random.default_rng(5)
    cap_ts = BASE + rng.integers(0, 60 * 86400, N_CAPS)
    stamps = [time.strftime("%Y%m%d%H%M%S", time.gmtime(int(t))) for t in cap_ts]
    lines = [f'hot {s} {{"url": "http://hot/", "timestamp": "{s}", "filename": "f", "offset": "{i}", "length": "1"}}'
             for i, s in enumerate(stamps)]
    (spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
     .write.option("compression", "gzip").text(f"{tmp_root}/S/s0"))
    targets = BASE + rng.integers(-86400, 61 * 86400, N_ROWS)
    rows = spark.createDataFrame(
        [("S", "p", "http://hot/", None, int(t), None, None, None, "pending", None, i) for i, t in enumerate(targets)],
        "snapshot_name string, hf_path string, url_raw string, url_norm string, warc_date long, offset long, "
        "length long, filename string, status string, saved_path string, ord long")

    t0 = time.time()
    got = {r.ord: r.offset for r in R.resolve(rows, cdx.read_captures(spark, tmp_root), ["ord"]).collect()}
    elapsed = time.time() - t0

    # expected: earliest line per second, then the nearest second (ties -> earlier line)
    first_line = {}
    for i, t in enumerate(cap_ts):
        first_line.setdefault(int(t), i)
    secs = np.array(sorted(first_line))
    for i, t in enumerate(targets):
        j = np.searchsorted(secs, t)
        opts = []
        for k in (j - 1, j):
            if 0 <= k < len(secs):
                opts.append((abs(int(secs[k]) - int(t)), first_line[int(secs[k])]))
        assert got[i] == min(opts)[1]
    assert elapsed < 120
