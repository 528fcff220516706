"""Resolve cases: the reference's nearest-capture scan plus the cases it leaves untested."""

import json

from pyspark.sql import functions as F

from crawlweave.operators import resolve as R
from crawlweave.operators import state as ST
from crawlweave.sources import cdx

ROW_SCHEMA = ("snapshot_name string, hf_path string, url_raw string, url_norm string, warc_date long, "
              "offset long, length long, filename string, status string, saved_path string, ord long")


def cdx_line(url, ts, filename, offset, length, mime="text/html", key="url", mkey="mimetype"):
    rec = {key: url, "timestamp": ts, "filename": filename, "offset": str(offset), "length": str(length)}
    if mime is not None:
        rec[mkey] = mime
    return f"com,example)/ {ts} {json.dumps(rec)}"


def write_index(spark, root, snapshot, shards):
    """shards: {name: [lines]} written as gzip text under root/snapshot/name/."""
    for name, lines in shards.items():
        (spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
         .write.option("compression", "gzip").text(f"{root}/{snapshot}/{name}"))


def rows(spark, data):
    return spark.createDataFrame(data, ROW_SCHEMA)


def resolved(spark, root, data, strategy="nearest"):
    out = R.resolve(rows(spark, data), cdx.read_captures(spark, root), ["ord"], strategy)
    return {r["ord"]: r for r in out.collect()}


def test_nearest_html_capture_wins(spark, tmp_root):
    # target 2020-01-02 11:00:00; the closest capture is a png, the next closest html wins
    write_index(spark, tmp_root, "CC-MAIN-2020-05", {"s0": [
        cdx_line("https://example.com", "20200101000000", "older.warc.gz", 10, 20),
        cdx_line("https://example.com", "20200102115959", "image.warc.gz", 30, 40, mime="image/png"),
        cdx_line("https://example.com", "20200102120000", "newer.warc.gz", 50, 60),
    ]})
    target = 1577962800
    got = resolved(spark, tmp_root, [("CC-MAIN-2020-05", "p", "https://example.com", None, target,
                                      None, None, None, "pending", None, 1)])
    r = got[1]
    assert (r.status, r.filename, r.offset, r.length) == ("matched", "newer.warc.gz", 50, 60)


def test_no_date_first_seen_and_ties_first_in_scan_order(spark, tmp_root):
    write_index(spark, tmp_root, "S", {
        "s0": [cdx_line("u", "20200101000010", "a.warc.gz", 1, 1), cdx_line("u", "20200101000000", "b.warc.gz", 2, 1)],
        "s1": [cdx_line("u", "20200101000020", "c.warc.gz", 3, 1)],
    })
    base = 1577836800
    data = [("S", "p", "u", None, None, None, None, None, "pending", None, 1),    # no date -> first seen
            ("S", "p", "u2", "u", 0, None, None, None, "pending", None, 2),      # date 0 -> first seen
            ("S", "p", "u", None, base + 15, None, None, None, "pending", None, 3),  # tie a/c (5 s) -> a
            ("S", "p", "v", None, base, None, None, None, "pending", None, 4)]   # no capture -> missing
    got = resolved(spark, tmp_root, data)
    assert got[1].filename == "a.warc.gz"
    assert got[2].filename == "a.warc.gz"
    assert got[3].filename == "a.warc.gz"
    assert got[4].status == "missing" and got[4].filename is None


def test_untimed_capture_only_when_nothing_else(spark, tmp_root):
    write_index(spark, tmp_root, "S", {"s0": [
        cdx_line("u", "", "untimed.warc.gz", 1, 1),
        cdx_line("u", "20300101000000", "far.warc.gz", 2, 1),
        cdx_line("w", "bad", "only.warc.gz", 3, 1),
    ]})
    data = [("S", "p", "u", None, 1577836800, None, None, None, "pending", None, 1),
            ("S", "p", "w", None, 1577836800, None, None, None, "pending", None, 2)]
    got = resolved(spark, tmp_root, data)
    assert got[1].filename == "far.warc.gz"
    assert got[2].filename == "only.warc.gz"


def test_fallback_keys_and_bad_offsets(spark, tmp_root):
    write_index(spark, tmp_root, "S", {"s0": [
        cdx_line("u", "20200101000000", "bad.warc.gz", "x1", 1),
        cdx_line("u", "20200101000000", "orig.warc.gz", 7, 8, key="original", mime="text/html", mkey="mime"),
        "no json on this line",
        "u 2020 {broken",
    ]})
    got = resolved(spark, tmp_root, [("S", "p", "u", None, 1577836800, None, None, None, "pending", None, 1)])
    assert (got[1].filename, got[1].offset, got[1].length) == ("orig.warc.gz", 7, 8)


def test_priority_prefers_earlier_candidate(spark, tmp_root):
    write_index(spark, tmp_root, "S", {"s0": [
        cdx_line("HTTP://X/", "20200101000000", "raw.warc.gz", 1, 1),
        cdx_line("http://x/", "20200101000500", "lower.warc.gz", 2, 1),
    ]})
    data = [("S", "p", "HTTP://X/", None, 1577836800 + 600, None, None, None, "pending", None, 1)]
    assert resolved(spark, tmp_root, data, "nearest")[1].filename == "lower.warc.gz"
    assert resolved(spark, tmp_root, data, "priority")[1].filename == "raw.warc.gz"


def test_other_snapshot_does_not_match(spark, tmp_root):
    write_index(spark, tmp_root, "A", {"s0": [cdx_line("u", "20200101000000", "a.warc.gz", 1, 1)]})
    got = resolved(spark, tmp_root, [("B", "p", "u", None, 1, None, None, None, "pending", None, 1)])
    assert got[1].status == "missing"


def test_missing_keeps_partial_location(spark, tmp_root):
    write_index(spark, tmp_root, "S", {"s0": [cdx_line("z", "20200101000000", "a.warc.gz", 1, 1)]})
    got = resolved(spark, tmp_root, [("S", "p", "u", None, 1, 5, None, None, "pending", None, 1)])
    assert (got[1].status, got[1].offset) == ("missing", 5)


def test_many_captures_across_days_match_brute_force(spark, tmp_root):
    """Nearest over captures spread across days equals a brute-force pick."""
    import random

    rnd = random.Random(7)
    base = 1577836800
    caps = [(f"u{rnd.randrange(5)}", base + rnd.randrange(40 * 86400)) for _ in range(400)]
    lines = [cdx_line(u, __import__("time").strftime("%Y%m%d%H%M%S", __import__("time").gmtime(t)), f"f{i}", i, 1)
             for i, (u, t) in enumerate(caps)]
    write_index(spark, tmp_root, "S", {"s0": lines})
    targets = [(f"u{rnd.randrange(6)}", base + rnd.randrange(40 * 86400)) for _ in range(60)]
    data = [("S", "p", u, None, t, None, None, None, "pending", None, i) for i, (u, t) in enumerate(targets)]
    got = resolved(spark, tmp_root, data)
    for i, (u, t) in enumerate(targets):
        cands = [(abs(ct - t), j) for j, (cu, ct) in enumerate(caps) if cu == u]
        if not cands:
            assert got[i].status == "missing"
        else:
            assert got[i].offset == min(cands)[1]


def test_limit_zero_and_budget(spark):
    data = [("S1", "p", f"u{i}", None, 1, None, None, None, "pending", None, i) for i in range(3)] + \
           [("S2", "p", f"v{i}", None, 1, None, None, None, "pending", None, 10 + i) for i in range(3)] + \
           [("S1", "p", "done", None, 1, 1, 1, "f", "matched", None, 20)]
    state = rows(spark, data)
    assert ST.unresolved(state, limit=0).count() == 0
    picked = [r.ord for r in ST.unresolved(state, limit=4).collect()]
    assert sorted(picked) == [0, 1, 2, 10]
    assert [r.ord for r in ST.unresolved(state, snapshot="S2").collect()] == [10, 11, 12]


def test_summary_rollup(spark):
    df = spark.createDataFrame([("A", "matched"), ("A", "missing"), ("B", "matched")], "snapshot_name string, status string")
    got = {r.snapshot_name: (r.matched, r.missing) for r in R.resolution_summary(df).collect()}
    assert got == {"A": (1, 1), "B": (1, 0), None: (2, 1)}


def test_random_cases_match_reference_rules(spark, tmp_root):
    """Random captures/rows vs. a direct reading of the pick rules (both strategies)."""
    import random
    import time as _t

    rnd = random.Random(23)
    base = 1577836800
    urls = ["http://x/a", "HTTP://X/A", "http://x/b", "http://x/a#f"]
    caps = []                                   # (url, ts or None, scan position)
    lines = []
    for i in range(120):
        u = rnd.choice(urls)
        kind = rnd.random()
        if kind < 0.1:
            ts, stamp = 0, ""
        elif kind < 0.15:
            ts, stamp = 0, "bad"
        else:
            ts = base + rnd.randrange(0, 5 * 86400, 600)       # coarse grid: many equal distances
            stamp = _t.strftime("%Y%m%d%H%M%S", _t.gmtime(ts))
        caps.append((u, ts, i))
        lines.append(cdx_line(u, stamp, f"f{i}", i, 1))
    write_index(spark, tmp_root, "S", {"s0": lines})
    data = []
    for j in range(40):
        raw = rnd.choice(["http://x/a", "HTTP://X/A", "http://x/b", "http://x/c"])
        norm = rnd.choice([None, "http://x/a#f", raw.lower()])
        d = rnd.choice([None, 0, base + rnd.randrange(0, 5 * 86400, 300)])
        data.append(("S", "p", raw, norm, d, None, None, None, "pending", None, j))

    def cands(raw, norm):
        out = []
        for c in (raw, raw.lower(), norm):
            if c and c not in out:
                out.append(c)
        return out

    def pick(raw, norm, d, strategy):
        best, best_key = None, None
        for pos, c in enumerate(cands(raw, norm)):
            for u, ts, i in caps:
                if u != c:
                    continue
                delta = 0 if not d else (10 ** 12 if ts == 0 else abs(ts - d))
                key = (pos, delta, i) if strategy == "priority" else (delta, i)
                if best_key is None or key < best_key:
                    best, best_key = i, key
        return best

    for strategy in ("nearest", "priority"):
        got = resolved(spark, tmp_root, data, strategy)
        for (_, _, raw, norm, d, *_rest, j) in data:
            want = pick(raw, norm, d, strategy)
            assert (got[j].offset if got[j].status == "matched" else None) == want, (strategy, raw, norm, d)
