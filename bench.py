"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric": ..., "value": total_sec, "unit": "sec",
"queries": {name: sec}, "engine": {name: sec}, "fixture": {name: sec}, "cold": {name: sec}, "sf": ...}.

Each query is forced end to end with the ``noop`` sink (all columns
computed, nothing pulled to the driver), three times: the first run is
``cold``, ``queries``/``value`` is the median of the three.  Most queries first derive their
crawl-shaped input (index shards, metadata shards, archives) from the test
tables; ``fixture`` is the part of the median run spent in those writers and ``engine`` the
rest.  Each run writes its derived input afresh.
"""

from __future__ import annotations

import functools
import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from crawlweave.plans import fixtures  # noqa: E402
from crawlweave.plans.queries import QUERIES  # noqa: E402
from crawlweave.session import get_spark  # noqa: E402

RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = get_spark(f"local[{cpus}]", app_name="crawlweave-bench", shuffle_partitions=int(cpus) * 2)

    failed: dict[str, str] = {}
    spent = {"fixture": 0.0, "depth": 0}

    def timed(write):
        """A fixture writer whose time is counted (once, where writers call writers)."""
        @functools.wraps(write)
        def run(*args, **kw):
            t0, spent["depth"] = time.perf_counter(), spent["depth"] + 1
            try:
                return write(*args, **kw)
            finally:
                spent["depth"] -= 1
                if not spent["depth"]:
                    spent["fixture"] += time.perf_counter() - t0
        return run

    for attr in [a for a in vars(fixtures) if a.startswith("write_") and a != "write_zstd_files"]:
        setattr(fixtures, attr, timed(getattr(fixtures, attr)))

    def run(name: str) -> tuple[float, float] | None:
        """(seconds, seconds in fixture writers), or None where the query failed."""
        t0, spent["fixture"] = time.perf_counter(), 0.0
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 - report the failure, keep measuring the rest
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            return None
        return time.perf_counter() - t0, spent["fixture"]

    cold: dict[str, float | None] = {}
    times: dict[str, float | None] = {}
    fixture: dict[str, float | None] = {}
    for name in names:
        runs = [run(name) for _ in range(RUNS)]
        done = sorted(r for r in runs if r)
        middle = done[len(done) // 2] if done else None
        cold[name] = round(runs[0][0], 3) if runs[0] else None
        times[name] = round(middle[0], 3) if middle else None
        fixture[name] = round(middle[1], 3) if middle else None
        print(f"# {name}: cold {cold[name]} s, median {times[name]} s, of it fixture {fixture[name]} s",
              file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(v for v in times.values() if v is not None), 3),
        "unit": "sec",
        "queries": times,
        "engine": {k: None if v is None else round(v - fixture[k], 3) for k, v in times.items()},
        "fixture": fixture,
        "cold": cold,
        "cold_total": round(sum(v for v in cold.values() if v is not None), 3),
        "failed": failed,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
