"""Compare registered queries against their DuckDB oracle (local check tool).

    python -m crawlweave.plans.check /root/testdata/sf0.01 [name ...]

Row count, column names/types and an order-insensitive hash of the values.
"""

from __future__ import annotations

import hashlib
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "\x00"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def table_hash(rows, cols) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x01".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    from crawlweave.plans.oracle import ORACLE
    from crawlweave.plans.queries import QUERIES

    con = duck(sf_dir)
    out = {}
    for name in names or list(QUERIES):
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        t1 = time.time()
        res = {"rows": len(rows), "sec": round(t1 - t0, 2)}
        sql = ORACLE.get(name)
        if sql is not None:
            rel = con.sql(sql)
            orows = rel.fetchall()
            ocols = rel.columns
            res.update({
                "oracle_rows": len(orows),
                "cols_match": sorted(cols) == sorted(ocols),
                "hash_match": table_hash(rows, cols) == table_hash(orows, ocols),
            })
            if verbose and not res["hash_match"]:
                sset = {tuple(_norm(r[cols.index(c)]) for c in sorted(cols)) for r in rows}
                oset = {tuple(_norm(r[ocols.index(c)]) for c in sorted(ocols)) for r in orows}
                res["only_spark"] = sorted(sset - oset)[:3]
                res["only_oracle"] = sorted(oset - sset)[:3]
                res["columns"] = (sorted(cols), sorted(ocols))
        out[name] = res
        if verbose:
            print(name, res, flush=True)
    return out


if __name__ == "__main__":
    from crawlweave.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]")
    compare(spark, sf, sys.argv[2:] or None)
