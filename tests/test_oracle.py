"""Every registered query against its DuckDB twin on the smallest test tables."""

import pytest

from crawlweave.plans.check import compare
from crawlweave.plans.oracle import ORACLE
from crawlweave.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    assert name in ORACLE
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res["rows"] == res["oracle_rows"]
    assert res["cols_match"]
    assert res["hash_match"], res


def test_entry_smoke(spark):
    import importlib.util
    import os

    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() >= 0
    assert set(mod.oracle_sql()) <= set(mod.queries())
    assert set(QUERIES) <= set(mod.oracle_sql())
