"""Operator 6 against brute force."""

import math

import numpy as np
import pytest
from helpers import collected
from pyspark.sql import functions as F

from crawlweave.llm import vector_search

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "clash", "clash") for i, v in vectors], SCHEMA)


def brute(vectors, queries, hits=20):
    usable = [(i, np.array(v, np.float64)) for i, v in vectors if i is not None and v is not None
              and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, own in usable:
        if q in queries:
            scored = sorted((-float(np.dot(np.float32(own).astype(float), np.float32(v).astype(float))), i)
                            for i, v in usable if i != q)
            out[q] = [i for _, i in scored[:hits]]
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, (v * (1 + i % 3)).tolist()) for i, v in enumerate(rng.standard_normal((1500, 24)))]
    out = collected(vector_search.search(table(spark, vectors), F.col("vec_id") % 20 == 0))
    want = brute(vectors, set(range(0, 1500, 20)))
    got = {}
    for r in out:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert got.keys() == want.keys()
    found = 0
    as_float = {i: np.float32(v).astype(float) for i, v in vectors}
    for q, hits in got.items():
        hits.sort()
        assert [h[0] for h in hits] == list(range(1, 21))
        assert all(abs(h[2] - as_float[q] @ as_float[h[1]]) < 1e-9 for h in hits)
        found += len({h[1] for h in hits} & set(want[q]))
    assert found / (20 * len(want)) >= 0.9


def test_odd_vectors_ties_and_few_candidates(spark):
    vectors = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]),
               (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]),
               (40, None), (60, [0.0, 0.0]), (9, [-1.0, 0.25])]
    out = collected(vector_search.search(table(spark, vectors), F.col("vec_id") % 20 == 0, hits=3))
    got = {q: [r["vec_id"] for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 20)}
    assert got == {0: [1, 2, 20], 20: [0, 1, 2]}
    assert {r["query_id"] for r in out} == {0, 20}


def test_many_equal_vectors(spark):
    vectors = [(i, [3.0, 4.0]) for i in range(400)] + [(1000 + i, [1.0, float(i)]) for i in range(10)]
    out = collected(vector_search.search(table(spark, vectors), F.col("vec_id") % 200 == 0, hits=5))
    got = {q: [r["vec_id"] for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 200)}
    want = brute(vectors, {0, 200, 1000}, 5)
    assert got[0] == want[0] and got[200] == want[200]


@pytest.mark.parametrize("largest", [1e7, 1e30])
def test_a_long_vector_hides_no_others(spark, largest):
    rng = np.random.default_rng(6)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((600, 24)))]
    vectors += [(1001, (rng.standard_normal(24) * largest).tolist()), (1002, (rng.standard_normal(24) / 1e7).tolist())]
    out = collected(vector_search.search(table(spark, vectors), F.col("vec_id") % 20 == 0, probe_share=1.0))
    want = brute(vectors, set(range(0, 600, 20)))
    got = {}
    for r in out:
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert got.keys() == want.keys()
    assert sum(len(got[q] & set(want[q])) for q in want) / (20 * len(want)) >= 0.95


def test_scores_decide_where_distances_do_not():
    """More points than are kept differ by less than distances in single precision can tell."""
    rng = np.random.default_rng(7)
    base = rng.standard_normal(16)
    vectors = np.tile(base, (300, 1))
    vectors[:, 0] += rng.permutation(300) * 1e-13
    turn = vector_search.Turn(16)
    top = np.log2(np.sqrt((vectors ** 2).sum(1)).max())
    points, queries = turn.points(vectors, np.full(300, top)), turn.queries(base[None])
    score = vector_search.inner_products(base[None], vectors)
    exact = score(np.zeros(300, int), np.arange(300))
    q, p, s = vector_search.adaptive_scan(queries, points, np.ones((1, 300), bool), 10, score=score)
    assert p.tolist() == np.lexsort((np.arange(300), -exact))[:10].tolist() and (s == exact[p]).all()


def test_scan_abandons_without_losing_the_nearest():
    rng = np.random.default_rng(2)
    points, queries = (rng.standard_normal((n, 64)).astype(np.float32) for n in (3000, 20))
    q, p, d = vector_search.adaptive_scan(queries, points, np.ones((20, 3000), bool), 10)
    exact = np.argsort(((queries[:, None, :] - points[None]) ** 2).sum(2), axis=1)[:, :10]
    assert np.mean([len(set(p[q == i]) & set(exact[i])) / 10 for i in range(20)]) > 0.97


def test_repeated_rows_count_once(spark):
    rng = np.random.default_rng(8)
    once = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((200, 8)))]
    repeated = once + once + [r for r in once if r[0] % 20 == 0] * 30
    repeated += [(500, once[0][1]), (501, once[0][1])]  # equal to a query, which itself occurs 32 times
    once += [(500, once[0][1]), (501, once[0][1])]
    asked = F.col("vec_id").isin(*range(0, 200, 20))
    want, got = ({(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in collected(vector_search.search(
        table(spark, x), asked, hits=5, probe_share=1.0))} for x in (once, repeated))
    assert got == want and len(got) == 50 and {got[0, 1][0], got[0, 2][0]} == {500, 501}


def test_an_id_with_several_vectors_counts_once(spark):
    vectors = [(0, [1.0, 0.0]), *[(1, [3.0, i / 8]) for i in range(8)], *[(0, [4.0, i / 64]) for i in range(8)],
               (2, [2.0, 0.0]), (3, [1.5, 0.0]), (4, [0.5, 0.0])]
    out = collected(vector_search.search(table(spark, vectors), F.col("vec_id") == 0, hits=3, probe_share=1.0))
    assert sorted((r["rank"], r["vec_id"]) for r in out) == [(1, 1), (2, 2), (3, 3)]


def test_empty(spark):
    assert collected(vector_search.search(table(spark, []), F.col("vec_id") % 20 == 0)) == []
    assert collected(vector_search.search(table(spark, [(0, None)]), F.col("vec_id") % 20 == 0)) == []


def test_an_id_with_most_of_the_vectors(spark):
    """One placeholder id with 2,000 vectors, nearest of all: it takes one place, and answers once as a query."""
    rng = np.random.default_rng(4)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 8)))]
    vectors += [(1000, (3 * v).tolist()) for v in rng.standard_normal((2000, 8))]
    out = collected(vector_search.search(table(spark, vectors), F.col("vec_id") % 20 == 0, hits=5, probe_share=1.0))
    best = {}
    exact = [(i, np.float32(v).astype(float)) for i, v in vectors]
    for q, own in exact:
        if q % 20 == 0:
            scores = best.setdefault(q, {})
            for i, v in exact:
                if i != q:
                    scores[i] = max(scores.get(i, -1e9), float(own @ v))
    got = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], pytest.approx(r["score"], abs=1e-9)))
    want = {q: sorted(s.items(), key=lambda x: (-x[1], x[0]))[:5] for q, s in best.items()}
    assert got == want


def test_blocks_tasks_and_chunks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(6)
    df = table(spark, [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((900, 12)))])
    rows = ["query_id", "rank", "vec_id", "score"]
    whole = sorted(map(tuple, vector_search.search(df, F.col("vec_id") % 3 == 0).select(rows).collect()))
    for name, value in (("BLOCKS", 3), ("LEAST_ROWS", 8), ("BLOCK_BYTES", 40 * 8 * 13), ("TASK_QUERIES", 70),
                        ("CHUNK_QUERIES", 9)):
        monkeypatch.setattr(vector_search, name, value)
    cut = sorted(map(tuple, vector_search.search(df, F.col("vec_id") % 3 == 0).select(rows).collect()))
    same = len(set(whole) & set(cut)) / len(whole)
    assert len(cut) == len(whole) and same > 0.98  # the adaptive test sees candidates in another order


def test_only_queries_are_shuffled_for_the_scan(spark):
    """No candidate is copied for the chunks of queries: the plan has no join of candidates, a task reads its block."""
    rng = np.random.default_rng(6)
    df = table(spark, [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 8)))])
    plan = vector_search.search(df, F.col("vec_id") % 3 == 0)._jdf.queryExecution().analyzed().toString()
    assert "CoGroup" not in plan and "sequence" not in plan
