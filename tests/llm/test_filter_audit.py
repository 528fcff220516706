"""Operator 13 against running every order over every document."""

import re
from collections import Counter
from itertools import permutations

from helpers import SCHEMA, no_documents, odd_documents, rows
from pyspark.sql import functions as F

from crawlweave.llm import common
from crawlweave.llm import filter_audit as fa

LABELS = [(0, 1, 0), (1, 1, 1), (2, 0, 1), (3, None, None), (5, 0, 0), (5, 1, None), (None, 1, 1), (24, 1, 0),
          (100, 1, 1), (100, 0, 0), (777, 1, 1)]


def labels(spark, data=LABELS):
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int")


def fails(docs):
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, part in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = set()
        if len(words) < 200:
            failed.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            failed.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            failed.add("C")
        if re.search(r"[#$%&*|]", t):
            failed.add("D")
        if i is not None and i > least[t]:
            failed.add("E")
        yield i, part or "", failed


def expected(docs, marks):
    good = {i for i, q, _ in marks if q == 1 and i is not None}
    toxic = {i for i, _, x in marks if x == 1 and i is not None}
    told = list(fails(docs))
    out, shapley = {}, Counter()
    for part in {p for _, p, _ in told}:
        for order in map("".join, permutations("ABCDE")):
            left = [(i, f) for i, p, f in told if p == part]
            everyone = list(left)
            for step, x in enumerate(order, 1):
                removed = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                shapley[part, x] += len(removed)
                out[part, order, step] = (
                    len(left), len(removed), sum(x in f for _, f in everyone) - len(removed),
                    sum(f == {x} for _, f in everyone), sum(i in good for i, _ in removed),
                    sum(i in toxic for i, _ in removed))
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def audited(df):
    rows = df.collect()
    got = {(r.part, r.filter_order, r.step): (*[r[c] for c in fa.COUNTS], r.shapley) for r in rows}
    assert len(got) == len(rows)
    assert all(r["filter"] == r.filter_order[r.step - 1] for r in rows)
    return got


def test_odd_documents(spark):
    docs = [(r[0], r[1], r[3]) for r in rows()]
    assert audited(fa.filter_audit(odd_documents(spark), labels(spark))) == expected(docs, LABELS)


def test_texts_that_pass_and_large_groups_of_copies(spark):
    prose = " ".join(f"word{i}" for i in range(250))
    texts = [prose, prose.upper(), prose + " #", "same " * 300, "A few words", prose + " 50%", "w " * 199]
    data = [(i, texts[0] if i % 3 == 0 else texts[i % 7] + (f" {i}" if i % 5 else ""), f"s{i % 2}")
            for i in range(400)]
    marks = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 400, 3)]
    full = spark.createDataFrame([(i, t, None, s, None, *["x"] * 5) for i, t, s in data], SCHEMA)
    got = audited(fa.filter_audit(full.repartition(3), labels(spark, marks)))
    assert got == expected(data, marks)
    # every letter's Shapley shares add up to all that an order removes, 120 times
    for part in ("s0", "s1"):
        total = sum(s == part for _, _, s in data)
        assert sum(got[part, "ABCDE", i][-1] for i in range(1, 6)) == 120 * (total - got[part, "ABCDE", 5][0])


def test_empty_tables(spark):
    assert fa.filter_audit(no_documents(spark), labels(spark, [])).collect() == []
    one = audited(fa.filter_audit(odd_documents(spark).filter("doc_id = 0"), labels(spark, [])))
    assert len(one) == 600 and all(v[4] == v[5] == 0 for v in one.values())


def test_join_by_group(spark):
    """Rows of large and of small groups, and of none, meet their group once; null keys have none."""
    data = [(i, f"k{0 if i < 50 else i % 20}") for i in range(100)] + [(200, None), (201, "lonely")]
    left = spark.createDataFrame(data, "id long, key string")
    groups = left.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("least")).filter("n > 1")
    sizes = Counter(k for _, k in data)
    least = {}
    for i, k in data:
        least.setdefault(k, i)
    for heavy in (2, 4096):
        got = {(r.id, r.least) for r in common.join_by_group(left, groups, "key", "n", len(data), heavy).collect()}
        assert got == {(i, least[k] if k is not None and sizes[k] > 1 else None) for i, k in data}
