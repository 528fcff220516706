"""Operators 7 and 8 against plain Python."""

import re
import zlib
from collections import Counter
from itertools import combinations

from helpers import collected, no_documents, odd_documents, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from crawlweave.llm import quality_rules, sharding


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_measures_and_verdict(spark):
    out = collected(quality_rules.cascade(odd_documents(spark)))
    assert len(out) == len(rows())
    for r in out:
        m = r["measures"]
        own = (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"])
        assert own == measures(r["text"]), r["text"]
        failed = own[0] < 50 or 100 * own[4] > 50 * own[0]
        assert r["base_failed"] == failed
        assert r["kept"] == (r["rejected_by"] is None)
        assert not (failed and r["kept"])
        assert r["ids"] == "clash"


def test_verdict_does_not_depend_on_the_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    runs = [{r["doc_id"]: r["kept"] for r in collected(quality_rules.cascade(docs, ordered=order))}
            for order in (quality_rules.RULES, quality_rules.RULES[::-1])]
    assert runs[0] == runs[1]
    assert {True, False} == set(runs[0].values())


def test_rules_are_ordered_by_rejections_per_cost(spark):
    rules = [quality_rules.Rule("never", "n_words < 0"), quality_rules.Rule("always", "n_words >= 0")]
    assert [r.name for r in quality_rules.order_rules(odd_documents(spark), rules)] == ["always", "never"]


def test_empty_tables(spark):
    assert collected(quality_rules.cascade(no_documents(spark))) == []
    assert collected(sharding.shard_by_bytes(no_documents(spark))) == []


def check_shards(out, documents, shards):
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in documents)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    slots, of_text = {}, {}
    for r in out:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert of_text.setdefault((r["text_crc32"], r["size"]), r["shard"]) == r["shard"]
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_shards(spark):
    check_shards(collected(sharding.shard_by_bytes(odd_documents(spark), 4)), rows(), 4)


def test_slots_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    runs = [{r["doc_id"]: (r["shard"], r["slot"]) for r in collected(sharding.shard_by_bytes(docs.repartition(n)))}
            for n in (1, 7)]
    assert runs[0] == runs[1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=9), st.integers(1, 4))
def test_smallest_capacity_is_the_minimax(sizes, shards):
    best = min(max(sum(sizes[a:b]) for a, b in zip([0, *cut], [*cut, len(sizes)], strict=True))
               for n in range(min(shards, len(sizes)))
               for cut in combinations(range(1, len(sizes)), n))
    assert sharding.smallest_capacity(sizes, shards) == best
    cuts = sharding.minimax_cuts(sizes, shards)
    assert len(cuts) <= shards and cuts[0] == 0 and cuts == sorted(cuts)
    assert max(sum(sizes[a:b]) for a, b in zip(cuts, [*cuts[1:], len(sizes)], strict=True)) == best


def test_a_large_group_does_not_empty_other_shards():
    sizes = [10] * 300 + [3000] + [10] * 300
    cuts = sharding.minimax_cuts(sizes, 8)
    loads = [sum(sizes[a:b]) for a, b in zip(cuts, [*cuts[1:], len(sizes)], strict=True)]
    assert max(loads) == 3000 and min(loads) > 700
