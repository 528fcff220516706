"""Bounds that hold in rows, models against plain arithmetic, odd tables through models and pipeline, long texts."""

import numpy as np
import public_tokenizers as vocab
import pytest
from helpers import SCHEMA, collected, no_documents, odd_documents, rows
from pyspark.sql import functions as F

import corpus_pipeline
from crawlweave.llm import (
    bpe,
    fill_in_middle,
    filter_audit,
    language,
    near_dup,
    packing,
    quality_model,
    quality_rules,
    sharding,
    token_count,
    token_files,
)

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def sample(spark, docs, labels, most):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    return quality_model.training_rows(docs, spark.createDataFrame(labels, LABELS), "doc_id", "text", most).toArrow()


def test_sample_with_one_id_repeated(spark):
    """200 labels and 300 documents of one id: at most 300 texts, weighed by their labels; bounded, never empty."""
    docs = [(7, f"text {i % 250}") for i in range(300)] + [(8, "other"), (9, "no label")]
    labels = [(7, 1, 0)] * 150 + [(7, 0, 0)] * 50 + [(8, 0, 1), (99, 1, 0)]
    whole = sample(spark, docs, labels, 20_000)
    assert sorted(zip(whole["grade"].to_pylist(), whole["times"].to_pylist(), strict=True)) == sorted(
        [(2, 150), (1, 50)] * 250 + [(0, 1)])
    for most in (1, 2, 10, 100, 300, 501):
        assert 1 <= sample(spark, docs, labels, most).num_rows <= most
    assert sample(spark, docs, [(99, 1, 0), (None, 1, 0), (7, None, 0)], 100).num_rows == 0


def test_sample_of_many_ids(spark):
    docs = [(i, f"text {i}") for i in range(2000)]
    labels = [(i, i % 2, 0) for i in range(3000)]
    assert 300 <= sample(spark, docs, labels, 400).num_rows <= 400
    assert 1 <= sample(spark, docs, labels, 3).num_rows <= 3
    again = [sorted(sample(spark, docs, labels, 400)["buckets"].to_pylist()) for _ in range(2)]
    assert again[0] == again[1]


def likelihood(x, w, cuts, grades, times):
    """Mean negative log-likelihood of the cumulative-link model and its ridge, straight from the definition."""
    s = x @ w
    above = [np.ones(len(s)), *[1 / (1 + np.exp(c - s)) for c in cuts], np.zeros(len(s))]
    p = np.array([above[g][i] - above[g + 1][i] for i, g in enumerate(grades)])
    return -np.average(np.log(np.maximum(p, 1e-12)), weights=times) + quality_model.RIDGE / 20 * w @ w


def test_fit_against_a_plain_optimiser():
    """No step in any weight or threshold betters the fit, and descent along numeric gradients ends there too."""
    rng = np.random.default_rng(2)
    hot = rng.random((1500, 6)) < 0.5
    truth = np.array([1.0, -1.0, 0.8, -0.9, 1.2, -0.9])
    grades = np.digitize(hot @ truth + rng.logistic(size=1500) * 0.5, [-0.6, 0.9])
    times = rng.integers(1, 4, 1500)
    model = quality_model.fit([np.flatnonzero(r).astype(np.int32) for r in hot], grades, 3000, times)
    w, cuts = model.weights[:6].astype(float), np.array(model.thresholds)
    assert not model.weights[6:].any() and (model.weights[:6] != 0).all()

    def value(v):
        return likelihood(hot, v[:6], v[6:], grades, times)

    def gradient(v):
        step = 1e-5 * np.eye(len(v))
        return np.array([(value(v + d) - value(v - d)) / 2e-5 for d in step])

    at = np.concatenate([w, cuts])
    assert np.abs(gradient(at)).max() < 1e-3
    plain = np.array([0.0] * 6 + [-1.0, 1.0])
    for _ in range(1500):
        plain -= 1.0 * gradient(plain)
    assert abs(value(plain) - value(at)) < 1e-4
    assert np.abs(plain - at).max() < 0.05


def test_counts_are_repeated_rows():
    rng = np.random.default_rng(5)
    data = [np.flatnonzero(rng.random(8) < 0.5).astype(np.int32) for _ in range(400)]
    grades = np.array([min(2, (r < 4).sum()) for r in data])
    times = rng.integers(1, 3, 400)
    once = quality_model.fit(data, grades, 200, times)
    repeated = quality_model.fit([r for r, n in zip(data, times, strict=True) for _ in range(n)],
                                 np.repeat(grades, times), 200)
    used = (once.weights != 0) & (repeated.weights != 0)
    assert used.any() and np.allclose(once.weights[used], repeated.weights[used], atol=1e-2)


def test_one_language_under_four_tags_stays(spark):
    """English dealt over four tags beside three other languages: every document is kept and named by one of them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    tags = F.array(*[F.lit(t) for t in ("en", "eng", "english", "e")])
    noisy = docs.withColumn("lang", F.when(F.col("lang") == "en", F.element_at(
        tags, (F.pmod(F.xxhash64("doc_id"), F.lit(4)) + 1).cast("int"))).otherwise(F.col("lang")))
    plain = {r["doc_id"]: r for r in collected(language.identify(docs))}
    out = {r["doc_id"]: r for r in collected(language.identify(noisy))}
    gone = [i for i in out if plain[i]["kept"] and not out[i]["kept"]]
    assert gone == []
    english = {"en", "eng", "english", "e"}
    agree = [(out[i]["language"] in english) == (plain[i]["language"] == "en") for i in out if plain[i]["kept"]]
    assert np.mean(agree) > 0.99
    assert corpus_pipeline.in_known_languages(spark, noisy, SF).count() == sum(r["kept"] for r in plain.values())


def test_fusion_in_plain_numpy(spark):
    """Likelihoods, channel and smoothed priors as sums over documents, written out."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.withColumn("source", F.concat(F.coalesce("source", F.lit("h")), F.when(
        F.col("doc_id") % 3 == 0, ".org").otherwise(".net")))
    data = docs.select("doc_id", "text", "lang", "source").collect()
    languages, models = language.trigram_models(docs, "doc_id", "text", "lang")
    logs = models[0].value.astype(np.float64)
    k = len(languages) + 1
    every = [language.trigram_buckets(r.text or "") for r in data]
    ll = np.array([[*logs[b].sum(0), len(b) * float(np.float32(-np.log(language.BUCKETS)))] for b in every])
    ll *= language.TEMPER
    start = np.array([(1 - language.UNKNOWN_SHARE) / (k - 1)] * (k - 1) + [language.UNKNOWN_SHARE])

    def soft(x):
        e = np.exp(x - x.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)

    p = soft(ll + np.log(start)) * np.array([len(b) > 0 for b in every])[:, None]
    m = language.SMOOTHING
    total = p.sum(0) + m * start
    overall = total / total.sum()

    def summed(names):
        out = {}
        for name, x in zip(names, p, strict=True):
            out[name] = out.get(name, 0) + x
        return out

    hosts = [r.source for r in data]
    suffixes = summed([h.rsplit(".", 1)[1] for h in hosts])
    by_host, by_tag = summed(hosts), summed([r.lang or "" for r in data])
    post = []
    for r, own in zip(data, ll, strict=True):
        s = suffixes[r.source.rsplit(".", 1)[1]]
        upper = (s + m * overall) / (s.sum() + m)
        h = by_host[r.source]
        prior = (h + m * upper) / (h.sum() + m)
        t = by_tag[r.lang or ""]
        channel = (t + m * t.sum() / total.sum()) / (total + m)
        post.append(soft(own + np.log(prior) + np.log(channel)))
    out = {r["doc_id"]: r for r in collected(language.identify(docs))}
    for r, q, b in zip(data, post, every, strict=True):
        got = out[r.doc_id]
        if not len(b):
            assert got["language"] is None and not got["kept"]
            continue
        assert got["kept"] == (1 - q[-1] >= 0.5)
        best = int(np.argmax(q[:-1])) if got["kept"] else int(np.argmax(q))
        assert got["language"] == [*languages, "und"][best]
        assert got["probability"] == pytest.approx(q[best], rel=1e-6)


def test_near_duplicate_names_of_large_groups(spark):
    """Half of the rows one text, another class of many texts, a class without an id."""
    base = " ".join(f"w{i}" for i in range(60))
    data = [(i, base) for i in range(300)] + [(i, f"{base} x y{i}") for i in range(300, 400)]
    data += [(i, f"lonely {i} " + " ".join(f"v{i}x{j}" for j in range(20))) for i in range(400, 500)]
    data += [(None, "no id at all"), (None, "no id at all"), (None, "alone without id")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, *["x"] * 5) for i, t in data], SCHEMA)
    out = collected(near_dup.near_duplicate_classes(docs))
    assert len(out) == len(data)
    by = {}
    for r in out:
        by.setdefault(r["root"], []).append(r)
    for members in by.values():
        ids = [r["doc_id"] for r in members if r["doc_id"] is not None]
        assert {r["class_id"] for r in members} == {min(ids) if ids else None}
        assert {r["class_size"] for r in members} == {len(members)}
    assert sorted(map(len, by.values()))[-1] == 400 and len(by) == 1 + 100 + 2


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_quality_of_odd_documents_with_a_model(spark, make):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_model.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    odd = make(spark)
    out = collected(quality_model.rate(odd, model, ["doc_id"]))
    assert len(out) == odd.count()
    if out:
        assert len(out) == len(rows()) and all(0 <= r["tail_probability"] <= 1 for r in out)
        assert len({r["tail_probability"] for r in out if r["doc_id"] == 5}) <= 2  # repeated rows rate alike


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_pipeline_on_odd_tables(spark, make):
    """Nulls, repeated rows, extra columns with clashing names, and an empty table pass every stage."""
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == corpus_pipeline.COLUMNS
        assert kept.count() <= docs.count()
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}


def test_texts_of_megabytes(spark):
    """Every text operator takes a text of 2 MB beside small ones."""
    long = " ".join(f"w{i * 7919 % 100003}" for i in range(300_000))
    docs = spark.createDataFrame([(1, long, "en", "s", 0, *["x"] * 5), (2, "short one", "en", "s", 0, *["x"] * 5),
                                  (3, long + " tail", "en", "s", 0, *["x"] * 5)], SCHEMA)
    byte_bpe = vocab.path("byte_bpe_50k.json")
    classes = {r["doc_id"]: r["class_id"] for r in collected(near_dup.near_duplicate_classes(docs))}
    assert classes == {1: 1, 2: 2, 3: 1}
    judged = {r["doc_id"]: r["measures"]["n_words"] for r in collected(quality_rules.cascade(docs.select(
        "doc_id", "text")))}
    assert judged == {1: 300_000, 2: 2, 3: 300_001}
    tokens = {r["doc_id"]: r["n_tokens"] for r in collected(token_files.token_files_round_trip(docs, byte_bpe))}
    packed = collected(packing.pack(docs, byte_bpe))
    assert {d: sum(r["length"] for r in packed if r["doc_id"] == d) for d in (1, 2, 3)} == tokens
    coded = {r["doc_id"]: r["n_tokens"] for r in collected(bpe.round_trip_digest(
        docs, vocab.path("byte_bpe_50k.tiktoken"), vocab.PATTERN))}
    assert coded == {d: n - 1 for d, n in tokens.items()}
    assert len(collected(token_count.count_tokens(docs, vocab.path("piece_bpe_32k.model")))) == 3
    assert len(collected(sharding.shard_by_bytes(docs))) == 3
    assert len(collected(language.identify(docs))) == 3
    made = {r["doc_id"]: r["n"] for r in collected(fill_in_middle.fill_in_middle(docs))}
    assert made == {1: len(long), 2: 9, 3: len(long) + 5}
    audit = collected(filter_audit.filter_audit(docs, spark.createDataFrame([], LABELS)))
    assert {(r["kept"]) for r in audit if r["filter_order"] == "ABCDE" and r["step"] == 1} == {2}
