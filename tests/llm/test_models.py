"""Operators 1, 2, 3 and the pipeline: brute force and held-out accuracy."""

import zlib

import numpy as np
import public_tokenizers as vocab
import pytest
from helpers import SCHEMA, collected, no_documents, odd_documents, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from crawlweave.llm import components, language, near_dup, quality_model
from crawlweave.llm.common import shingle_hashes, word_hashes

SF = "/root/testdata/sf0.01"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0, *["clash"] * 5) for i, t in texts], SCHEMA)


def test_word_hashes_tell_words_apart():
    h = word_hashes("the cat\tthe  dog\nété the")
    assert len(h) == 6 and h[0] == h[2] == h[5] and len(set(h.tolist())) == 4
    assert len(word_hashes("")) == 0 and len(word_hashes(" \n")) == 0
    assert len(shingle_hashes(h)) == 2 and len(shingle_hashes(h[:3])) == 1


def brute_classes(texts, idf):
    sets = {t: near_dup.weighted_set(t, idf) for t in set(texts)}
    names = sorted(sets)
    root = {t: t for t in names}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(names):
        for b in names[:i]:
            if len(sets[a][0]) and len(sets[b][0]) and near_dup.weighted_jaccard(sets[a], sets[b]) >= 0.8:
                root[top(a)] = top(b)
    return [top(t) for t in texts]


def same_partition(left, right):
    return len(set(zip(left, right, strict=True))) == len(set(left)) == len(set(right))


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for g in range(25):
        base = rng.choice(words, 120).tolist()
        texts.append(" ".join(base))
        for _ in range(int(rng.integers(0, 6))):
            copy = list(base)
            for at in rng.integers(0, 120, int(rng.integers(0, 5))):
                copy[at] = str(rng.choice(words))
            texts.append(" ".join(copy))
    base = rng.choice(words, 200).tolist()  # a large group of near copies, and one of exact copies
    for _ in range(150):
        copy = list(base)
        copy[int(rng.integers(0, 200))] = str(rng.integers(0, 10**6))
        texts.append(" ".join(copy))
    texts += ["exact copy of a text that is common"] * 60 + [None, "", "", "two words", "two words", "two word"]
    df = documents(spark, enumerate(texts))
    out = {r["doc_id"]: r for r in collected(near_dup.near_duplicate_classes(df))}
    counts, n = near_dup.document_frequencies(df, "text")
    want = brute_classes([t or "" for t in texts], near_dup.idf_table(counts, n))
    got = [out[i]["class_id"] for i in range(len(texts))]
    assert n == len(texts) and same_partition(got, want)
    for i, c in enumerate(got):
        assert c == min(j for j, d in enumerate(got) if d == c) and out[i]["class_size"] == got.count(c)


def test_what_shares_a_bucket_beside_its_leader_is_decided(spark):
    """b and c are alike, their bucket's leader is like neither: only the last step can link them."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(100)) for x in "xyy")
    c += " tail"
    texts = spark.createDataFrame([(bytes([i]), t) for i, t in enumerate((a, b, c))], "key binary, text string")
    rows_ = spark.createDataFrame([(1, 0, 0, bytes([1]), bytes([1])), (1, 0, 0, bytes([2]), bytes([2])),
                                   (1, 0, 0, bytes([0]), bytes([0]))],
                                  "bucket long, i int, j int, key binary, root binary")
    found = collected(near_dup.verify_blocks(rows_, rows_, texts, np.ones(near_dup.COUNTERS, np.float32)))
    assert {frozenset((bytes(r["a"]), bytes(r["b"]))) for r in found} == {frozenset((bytes([1]), bytes([2])))}


def test_samples_agree_with_weighted_jaccard():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 400, dtype=np.uint64)
    h.sort()
    a = (h[:300], rng.uniform(1, 3, 300).astype(np.float32))
    b = (h[100:], np.concatenate([a[1][100:], rng.uniform(1, 3, 100)]).astype(np.float32))
    s = near_dup.Sampler(2000)
    agree = (s.samples(*a) == s.samples(*b)).mean()
    assert abs(agree - near_dup.weighted_jaccard(a, b)) < 0.05


def test_components(spark):
    rng = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(i, i + 1) for i in range(1000, 1040)]
    got = {r["v"]: r["root"] for r in collected(components.connected(spark.createDataFrame(links, "a long, b long")))}
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for v in got:
        seen, todo = {v}, [v]
        while todo:
            for w in near[todo.pop()] - seen:
                seen.add(w)
                todo.append(w)
        assert got[v] == min(seen)
    assert collected(components.connected(spark.createDataFrame([], "a long, b long"))) == []


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = quality_model.train(docs, labels.filter(~held))
    out = [r for r in quality_model.rate(docs, model, ["doc_id"]).join(labels.filter(held), "doc_id").collect()]
    good = [r.kept for r in out if r.quality == 1 and r.toxic == 0]
    low = [r.kept for r in out if r.quality == 0]
    assert len(good) > 50 and np.mean(good) >= 0.95
    assert np.mean(low) <= 0.1
    assert all(0 <= r.expected_grade <= 2 and r.kept == (r.tail_probability >= 0.6) for r in out)
    assert (np.diff(model.thresholds) > 0).all()


def test_ordinal_fit_recovers_an_order():
    rng = np.random.default_rng(8)
    x = [np.flatnonzero(rng.random(12) < 0.5).astype(np.int32) for _ in range(3000)]
    score = np.array([(r < 4).sum() - ((r >= 4) & (r < 8)).sum() for r in x]) + rng.logistic(size=3000) * 0.3
    model = quality_model.fit(x, np.digitize(score, [-0.5, 1.5]))
    w = model.weights
    assert w[:4].min() > 0 > w[4:8].max() and np.abs(w[8:12]).max() < 0.5 * w[:4].min()


def test_quality_without_labels(spark):
    docs = odd_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_model.train(docs, none) is None
    out = collected(quality_model.rate(docs, None, ["doc_id"]))
    assert len(out) == len(rows()) and all(r["kept"] for r in out)


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    languages, logs = language.trigram_models(docs.filter(~held), "doc_id", "text", "lang")
    scored = language.score_texts(docs.filter(held), ["lang"], "text", logs).collect()
    right = [languages[int(np.argmax(r.ll[:-1]))] == r.lang for r in scored]
    assert languages == ["de", "en", "es", "fr"] and len(right) > 150 and np.mean(right) > 0.97


def test_language_evidence_decides_where_the_text_does_not(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    plain = [(9001, "12 aa 34", "fr", "x.fr", 0), (9002, "### 12", "en", "src1", 0), (9003, None, None, None, 0),
             (9004, "中文的句子是没有模型的语言" * 20, None, None, 0)]
    out = {r["doc_id"]: r for r in collected(language.identify(docs.union(spark.createDataFrame(plain, docs.schema))))}
    assert out[9001]["language"] == "fr" and out[9001]["kept"]
    assert out[9002]["language"] is None and not out[9002]["kept"]
    assert out[9003]["language"] is None and not out[9003]["kept"]
    assert out[9004]["language"] == "und" and not out[9004]["kept"]


def test_every_label_has_a_model(spark):
    """70 languages, each in a script of its own: the rarest labels are named like the others."""
    rng = np.random.default_rng(3)
    made = []
    for i in range(70):
        letters = [chr(0x4E00 + 40 * i + j) for j in range(40)]
        made += [(f"l{i:02}", " ".join("".join(rng.choice(letters, 4)) for _ in range(30)))
                 for _ in range(3 if i >= 64 else 5)]
    docs = documents(spark, enumerate(t for _, t in made)).drop("lang", "source")
    names = spark.createDataFrame([(i, n, "h") for i, (n, _) in enumerate(made)], "doc_id long, lang string, source string")
    docs = docs.join(names, "doc_id").select("doc_id", "text", "lang", "source", "n_chars")
    out = {r["doc_id"]: r for r in collected(language.identify(docs))}
    assert [out[i]["language"] for i in range(len(made))] == [n for n, _ in made]
    assert [out[i]["text_language"] for i in range(len(made))] == [n for n, _ in made]
    assert all(r["kept"] for r in out.values())
    assert corpus_pipeline.in_known_languages(spark, docs, SF).count() == len(made)


def test_blocks_of_languages_change_nothing(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = {r["doc_id"]: r for r in collected(language.identify(docs))}
    monkeypatch.setattr(language, "LANGUAGE_BLOCK", 2)
    cut = {r["doc_id"]: r for r in collected(language.identify(docs))}
    assert whole.keys() == cut.keys()
    for i, r in whole.items():
        assert {c: v for c, v in cut[i].items() if c != "probability"} == {
            c: v for c, v in r.items() if c != "probability"}
        assert r["probability"] == pytest.approx(cut[i]["probability"], rel=1e-9)


def test_language_of_pages(spark):
    """Markup and address as evidence, on raw pages: labels are the pages' own declarations."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("declared", language.markup_language(F.col("html")))
    text = F.regexp_replace(F.regexp_replace("html", "(?is)<(script|style)\\b.*?</\\1>", " "), "<[^>]*>", " ")
    pages = pages.withColumn("text", text)
    out = collected(language.identify(pages, "page_id", "text", "declared", declared=F.col("declared"),
                                      host=language.host_of(F.col("url"))))
    assert len(out) == pages.count()
    assert np.mean([r["language"] == r["declared"] for r in out if r["declared"]]) > 0.9
    parts = spark.createDataFrame([("http://www.Ex.de:80/a", "<HTML LANG='de-AT'>"), ("x", "<p lang='en'>")],
                                  "u string, h string")
    assert [tuple(r) for r in parts.select(
        language.host_of(F.col("u")), language.suffix_of(language.host_of(F.col("u"))),
        language.markup_language(F.col("h"))).collect()] == [("ex.de", "de", "de"), (None, None, None)]


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_odd_and_empty_documents(spark, make):
    docs = make(spark)
    n = docs.count()
    assert len(collected(near_dup.near_duplicate_classes(docs))) == n
    judged = collected(language.identify(docs))
    assert len(judged) == n and all(not r["kept"] for r in judged if r["language"] is None)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(1).select((F.col("doc_id") * 0 - 1).alias("doc_id"), F.lit("12 34").alias("text"), "lang",
                                 "source", "n_chars")
    docs = docs.union(extra).union(docs.filter("doc_id = 2"))  # a row without letters, and a repeated row
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == corpus_pipeline.COLUMNS
        before = {(r.doc_id, r.text) for r in docs.collect()}
        after = [(r.doc_id, r.text) for r in kept.collect()]
        assert set(after) <= before
        sizes.append((name, len(before), len(after)))
        if name == "language":
            assert before - set(after) == {(-1, "12 34")}
        if name == "quality":  # the same model, applied text by text
            model = quality_model.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            good = {(d, t) for d, t in before if model.grade(np.array([model.score(
                quality_model.features(t or ""))]))[1][0] >= quality_model.KEEP_PROBABILITY}
            assert set(after) == good and 0 < len(good) < len(before)
        if name == "near_duplicates":  # all pairs of texts
            listed = sorted(before)
            classes = brute_classes([t or "" for _, t in listed],
                                    near_dup.idf_table(*near_dup.document_frequencies(docs, "text")))
            first = {}
            for (doc, text), c in zip(listed, classes, strict=True):
                first.setdefault(c, (doc, text))
            assert len(after) == len(set(after)) and set(after) == set(first.values()) and len(after) < len(before)
        docs = kept
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    encode = Tokenizer.from_file(vocab.path("byte_bpe_50k.json")).encode
    ids = {d: [*encode(t, add_special_tokens=False).ids, 1] for d, t in after}
    covered = {}
    for r in out:
        piece = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(piece) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        covered[r.doc_id] = covered.get(r.doc_id, 0) + r.length
    assert covered == {d: len(x) for d, x in ids.items()}


def test_pipeline_run_reads_documents(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert set(out.columns) >= {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert 0 < out.select("doc_id").distinct().count() < 200
