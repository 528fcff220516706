"""Operator 3: language identification by Bayesian evidence fusion.

Evidence on a document's language:

* text: hashed letter trigrams under one multinomial model per language, for every label that has rows,
  fitted on a bounded sample of labelled rows (``SAMPLE_PER_LANGUAGE``); the class ``und`` (no known language)
  gives every trigram the same probability;
* the declared language (``lang`` attribute of the markup, or a column),
  through the channel P(declared | language);
* the address: P(language | host), smoothed towards P(language | suffix),
  that towards P(language).

Channel and priors are sums of the text posteriors over *all* documents, by
grouped aggregation (partial sums before the shuffle, so that a host with a
third of the rows is as cheap as any).  Models are fitted, broadcast and
applied in blocks of ``LANGUAGE_BLOCK`` languages, sums are taken in blocks of
as many classes: only one block's trigram counts (at most ``BUCKETS`` per
language) at a time, the list of labels and the classes' totals come to the
driver, and a task holds one block of models.

A text is kept when it is in some known language: when the posterior of the
unknown class is at most 1 - ``KEEP_PROBABILITY``.  Where one language goes by several tags
(``en``, ``eng``) they share its posterior, so that ``probability``, that of the best
tag, falls; the sum of all known ones does not.

A text without letters (null and empty ones too) has no language and is not
kept.  Null declared values and hosts are values of their own.  Ties go to
the language that comes first by name.  An empty table, or one without
labels, leaves the uniform class only.  Scores are computed on named
columns; others are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.llm.common import letter_bytes, map_texts, mix64, prepare, text_batches
from crawlweave.session import scratch_dir

#: Labelled rows per language that the trigram models are fitted on (expected; rows are chosen by id hash).
SAMPLE_PER_LANGUAGE = 2000
#: Languages whose models are held together (8 MB), and classes that are summed in one row.
LANGUAGE_BLOCK = 64
BUCKETS = 1 << 15
#: Weight of a trigram's log-likelihood: neighbouring trigrams share letters and are no independent evidence.
TEMPER = 0.2
#: Pseudo-documents of the upper level in the smoothing of suffix and host priors, and of a declared value.
SMOOTHING = 20.0
UNKNOWN = "und"
#: Prior share of the unknown class before any document is seen.
UNKNOWN_SHARE = 1e-3
#: Posterior of all known languages together from which a text is kept.
KEEP_PROBABILITY = 0.5


def trigram_buckets(text: str) -> np.ndarray:
    """Buckets of the whole text's trigrams over letters and single spaces; none without a letter."""
    raw = letter_bytes(text)
    blank = raw == 32
    if blank.all():
        return np.zeros(0, np.int64)
    keep = np.ones(len(raw), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    raw = np.concatenate([[np.uint8(32)], raw[keep], [np.uint8(32)]]).astype(np.uint64)
    code = (raw[:-2] << np.uint64(16)) | (raw[1:-1] << np.uint64(8)) | raw[2:]
    return (mix64(code) & np.uint64(BUCKETS - 1)).astype(np.int64)


def trigram_models(df: DataFrame, id_col: str, text_col: str, label_col: str,
                   per_language: int = SAMPLE_PER_LANGUAGE) -> tuple[list[str], list[Broadcast]]:
    """Languages (by name) and their log-probabilities, fitted on the sample.

    A broadcast holds one block of languages, a row per bucket.
    """
    spark = df.sparkSession
    label = primary_subtag(F.col(label_col))
    counts = df.groupBy(label.alias("lang")).count().filter(F.col("lang").isNotNull()).collect()
    counts.sort(key=lambda r: r.lang)
    languages = [r.lang for r in counts]
    if not languages:
        return [], []
    whole = 1 << 30
    limits = spark.createDataFrame([(r.lang, i, int(min(1.0, per_language / r["count"]) * whole))
                                    for i, r in enumerate(counts)], "lang string, place int, limit long")
    rows = df.select(F.col(id_col).alias("id"), label.alias("lang"), F.col(text_col).alias("text"))
    chosen = F.pmod(F.xxhash64(F.lit("language sample"), F.col("id")), F.lit(whole)) < F.col("limit")
    sample = rows.join(F.broadcast(limits), "lang").filter(chosen).select("place", "text")
    schema = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("bucket", T.IntegerType()),
                           T.StructField("n", T.LongType())])
    most = LANGUAGE_BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}

        def summed() -> Iterator[pa.RecordBatch]:
            for place, n in sums.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([place] * len(at), pa.int32()), pa.array(at, pa.int32()),
                                                  pa.array(n[at], pa.int64())], names=["place", "bucket", "n"])
            sums.clear()

        for batch in batches:
            for part, texts in text_batches(batch, "text"):
                for place, text in zip(part.column("place").to_pylist(), texts, strict=True):
                    if place not in sums and len(sums) >= most:
                        yield from summed()
                    sums[place] = sums.get(place, 0) + np.bincount(trigram_buckets(text), minlength=BUCKETS)
        yield from summed()

    found = sample.mapInArrow(run, schema).groupBy("place", "bucket").agg(F.sum("n").alias("n"))
    starts = range(0, len(languages), LANGUAGE_BLOCK)
    if len(starts) > 1:
        folder = scratch_dir(spark, "language-models")
        found.withColumn("block", F.floor(F.col("place") / LANGUAGE_BLOCK)).write.partitionBy("block").parquet(folder)
        found = spark.read.schema("place int, bucket int, n long, block int").parquet(folder)
    models = []
    for i, start in enumerate(starts):
        own = (found.filter(F.col("block") == i) if len(starts) > 1 else found).select("place", "bucket", "n").toArrow()
        sums = np.full((len(languages[start:start + LANGUAGE_BLOCK]), BUCKETS), 0.5)
        np.add.at(sums, (np.array(own["place"], dtype=np.int64) - start, np.array(own["bucket"], dtype=np.int64)),
                  np.array(own["n"]))
        logs = np.log(sums / sums.sum(1, keepdims=True)).astype(np.float32)
        models.append(spark.sparkContext.broadcast(logs.T.copy()))
    return languages, models


def primary_subtag(declared: Column) -> Column:
    """``en-GB`` and ``EN_us`` as ``en``; empty as null."""
    tag = F.lower(F.trim(F.substring_index(F.translate(declared, "_", "-"), "-", 1)))
    return F.when(F.length(tag) > 0, tag)


def markup_language(html: Column) -> Column:
    """The language that a page's root element declares."""
    return primary_subtag(F.nullif(F.regexp_extract(html, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z_-]+)", 1),
                                   F.lit("")))


def host_of(url: Column) -> Column:
    """The host of an address, in lower case, without port and leading ``www.`` or ``m.``."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^(www|m)\.", ""), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label of a host name; none where there is no dot."""
    return F.when(host.contains("."), F.substring_index(host, ".", -1))


def score_texts(df: DataFrame, keep: list[str], text_col: str, models: list[Broadcast]) -> DataFrame:
    """``keep`` plus ``letters`` (any?) and ``ll``: tempered log-likelihoods by language, the unknown class last."""
    unknown = float(np.float32(-np.log(BUCKETS)))

    def make():
        def score(texts):
            # bucket numbers fit two bytes; a batch's texts meet one block of languages after the other
            every = [trigram_buckets(text).astype(np.uint16) for text in texts]
            blocks = []
            for model in models:
                logs = model.value
                if len(models) > 1:
                    vars(model).pop("_value", None)
                out = np.zeros((len(texts), logs.shape[1]))
                for i, buckets in enumerate(every):
                    # summed by distinct bucket: a long text touches the model once per bucket
                    if len(buckets) > BUCKETS:
                        out[i] = np.bincount(buckets, minlength=BUCKETS) @ logs
                    else:
                        out[i] = logs[buckets].sum(0, dtype=np.float64)
                blocks.append(out)
            sizes = np.array([len(x) for x in every], np.int64)
            ll = TEMPER * np.hstack([*blocks, (sizes * unknown)[:, None]])
            at = np.arange(len(texts) + 1, dtype=np.int32) * np.int32(ll.shape[1])
            return [pa.array(sizes > 0), pa.ListArray.from_arrays(pa.array(at), pa.array(ll.ravel()))]

        return score

    return map_texts(df, text_col, keep, [T.StructField("letters", T.BooleanType()),
                                          T.StructField("ll", T.ArrayType(T.DoubleType()))], make)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _same(value: Column, like: Column) -> Column:
    """``value`` once per element of ``like``: within a lambda it would be computed for every element."""
    return F.array_repeat(value, F.size(like))


def _softmax(logs: Column) -> Column:
    powers = F.zip_with(logs, _same(F.array_max(logs), logs), lambda x, top: F.exp(x - top))
    return F.zip_with(powers, _same(_total(powers), logs), lambda x, total: x / total)


def _sums(rows: DataFrame, names: list[str], values: str, k: int) -> DataFrame:
    """``names`` and ``s``: the sums of ``values``, arrays of ``k`` numbers, element by element."""
    if k <= LANGUAGE_BLOCK + 1:
        return rows.groupBy(*names).agg(F.array(*[F.sum(F.col(values)[i]) for i in range(k)]).alias("s"))
    width = LANGUAGE_BLOCK
    cut = F.array(*[F.slice(values, i + 1, width) for i in range(0, k, width)])
    parts = rows.select(*names, F.posexplode(cut).alias("block", "x"))
    summed = parts.groupBy(*names, "block").agg(F.array(*[F.sum(F.get("x", F.lit(i))) for i in range(width)]).alias("x"))
    whole = summed.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("block", "x"))).alias("parts"))
    return whole.select(*names, F.slice(F.flatten(F.col("parts.x")), 1, k).alias("s"))


def _numbers(values: np.ndarray) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
             declared: Column | None = None, host: Column | None = None, keys: list[Column] | None = None) -> DataFrame:
    """``id_col`` (and ``keys``), ``language``, ``probability``, ``text_language``, ``declared``, ``host``, ``kept``.

    A kept text's language is the likeliest known one, any other's the likeliest class.

    ``declared`` and ``host`` default to the columns ``lang`` and ``source``.
    """
    spark = prepare(df.sparkSession)
    declared = primary_subtag(F.col("lang")) if declared is None else declared
    host = F.col("source") if host is None else host
    languages, models = trigram_models(df, id_col, text_col, label_col)
    classes = [*languages, UNKNOWN]
    k = len(classes)

    extra = [c.alias(f"__key{i}") for i, c in enumerate(keys or [])]
    named = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"),
                      F.coalesce(declared, F.lit("")).alias("declared"), F.coalesce(host, F.lit("")).alias("host"), *extra)
    keep = ["__id", "declared", "host", *[f"__key{i}" for i in range(len(extra))]]
    folder = scratch_dir(spark, "language")
    # the texts are scored once; what follows works on a slim table
    score_texts(named, keep, "__text", models).write.parquet(folder)
    for model in models:
        model.unpersist()
    scored = spark.read.parquet(folder).withColumn("suffix", F.coalesce(suffix_of(F.col("host")), F.lit("")))

    start = np.log([(1 - UNKNOWN_SHARE) / max(1, k - 1)] * (k - 1) + [UNKNOWN_SHARE])
    add = lambda x, y: x + y
    soft = scored.withColumn("first", F.zip_with("ll", _numbers(start), add)).withColumn("p", _softmax(F.col("first")))
    seen = soft.filter("letters")
    by_host = _sums(seen, ["host", "suffix"], "p", k)
    by_declared = _sums(seen, ["declared"], "p", k)
    totals = _sums(seen, [], "p", k).first()
    total = np.array([x or 0.0 for x in (totals and totals.s) or [0.0] * k]) + SMOOTHING * np.exp(start)
    overall = total / total.sum()

    # P(language | suffix) towards P(language); P(language | host) towards P(language | suffix)
    all_of = lambda c: _same(_total(F.col(c)), F.col(c))
    by_suffix = _sums(by_host, ["suffix"], "s", k).select("suffix", F.zip_with(
        F.zip_with("s", _numbers(overall), lambda u, o: u + SMOOTHING * o), all_of("s"),
        lambda x, n: x / (n + SMOOTHING)).alias("u"))
    prior = by_host.join(by_suffix, "suffix").select("host", F.zip_with(
        F.zip_with("s", "u", lambda x, u: x + SMOOTHING * u), all_of("s"),
        lambda x, n: F.log(x / (n + SMOOTHING))).alias("prior"))
    # P(declared | language), towards the share of the declared value
    channel = by_declared.select("declared", F.zip_with(
        F.zip_with("s", all_of("s"), lambda x, n: x + SMOOTHING * n / float(total.sum())), _numbers(total),
        lambda x, n: F.log(x / (n + SMOOTHING))).alias("channel"))

    fused = (soft.join(prior, "host", "left").join(channel, "declared", "left")
             .withColumn("prior", F.coalesce("prior", _numbers(np.log(overall))))
             .withColumn("channel", F.coalesce("channel", _numbers(np.zeros(k))))
             .withColumn("logs", F.zip_with(F.zip_with("ll", "prior", add), "channel", add)))
    fused = fused.withColumn("p", _softmax(F.col("logs")))
    known = 1 - F.element_at("p", k) >= KEEP_PROBABILITY
    names = F.array(*[F.lit(c) for c in classes])
    # the unknown class, the last, is named only where it outweighs all others together
    best = F.when(known & F.lit(k > 1), F.array_position(F.col("logs"), F.array_max(F.slice("logs", 1, max(1, k - 1))))
                  ).otherwise(F.array_position(F.col("logs"), F.array_max("logs"))).cast("int") - 1
    text_best = F.array_position(F.col("ll"), F.array_max("ll")).cast("int") - 1
    return fused.select(
        F.col("__id").alias(id_col), *[F.col(f"__key{i}") for i in range(len(extra))],
        F.when(F.col("letters"), F.get(names, best)).alias("language"),
        F.when(F.col("letters"), F.get("p", best)).alias("probability"),
        F.when(F.col("letters"), F.get(names, text_best)).alias("text_language"),
        F.nullif("declared", F.lit("")).alias("declared"), F.nullif("host", F.lit("")).alias("host"),
        (F.col("letters") & known & F.lit(k > 1)).alias("kept"))
