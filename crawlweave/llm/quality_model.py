"""Operator 2: quality by ordinal cumulative-link regression on graded ratings.

A document's grade is 0, 1 or 2: its quality label plus one if it is not
toxic.  One score s = w . x over hashed text features is shared by all
grades; ordered thresholds cut it: P(grade <= k) = sigmoid(t_k - s).  That
gives the expected grade and the tail probability P(grade >= 2), by which
documents are selected.

Features are buckets of a fixed hash space, each counted once per document:
the words (runs of letters, in lower case) and, for the shape of the text,
the bins of some ratios (symbols, capitals, repeated words, ...).  Buckets
seen in fewer than ``MIN_DOCS`` training documents, or whose mean grade is
not significantly off (``SIGNIFICANCE``), have no weight.

Fitted on a bounded sample of at most ``TRAIN_ROWS`` rows on the driver; every
text is scored whole, map-only, with the weights (1 MB) broadcast.  A row of the
sample is a distinct (id, text) with one of its id's grades; it weighs as much as
its id has labels of that grade.  Ids are cut by a hash so that they have at most
TRAIN_ROWS grades (three an id), their texts by a second hash over id and text
so that at most TRAIN_ROWS rows are left, whatever is repeated; the cuts widen
until the sample holds a row, if any id with a label has a document.

Null and empty texts have the shape features only.  Rows without label are
scored like any other.  A null id has no label.  Without labels (an empty
table), or with labels of a single grade, every document is kept with
probability 1.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.llm.common import _IS_SPACE, byte_word_hashes, letter_bytes, map_texts, mix64, prepare, word_hashes
from crawlweave.session import scratch_dir

#: Rows (distinct id, text and grade) the model is fitted on, at most; the share first tried stays a little below.
TRAIN_ROWS = 20_000
MARGIN = 0.95
HASHES = 1 << 62
BUCKETS = 1 << 18
MIN_DOCS = 4
SIGNIFICANCE = 5.0
GRADES = 3
ROUNDS = 200
RATE = 0.05
RIDGE = 2e-4
#: A document is kept when P(grade >= 2) is at least this.
KEEP_PROBABILITY = 0.6

_EDGES = np.array([0.0, 0.005, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])


def shape(text: str, raw: np.ndarray, words: np.ndarray) -> list[float]:
    """Ratios in 0 .. 1 that tell prose from lists, shouting, symbols and repetition."""
    n, m = max(1, len(raw)), max(1, len(words))
    counts = np.bincount(raw, minlength=256)
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    other = counts[33:127].sum() - upper - lower - counts[48:58].sum()
    lines = text.split("\n")
    distinct = len(np.unique(words)) / m if len(words) else 1.0
    return [other / n, upper / max(1, upper + lower), counts[48:58].sum() / n, counts[ord("|")] / m,
            counts[ord("!")] / m, counts[[ord(c) for c in "#*$%&<>"]].sum() / (8 * m),
            float((words[1:] == words[:-1]).mean()) if len(words) > 1 else 0.0,
            1 - distinct, 1 - len(set(lines)) / len(lines), min(1.0, counts[~_IS_SPACE].sum() / (20 * m)),
            min(1.0, np.log1p(m) / 12)]


def features(text: str) -> np.ndarray:
    """Distinct buckets of a whole text."""
    words = np.unique(byte_word_hashes(letter_bytes(text)))
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    ratios = shape(text, raw, word_hashes(text))
    bins = np.searchsorted(_EDGES, ratios, side="left").astype(np.uint64) + np.arange(
        1, len(ratios) + 1, dtype=np.uint64) * np.uint64(1000)
    # a ratio counts for every bin up to its own, so that neighbouring bins share weight
    steps = [np.arange(i * 1000, b + 1, dtype=np.uint64) for i, b in enumerate(bins.tolist(), start=1)]
    every = np.concatenate([words, mix64(np.concatenate(steps) + np.uint64(1 << 40))])
    return np.unique(every & np.uint64(BUCKETS - 1)).astype(np.int32)


@dataclass
class OrdinalModel:
    """``weights`` by bucket and the ordered ``thresholds`` between grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, buckets: np.ndarray) -> float:
        return float(self.weights[buckets].sum())

    def grade(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and probability of the best grade."""
        above = 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)))
        return above.sum(1), above[:, -1]


def fit(rows: list[np.ndarray], grades: np.ndarray, rounds: int = ROUNDS,
        counts: np.ndarray | None = None) -> OrdinalModel:
    """Full-batch Adam on the cumulative-link likelihood; thresholds stay ordered as a base and positive steps.

    ``counts``: how often each row counts (once by default).
    """
    sizes = np.array([len(r) for r in rows])
    every = np.concatenate(rows).astype(np.int64)
    seen = np.bincount(every, minlength=BUCKETS)
    times = np.ones(len(rows)) if counts is None else np.asarray(counts, np.float64)
    weight = times / times.mean()
    mean = float(np.average(grades, weights=weight))
    spread = float(np.sqrt(np.average((grades - mean) ** 2, weights=weight)))
    # a bucket must tell grades apart: its mean grade lies SIGNIFICANCE standard errors off the mean of all
    summed = np.bincount(every, weights=np.repeat(weight, sizes), minlength=BUCKETS)
    means = np.bincount(every, weights=np.repeat(grades * weight, sizes), minlength=BUCKETS) / np.maximum(summed, 1e-9)
    off = np.abs(means - mean) * np.sqrt(seen) / max(spread, 1e-9)
    useful = (seen >= MIN_DOCS) & (off >= SIGNIFICANCE)
    columns = np.cumsum(useful) - 1
    owner = np.repeat(np.arange(len(rows)), sizes)[useful[every]]
    at = columns[every[useful[every]]]
    width, n = int(useful.sum()), len(rows)
    shares = np.clip(np.cumsum(np.bincount(grades, weights=weight, minlength=GRADES))[:-1] / n, 1e-3, 1 - 1e-3)
    first = np.log(shares / (1 - shares))
    # parameters: weights, first threshold, logs of the steps between thresholds
    x = np.concatenate([np.zeros(width), [first[0]], np.log(np.maximum(1e-2, np.diff(first)))])
    m, v = np.zeros_like(x), np.zeros_like(x)

    def thresholds(x):
        return np.cumsum(np.concatenate([[x[width]], np.exp(x[width + 1:])]))

    for t in range(1, rounds + 1):
        cuts = thresholds(x)
        s = np.bincount(owner, weights=x[at], minlength=n)
        bounds = np.concatenate([[-np.inf], cuts, [np.inf]])
        with np.errstate(over="ignore"):
            a = 1 / (1 + np.exp(s - bounds[grades + 1]))
            b = 1 / (1 + np.exp(s - bounds[grades]))
        p = np.maximum(a - b, 1e-9)
        ds = weight * (1 - a - b) / n
        d_cut = np.zeros(GRADES + 1)
        np.add.at(d_cut, grades + 1, -weight * a * (1 - a) / p / n)
        np.add.at(d_cut, grades, weight * b * (1 - b) / p / n)
        d_cut = d_cut[1:-1]
        tail = np.cumsum(d_cut[::-1])[::-1]  # a step moves all thresholds above it
        g = np.concatenate([np.bincount(at, weights=ds[owner], minlength=width) + RIDGE * x[:width] / 10,
                            [tail[0]], tail[1:] * np.exp(x[width + 1:])])
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        x -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    weights = np.zeros(BUCKETS, np.float32)
    weights[useful] = x[:width]
    return OrdinalModel(weights, thresholds(x))


def hash_cut(rows: DataFrame, hashed: Column, most: int) -> DataFrame:
    """Rows by ascending hash (0 to HASHES), at most ``most`` and at least one where there is any.

    The first cut is the share that should give them; it is moved until the
    count fits, halfway between cuts that held too many and none.
    """
    total = rows.count()
    if total <= most:
        return rows
    empty, full, at = 0, HASHES, max(1, int(MARGIN * most / total * HASHES))
    while True:
        chosen = rows.filter(hashed < at)
        n = chosen.count()
        if 0 < n <= most:
            return chosen
        empty, full = (at, full) if n == 0 else (empty, at)
        if full - empty <= 1:  # too many rows share the first hash (an id's grades)
            return rows.filter(hashed < full).orderBy(*rows.columns).limit(most)
        at = min(at * 2, (empty + full) // 2) if n == 0 and full == HASHES else (empty + full) // 2


def training_rows(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """``grade``, ``times`` and ``buckets`` of the sample, at most ``most`` rows."""
    spark = prepare(df.sparkSession)

    def hashed(name: str, *columns: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(name), *columns), F.lit(HASHES))

    def cut(frame: DataFrame, name: str) -> DataFrame:
        folder = scratch_dir(spark, name)
        frame.write.parquet(folder)
        return spark.read.schema(frame.schema).parquet(folder)

    grade = (F.col("quality") + (1 - F.col("toxic"))).cast("int")
    graded = (labels.select(F.col("doc_id").alias("__id"), grade.alias("grade")).dropna()
              .groupBy("__id", "grade").agg(F.count("*").alias("times")))
    # slim rows: the grades of the ids that have documents, and how many
    graded = cut(df.select(F.col(id_col).alias("__id")).join(graded, "__id")
                 .groupBy("__id", "grade").agg(F.any_value("times").alias("times"), F.count("*").alias("docs")),
                 "quality-grades")
    chosen = cut(hash_cut(graded, hashed("quality sample", "__id"), most), "quality-sample")  # at most ``most`` rows
    texts = df.select(F.col(id_col).alias("__id"), F.coalesce(text_col, F.lit("")).alias("__text"))
    keyed = (texts.join(F.broadcast(chosen.select("__id").distinct()), "__id")
             .withColumn("__key", F.unhex(F.sha2("__text", 256))))
    if (chosen.agg(F.sum("docs")).first()[0] or 0) > most:
        # repeated ids: their distinct texts are cut by a hash of their own
        units = cut(keyed.select("__id", "__key").distinct(), "quality-texts").join(F.broadcast(chosen), "__id")
        chosen = cut(hash_cut(units, hashed("quality text", "__id", "__key"), most), "quality-rows")
        keyed = keyed.join(F.broadcast(chosen.select("__id", "__key").distinct()), ["__id", "__key"], "left_semi")
    found = keyed.groupBy("__id", "__key").agg(F.any_value("__text").alias("__text")).join(
        F.broadcast(chosen), [c for c in ("__id", "__key") if c in chosen.columns])
    return map_texts(found, "__text", ["grade", "times"], [T.StructField("buckets", T.BinaryType())],
                     lambda: lambda texts: [pa.array([features(t).tobytes() for t in texts], pa.binary())])


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          most: int = TRAIN_ROWS) -> OrdinalModel | None:
    found = training_rows(df, labels, id_col, text_col, most).toArrow()
    grades = np.array(found["grade"], dtype=np.int64)
    if len(np.unique(grades)) < 2:
        return None
    rows = [np.frombuffer(x, np.int32) for x in found["buckets"].to_pylist()]
    times = np.array(found["times"], dtype=np.int64)
    # the same whatever the task order
    order = np.lexsort((times, np.array([zlib.crc32(r.tobytes()) for r in rows]), grades))
    return fit([rows[i] for i in order.tolist()], grades[order], counts=times[order])


def rate(df: DataFrame, model: OrdinalModel | None, keep: list[str], text_col: str = "text",
         threshold: float = KEEP_PROBABILITY) -> DataFrame:
    """``keep`` columns plus ``expected_grade``, ``tail_probability`` and ``kept``."""
    spark = prepare(df.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def make():
        own = shared.value

        def judge(texts):
            if own is None:
                expected, tail = np.full(len(texts), GRADES - 1.0), np.ones(len(texts))
            else:
                expected, tail = own.grade(np.array([own.score(features(t)) for t in texts]))
            return [pa.array(expected, pa.float64()), pa.array(tail, pa.float64()), pa.array(tail >= threshold)]

        return judge

    return map_texts(df, text_col, keep, [T.StructField("expected_grade", T.DoubleType()),
                                          T.StructField("tail_probability", T.DoubleType()),
                                          T.StructField("kept", T.BooleanType())], make)
