"""Operator 1: near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its 5-word shingles (a shorter text is one
shingle): weight = count x idf, with a damped idf between 1 (in every
document) and ``IDF_TOP`` (in a share of at most ``RARE_SHARE`` of them).
Two texts are linked when their weighted Jaccard similarity (sum of smaller
over sum of larger weights) is ``SIMILARITY`` or more.  Classes are the
connected components of the links, equal texts included.

1. Document frequencies of all shingles of all documents are counted in a
   table of ``COUNTERS`` hash counters per task, summed over tasks; the mean
   of the counters, which collisions add, is taken off.  The table is 4 MB at any size.
2. Every text gets ``BANDS`` x ``ROWS`` samples, each drawing a shingle
   with a probability in proportion to its weight, alike in similar texts (Ioffe's
   construction), and a bucket per band.  Only text digests and buckets are shuffled.
3. Candidates are texts that share a bucket.  A bucket's leader is the text
   that has the most company over all buckets.  Each text is compared with
   one leader, then with the other leaders it is not connected to yet - a
   linear number of comparisons, made where the samples agree enough.  What
   then still shares a bucket without being connected is compared exactly,
   small components of the bucket against its members, in blocks of bounded
   size: no group lands in one task, and no pair that shares a bucket and
   agrees enough is left undecided.

Nodes are digests of texts, so a group of equal texts is one node, however
large.  Null text counts as empty; texts without words are linked to equal
texts only.  Repeated rows are in one class.  An empty table gives no rows.
A class is named by its smallest id (null if it has none).  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.llm.common import join_by_group, map_texts, mix64, prepare, shingle_hashes, text_batches, word_hashes
from crawlweave.llm.components import connected
from crawlweave.session import scratch_dir

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: A pair at the threshold shares a bucket with probability 1 - (1 - 0.8^4)^14 = 0.9994.
BANDS, ROWS = 14, 4
#: Of the 56 samples, so many must agree for a pair to be verified: one at the
#: threshold falls short with a probability of 1 in 10,000, less than its bands miss.
LEAST_AGREEING = 34
COUNTERS = 1 << 20
#: Rows the counter table is cut into, and groups of tasks, while it is summed.
SEGMENTS, TASK_GROUPS = 16, 64
RARE_SHARE = 1e-3
IDF_TOP = 1.15
#: Texts of a block in the exact comparison of what is left in a bucket.
LEFT_BLOCK, RIGHT_BLOCK = 256, 512
SEED = 7


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a whole text, in order, and their counts."""
    return np.unique(shingle_hashes(word_hashes(text), SHINGLE_WORDS), return_counts=True)


def counter_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def document_frequencies(df: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Counters of shingle document frequencies over all texts, and the number of texts."""
    schema = T.StructType([T.StructField("segment", T.IntegerType()), T.StructField("task", T.LongType()),
                           T.StructField("docs", T.LongType()), T.StructField("counts", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts, docs = np.zeros(COUNTERS, np.int64), 0
        for batch in batches:
            for _, texts in text_batches(batch, text_col):
                found = [counter_of(shingles(t)[0]) for t in texts]
                docs += len(texts)
                counts += np.bincount(np.concatenate(found) if found else [], minlength=COUNTERS)
        if docs:
            parts = counts.reshape(SEGMENTS, -1)
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pylist([
                {"segment": i, "task": task, "docs": docs if i == 0 else 0, "counts": p.astype("<i4").tobytes()}
                for i, p in enumerate(parts)], schema=_arrow(schema))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come in no order: a partition's sums per segment, one row each
        sums: dict[int, np.ndarray] = {}
        docs = 0
        for batch in batches:
            for row in batch.to_pylist():
                part = _numbers(row["counts"])
                sums[row["segment"]] = sums.get(row["segment"], 0) + part
                docs += row["docs"]
        for i, (segment, part) in enumerate(sorted(sums.items())):
            yield pa.RecordBatch.from_pylist([{"segment": segment, "task": 0, "docs": docs if i == 0 else 0,
                                               "counts": part.astype("<i8").tobytes()}], schema=_arrow(schema))

    # sums in two steps: over groups of tasks, then over all
    partial = df.select(text_col).mapInArrow(run, schema)
    halfway = partial.repartition("segment", F.pmod("task", F.lit(TASK_GROUPS))).mapInArrow(add, schema)
    rows = halfway.repartition("segment").mapInArrow(add, schema).toArrow().to_pylist()
    counts, docs = np.zeros((SEGMENTS, COUNTERS // SEGMENTS), np.int64), 0
    for row in rows:
        counts[row["segment"]] += _numbers(row["counts"])
        docs += row["docs"]
    return counts.ravel(), docs


def _numbers(raw: bytes) -> np.ndarray:
    """Counters of a segment: 4 bytes each from one task, 8 once summed."""
    return np.frombuffer(raw, "<i4" if len(raw) == 4 * COUNTERS // SEGMENTS else "<i8")


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def idf_table(counts: np.ndarray, docs: int) -> np.ndarray:
    """idf by counter, between 1 and IDF_TOP."""
    share = np.maximum(0, counts - counts.mean()) / max(1, docs)
    rare = np.log(1 / np.clip(share, RARE_SHARE, 1)) / np.log(1 / RARE_SHARE)
    return (1 + (IDF_TOP - 1) * rare).astype(np.float32)


def weighted_set(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, counts = shingles(text)
    return hashes, counts.astype(np.float32) * idf[counter_of(hashes)]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller over sum of the larger weights."""
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    smaller = float(np.minimum(a[1][same], b[1][at[same]]).sum(dtype=np.float64))
    larger = float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - smaller
    return smaller / larger if larger else 0.0


class BlockIndex:
    """Shingles of a block of texts in one sorted list, to compare a text with all of them at once."""

    def __init__(self, sets: list[tuple[np.ndarray, np.ndarray]]):
        self.n = len(sets)
        hashes = np.concatenate([h for h, _ in sets])
        owner = np.repeat(np.arange(self.n), [len(h) for h, _ in sets])
        weights = np.concatenate([w for _, w in sets])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner, self.weights = hashes[order], owner[order], weights[order]
        self.totals = np.array([w.sum(dtype=np.float64) for _, w in sets])

    def jaccard(self, own: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Weighted Jaccard similarity of a text with each of the block."""
        low, high = (np.searchsorted(self.hashes, own[0], side) for side in ("left", "right"))
        found = high - low
        places = np.arange(int(found.sum())) + np.repeat(low - (np.cumsum(found) - found), found)
        shared = np.minimum(np.repeat(own[1], found), self.weights[places])
        smaller = np.bincount(self.owner[places], weights=shared, minlength=self.n)
        return smaller / np.maximum(self.totals + own[1].sum(dtype=np.float64) - smaller, 1e-30)


class Sampler:
    """Improved consistent weighted sampling.

    Per sample k and shingle s, three numbers are drawn from s by a
    multiplicative hash: r and c from Gamma(2, 1) (tables of 2^16 seeded draws) and
    b, uniform.  With t = floor(ln w / r + b), the shingle with the smallest
    ln c - r (t - b + 1) is the sample, together with its t.
    """

    def __init__(self, samples: int):
        rng = np.random.default_rng(SEED)
        draw = -np.log(rng.random((2, 1 << 16)) * rng.random((2, 1 << 16)))
        self.r, self.ln_c = draw[0].astype(np.float32), np.log(draw[1]).astype(np.float32)
        self.inverse = (1 / draw[0]).astype(np.float32)
        self.turns = (rng.integers(1, 1 << 62, samples, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def samples(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        best = np.full(len(self.turns), np.inf, np.float32)
        out = np.zeros(len(self.turns), np.uint64)
        log_w = np.log(weights)
        rows = np.arange(len(self.turns))
        for begin in range(0, len(hashes), 2048):  # long texts in parts
            h = hashes[begin:begin + 2048]
            u = h[None, :] * self.turns[:, None]
            at = (u >> np.uint64(48)).astype(np.int32)
            r = self.r[at]
            b = ((u >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.float32) / np.float32(65536)
            t = np.floor(log_w[None, begin:begin + 2048] * self.inverse[at] + b)
            a = self.ln_c[((u >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int32)] - r * (t - b + 1)
            low = a.argmin(axis=1)
            value = a[rows, low]
            name = mix64(h[low] ^ (t[rows, low].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            better = value < best
            best[better], out[better] = value[better], name[better]
        return out


def band_buckets(samples: np.ndarray) -> np.ndarray:
    """One bucket per band; the band's number is part of it."""
    acc = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for column in samples.reshape(BANDS, ROWS).T:
        acc = mix64(acc ^ column)
    return acc.view(np.int64)


def agreeing(a: Column, b: Column) -> Column:
    """How many of two signatures' samples are the same."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def digest(text: Column) -> Column:
    """The name of a text: 16 bytes of MD5."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def sketches(df: DataFrame, id_col: str, text_col: str, idf: np.ndarray) -> DataFrame:
    """``id``, ``key`` (text digest), ``buckets`` and ``signature`` (a byte of each sample) of each row."""
    shared = df.sparkSession.sparkContext.broadcast(idf)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), digest(F.col(text_col)).alias("key"))

    def make():
        table, sampler = shared.value, Sampler(BANDS * ROWS)

        def sketch(texts):
            buckets, signatures = [], []
            for text in texts:
                hashes, weights = weighted_set(text, table)
                samples = sampler.samples(hashes, weights) if len(hashes) else np.zeros(0, np.uint64)
                buckets.append(band_buckets(samples).tolist() if len(hashes) else [])
                signatures.append((samples & np.uint64(255)).astype(np.uint8).view(np.int8).tolist())
            return [pa.array(buckets, pa.list_(pa.int64())), pa.array(signatures, pa.list_(pa.int8()))]

        return sketch

    return map_texts(rows, "text", ["id", "key"], [T.StructField("buckets", T.ArrayType(T.LongType())),
                                                   T.StructField("signature", T.ArrayType(T.ByteType()))], make)


def verify(pairs: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """The links among ``pairs(a, b)``: both texts are joined, b's last, so that rows of one b follow each other."""
    shared = pairs.sparkSession.sparkContext.broadcast(idf)
    with_a = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, last, last_set = shared.value, None, None
        for batch in batches:
            a, b = batch.column("a"), batch.column("b").to_pylist()
            good = []
            for name, text_a, text_b in zip(b, batch.column("text_a"), batch.column("text_b"), strict=True):
                if name != last:
                    last, last_set = name, weighted_set(text_b.as_py(), table)
                good.append(weighted_jaccard(weighted_set(text_a.as_py(), table), last_set) >= SIMILARITY)
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def verify_blocks(left: DataFrame, right: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """Links between the members of two sides of a block (``bucket, i, j``) that are in different components."""
    shared = left.sparkSession.sparkContext.broadcast(idf)
    names = ["bucket", "i", "j"]
    left, right = left.join(texts, "key"), right.join(texts, "key")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # both sides come from one table

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        table, found = shared.value, []
        joined: dict[bytes, bytes] = {}  # components linked within this block

        def top(x: bytes) -> bytes:
            while joined.get(x, x) != x:
                x = joined[x]
            return x

        if a.num_rows and b.num_rows:
            block = BlockIndex([weighted_set(t, table) for t in b["text"].to_pylist()])
            roots, keys = b["root"].to_pylist(), b["key"].to_pylist()
            for key, root, text in zip(a["key"].to_pylist(), a["root"].to_pylist(), a["text"].to_pylist(), strict=True):
                for i in np.flatnonzero(block.jaccard(weighted_set(text, table)) >= SIMILARITY).tolist():
                    if top(root) != top(roots[i]):
                        joined[top(root)] = top(roots[i])
                        found.append((key, keys[i]))
        return pa.table({"a": pa.array([x for x, _ in found], pa.binary()),
                         "b": pa.array([x for _, x in found], pa.binary())})

    return left.groupBy(*names).cogroup(right.groupBy(*names)).applyInArrow(compare, "a binary, b binary")


def _blocks(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (``bucket, key, root``, more) of buckets with several components, dealt to blocks ``bucket, i, j``.

    Left: those outside the bucket's largest component; right: all.  Every
    pair of a left and a right member meets in one block of bounded size.
    """
    parts = members.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    mixed = (parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("n").alias("n"),
                                         F.max(F.struct("n", "root")).alias("main")).filter("parts > 1")
             .select("bucket", F.col("main.root").alias("main"),
                     F.ceil((F.col("n") - F.col("main.n")) / LEFT_BLOCK).cast("int").alias("lefts"),
                     F.ceil(F.col("n") / RIGHT_BLOCK).cast("int").alias("rights")))
    open_, spot = members.join(mixed, "bucket"), F.xxhash64("key")
    kept = [c for c in members.columns if c != "bucket"]
    left = open_.filter("root <> main").select(
        "bucket", F.pmod(spot, F.col("lefts")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("j"), *kept)
    right = open_.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("i"),
        F.pmod(spot, F.col("rights")).cast("int").alias("j"), *kept)
    return left, right


def _with_partners(left: DataFrame, right: DataFrame) -> DataFrame:
    """``bucket, key`` of the members that agree enough with one of another component in their block."""
    names = ["bucket", "i", "j"]
    right = right.select(*[F.col(c).alias(c) for c in right.columns])

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        if not (a.num_rows and b.num_rows):
            return pa.table({"bucket": pa.array([], pa.int64()), "key": pa.array([], pa.binary())})
        x, y = (np.array(t["signature"].combine_chunks().flatten()).reshape(t.num_rows, -1) for t in (a, b))
        agree = np.zeros((len(x), len(y)), np.uint8)
        for k in range(x.shape[1]):
            agree += x[:, k, None] == y[None, :, k]
        names_of = {r: i for i, r in enumerate({*a["root"].to_pylist(), *b["root"].to_pylist()})}
        of_a, of_b = (np.array([names_of[r] for r in t["root"].to_pylist()]) for t in (a, b))
        good = (agree >= LEAST_AGREEING) & (of_a[:, None] != of_b[None, :])
        keys = (a["key"].filter(pa.array(good.any(axis=1))).to_pylist()
                + b["key"].filter(pa.array(good.any(axis=0))).to_pylist())
        return pa.table({"bucket": pa.array([a["bucket"][0].as_py()] * len(keys), pa.int64()),
                         "key": pa.array(keys, pa.binary())})

    return left.groupBy(*names).cogroup(right.groupBy(*names)).applyInArrow(compare, "bucket long, key binary")


def _labelled(nodes: DataFrame, roots: DataFrame, key: str = "key") -> DataFrame:
    """``nodes`` with the component (``root``) of each key; a node without links is its own."""
    return nodes.join(roots.select(F.col("v").alias(key), "root"), key, "left").withColumn(
        "root", F.coalesce("root", key))


def near_duplicate_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``key`` (text digest), ``root`` (the class's smallest digest), ``class_id`` (its
    smallest id), ``class_size`` (its rows)."""
    spark = prepare(df.sparkSession)
    folder = scratch_dir(spark, "near-dup")

    def cut(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    counts, docs = document_frequencies(df, text_col)
    idf = idf_table(counts, docs)
    rows = cut(sketches(df, id_col, text_col, idf), "sketches")

    # one node per distinct text; its places in buckets that hold another node
    nodes = rows.groupBy("key").agg(F.any_value(F.struct("buckets", "signature")).alias("n"))
    nodes = cut(nodes.select("key", "n.buckets", "n.signature"), "nodes")
    places = cut(nodes.select("key", F.explode("buckets").alias("bucket")), "places")
    buckets = places.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    places = cut(places.join(buckets, "bucket"), "shared")
    # a bucket's leader is its node with the most company over all buckets: in a group of copies, the one they came from
    company = places.groupBy("key").agg(F.sum("n").alias("company"))
    leaders = places.join(company, "key").groupBy("bucket").agg(F.max(F.struct("company", "key")).alias("top")).select(
        "bucket", F.col("top.key").alias("leader"))
    places = cut(places.join(leaders, "bucket"), "led")
    signatures = cut(nodes.select("key", "signature").join(places.select("key").distinct(), "key", "left_semi"), "signed")

    def signed(name: str) -> DataFrame:
        return signatures.select(F.col("key").alias(name), F.col("signature").alias(f"signature_{name}"))

    pairs = places.filter("key <> leader").groupBy(F.col("key").alias("a"), F.col("leader").alias("b")).agg(
        F.count("*").alias("shared"))
    pairs = cut(pairs.join(signed("a"), "a").join(signed("b"), "b")
                .filter(agreeing(F.col("signature_a"), F.col("signature_b")) >= LEAST_AGREEING)
                .select("a", "b", "shared"), "pairs")
    # the texts of candidates, once per digest (equal texts fall together before the shuffle)
    texts = cut(df.select(digest(F.col(text_col)).alias("key"), F.coalesce(text_col, F.lit("")).alias("text"))
                .groupBy("key").agg(F.any_value("text").alias("text")).join(signatures.select("key"), "key", "left_semi"),
                "texts")

    # one leader per node: the one it shares most buckets with
    best = pairs.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("top")).select("a", "top.b")
    links = cut(verify(best, texts, idf), "links-1")
    roots = connected(links)
    # the other leaders of nodes that are in another component than the leader
    others = pairs.join(best, ["a", "b"], "left_anti").select("a", "b")
    apart = _labelled(_labelled(others, roots, "a").withColumnRenamed("root", "root_a"), roots, "b").filter(
        "root_a <> root").select("a", "b")
    links = links.union(cut(verify(apart, texts, idf), "links-2"))
    roots = connected(links)

    # buckets whose members beside the leader (compared with all) are in several components:
    # first the signatures tell which members have a partner to be verified with, then the texts decide
    members = _labelled(places.filter("key <> leader").select("bucket", "key"), roots)
    left, right = _blocks(cut(members.join(signatures, "key"), "members"))
    partners = cut(_with_partners(left, right), "partners")
    if not partners.isEmpty():
        left, right = _blocks(_labelled(partners.distinct(), roots))
        links = links.union(cut(verify_blocks(left, right, texts, idf), "links-3"))
        roots = connected(links)

    # classes are named by text first: one row per text, with the number of its rows
    texts = rows.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    named = cut(_labelled(texts, roots), "named")
    classes = cut(named.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"),
                                            F.count("*").alias("texts")).filter("class_size > 1"), "classes")
    # neither a class of many texts nor a text of many rows is gathered for its name
    own = cut(join_by_group(named, classes, "root", "texts", named.count()).filter("class_size > 1")
              .select("key", "copies", "root", "class_id", "class_size"), "class-of-text")
    classed = join_by_group(rows.select("id", "key"), own, "key", "copies", docs)
    alone = F.col("class_size").isNull()
    return classed.select(F.col("id").alias(id_col), "key", F.coalesce("root", "key").alias("root"),
                          F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                          F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))
