"""The corpus pipeline: language, quality, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's documents.  Every stage but the
last returns the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers as vocab
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.llm import language, near_dup, packing, quality_model
from crawlweave.llm.common import table
from crawlweave.session import scratch_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def in_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (3): documents whose fused evidence names a known language stay.

    The rejected ones are few; they are taken out by id and text digest.
    """
    judged = language.identify(docs, keys=[near_dup.digest(F.col("text"))])
    gone = judged.filter("NOT kept").select(F.col("doc_id").alias("__id"), F.col("__key0").alias("__key")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["__id"])
                     & (near_dup.digest(docs["text"]) == gone["__key"]), "left_anti").select(*COLUMNS)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (2), fitted on the labelled ones among these documents: the best grade stays."""
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.rate(docs, model, COLUMNS).filter("kept").select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup (1): of each class the row with the smallest (id, text digest) stays.

    Rows that repeat that id and text are one row.
    """
    classes = near_dup.near_duplicate_classes(docs)
    folder = scratch_dir(spark, "dedup-choice")
    # copies of one row share id and digest: they are counted before the choice
    counted = classes.groupBy("root", "doc_id", "key").agg(F.count("*").alias("n"))
    (counted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key", "n"))
                                 .alias("first"))
     .select(F.col("first.doc_id").alias("__id"), F.col("first.key").alias("__key"), F.col("first.n").alias("__n"))
     .write.parquet(folder))
    chosen = spark.read.parquet(folder)
    kept = docs.select(*COLUMNS).join(chosen, docs["doc_id"].eqNullSafe(chosen["__id"])
                                      & (near_dup.digest(docs["text"]) == chosen["__key"]))
    if chosen.filter("__n > 1").isEmpty():
        return kept.select(*COLUMNS)
    once = kept.filter("__n > 1").dropDuplicates(["__id", "__key"])
    return kept.filter("__n = 1").select(*COLUMNS).union(once.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (5): every kept document's pieces and their places."""
    out = packing.pack(docs, vocab.path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset", "sequence_tokens", "padded_tokens")


STAGES = [("language", in_known_languages), ("quality", good_documents),
          ("near_duplicates", without_near_duplicates), ("packing", packed)]

#: Two stages decide by trained models: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
