"""Operator 10: token counts by a map-side two-tier lookup.

First tier: a broadcast hash table with the token counts of the most frequent
pieces of the corpus.  Second tier: a worker's cache, filled by the tokenizer.
No piece is shuffled; only the bounded list of each task's frequent pieces is.

Null and empty texts count 0 tokens.  Texts with other white space than
single spaces and line feeds, or with the tokenizer's own space mark, are
counted whole.  Repeated rows give repeated results; columns other than the
id and the text are not read.
"""

from __future__ import annotations

import functools
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.llm.common import map_texts, prepare, text_batches
from crawlweave.llm.pieces import HEAD, PieceCache, keys_of
from crawlweave.session import scratch_dir

#: Entries of the broadcast table: about 1 MB, whatever the corpus.
FREQUENT = 16_384
#: Levels per power of two, by which counts are told apart when the list is cut.
LEVELS = 16
#: Counters a task holds while it looks for its frequent pieces.
TASK_COUNTERS = 8 * FREQUENT
#: The tokenizer's mark for a space.
SPACE_MARK = "▁"


@functools.lru_cache(2)
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def count_keys(path: str, keys: list[str]) -> list[int]:
    """Tokens of each piece.  The tokenizer puts a space before its input; a
    piece after a line feed has none, so that one token is taken off."""
    encode = processor(path).encode
    spaced = [k[1:] if k[0] == HEAD else k for k in keys]
    return [len(ids) - (k[0] == "\n") for k, ids in zip(keys, encode(spaced, num_threads=1), strict=True)]


def frequent_pieces(df: DataFrame, text_col: str = "text", entries: int = FREQUENT,
                    task_counters: int = TASK_COUNTERS) -> list[str]:
    """The most frequent pieces of all texts, at most ``entries``.

    Each task counts its pieces in a bounded table (when it is full, the
    median count is taken off all and what falls to zero goes) and hands on
    its ``entries`` largest; the merged sums give the corpus's list.  It only
    decides what is broadcast, never a count that is returned.
    """
    pieces = PieceCache(lambda keys: keys, alone=[SPACE_MARK])
    schema = T.StructType([T.StructField("piece", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for _, texts in text_batches(batch, text_col):
                for t in texts:
                    seen.update(keys_of(t))
                if len(seen) > task_counters:
                    off = sorted(seen.values())[len(seen) // 2]
                    seen = Counter({k: v - off for k, v in seen.items() if v > off})
        top = seen.most_common(entries)
        if top:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()),
                                              pa.array([v for _, v in top], pa.int64())], names=["piece", "n"])

    folder = scratch_dir(df.sparkSession, "frequent-pieces")
    (df.select(text_col).mapInArrow(run, schema).groupBy("piece").agg(F.sum("n").alias("n"))
     .withColumn("level", F.floor(F.log2("n") * LEVELS).cast("int")).write.parquet(folder))
    counted = df.sparkSession.read.parquet(folder)
    # the lowest level above which there are no more than ``entries``: only those come to the driver
    level, above = None, 0
    for r in sorted(counted.groupBy("level").count().collect(), key=lambda r: -r.level):
        if above + r["count"] > entries:
            break
        level, above = r.level, above + r["count"]
    if level is None:
        return []
    top = counted.filter(F.col("level") >= level).select("piece").collect()
    return sorted(r.piece for r in top if pieces.is_piece(r.piece))


#: A worker process keeps the cache of the latest count.
_CACHES: dict[str, PieceCache] = {}


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit`` of each whole text."""
    spark = prepare(df.sparkSession)
    frequent = frequent_pieces(df, text_col)
    table = spark.sparkContext.broadcast(dict(zip(frequent, count_keys(path, frequent), strict=True)))
    key = uuid.uuid4().hex

    def make():
        cache = _CACHES.get(key)
        if cache is None:
            _CACHES.clear()
            cache = _CACHES[key] = PieceCache(lambda keys: count_keys(path, keys), alone=[SPACE_MARK],
                                                       fixed=table.value)

        def count(texts):
            keys = cache.learn(texts)
            known = cache.known.__getitem__
            n = [len(processor(path).encode(t, num_threads=1)) if k is None else sum(map(known, k))
                 for t, k in zip(texts, keys, strict=True)]
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            return [pa.array(sizes, pa.int64()), pa.array(n, pa.int64()),
                    pa.array([x > limit for x in n], pa.bool_())]

        return count

    return map_texts(df, text_col, [id_col], [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ], make)
