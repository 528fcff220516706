"""Shared helpers: session settings, bounded Arrow text batches, word hashing."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from crawlweave.session import ship_package

#: Text handed to a batch function at once; a single longer text goes alone.
BATCH_BYTES = 8 << 20
#: Rows per Arrow batch: texts can be long, so fewer than Spark's default.
BATCH_ROWS = 1000

#: The ASCII white space that separates words.
SPACES = " \t\n\x0b\x0c\r"

_MIX = np.uint64(0x9E3779B97F4A7C15)
_POW = np.uint64(0x100000001B3)


def prepare(spark: SparkSession) -> SparkSession:
    """Make the package importable in workers and bound Arrow batches by rows and bytes."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{4 * BATCH_BYTES}b")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of at most BATCH_BYTES of text (or one row) with their texts, null as empty."""
    values = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(values), 0)
    begin, held = 0, 0
    for i, size in enumerate(sizes.to_pylist()):
        if held and held + size > BATCH_BYTES:
            part = batch.slice(begin, i - begin)
            yield part, [x or "" for x in part.column(column).to_pylist()]
            begin, held = i, 0
        held += size
    if begin < len(values):
        part = batch.slice(begin)
        yield part, [x or "" for x in part.column(column).to_pylist()]


def text_parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The slices of ``text_batches``, with the texts left in Arrow."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    begin = 0
    while begin < len(sizes):
        held = np.cumsum(sizes[begin:])
        end = begin + max(1, int(np.searchsorted(held, BATCH_BYTES, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def map_texts(df: DataFrame, text_col: str, keep: list[str], out: list[T.StructField],
              make: Callable[[], Callable[[list[str]], list]]) -> DataFrame:
    """``keep`` columns of ``df`` plus columns computed from the text, row for row.

    ``make()`` runs once per task and returns ``f(texts) -> [one array or list
    per out column]``.  Only ``keep`` and the text reach Python.
    """
    wanted = [text_col, *[c for c in keep if c != text_col]]
    source = df.select(*[df[c] for c in wanted])
    schema = T.StructType([source.schema[c] for c in keep] + out)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for part, texts in text_batches(batch, text_col):
                made = [x if isinstance(x, pa.Array) else pa.array(x, arrow.field(len(keep) + i).type)
                        for i, x in enumerate(f(texts))]
                kept = [part.column(c).cast(arrow.field(i).type) for i, c in enumerate(keep)]
                yield pa.RecordBatch.from_arrays([*kept, *made], schema=arrow)

    return source.mapInArrow(run, schema)


def crc32_ids(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply) over an unsigned array."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end positions of the words of a byte array (split at ASCII white space)."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_IS_SPACE[raw]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 4096), _POW, np.uint64)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS[:n]


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per word of the whole text, in order, without a Python loop."""
    return byte_word_hashes(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))


def byte_word_hashes(raw: np.ndarray) -> np.ndarray:
    """A polynomial over each word's bytes (position counted from the word's start)
    and its length, finalised by ``mix64``."""
    if not len(raw):
        return np.zeros(0, np.uint64)
    start, end = word_spans(raw)
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    # letters of all words, one after the other, with their place in the word
    inside = ~_IS_SPACE[raw]
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    terms = raw[inside].astype(np.uint64)
    terms += np.uint64(1)
    terms *= _powers(int(size.max()))[place]
    return mix64(np.add.reduceat(terms, first) + size.astype(np.uint64) * _MIX)


_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[128:] = np.arange(128, 256)


def letter_bytes(text: str) -> np.ndarray:
    """The text in lower case as bytes, with a space for every ASCII character that is no letter."""
    return _LETTERS[np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)]


def shingle_hashes(words: np.ndarray, k: int = 5) -> np.ndarray:
    """One hash per run of ``k`` words; a shorter text is one shingle of all its words, an empty one none."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    width = min(k, n)
    acc = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        acc = (acc * _MIX) + words[i:n - width + 1 + i]
        acc ^= acc >> np.uint64(29)
    return mix64(acc)


#: A group with more than 1 / HEAVY_GROUPS of the rows is joined by broadcast; there are fewer than so many.
HEAVY_GROUPS = 4096


def join_by_group(rows: DataFrame, groups: DataFrame, key: str, count: str, total: int,
                  heavy: int = HEAVY_GROUPS) -> DataFrame:
    """``rows`` left-joined to ``groups`` (one row per ``key``, none null) without gathering a large group.

    ``count`` is the group's number of rows in ``rows`` and ``total`` the number
    of all rows.  Groups above ``total / heavy`` rows are fewer than ``heavy``,
    whatever the table, and are broadcast; the rows of the others are shuffled.
    """
    large = F.broadcast(groups.filter(F.col(count) * heavy > total))
    small = groups.filter(F.col(count) * heavy <= total)
    return (rows.join(large, key)
            .unionByName(rows.join(large.select(key), key, "left_anti").join(small, key, "left")))
