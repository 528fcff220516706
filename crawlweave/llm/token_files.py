"""Operator 4: token ids of all documents in binary files, in ascending id order.

File format ``.s8b`` (little-endian): the words of Simple-8b blocks of
``simple8b.BLOCK`` ids each (the last one shorter), one after the other; then
the footer: per block its first word (int64), per document its id (int64, the
smallest value for null) and its number of ids (int64); then 5 int64 values:
blocks, documents, ids, words, ``MAGIC``.  A reader decodes any block by its
offset, or all of them at once.

Documents are range-partitioned and sorted by id (null first, ties by text
hash), tokenized behind the shuffle, and streamed into files that hold whole
documents.  Files go under the shared scratch folder, first under an
attempt's own name, so that a lost or repeated task leaves no half file; the
manifest, written by Spark, lists the files of the attempts that counted.

Null and empty texts are one end id.  Repeated rows are written as often as
they come (rows equal in id and text stay in one range, so in one task).  Columns other than the id and the
text are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlweave.llm import simple8b
from crawlweave.llm.common import crc32_ids, prepare, text_batches
from crawlweave.llm.hf_ids import id_encoder
from crawlweave.session import ensure_local_dir, filesystem_for, scratch_dir

MAGIC = 0x3842_5353
#: Ids after which a file is closed: some 35 MB.
FILE_IDS = 16 << 20
NULL_ID = -(1 << 63)
_MANIFEST = "part int, seq int, path string, first_doc long, docs long, ids long"


class _Writer:
    """One open file: blocks are coded as soon as they are full."""

    def __init__(self):
        self.words: list[np.ndarray] = []
        self.rest: list[np.ndarray] = []
        self.held = self.ids = 0
        self.docs: list[int] = []
        self.sizes: list[int] = []

    def add(self, doc: int, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.sizes.append(len(ids))
        self.ids += len(ids)
        self.rest.append(ids)
        self.held += len(ids)
        if self.held >= 16 * simple8b.BLOCK:
            self._code(False)

    def _code(self, all_of_it: bool) -> None:
        values = np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32)
        end = len(values) if all_of_it else len(values) // simple8b.BLOCK * simple8b.BLOCK
        for i in range(0, end, simple8b.BLOCK):
            self.words.append(simple8b.encode_block(values[i:min(end, i + simple8b.BLOCK)]))
        self.rest = [values[end:]]
        self.held = len(values) - end

    def close(self, folder: str, name: str) -> str:
        self._code(True)
        sizes = np.array([len(w) for w in self.words], np.int64)
        path = f"{folder}/{name}"
        fs, inner = filesystem_for(path)
        with fs.open_output_stream(inner) as out:
            for w in self.words:
                out.write(w.astype("<u8").tobytes())
            out.write((np.cumsum(sizes) - sizes).astype("<i8").tobytes())
            out.write(np.array(self.docs, "<i8").tobytes())
            out.write(np.array(self.sizes, "<i8").tobytes())
            out.write(np.array([len(sizes), len(self.docs), self.ids, int(sizes.sum()), MAGIC], "<i8").tobytes())
        return path


def read_file(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, ids of each, all ids) of one file."""
    fs, inner = filesystem_for(path)
    with fs.open_input_file(inner) as f:
        raw = f.read()
    blocks, docs, ids, words, magic = np.frombuffer(raw, "<i8", 5, len(raw) - 40).tolist()
    if magic != MAGIC:
        raise ValueError(f"{path} is not a token file")
    at = words * 8
    offsets = np.frombuffer(raw, "<i8", blocks, at)
    doc_ids = np.frombuffer(raw, "<i8", docs, at + blocks * 8)
    sizes = np.frombuffer(raw, "<i8", docs, at + (blocks + docs) * 8)
    coded = np.frombuffer(raw, "<u8", words, 0)
    out = np.empty(ids, np.uint32)
    done = 0
    for first in range(0, blocks, 64):  # 64 blocks at a time bound the scratch arrays
        end = offsets[first + 64] if first + 64 < blocks else words
        part = simple8b.decode_blocks(coded[offsets[first]:end])
        out[done:done + len(part)] = part
        done += len(part)
    return doc_ids, sizes, out


def write_token_files(df: DataFrame, tokenizer: str, folder: str, end_id: int = 0, id_col: str = "doc_id",
                      text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Write ``folder/*.s8b`` and ``folder/manifest``; return the manifest with each file's ``start``."""
    spark = prepare(df.sparkSession)
    ensure_local_dir(folder)

    def run(batches):
        encoder = id_encoder(tokenizer)
        context = TaskContext.get()
        part, attempt, seq = context.partitionId(), context.taskAttemptId(), 0
        end = np.array([end_id], np.uint32)
        writer = _Writer()

        def manifest():
            name = f"part-{part:06d}-{seq:05d}-{attempt}-{uuid.uuid4().hex[:8]}.s8b"
            return pa.RecordBatch.from_pylist([{
                "part": part, "seq": seq, "path": writer.close(folder, name),
                "first_doc": None if writer.docs[0] == NULL_ID else writer.docs[0],
                "docs": len(writer.docs), "ids": writer.ids}], schema=schema)

        schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()),
                            ("first_doc", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64())])
        for batch in batches:
            for rows, texts in text_batches(batch, "text"):
                for doc, ids in zip(rows.column("id").to_pylist(), encoder.encode(texts), strict=True):
                    writer.add(NULL_ID if doc is None else doc, np.concatenate([np.frombuffer(ids, "<u4"), end]))
                    if writer.ids >= file_ids:
                        yield manifest()
                        writer, seq = _Writer(), seq + 1
        if writer.docs:
            yield manifest()

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("id").asc_nulls_first(), tie).sortWithinPartitions(
        F.col("id").asc_nulls_first(), tie)
    ordered.mapInArrow(run, _MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file, in order, with ``start``: ids in the files before it (a running sum over files, not rows)."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").withColumn(
        "start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def scan_token_files(manifest: DataFrame) -> DataFrame:
    """Decode the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of each document."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                docs, sizes, ids = read_file(row["path"])
                first = np.cumsum(sizes) - sizes
                crc = [crc32_ids(ids[a:a + n]) for a, n in zip(first.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64(), mask=docs == NULL_ID), pa.array(first + row["start"], pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())], schema=schema)

    # a stated number of partitions, one per file: the rows are tiny, the files are not
    files = max(1, manifest.count())
    return manifest.select("path", "start").repartitionByRange(files, "start").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files_round_trip(df: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """Write all documents to files under the shared scratch folder and read them back."""
    folder = scratch_dir(df.sparkSession, "token-files")
    return scan_token_files(write_token_files(df, tokenizer, folder, end_id, id_col, text_col))
