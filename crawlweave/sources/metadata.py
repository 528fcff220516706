"""Metadata shard sources (S1, S2): zstd JSONL with WARC headers per line.

``read_metadata_lines`` reads shards with Spark's text source (the codec is
picked by the ``.zst`` extension).  Its zstd decoder refuses frames whose
window exceeds 2^27 bytes; ``reader="stream"`` instead hands each shard path
to a ``mapInPandas`` task that streams it through ``zstandard`` with a window
limit of 2^31 -- still one task per shard and bounded memory per task.
"""

from __future__ import annotations

import io
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.functions import scalars as S
from crawlweave.session import file_path_of, filesystem_for

SHARD_GLOB = "*.jsonl.zst"
SHARD_MARK = "tt_meta"
ZSTD_MAX_WINDOW = 2 ** 31
STREAM_BATCH_ROWS = 4096

HEADERS = T.StructType([
    T.StructField("warc-target-uri", T.StringType()),
    T.StructField("warc-date", T.StringType()),
    T.StructField("warc-record-id", T.StringType()),
    T.StructField("warc-block-digest", T.StringType()),
    T.StructField("warc-payload-digest", T.StringType()),
])
RECORD_SCHEMA = T.StructType([T.StructField("warc_headers", HEADERS)])

LINE_SCHEMA = "hf_path string, line_ord long, value string"


def relative_to(path: F.Column, root: str) -> F.Column:
    """Path below ``root`` (the shard id the state keeps, like a dataset-relative path)."""
    from crawlweave.session import path_below

    return path_below(path, root)


def _files(spark: SparkSession, root: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", SHARD_GLOB)
        .load(root)
        .select("path")
    )


def list_shards(spark: SparkSession, root: str) -> DataFrame:
    """Shard paths under ``root`` whose path contains ``tt_meta`` and ends in ``.jsonl.zst``."""
    files = _files(spark, root).select(F.col("path").alias("file_path"), relative_to(F.col("path"), root).alias("hf_path"))
    return files.where(F.col("hf_path").contains(SHARD_MARK))


def read_metadata_lines(spark: SparkSession, root: str, reader: str = "native",
                        shards: DataFrame | None = None) -> DataFrame:
    """Every line of every shard (or of the listed ones): ``hf_path, line_ord, value`` (line order kept)."""
    if reader == "stream":
        return stream_lines(list_shards(spark, root) if shards is None else shards)
    # one task reads a whole shard (zstd is not splittable): the id grows with the line
    return _shard_text(spark, root, shards).select("hf_path", F.monotonically_increasing_id().alias("line_ord"), "value")


def _shard_text(spark: SparkSession, root: str, shards: DataFrame | None = None) -> DataFrame:
    """``value, hf_path`` of the shards; with a list, only its files are opened (one path per file comes to the driver)."""
    reader = spark.read.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", SHARD_GLOB)
    if shards is None:
        files = reader.load(root)
    else:
        paths = [re.sub(r"([\\{}\[\]*?])", r"\\\1", r.file_path) for r in shards.select("file_path").collect()]
        if not paths:
            return spark.createDataFrame([], "value string, hf_path string")
        files = reader.load(paths)
    return (
        files.select("value", relative_to(file_path_of(F.col("_metadata.file_path")), root).alias("hf_path"))
        .where(F.col("hf_path").contains(SHARD_MARK))
    )


def _open_input(path: str):
    filesystem, inner = filesystem_for(path)
    return filesystem.open_input_stream(inner, compression=None)


def _stream_shards(batches):
    import zstandard

    for pdf in batches:
        for path, rel in zip(pdf["file_path"], pdf["hf_path"]):
            rows, n = [], 0
            with _open_input(path) as raw:
                dctx = zstandard.ZstdDecompressor(max_window_size=ZSTD_MAX_WINDOW)
                with dctx.stream_reader(raw) as reader:
                    text = io.TextIOWrapper(reader, encoding="utf-8", errors="replace", newline="\n")
                    for line in text:
                        rows.append(line.rstrip("\n"))
                        n += 1
                        if len(rows) >= STREAM_BATCH_ROWS:
                            yield pd.DataFrame({"hf_path": rel, "line_ord": range(n - len(rows), n), "value": rows})
                            rows = []
            if rows:
                yield pd.DataFrame({"hf_path": rel, "line_ord": range(n - len(rows), n), "value": rows})


def stream_lines(shards: DataFrame) -> DataFrame:
    """Lines of the shards listed in ``file_path`` (ids in ``hf_path``), one shard per task.

    The number of tasks is stated (a listing counts the shards when this is
    called): rows this small would otherwise be merged into one task.
    """
    n = max(1, shards.count())
    return shards.repartitionByRange(n, "hf_path").mapInPandas(_stream_shards, LINE_SCHEMA)


def records_from(lines: DataFrame, line_ord: F.Column | None = None, every_line: bool = False) -> DataFrame:
    """S1 + P1/P2/P9/P10: one row per usable record of ``hf_path, value`` lines.

    Lines are stripped; blank lines, lines that are not a JSON object and
    records without a target URI are dropped.  ``url_norm`` is the raw URL
    (the reference re-serialises without canonicalising; see
    ``scalars.canonicalize_url`` for an opt-in canonical form).

    Pass ``line_ord=F.monotonically_increasing_id()`` to number lines in the
    projection that parses them (valid for unsplittable shards).  With
    ``every_line`` lines without a usable record stay, their URL NULL.

    The JSON is strict: the line is read as the only element of an array, so
    that text behind the object makes it malformed.
    """
    ord_col = F.col("line_ord") if line_ord is None else line_ord
    rec = lines.select(
        "hf_path",
        ord_col.alias("line_ord"),
        S.strict_json(F.trim(F.col("value")), RECORD_SCHEMA).alias("r"),
    )
    h = F.col("r.warc_headers")
    url = S.blank_to_null(h["warc-target-uri"])
    row = F.struct(
        F.col("hf_path").alias("hf_path"),
        F.col("line_ord").alias("line_ord"),
        S.snapshot_name_from_path(F.col("hf_path")).alias("snapshot_name"),
        url.alias("url_raw"),
        url.alias("url_norm"),
        S.parse_warc_date(h["warc-date"]).alias("warc_date"),
        h["warc-record-id"].alias("warc_record_id"),
        S.first_digest(h["warc-block-digest"], h["warc-payload-digest"]).alias("digest"),
    )
    # records come out of ``inline`` (0 or 1 per line) instead of a filter, so
    # Catalyst cannot push a condition below the parse: one parse per line
    if every_line:
        return rec.select(F.inline(F.array(row)))
    return rec.select(F.inline(F.filter(F.array(F.when(url.isNotNull(), row)), lambda x: x.isNotNull())))


def parse_records(lines: DataFrame) -> DataFrame:
    """Records of numbered lines (``hf_path, line_ord, value``)."""
    return records_from(lines)


def read_records(spark: SparkSession, root: str, reader: str = "native", shards: DataFrame | None = None,
                 every_line: bool = False) -> DataFrame:
    """Usable records of every shard under ``root`` (or of the listed ones), with line order."""
    if reader == "stream":
        return records_from(read_metadata_lines(spark, root, "stream", shards), every_line=every_line)
    return records_from(_shard_text(spark, root, shards), F.monotonically_increasing_id(), every_line)
