"""Capture-index sources: CDXJ shard scan (S4) and the shard manifest.

A CDXJ line is ``<urlkey> <timestamp> <json>``.  Shards are gzip text and not
splittable, so Spark reads each shard in one task; the scan order the
nearest-match tie-break needs is ``(file_path, file_block_start, line_ord)``,
where ``line_ord`` comes from ``monotonically_increasing_id`` (it increases
along the lines of one file split, and is stable on task retry).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.functions import scalars as S
from crawlweave.session import file_path_of

# JSON keys of a capture-index record that the engine reads.  Every value is
# read as text; numbers in the JSON come back as their literal text.
CDXJ_SCHEMA = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("url", "original", "filename", "offset", "length",
                 "mimetype", "mime", "timestamp", "status", "digest")
])

def snapshot_below(path: F.Column, root: str) -> F.Column:
    """Name of the folder right below ``root`` in ``path`` (a ``snapshot=`` prefix is dropped)."""
    from crawlweave.session import path_below

    return F.regexp_extract(path_below(path, root), r"^(?:snapshot=)?([^/]+)/", 1)


def snapshot_folders(root: str, snapshots: list[str]) -> dict[str, str]:
    """Existing index folders of the given snapshots (``<root>/<s>`` or ``<root>/snapshot=<s>``)."""
    from pyarrow import fs as pafs

    from crawlweave.session import filesystem_for

    found = {}
    for s in snapshots:
        for path in (f"{root}/{s}", f"{root}/snapshot={s}"):
            filesystem, inner = filesystem_for(path)
            if filesystem.get_file_info(inner).type == pafs.FileType.Directory:
                found[s] = path
                break
    return found


def _index_text(spark: SparkSession, root: str, snapshots: list[str] | None, path_glob: str) -> DataFrame:
    paths = _index_paths(root, snapshots)
    if not paths:
        return spark.createDataFrame([], "value string, file_path string, block_start long")
    return (
        spark.read.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", path_glob)
        .load(paths)
        .select(
            "value",
            file_path_of(F.col("_metadata.file_path")).alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
        )
    )


def _scan_ord() -> F.Column:
    return F.struct("file_path", "block_start", F.monotonically_increasing_id().alias("line_ord"))


def _index_paths(root: str, snapshots: list[str] | None) -> list[str]:
    return [root] if snapshots is None else list(snapshot_folders(root, snapshots).values())


def index_file_ranks(spark: SparkSession, root: str, snapshots: list[str] | None = None,
                     path_glob: str = "*.gz") -> DataFrame:
    """``file_path, file_rank``: position of each index file in name order
    within its snapshot -- one row per file (a listing, no content read)."""
    paths = _index_paths(root, snapshots)
    if not paths:
        return spark.createDataFrame([], "file_path string, file_rank int")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", path_glob).load(paths).select(F.col("path").alias("file_path")))
    by_snapshot = Window.partitionBy(snapshot_below(F.col("file_path"), root)).orderBy("file_path")
    return files.select("file_path", F.row_number().over(by_snapshot).cast("int").alias("file_rank"))


def read_index_lines(spark: SparkSession, root: str, snapshots: list[str] | None = None,
                     path_glob: str = "*.gz") -> DataFrame:
    """Every line of every index shard under ``root/<snapshot>/...``.

    Only the listed snapshot folders are read when ``snapshots`` is given
    (partition pruning by path).  Returns ``snapshot_name, value, scan_ord``.
    """
    return _index_text(spark, root, snapshots, path_glob).select(
        snapshot_below(F.col("file_path"), root).alias("snapshot_name"),
        S.bytes_to_text(F.col("value").cast("binary")).alias("value"),
        _scan_ord().alias("scan_ord"),
    )


def parse_cdxj(value) -> F.Column:
    """JSON payload of a CDXJ line (text from the first ``{``); NULL if none or malformed."""
    v = F.col(value) if isinstance(value, str) else value
    pos = F.instr(v, "{")
    return F.when(pos > 0, S.strict_json(F.trim(F.substring(v, pos, 1 << 30)), CDXJ_SCHEMA))


def _captures(rec: DataFrame) -> DataFrame:
    """Valid captures of parsed records (``snapshot_name, scan_ord, r``).

    Each record yields a 0/1-element array that ``inline`` expands: there is
    no filter for Catalyst to push below the parse, so ``from_json`` runs
    once per line whatever columns the caller keeps.
    """
    r = F.col("r")
    url = S.capture_url(r["url"], r["original"])
    offset = S.to_long_strict(r["offset"])
    length = S.to_long_strict(r["length"])
    valid = (
        r.isNotNull() & url.isNotNull() & offset.isNotNull() & length.isNotNull()
        & S.is_html_capture(r["filename"], r["offset"], r["length"], r["mimetype"], r["mime"])
    )
    row = F.struct(
        F.col("snapshot_name").alias("snapshot_name"),
        url.alias("url"),
        r["filename"].alias("filename"),
        offset.alias("offset"),
        length.alias("length"),
        S.parse_cdx_timestamp(r["timestamp"]).alias("capture_ts"),
        F.col("scan_ord").alias("scan_ord"),
    )
    return rec.select(F.inline(F.filter(F.array(F.when(valid, row)), lambda x: x.isNotNull())))


def read_captures(spark: SparkSession, root: str, snapshots: list[str] | None = None,
                  path_glob: str = "*.gz") -> DataFrame:
    """The valid HTML captures of the index shards under ``root``.

    Each line is parsed once: the validity rules select records through
    ``inline`` (see ``_captures``) rather than a filter Catalyst could push
    below the parse and split into one ``from_json`` per field.
    """
    text = S.bytes_to_text(F.col("value").cast("binary"))
    lines = _index_text(spark, root, snapshots, path_glob).select(
        "value", "file_path", "block_start", F.monotonically_increasing_id().alias("line_ord"))
    # the scan order carries a small file rank instead of the file path: every
    # capture is shuffled by the semi-join, and the path is its widest field.
    # The rank table has one row per index file, so broadcasting it is bounded.
    ranks = F.broadcast(index_file_ranks(spark, root, snapshots, path_glob))
    rank = F.coalesce("file_rank", F.raise_error(F.concat(F.lit("index file not listed: "), "file_path")).cast("int"))
    rec = lines.join(ranks, "file_path", "left").select(
        snapshot_below(F.col("file_path"), root).alias("snapshot_name"),
        F.struct(rank.alias("file_rank"), "block_start", "line_ord").alias("scan_ord"),
        parse_cdxj(text).alias("r"),
    )
    return _captures(rec)


# --------------------------------------------------------------------------- manifest

def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Manifest text (gzip) under ``root/<snapshot>/``: ``snapshot_name, value``;
    undecodable bytes are dropped."""
    lines = (spark.read.format("text").option("recursiveFileLookup", "true").load(root)
             .select("value", file_path_of(F.col("_metadata.file_path")).alias("file_path")))
    return lines.select(snapshot_below(F.col("file_path"), root).alias("snapshot_name"),
                        F.regexp_replace(S.bytes_to_text(F.col("value").cast("binary")), "\uFFFD", "").alias("value"))


def manifest_entries(manifest_lines: DataFrame, snapshot_col: str = "snapshot_name") -> DataFrame:
    """S3: shard entries of an index manifest (``value`` column of text lines).

    Strips lines, drops blanks, cuts everything up to the last ``commoncrawl/``
    and keeps basenames that fully match ``cdx-NNNNN.gz``.  Returns
    ``snapshot_name, rel_path, basename`` (order with ``orderBy("basename")``).
    """
    line = F.trim(F.col("value"))
    rel = F.when(line.contains("commoncrawl/"), F.substring_index(line, "commoncrawl/", -1)).otherwise(line)
    base = F.substring_index(rel, "/", -1)
    return (
        manifest_lines.where(line != "")
        .select(F.col(snapshot_col).alias("snapshot_name"), rel.alias("rel_path"), base.alias("basename"))
        .where(F.col("basename").rlike(S.CDX_SHARD_NAME))
        .distinct()
    )


def missing_shards(entries: DataFrame, present: DataFrame) -> DataFrame:
    """Manifest entries with no local file (anti join on snapshot + basename)."""
    return entries.join(present.select("snapshot_name", "basename"),
                        ["snapshot_name", "basename"], "left_anti")


def complete_snapshots(spark: SparkSession, index_root: str, manifest_root: str | None,
                       snapshots: list[str]) -> list[str]:
    """The snapshots whose index can be resolved against.

    With manifests: those that name at least one shard and whose named shards
    are all present.  Without: those whose folder holds a shard.  The answer
    is a short list (crawl snapshots, not URLs).
    """
    folders = snapshot_folders(index_root, snapshots)
    if not folders:
        return []
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz")
             .load(list(folders.values())).select(F.col("path").alias("file_path")))
    present = files.select(snapshot_below(F.col("file_path"), index_root).alias("snapshot_name"),
                           F.substring_index("file_path", "/", -1).alias("basename")).distinct()
    if manifest_root is None:
        names = present.select("snapshot_name").distinct()
    else:
        entries = manifest_entries(read_manifests(spark, manifest_root))
        names = entries.select("snapshot_name").distinct().join(
            missing_shards(entries, present).select("snapshot_name"), "snapshot_name", "left_anti")
    found = {r[0] for r in names.collect()}
    return [s for s in snapshots if s in found and s in folders]


def list_present_shards(spark: SparkSession, root: str) -> DataFrame:
    """Local shard files under ``root/<snapshot>/`` as ``snapshot_name, basename``."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "cdx-*.gz")
        .load(root)
        .select(F.col("path"))
    )
    return files.select(
        snapshot_below(F.col("path"), root).alias("snapshot_name"),
        F.substring_index(F.col("path"), "/", -1).alias("basename"),
    )
