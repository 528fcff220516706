"""Pruned lookups in a block-compressed capture index.

Index shards that are sorted by key and stored as many gzip members ("blocks")
come with a sidecar that names the first key of every block.  A lookup of some
URLs needs only the blocks whose key range holds one of their keys: the last
block that begins before the key, and all that begin with it.  Wanted keys and
block keys are matched by a distributed as-of scan, and only the matching
members are fetched and inflated; all others are not opened.

Layout: ``<root>/<snapshot>/*.gz`` and ``<root>/<snapshot>/cluster.idx`` (a text
file or a folder of them) with tab-separated lines ``<key> <timestamp>, file,
offset, length, number of lines``.  Keys must be those of ``sort_key``; an index with
other keys can be read by ``cdx.read_captures`` only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.functions import scalars as S
from crawlweave.operators import sequence as Q
from crawlweave.session import ensure_local_dir, file_path_of, filesystem_for
from crawlweave.sources import cdx
from crawlweave.sources.warc import range_tasks

SIDECAR = "cluster.idx"
BLOCK_LINES = 3000
STEP_BYTES = 1 << 20
YIELD_LINES = 10_000

_URL = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^#]*)"


def sort_key(url) -> Column:
    """Sort-friendly form of a URL: ``com,example)/path?query``.

    Lower case; without scheme, user, fragment, a leading ``www.`` (or
    ``www2.``) and the ports 80 and 443; host labels in reverse order.
    Text that is no URL with a scheme stands for itself, in lower case.
    """
    u = F.lower(F.trim(F.col(url) if isinstance(url, str) else url))
    host = F.regexp_replace(F.regexp_extract(u, _URL, 1), r"^www\d*\.(?=.)", "")
    port = F.regexp_extract(u, _URL, 2)
    rest = F.regexp_extract(u, _URL, 3)
    named = F.concat(
        F.array_join(F.reverse(F.split(host, r"\.")), ","),
        F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port)), F.lit(")"),
        F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest)))
    return F.when(u.rlike(_URL), named).otherwise(u)


def write_blocks(lines: DataFrame, root: str, block_lines: int = BLOCK_LINES, n: int | None = None) -> None:
    """Write index lines (``snapshot, key, stamp, value``) as sorted shards of gzip members with their sidecar.

    Shards hold ranges of keys; every task writes its own, under names that
    tell its attempt, and the sidecar names the ones that count.
    """
    spark = lines.sparkSession
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ensure_local_dir(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"cdx-{task.partitionId():05d}-{task.taskAttemptId()}.gz"
        out, snapshot, held, at, entries = None, None, [], 0, []

        def close_block() -> None:
            nonlocal at
            if held:
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = packer.compress("".join(f"{v}\n" for _, v in held).encode()) + packer.flush()
                out.write(data)
                entries.append((snapshot, f"{held[0][0]}\t{name}\t{at}\t{len(data)}\t{len(held)}"))
                at += len(data)
                held.clear()

        for batch in batches:
            for r in batch.to_pylist():
                if r["snapshot"] != snapshot or out is None:
                    close_block()
                    if out is not None:
                        out.close()
                    snapshot, at = r["snapshot"], 0
                    filesystem, inner = filesystem_for(f"{root}/{snapshot}")
                    filesystem.create_dir(inner, recursive=True)
                    out = filesystem.open_output_stream(f"{inner}/{name}", compression=None)
                held.append((f"{r['key']} {r['stamp']}", r["value"]))
                if len(held) == block_lines:
                    close_block()
        close_block()
        if out is not None:
            out.close()
        if entries:
            yield pa.RecordBatch.from_pydict({"snapshot": [e[0] for e in entries], "value": [e[1] for e in entries]})

    sorted_lines = lines.select("snapshot", "key", "stamp", "value").repartitionByRange(
        n, "snapshot", "key", "stamp").sortWithinPartitions("snapshot", "key", "stamp")
    work = f"{root}/_sidecar"
    sorted_lines.mapInArrow(run, "snapshot string, value string").write.partitionBy("snapshot").text(work)
    filesystem, inner = filesystem_for(work)
    from pyarrow import fs as pafs

    for entry in filesystem.get_file_info(pafs.FileSelector(inner)):
        if entry.type == pafs.FileType.Directory:
            snapshot = entry.base_name.removeprefix("snapshot=")
            filesystem.move(entry.path, f"{filesystem_for(root)[1]}/{snapshot}/{SIDECAR}")
    filesystem.delete_dir(inner)


def read_sidecar(spark: SparkSession, root: str, snapshots: list[str] | None = None) -> DataFrame:
    """``snapshot_name, key, file, offset, length, lines`` of every block."""
    folders = [root] if snapshots is None else list(cdx.snapshot_folders(root, snapshots).values())
    if not folders:
        return spark.createDataFrame([], "snapshot_name string, key string, file string, offset long, length long, lines long")
    text = (spark.read.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", "{part-*,cluster.idx}")
            .load(folders).select("value", file_path_of(F.col("_metadata.file_path")).alias("path"))
            .where(F.col("path").contains(f"/{SIDECAR}")))
    part = F.split("value", "\t")
    return text.select(
        cdx.snapshot_below(F.col("path"), root).alias("snapshot_name"),
        # up to the last space, which comes before the timestamp
        F.regexp_extract(part[0], r"^(.*) [^ ]*$", 1).alias("key"), part[1].alias("file"),
        part[2].cast("long").alias("offset"), part[3].cast("long").alias("length"), part[4].cast("long").alias("lines"))


def matching_blocks(blocks: DataFrame, wanted: DataFrame, n_parts: int | None = None) -> DataFrame:
    """The blocks that may hold one of the wanted keys (``snapshot_name, key``).

    A key lies in the last block that begins before it, or in those that
    begin with it.  The first is found by a forward fill over the sorted union of
    both (spread over tasks, whatever the snapshot), the others by a join.
    """
    name = F.concat_ws("\t", "file", F.col("offset").cast("string"))
    keys = wanted.select("snapshot_name", "key").distinct()
    both = (keys.withColumn("kind", F.lit(0)).withColumn("block", F.lit(None).cast("string"))
            .unionByName(blocks.select("snapshot_name", "key", F.lit(1).alias("kind"), name.alias("block"))))
    # a wanted key sorts before the blocks that begin with it
    filled = Q.segmented_ffill(both, ["snapshot_name"], ["key", "kind", "block"], "block", "before", n_parts)
    before = filled.where((F.col("kind") == 0) & F.col("before").isNotNull()).select("snapshot_name", F.col("before").alias("name"))
    same = blocks.join(keys, ["snapshot_name", "key"], "left_semi").select("snapshot_name", name.alias("name"))
    found = before.unionByName(same).distinct()
    return blocks.withColumn("name", name).join(found, ["snapshot_name", "name"], "left_semi").drop("name")


def read_block_lines(spark: SparkSession, root: str, blocks: DataFrame) -> DataFrame:
    """The lines of some blocks: ``snapshot_name, file_path, block_start, line_ord, value``.

    Runs a job that adds up the blocks' bytes, which set the number of tasks.
    Members are inflated step by step.
    """
    size = blocks.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")).first()
    n = range_tasks(spark, size["n"], int(size["bytes"] or 0))

    def lines_of(f, offset: int, length: int) -> Iterator[bytes]:
        member, at, rest = zlib.decompressobj(31), offset, b""
        while at < offset + length and not member.eof:
            data = f.read_at(min(STEP_BYTES, offset + length - at), at)
            if not data:
                break
            at += len(data)
            while data:
                text = rest + member.decompress(data, STEP_BYTES)
                data = member.unconsumed_tail
                *whole, rest = text.split(b"\n")
                yield from whole
        if not member.eof:
            raise ValueError(f"index block at {offset} ends early")
        if rest:
            yield rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["snapshot_name", "file_path", "block_start", "line_ord", "value"]
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                path = f"{root}/{r['snapshot_name']}/{r['file']}"
                filesystem, inner = filesystem_for(path)
                with filesystem.open_input_file(inner) as f:
                    for i, line in enumerate(lines_of(f, r["offset"], r["length"])):
                        out.append((r["snapshot_name"], r["file"], r["offset"], i, line))
                        if len(out) >= YIELD_LINES:
                            yield _batch(out, names)
                            out = []
            if out:
                yield _batch(out, names)

    slim = blocks.select("snapshot_name", "file", "offset", "length")
    return (slim.repartitionByRange(n, "snapshot_name", "file", "offset")
            .sortWithinPartitions("snapshot_name", "file", "offset").mapInArrow(
                run, "snapshot_name string, file_path string, block_start long, line_ord long, value binary"))


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=names)


def captures_of(spark: SparkSession, root: str, wanted: DataFrame, snapshots: list[str] | None = None) -> DataFrame:
    """The valid captures of the wanted URLs (``snapshot_name, url``), like those of ``cdx.read_captures``.

    Scan order: file by name, block, line, as of a whole scan.
    """
    urls = wanted.select("snapshot_name", "url").where(F.col("url").isNotNull()).distinct()
    blocks = matching_blocks(read_sidecar(spark, root, snapshots), urls.withColumn("key", sort_key("url")))
    lines = read_block_lines(spark, root, blocks)
    rec = lines.select(
        "snapshot_name", F.struct("file_path", "block_start", "line_ord").alias("scan_ord"),
        cdx.parse_cdxj(S.bytes_to_text(F.col("value"))).alias("r"))
    return cdx._captures(rec).join(urls, ["snapshot_name", "url"], "left_semi")
