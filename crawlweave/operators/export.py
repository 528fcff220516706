"""Corpus export: Parquet per snapshot, optionally size-split.

Output layout: ``<out>/snapshot=<YYYY-NN>/[part=<n>/]part-*.parquet`` with the
columns ``url, offset, length, filename, html, markdown`` -- a folder per
snapshot instead of one file, written by many tasks.  Rows are range
partitioned by (snapshot, insertion order), so files hold consecutive rows
and a large snapshot is spread over many writers.  Re-exporting a snapshot
replaces only that snapshot's folder (dynamic partition overwrite).
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.functions import scalars as S
from crawlweave.functions.markdown import with_markdown
from crawlweave.operators import rollover
from crawlweave.operators import sequence as Q
from crawlweave.operators.selection import first_rows_of_each
from crawlweave.session import cut_lineage, filesystem_for, scratch_scope

EXPORT_COLUMNS = ["url", "offset", "length", "filename", "html", "markdown"]
BATCH_ROWS = 500            # rows per size check (fixed by the export format)
MAX_BOUNDS = 200_000        # parts whose first keys go out to the tasks (some 20 MB)


def export_rows(saved: DataFrame, html: DataFrame, key_cols: list[str]) -> DataFrame:
    """Saved URL rows + their HTML (S7: missing HTML -> NULL) -> ``snapshot, ord`` + the export columns but
    ``markdown``, which ``write_export`` computes behind its shuffle."""
    j = saved.join(html.select(*key_cols, "html"), key_cols, "left")
    return j.select(
        S.snapshot_basename("snapshot_name").alias("snapshot"),
        "ord",
        S.export_url("url_raw").alias("url"),
        "offset", "length", "filename", "html",
    )


def limit_per_snapshot(rows: DataFrame, limit: int | None, snapshot_col: str = "snapshot") -> DataFrame:
    """The first ``limit`` rows of each snapshot by insertion order.

    Meant for the slim saved rows, before HTML is joined.  The last row of
    each snapshot's share is found by distributed selection, so no snapshot is
    sorted in one task, whatever the limit.
    """
    return rows if limit is None else first_rows_of_each(rows, [snapshot_col], ["ord"], int(limit))


def row_bytes() -> F.Column:
    """Size of a row for split decisions = UTF-8 bytes of html + markdown."""
    return (F.coalesce(F.octet_length("html"), F.lit(0))
            + F.coalesce(F.octet_length("markdown"), F.lit(0))).cast("long")


def assign_parts(rows: DataFrame, max_bytes: int, batch_rows: int = BATCH_ROWS,
                 n_parts: int | None = None, chunk: int = rollover.CHUNK) -> DataFrame:
    """Greedy size rollover -> ``snapshot, ord, part`` of each row (``snapshot, ord, bytes``).

    Rows go in insertion order in batches of ``batch_rows``; a part closes
    after the first batch at which its bytes reach ``max_bytes`` and the next
    batch opens a new part (overshoot is not carried over).  Batch numbers come
    from a distributed row index, the parts of batches from composed transfer
    functions (``rollover.py``): three jobs, one sort of slim rows.
    """
    if max_bytes is None or max_bytes <= 0:
        raise ValueError("a part needs a positive number of bytes")
    r = Q.row_index(rows.select("snapshot", "ord", "bytes"), ["snapshot"], ["ord"], "_idx", n_parts)
    r = r.withColumn("batch", F.floor(F.col("_idx") / batch_rows).cast("long"))
    b = r.groupBy(F.col("snapshot").alias("group"), "batch").agg(F.sum("bytes").cast("long").alias("bytes"))
    parts = rollover.parts_of_batches(b, max_bytes, chunk, n_parts).withColumnRenamed("group", "snapshot")
    return r.join(parts, ["snapshot", "batch"]).select("snapshot", "ord", "part")


def _with_parts(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """``rows`` with their ``part``: by the first row of every part where these are few, else by a join.

    A part's rows are consecutive, so that one key per part tells them apart
    and the wide rows are not shuffled for it.
    """
    firsts = slots.groupBy("snapshot", "part").agg(F.min("ord").alias("ord"))
    found = firsts.limit(MAX_BOUNDS + 1).toArrow().to_pylist()
    if len(found) > MAX_BOUNDS:
        return rows.join(slots, ["snapshot", "ord"])
    keys = sorted((Q.comparable({"snapshot": r["snapshot"], "ord": r["ord"]}), r["part"]) for r in found)
    starts, parts = [k for k, _ in keys], [p for _, p in keys]
    part_of = Q.udf_of(lambda key: parts[bisect.bisect_right(starts, key) - 1], T.IntegerType())
    return rows.withColumn("part", part_of(F.struct("snapshot", "ord")))


def write_export(rows: DataFrame, out: str, max_bytes: int | None = None,
                 batch_rows: int = BATCH_ROWS, n_parts: int | None = None) -> None:
    """K1/K2: write export rows; with ``max_bytes`` split into ``part=<n>`` folders.

    Runs its jobs when called.  A snapshot's folder is replaced as a whole.
    Wide rows (html) are shuffled once, by ranges of the insertion order or by
    part, and their markdown is computed behind that shuffle; the ranges come
    from slim keys.  With parts, a first pass computes the rows' sizes alone
    (and so their markdown once more); nothing wide is written to the scratch
    folder.  A part, bounded by its size, is written by one task.
    """
    spark = rows.sparkSession
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def with_pages(df: DataFrame) -> DataFrame:
        return df if "markdown" in df.columns else with_markdown(df)

    if max_bytes is None:
        (with_pages(Q.spread_by_range(rows, ["snapshot", "ord"], n)).select("snapshot", *EXPORT_COLUMNS)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot").parquet(out))
        return
    if max_bytes <= 0:
        raise ValueError("a part needs a positive number of bytes")
    with scratch_scope():
        sizes = cut_lineage(with_pages(rows).select("snapshot", "ord", row_bytes().alias("bytes")), "export-sizes")
        parts = cut_lineage(assign_parts(sizes, max_bytes, batch_rows, n_parts), "export-parts")
        placed = (_with_parts(rows, parts).repartition(n, "snapshot", "part")
                  .sortWithinPartitions("snapshot", "part", "ord"))
        (with_pages(placed).select("snapshot", "part", *EXPORT_COLUMNS)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("snapshot", "part").parquet(out))
        # parts of an earlier export beyond the new ones (one row per snapshot comes to the driver)
        for r in parts.groupBy("snapshot").agg(F.max("part").alias("last")).collect():
            _drop_old_parts(f"{out.rstrip('/')}/snapshot={r.snapshot}", r.last)


def _drop_old_parts(folder: str, last: int) -> None:
    """Remove what an earlier export left in a snapshot's folder: higher parts, or files without parts."""
    from pyarrow import fs as pafs

    filesystem, inner = filesystem_for(folder)
    for entry in filesystem.get_file_info(pafs.FileSelector(inner)):
        name = entry.base_name
        if entry.type == pafs.FileType.Directory and name.startswith("part="):
            if int(name[len("part="):]) > last:
                filesystem.delete_dir(entry.path)
        elif entry.type == pafs.FileType.File and name.endswith(".parquet"):
            filesystem.delete_file(entry.path)
