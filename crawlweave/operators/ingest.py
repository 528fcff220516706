"""Ingest metadata records into the URL state.

State rows are keyed by (hf_path, url_raw): the first occurrence of a URL in
a shard wins, a URL already in the state is never overwritten, and shards
already imported are skipped unless ``force``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["hf_path", "url_raw"]
RECORD_COLUMNS = ["snapshot_name", "url_raw", "url_norm", "warc_date", "warc_record_id", "digest"]


def first_wins(records: DataFrame) -> DataFrame:
    """One row per (hf_path, url_raw), the earliest line, with the number of its ``records``.

    A ``min_by`` aggregation rather than a window: duplicates collapse in the
    map-side partial aggregation, so a URL repeated a billion times in one
    shard never gathers in one task.
    """
    payload = F.struct(*[F.col(c) for c in RECORD_COLUMNS + ["line_ord"]])
    return (
        records.groupBy(*KEY)
        .agg(F.min_by(payload, F.col("line_ord")).alias("r"), F.count(F.lit(1)).cast("long").alias("records"))
        .select("hf_path", *[F.col("r")[c].alias(c) for c in RECORD_COLUMNS if c != "url_raw"],
                "url_raw", F.col("r.line_ord").alias("line_ord"), "records")
    )


def new_rows(deduped: DataFrame, existing: DataFrame | None, shards: DataFrame | None = None) -> DataFrame:
    """Insert-or-ignore -- rows whose key is not in the state yet.

    The key starts with ``hf_path``, so only state rows of the shards being
    ingested can collide.  When ``shards`` (one row per shard file of this
    batch) is given, the state is cut to those shards first with a semi-join
    -- the shard list has one row per file, so AQE broadcasts it from its
    measured size -- and the anti join then shuffles only that slice.
    """
    if existing is None:
        return deduped
    keys = existing.select(*KEY)
    if shards is not None:
        keys = keys.join(shards.select("hf_path").distinct(), "hf_path", "left_semi")
    return deduped.join(keys, KEY, "left_anti")


def as_state_rows(rows: DataFrame, batch: int = 0) -> DataFrame:
    """New URL rows in state layout (status pending, nothing located yet)."""
    return rows.select(
        "snapshot_name", "hf_path", "url_raw", "url_norm", "warc_date", "warc_record_id", "digest",
        F.lit(None).cast("long").alias("offset"),
        F.lit(None).cast("long").alias("length"),
        F.lit(None).cast("string").alias("filename"),
        F.lit("pending").alias("status"),
        F.lit(None).cast("string").alias("saved_path"),
        F.lit(None).cast("string").alias("last_error"),
        F.lit(batch).cast("long").alias("ingest_batch"),
        "line_ord",
    )


def pending_shards(shards: DataFrame, snapshots: DataFrame | None, force: bool = False) -> DataFrame:
    """Shards not imported yet (all of them with ``force``)."""
    if force or snapshots is None:
        return shards
    done = snapshots.where(F.col("imported")).select("hf_path")
    return shards.join(done, "hf_path", "left_anti")


def shard_rows(shards: DataFrame | None, firsts: DataFrame, imported_at) -> DataFrame:
    """K5/K7: one row per shard of the list -- name, imported flag, time, records parsed (0 without records).

    Without a list, the shards are those of ``firsts``.
    """
    from crawlweave.functions import scalars as S

    counts = firsts.groupBy("hf_path").agg(F.sum(F.when(F.col("url_raw").isNotNull(), F.col("records"))).alias("n"))
    rows = counts if shards is None else shards.select("hf_path").distinct().join(counts, "hf_path", "left")
    return rows.select(
        "hf_path", S.snapshot_name_from_path(F.col("hf_path")).alias("snapshot_name"), F.lit(True).alias("imported"),
        F.lit(imported_at).cast("timestamp").alias("imported_at"), F.coalesce("n", F.lit(0)).cast("long").alias("total_urls"))


def upsert_shards(snapshots: DataFrame | None, updates: DataFrame) -> DataFrame:
    """K5: upsert on hf_path (new values win), as a full outer join."""
    if snapshots is None:
        return updates
    cols = ["snapshot_name", "imported", "imported_at", "total_urls"]
    j = snapshots.alias("o").join(updates.alias("n"), "hf_path", "full_outer")
    return j.select("hf_path", *[F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in cols])


def ingest(records: DataFrame, existing: DataFrame | None = None, batch: int = 0,
           shards: DataFrame | None = None) -> DataFrame:
    """Records -> new state rows (first-wins inside the input, ignore existing keys)."""
    return as_state_rows(new_rows(first_wins(records), existing, shards), batch)
