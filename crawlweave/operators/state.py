"""URL state: selections (P15-P19, J1, O1-O3), event folding.

There is no table format with MERGE in this install, so state is an
append-only event log plus a latest-wins fold.  Work selection follows the
resume contract: by NULL location / saved path, never by status, so
``missing`` rows are retried by the next resolve and ``error`` rows by the
next extraction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweave.functions import scalars as S
from crawlweave.operators.selection import first_rows


def is_unresolved() -> F.Column:
    """Any of offset / length / filename missing."""
    return F.col("offset").isNull() | F.col("length").isNull() | F.col("filename").isNull()


def is_ready() -> F.Column:
    """Located and not yet saved."""
    return (F.col("filename").isNotNull() & F.col("offset").isNotNull()
            & F.col("length").isNotNull() & F.col("saved_path").isNull())


def is_saved() -> F.Column:
    """P17."""
    return F.col("saved_path").isNotNull()


def _in_snapshot(df: DataFrame, snapshot: str | None) -> DataFrame:
    """Snapshot filter (a partition filter when the state is partitioned by snapshot)."""
    return df if snapshot is None else df.where(F.col("snapshot_name") == F.lit(snapshot))


def unresolved(state: DataFrame, snapshot: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows still lacking a location.  With ``limit`` the budget is shared by
    the snapshots in name order, rows in insertion order (O3/O4)."""
    df = _in_snapshot(state.where(is_unresolved()), snapshot)
    if limit is not None:
        df = first_rows(df, ["snapshot_name", "ord"], limit)
    return df


def snapshots_with_unresolved(state: DataFrame) -> DataFrame:
    """A4."""
    return state.where(is_unresolved()).select("snapshot_name").distinct().orderBy("snapshot_name")


def snapshots_with_saved(state: DataFrame) -> DataFrame:
    """A4."""
    return state.where(is_saved()).select("snapshot_name").distinct().orderBy("snapshot_name")


def ready(state: DataFrame, snapshot: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows ready for extraction; with ``limit`` the first ones by (filename, offset),
    ties by insertion order (O1)."""
    df = _in_snapshot(state.where(is_ready()), snapshot)
    if limit is not None:
        df = first_rows(df, ["filename", "offset", "ord"], limit)
    return df


def saved(state: DataFrame, snapshot: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows with saved HTML; with ``limit`` the first ones by insertion order (O2)."""
    df = _in_snapshot(state.where(is_saved()), snapshot)
    if limit is not None:
        df = first_rows(df, ["ord"], limit)
    return df


def count_ready(state: DataFrame, snapshot: str | None = None) -> int:
    """A2."""
    return ready(state, snapshot).count()


def with_snapshot_names(urls: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Attach ``snapshot_name`` from the shard table (one row per shard).

    The shard table has one row per metadata file; AQE broadcasts it when its
    materialised size is under the broadcast threshold and sort-merges otherwise.
    """
    return urls.join(snapshots.select("hf_path", "snapshot_name"), "hf_path")


def range_plan(rows: DataFrame) -> DataFrame:
    """P20: byte-range arithmetic per ready row (invalid ranges flagged, not raised)."""
    return rows.select(
        "*",
        S.archive_key("filename").alias("archive"),
        S.range_end("offset", "length").alias("range_end"),
        S.range_is_valid("offset", "length").alias("range_valid"),
        S.range_part_name("filename", "offset", "length").alias("part_name"),
    )


# --------------------------------------------------------------------------- events

def resolve_events(resolved: DataFrame, seq) -> DataFrame:
    """K8 events out of a resolve result (``matched`` or ``missing``)."""
    return resolved.select(
        "hf_path", "url_raw", F.lit(seq).cast("long").alias("seq"),
        F.col("status").alias("kind"), "filename", "offset", "length",
        F.lit(None).cast("string").alias("saved_path"), F.lit(None).cast("string").alias("message"))


def fold_events(state: DataFrame, events: DataFrame, key_cols=("hf_path", "url_raw")) -> DataFrame:
    """Latest state per URL from an event log.

    Event kinds and the fields they set (in ``seq`` order, later wins):
    ``matched`` filename/offset/length/status; ``missing`` status only
    (location kept); ``downloaded`` saved_path/status, clears last_error;
    ``error`` last_error (cut to 500)/status.  Runs as one hash aggregation
    with partial aggregation, so a URL with many events stays cheap.
    """
    key_cols = list(key_cols)
    kind, seq = F.col("kind"), F.col("seq")

    def last(value: F.Column, when: F.Column) -> F.Column:
        return F.max_by(F.struct(value.alias("v")), F.when(when, seq))

    folded = events.groupBy(*key_cols).agg(
        last(F.struct("filename", "offset", "length"), kind == "matched").alias("loc"),
        last(kind, F.lit(True)).alias("st"),
        last(F.col("saved_path"), kind == "downloaded").alias("sp"),
        last(F.when(kind == "error", S.truncate_error("message")), kind.isin("error", "downloaded")).alias("le"),
    )
    s = state.join(folded, key_cols, "left")
    loc = F.col("loc.v")
    return s.select(
        *[c for c in state.columns if c not in ("filename", "offset", "length", "status", "saved_path", "last_error")],
        F.when(F.col("loc").isNotNull(), loc["filename"]).otherwise(F.col("filename")).alias("filename"),
        F.when(F.col("loc").isNotNull(), loc["offset"]).otherwise(F.col("offset")).alias("offset"),
        F.when(F.col("loc").isNotNull(), loc["length"]).otherwise(F.col("length")).alias("length"),
        F.coalesce(F.col("st.v"), F.col("status")).alias("status"),
        F.when(F.col("sp").isNotNull(), F.col("sp.v")).otherwise(F.col("saved_path")).alias("saved_path"),
        F.when(F.col("le").isNotNull(), F.col("le.v")).otherwise(F.col("last_error")).alias("last_error"),
    )
