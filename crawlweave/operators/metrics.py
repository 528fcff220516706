"""Counts over the URL state and the pipeline steps.

All are single hash aggregations with partial (map-side) aggregation; an
empty input gives zeros, not an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def progress_stats(state: DataFrame) -> DataFrame:
    """A1: total, resolved (filename set), downloaded (saved_path set), errors."""
    return state.agg(
        F.count(F.lit(1)).cast("long").alias("total"),
        F.count_if(F.col("filename").isNotNull()).cast("long").alias("resolved"),
        F.count_if(F.col("saved_path").isNotNull()).cast("long").alias("downloaded"),
        F.count_if(F.col("status") == "error").cast("long").alias("errors"),
    )


#: The counters of A1 and the condition on a state row that each counts.
COUNTERS = {
    "total": lambda: F.lit(True),
    "resolved": lambda: F.col("filename").isNotNull(),
    "downloaded": lambda: F.col("saved_path").isNotNull(),
    "errors": lambda: F.coalesce(F.col("status") == "error", F.lit(False)),
}


def counter_changes(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """Signed changes of the counters per snapshot, from the touched rows alone: their state before and after.

    Rows that were not there before are new.  Added up over all runs, the
    changes are the counters of the whole state.
    """
    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select("snapshot_name", *[
            F.when(held(), F.lit(sign)).otherwise(F.lit(0)).cast("long").alias(name) for name, held in COUNTERS.items()])

    rows = signed(after, 1) if before is None else signed(after, 1).unionByName(signed(before, -1))
    summed = rows.groupBy("snapshot_name").agg(*[F.sum(c).cast("long").alias(c) for c in COUNTERS])
    changed = F.lit(False)
    for c in COUNTERS:
        changed |= F.col(c) != 0
    return summed.where(changed)


def summed_changes(changes: DataFrame, by_snapshot: bool = False) -> DataFrame:
    """The counters that the changes add up to: one row, or one per snapshot and a total row."""
    sums = {c: F.coalesce(F.sum(c), F.lit(0)).cast("long") for c in COUNTERS}
    if by_snapshot:
        return with_total_row(changes, "snapshot_name", sums)
    return changes.agg(*[v.alias(c) for c, v in sums.items()])


def with_total_row(df: DataFrame, key: str, counts: dict[str, F.Column]) -> DataFrame:
    """Counts per ``key`` plus a total row (``key`` NULL), zeros on empty input.

    One pass: ``rollup`` gives the groups and the total; a one-row zero total
    is added and the rollup output (a handful of rows) is re-aggregated, so
    the total row exists even when the input is empty.
    """
    names = list(counts)
    rolled = df.rollup(key).agg(*[c.cast("long").alias(n) for n, c in counts.items()],
                                F.grouping_id().alias("_gid"))
    zero = df.sparkSession.range(1).select(
        F.lit(None).cast(df.schema[key].dataType).alias(key),
        *[F.lit(0).cast("long").alias(n) for n in names], F.lit(1).cast(rolled.schema["_gid"].dataType).alias("_gid"))
    return (rolled.unionByName(zero).groupBy(key, "_gid")
            .agg(*[F.sum(n).cast("long").alias(n) for n in names]).drop("_gid"))


def progress_by_snapshot(state: DataFrame) -> DataFrame:
    """A1 per snapshot, with a total row (snapshot_name NULL; zeros when empty)."""
    return with_total_row(state, "snapshot_name", {
        "total": F.count(F.lit(1)),
        "resolved": F.count_if(F.col("filename").isNotNull()),
        "downloaded": F.count_if(F.col("saved_path").isNotNull()),
        "errors": F.count_if(F.col("status") == "error"),
    })


def saved_counts(state: DataFrame, limit: int | None = None) -> DataFrame:
    """A3: rows with saved HTML per snapshot, capped by the export limit."""
    n = F.count(F.lit(1)).cast("long")
    if limit is not None:
        n = F.least(n, F.lit(int(limit)).cast("long"))
    return state.where(F.col("saved_path").isNotNull()).groupBy("snapshot_name").agg(n.alias("rows"))


def ingest_counts(records: DataFrame, inserted: DataFrame | None = None) -> DataFrame:
    """Records parsed vs newly inserted, per shard.

    Without ``inserted`` (a fresh state) every distinct URL of a shard is
    new, so both counts come from one pass over the records.
    """
    parsed = F.count(F.lit(1)).cast("long").alias("parsed")
    if inserted is None:
        return records.groupBy("hf_path").agg(
            parsed, F.count_distinct("url_raw").cast("long").alias("inserted"))
    p = records.groupBy("hf_path").agg(parsed)
    i = inserted.groupBy("hf_path").agg(F.count(F.lit(1)).cast("long").alias("inserted"))
    return p.join(i, "hf_path", "left").select(
        "hf_path", "parsed", F.coalesce("inserted", F.lit(0).cast("long")).alias("inserted"))
