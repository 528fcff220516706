"""Resolve URL rows to their best capture.

The capture index is joined to the candidate URLs of each unresolved row
(raw, lower-cased, normalised) within the row's snapshot, and one capture is
picked per row:

* ``strategy="nearest"`` (bulk scan semantics): the capture whose time is
  nearest to the row's ``warc_date`` across all candidates; a capture without
  a time counts as 10^12 s away; ties go to the capture seen first in index
  scan order.  A row without a date (NULL or 0) takes the first capture seen.
* ``strategy="priority"`` (per-URL lookup semantics): the first candidate that
  has any capture wins, nearest within it, same tie rules.

Scale design -- no step emits all pairs of a (snapshot, url) group, and no
group whose size grows with the data is gathered into one task:

0. the candidate rows (rows x <= 3 URLs) are the largest intermediate: they
   are reduced once to distinct (snapshot, url, target date) lookups and
   joined back once at the end -- two shuffles of them in total.
1. distinct candidate keys semi-join the index (the index is cut to the URLs
   we need; AQE turns this into a broadcast when the key set is small).
2. captures collapse to one per (snapshot, url, second) -- the earliest in
   scan order -- with partial aggregation before the shuffle, so a URL that
   was captured millions of times shrinks map-side.  This table is written
   to the scratch folder: the index is scanned exactly once.
3. the as-of step runs on the union of captures and distinct target dates,
   windowed per (snapshot, url, day): each window holds at most one row per
   second of that day (<= 2 * 86,400 rows) whatever the data volume.
4. neighbours in other days come from a per-(snapshot, url) window over the
   per-day summary table (one row per day with data).
5. each lookup picks the least of (previous, next, first-untimed) capture by
   (delta, scan order); each row then takes the least over its <= 3
   candidates (prefixed by the candidate position for ``priority``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.functions import scalars as S
from crawlweave.session import cut_lineage

DAY = 86_400
STRATEGIES = ("nearest", "priority")
UNDATED = -1            # target key of rows without a date (dates are > 0)


def _capture_struct() -> F.Column:
    return F.struct(
        F.col("filename").alias("filename"),
        F.col("offset").alias("offset"),
        F.col("length").alias("length"),
        F.col("capture_ts").alias("capture_ts"),
        F.col("scan_ord").alias("scan_ord"),
    )


def candidate_rows(rows: DataFrame, key_cols: list[str]) -> DataFrame:
    """One row per (row, candidate URL) with the candidate's priority position.

    ``posexplode_outer`` keeps rows without any candidate so they come out as
    ``missing`` rather than disappearing.
    """
    date = F.col("warc_date")
    return rows.select(
        *[F.col(c) for c in key_cols],
        "snapshot_name",
        F.when(date.isNull() | (date == 0), F.lit(UNDATED)).otherwise(date).cast("long").alias("target_ts"),
        F.posexplode_outer(S.url_candidates("url_raw", "url_norm")).alias("cand_pos", "url"),
    )


def distinct_targets(cands: DataFrame) -> DataFrame:
    """Distinct (snapshot, url, target_ts) lookups: every later step runs on
    these instead of on the (much larger) candidate rows."""
    return cands.where(F.col("url").isNotNull()).select("snapshot_name", "url", "target_ts").distinct()


def needed_captures(captures: DataFrame, targets: DataFrame) -> DataFrame:
    """Captures whose (snapshot, url) is a candidate of some row."""
    wanted = targets.select("snapshot_name", "url").distinct()
    return captures.join(wanted, ["snapshot_name", "url"], "left_semi")


def first_per_second(caps: DataFrame) -> DataFrame:
    """One capture per (snapshot, url, capture_ts): the earliest in scan order."""
    return (
        caps.groupBy("snapshot_name", "url", "capture_ts")
        .agg(F.min_by(_capture_struct(), F.col("scan_ord")).alias("cap"))
    )


def url_summary(per_second: DataFrame) -> DataFrame:
    """Per (snapshot, url): first capture seen at all, first capture without a time."""
    cap = F.col("cap")
    return per_second.groupBy("snapshot_name", "url").agg(
        F.min_by(cap, cap["scan_ord"]).alias("first_any"),
        F.min_by(cap, F.when(F.col("capture_ts") == 0, cap["scan_ord"])).alias("first_untimed"),
    )


def nearest_timed(per_second: DataFrame, targets: DataFrame) -> DataFrame:
    """As-of in both directions: for each distinct dated (snapshot, url, target_ts)
    the last timed capture at or before it and the first one after it."""
    targets = (
        targets.where(F.col("target_ts") != UNDATED)
        .select("snapshot_name", "url", F.col("target_ts").alias("t"), F.lit(1).alias("kind"),
                F.lit(None).cast(per_second.schema["cap"].dataType).alias("cap"))
    )
    timed = per_second.where(F.col("capture_ts") > 0).select(
        "snapshot_name", "url", F.col("capture_ts").alias("t"), F.lit(0).alias("kind"), "cap")
    both = timed.unionByName(targets).withColumn("day", F.floor(F.col("t") / DAY))

    in_day = Window.partitionBy("snapshot_name", "url", "day").orderBy("t", "kind")
    whole_day = in_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one window pass gives the in-day neighbours of each target and the
    # day's first / last capture (same partitioning and order, different frames)
    scanned = both.select(
        "snapshot_name", "url", "day", "t", "kind",
        F.last("cap", ignorenulls=True).over(
            in_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("prev_in"),
        F.first("cap", ignorenulls=True).over(
            in_day.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("next_in"),
        F.first("cap", ignorenulls=True).over(whole_day).alias("day_first"),
        F.last("cap", ignorenulls=True).over(whole_day).alias("day_last"),
    )
    near = scanned.where(F.col("kind") == 1)
    # the data is already partitioned by (snapshot, url, day): no shuffle here
    days = scanned.groupBy("snapshot_name", "url", "day").agg(
        F.first("day_first").alias("day_first"), F.first("day_last").alias("day_last"))
    across = Window.partitionBy("snapshot_name", "url").orderBy("day")
    days = days.select(
        "snapshot_name", "url", "day",
        F.last("day_last", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("prev_out"),
        F.first("day_first", ignorenulls=True).over(across.rowsBetween(1, Window.unboundedFollowing)).alias("next_out"),
    )
    return near.join(days, ["snapshot_name", "url", "day"], "left").select(
        "snapshot_name", "url", F.col("t").alias("target_ts"),
        F.coalesce("prev_in", "prev_out").alias("prev_cap"),
        F.coalesce("next_in", "next_out").alias("next_cap"),
    )


def _option(cap: F.Column, target: F.Column | None) -> F.Column:
    """(delta, scan order, capture) of one capture; NULL when ``cap`` is NULL."""
    if target is None:
        delta = F.lit(0).cast("long")
    else:
        delta = F.when(cap["capture_ts"] == 0, F.lit(S.NO_TIMESTAMP_DELTA)).otherwise(
            F.abs(cap["capture_ts"] - target))
    return F.when(cap.isNotNull(), F.struct(delta.alias("delta"), cap["scan_ord"].alias("ord"), cap.alias("cap")))


def best_per_target(per_second: DataFrame, targets: DataFrame) -> DataFrame:
    """Best capture for each distinct (snapshot, url, target_ts): the least
    of (previous, next, first untimed) by (delta, scan order); the first
    capture seen when the target is undated."""
    summary = url_summary(per_second)
    timed = nearest_timed(per_second, targets)
    t = (targets.join(summary, ["snapshot_name", "url"], "left")
         .join(timed, ["snapshot_name", "url", "target_ts"], "left"))
    tgt = F.col("target_ts")
    dated = F.least(_option(F.col("prev_cap"), tgt), _option(F.col("next_cap"), tgt),
                    _option(F.col("first_untimed"), tgt))
    best = F.when(tgt == UNDATED, _option(F.col("first_any"), None)).otherwise(dated)
    return t.select("snapshot_name", "url", "target_ts", best.alias("opt"))


def best_captures(rows: DataFrame, captures: DataFrame, key_cols: list[str],
                  strategy: str = "nearest") -> DataFrame:
    """Best capture per row: ``key_cols`` + ``best`` (struct or NULL)."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    cands = candidate_rows(rows, key_cols)
    targets = distinct_targets(cands)
    # the index is the largest input: scan it once, keep only the captures of
    # our URLs (one per second), and cut the lineage so the consumers below
    # read this table instead of rescanning the index
    per_second = cut_lineage(first_per_second(needed_captures(captures, targets)), "captures")
    per_target = best_per_target(per_second, targets)

    opt = F.col("opt")
    fields = [F.col("cand_pos").alias("pos")] if strategy == "priority" else []
    choice = F.when(opt.isNotNull(), F.struct(*fields, opt["delta"].alias("delta"), opt["ord"].alias("ord"),
                                              opt["cap"].alias("cap")))
    scored = cands.join(per_target, ["snapshot_name", "url", "target_ts"], "left")
    return scored.groupBy(*key_cols).agg(F.min(choice).alias("best"))


def apply_resolution(rows: DataFrame, best: DataFrame, key_cols: list[str]) -> DataFrame:
    """Every input row comes back; matched rows get the capture's
    location, the others keep their old values and become ``missing``."""
    cap = F.col("best.cap")
    hit = F.col("best").isNotNull()
    out = rows.join(best, key_cols, "left")
    return out.select(
        *[c for c in rows.columns if c not in ("filename", "offset", "length", "status")],
        F.when(hit, cap["filename"]).otherwise(F.col("filename")).alias("filename"),
        F.when(hit, cap["offset"]).otherwise(F.col("offset")).alias("offset"),
        F.when(hit, cap["length"]).otherwise(F.col("length")).alias("length"),
        F.when(hit, F.lit("matched")).otherwise(F.lit("missing")).alias("status"),
        F.when(hit, cap["capture_ts"]).alias("capture_ts"),
    )


def resolve(rows: DataFrame, captures: DataFrame, key_cols: list[str],
            strategy: str = "nearest") -> DataFrame:
    """Resolve rows (already filtered to the unresolved ones) against captures."""
    return apply_resolution(rows, best_captures(rows, captures, key_cols, strategy), key_cols)


def resolution_summary(resolved: DataFrame) -> DataFrame:
    """Matched / missing per snapshot, plus a total row (snapshot NULL)
    that is there even when nothing was resolved (zeros)."""
    from crawlweave.operators.metrics import with_total_row

    return with_total_row(resolved, "snapshot_name", {
        "matched": F.count_if(F.col("status") == "matched"),
        "missing": F.count_if(F.col("status") == "missing"),
    })
