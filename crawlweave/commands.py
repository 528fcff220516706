"""Job-level API: the reference's commands as Spark jobs over a state folder.

Layout of ``state_root`` (every part append-only; readers take the latest)::

    urls/batch=<n>/            URL rows written by ingest (key: hf_path, url_raw)
    shards/batch=<n>/          one row per ingested shard (imported, time, count)
    events/run=<seq>/          state updates from resolve / extract runs
    html/run=<seq>/            saved pages: hf_path, url_raw, snapshot_name, saved_path, html
    counters/batch=<n>/, run=<seq>/   changes of the progress counters by that ingest batch or run
    compact/v=<seq>/bucket=<n>/ folded state of some hash buckets up to event ``seq`` (see ``compact``)
    compact/covered=<seq>/     ingest batches that version covers
    compact/places=<seq>/      which version holds each bucket
    stream-checkpoint/         file-source checkpoint of the incremental ingest

``current_state`` folds the event log over the URL rows (latest event per
field wins), so every command is a pure DataFrame job that appends its
results -- a re-run after a failure only redoes the missing work, which is
the resume contract: unresolved = location missing, ready = located and not
saved.
"""

from __future__ import annotations

import functools
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.functions import scalars as S
from crawlweave.operators import export as E
from crawlweave.operators import extract as X
from crawlweave.operators import metrics as M
from crawlweave.operators import resolve as R
from crawlweave.operators import state as ST
from crawlweave.session import apply_session_conf, cut_lineage, local_table, scratch_dir, scratch_scope
from crawlweave.sources import cdx
from crawlweave.sources import warc as W
from crawlweave.streaming import ingest_stream as IS

KEY = ["hf_path", "url_raw"]


def _p(state_root: str, part: str) -> str:
    return f"{state_root.rstrip('/')}/{part}"


def _next_seq(state_root: str) -> int:
    """A run number above every earlier one, even if the driver clock stepped back."""
    seen = IS.committed(_p(state_root, "events"), "run") + IS.committed(_p(state_root, "compact"), "v")
    return max([time.time_ns()] + [x + 1 for x in seen])


def ingest(spark: SparkSession, shards_root: str, state_root: str, force: bool = False,
           stream: bool = True, max_files_per_trigger: int | None = IS.MAX_FILES_PER_TRIGGER,
           reader: str = "native") -> None:
    """Ingest metadata shards: new shards only (incremental stream), or all
    of them again with ``force`` (existing URL rows are never overwritten).
    ``reader="stream"`` (a batch job) takes shards with zstd windows above 128 MB."""
    apply_session_conf(spark)
    urls, shards = _p(state_root, "urls"), _p(state_root, "shards")
    if stream and not force and reader == "native":
        IS.run_ingest_stream(spark, shards_root, urls, shards, _p(state_root, "stream-checkpoint"),
                             max_files_per_trigger)
    else:
        IS.ingest_batch(spark, shards_root, urls, shards, force=force, reader=reader)
    _count_batches(spark, state_root)


COUNTER_SCHEMA = "snapshot_name string, " + ", ".join(f"{c} long" for c in M.COUNTERS)


def _count_batches(spark: SparkSession, state_root: str) -> None:
    """The counter changes of ingest batches that have none yet: their rows are all new."""
    done = set(IS.committed(_p(state_root, "counters"), "batch"))
    for batch in IS.committed(_p(state_root, "shards"), "batch"):
        if batch not in done:
            rows = url_rows(spark, state_root, [batch])
            IS.write_batch(M.counter_changes(None, rows), f"{_p(state_root, 'counters')}/batch={batch}")


def kept_changes(spark: SparkSession, state_root: str) -> DataFrame | None:
    """The counter changes of every committed ingest batch and run; None where one of them left none (it stopped
    before, or was written by other means)."""
    path, found = _p(state_root, "counters"), []
    for name, part in (("batch", "shards"), ("run", "events")):
        wanted = IS.committed(_p(state_root, part), name)
        if set(wanted) - set(IS.committed(path, name)):
            return None
        found += [f"{path}/{name}={x}" for x in wanted]
    if not found:
        return spark.createDataFrame([], COUNTER_SCHEMA)
    return spark.read.schema(COUNTER_SCHEMA).parquet(*found)


def url_rows(spark: SparkSession, state_root: str, batches: list[int] | None = None) -> DataFrame:
    """URL rows of the committed ingest batches (or the given ones), with ``ord`` = insertion order (batch, shard,
    line)."""
    urls = IS.read_state(spark, _p(state_root, "urls"), _p(state_root, "shards"), batches)
    return urls.withColumn("ord", F.struct("ingest_batch", "hf_path", "line_ord"))


EVENT_SCHEMA = ("hf_path string, url_raw string, seq long, kind string, filename string, offset long, length long, "
                "saved_path string, message string, run long")
HTML_SCHEMA = "hf_path string, url_raw string, snapshot_name string, saved_path string, html string, run long"


def events(spark: SparkSession, state_root: str, after: int = -1) -> DataFrame:
    """Events of the runs that ended, those after run ``after``."""
    path = _p(state_root, "events")
    runs = [r for r in IS.committed(path, "run") if r > after]
    return IS.read_batches(spark, path, runs, EVENT_SCHEMA, "run")


def saved_html(spark: SparkSession, state_root: str) -> DataFrame:
    """Saved pages of the runs whose events are there: a page without its event is not saved."""
    path = _p(state_root, "html")
    runs = set(IS.committed(path, "run")) & set(IS.committed(_p(state_root, "events"), "run"))
    return IS.read_batches(spark, path, sorted(runs), HTML_SCHEMA, "run")


LEAST_BUCKETS = 64  # hash buckets of the key that a first compaction deals the state to, at least


def bucket_of(buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


def _latest_compaction(spark: SparkSession, state_root: str) -> tuple[int, list[int], int, dict[int, int]] | None:
    """(version, ingest batches it covers, number of buckets, version that holds each bucket) of the newest
    compaction whose write ended."""
    root = _p(state_root, "compact")
    versions = IS.committed(root, "v")
    if not versions:
        return None
    v = max(versions)
    covered = [r[0] for r in spark.read.parquet(f"{root}/covered={v}").collect()]
    places = spark.read.parquet(f"{root}/places={v}").collect()  # a row per bucket
    return v, covered, places[0].buckets, {r.bucket: r.version for r in places if r.version is not None}


def _compacted(spark: SparkSession, state_root: str, places: dict[int, int]) -> DataFrame:
    """The folded rows of the given buckets, each from the version that holds it."""
    root = _p(state_root, "compact")
    schema = T.StructType([*url_rows(spark, state_root, []).schema.fields, T.StructField("bucket", T.IntegerType())])
    parts = [spark.createDataFrame([], schema)]
    for version in sorted(set(places.values())):
        # a bucket whose events belong to no row has no folder
        paths = [f"{root}/v={version}/bucket={b}" for b in IS.folders(f"{root}/v={version}", "bucket")
                 if places.get(b) == version]
        if paths:
            parts.append(spark.read.schema(schema).option("basePath", f"{root}/v={version}").parquet(*paths))
    return functools.reduce(DataFrame.unionByName, parts)


def current_state(spark: SparkSession, state_root: str, batches: list[int] | None = None) -> DataFrame:
    """Latest state of every URL row (W4 over the event log), or of those of the given ingest batches.

    With a compaction, only the URL batches it does not cover and the events
    newer than it are folded over it -- the cost no longer grows with the
    number of past runs.  (Compact while no command is running.)
    """
    apply_session_conf(spark)
    base = _latest_compaction(spark, state_root)
    if base is None:
        return ST.fold_events(url_rows(spark, state_root, batches), events(spark, state_root), KEY)
    v, covered, _, places = base
    batches = IS.committed(_p(state_root, "shards"), "batch") if batches is None else batches
    late = url_rows(spark, state_root, [b for b in batches if b not in set(covered)])
    done = _compacted(spark, state_root, places).drop("bucket")
    return ST.fold_events(done.unionByName(late), events(spark, state_root, after=v), KEY)


def compact(spark: SparkSession, state_root: str, buckets: int | None = None) -> int:
    """Write the current state of what changed as ``compact/v=<seq>`` and return ``seq``; later reads start from it.
    Old URL batches and events stay on disk.

    State lies in hash buckets of the key.  Only buckets with an event or a URL
    row since the last compaction are folded and written; the others stay where
    they are, and ``places=<seq>`` tells which version holds each.  The first
    compaction sets the number of buckets for good: ``buckets``, or as many as
    shuffle partitions.

    The list of covered batches is written first, and just those are folded: a
    batch that ends meanwhile stays uncovered.  A compaction counts from the
    moment its rows are complete."""
    apply_session_conf(spark)
    root, seq = _p(state_root, "compact"), _next_seq(state_root)
    batches = IS.committed(_p(state_root, "shards"), "batch")
    base = _latest_compaction(spark, state_root)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    v, covered, buckets, places = base if base else (-1, [], buckets or max(LEAST_BUCKETS, partitions), {})
    late = url_rows(spark, state_root, [b for b in batches if b not in set(covered)])
    recent = events(spark, state_root, after=v)
    bucket = bucket_of(buckets).alias("bucket")
    touched = late.select(*KEY).unionByName(recent.select(*KEY))
    dirty = sorted(r.bucket for r in touched.select(bucket).distinct().collect())
    IS.write_batch(spark.createDataFrame([(b,) for b in batches], "batch long"), f"{root}/covered={seq}")
    stale = _compacted(spark, state_root, {b: x for b, x in places.items() if b in set(dirty)})
    rows = stale.drop("bucket").unionByName(late)
    folded = ST.fold_events(rows, recent, KEY).withColumn("bucket", bucket_of(buckets))
    now = {**places, **{b: seq for b in dirty}}
    IS.write_batch(spark.createDataFrame([(b, now.get(b), buckets) for b in range(buckets)],
                                         "bucket int, version long, buckets int"), f"{root}/places={seq}")
    # a bucket's rows to one task: one file per bucket, of a bounded share of the state
    n = max(1, min(len(dirty), partitions))
    IS.write_batch(folded.repartition(n, "bucket"), f"{root}/v={seq}", "bucket")
    return seq


def _append_events(ev: DataFrame, state_root: str, seq: int) -> DataFrame:
    path = f"{_p(state_root, 'events')}/run={seq}"
    IS.write_batch(ev, path)
    return ev.sparkSession.read.parquet(path)


def _count_run(rows: DataFrame, written: DataFrame, state_root: str, seq: int) -> None:
    """The counter changes of a run, from the rows it worked on and its events (a run without them is counted from
    the state)."""
    slim = rows.select(*KEY, "snapshot_name", "filename", "offset", "length", "status", "saved_path", "last_error")
    after = ST.fold_events(slim, written, KEY)
    IS.write_batch(M.counter_changes(slim, after), f"{_p(state_root, 'counters')}/run={seq}")


def resolve_local(spark: SparkSession, state_root: str, index_root: str, snapshot: str | None = None,
                  limit: int | None = None, strategy: str = "nearest", manifest_root: str | None = None) -> DataFrame:
    """Resolve unresolved rows against the capture index under ``index_root/<snapshot>/``.

    A snapshot is resolved only against its whole index: with manifests under
    ``manifest_root/<snapshot>/``, every shard they name must be present;
    without, its folder must hold a shard.  The rows of other snapshots stay as they are.

    Only the snapshot folders that still have unresolved rows are read; the
    budget ``limit`` is shared by snapshots in name order.  Appends one
    event per row (matched / missing) and returns matched/missing counts per
    snapshot plus a total row.
    """
    with scratch_scope():
        # the work set is written once: the state fold behind it is a large join
        work = cut_lineage(ST.unresolved(current_state(spark, state_root), snapshot, limit), "resolve-work")
        # one row per crawl snapshot, not per URL
        snaps = [r[0] for r in work.select("snapshot_name").distinct().collect()]
        # a snapshot that is skipped still used its share of the budget above
        present = cdx.complete_snapshots(spark, index_root, manifest_root, snaps)
        rows = work.where(F.col("snapshot_name").isin(present))
        resolved = R.resolve(rows, cdx.read_captures(spark, index_root, snapshots=present), KEY, strategy)
        seq = _next_seq(state_root)
        written = _append_events(ST.resolve_events(resolved, seq), state_root, seq)
        _count_run(rows, written, state_root, seq)
        counted = written.join(rows.select(*KEY, "snapshot_name"), KEY)
        return local_table(R.resolution_summary(counted.withColumnRenamed("kind", "status")))


def write_paths(spark: SparkSession, state_root: str, path_file: str) -> int:
    """K4: distinct archive names of ready rows, sorted, one per line; returns the count."""
    X.write_path_file(current_state(spark, state_root), path_file)
    return spark.read.text(path_file).count()


def _keep_extracted(spark: SparkSession, state_root: str, rows: DataFrame, archive_root: str,
                    check_target: bool) -> DataFrame:
    """Read the pages, store them, then append the events that make them count (a run stopped
    in between leaves rows that the next run extracts again)."""
    rows = cut_lineage(rows, "extract-work")
    results = X.extract_to_table(rows, archive_root, KEY, scratch_dir(spark, "extracted"), check_target)
    seq = _next_seq(state_root)
    IS.write_batch(X.html_table(results, KEY), f"{_p(state_root, 'html')}/run={seq}")
    written = _append_events(X.extraction_events(results, KEY, seq), state_root, seq)
    _count_run(rows, written, state_root, seq)
    return local_table(written.groupBy("kind").agg(F.count(F.lit(1)).cast("long").alias("rows")))


def extract_html(spark: SparkSession, state_root: str, archive_root: str, limit: int | None = None,
                 check_target: bool = True) -> DataFrame:
    """Extract the HTML of ready rows whose archive exists under ``archive_root``.

    ``limit`` caps the number of archives (first by name).  Saved pages go to
    the HTML table, every row gets a ``downloaded`` or ``error`` event.
    Returns the counts per kind.
    """
    with scratch_scope():
        rows = X.plan_extraction(current_state(spark, state_root), W.list_archives(spark, archive_root),
                                 limit_archives=limit)
        return _keep_extracted(spark, state_root, rows, archive_root, check_target)


def extract_ranges(spark: SparkSession, state_root: str, archive_root: str, snapshot: str | None = None,
                   limit: int | None = None, check_target: bool = False) -> DataFrame:
    """The range variant of ``extract_html``: ready rows in (filename, offset)
    order, optionally one snapshot and a row budget (not an archive budget),
    target check off by default.  Rows whose archive is absent get an error
    (there is no "skip"; every selected range is attempted)."""
    with scratch_scope():
        rows = ST.range_plan(ST.ready(current_state(spark, state_root), snapshot, limit))
        return _keep_extracted(spark, state_root, rows, archive_root, check_target)


def stats(spark: SparkSession, state_root: str, by_snapshot: bool = False) -> DataFrame:
    """A1: total, resolved, downloaded, errors (optionally per snapshot with a total row).

    Added up from the changes that each run wrote, a few rows a run; only
    where those are incomplete from the state itself.
    """
    apply_session_conf(spark)
    changes = kept_changes(spark, state_root)
    if changes is not None:
        return M.summed_changes(changes, by_snapshot)
    state = current_state(spark, state_root)
    return M.progress_by_snapshot(state) if by_snapshot else M.progress_stats(state)


def export_parquet(spark: SparkSession, state_root: str, out: str, snapshot: str | None = None,
                   limit: int | None = None, split_mb=None) -> DataFrame:
    """Export saved pages (url, offset, length, filename, html, markdown) to
    ``out/snapshot=<YYYY-NN>/[part=<n>/]``; returns rows per snapshot (A3)."""
    max_bytes = S.parse_split_mb(split_mb)
    state = current_state(spark, state_root)
    # the limit cuts slim rows, before HTML is joined and markdown computed
    saved = E.limit_per_snapshot(ST.saved(state, snapshot), limit, "snapshot_name")
    html = saved_html(spark, state_root).select(*KEY, "html")
    E.write_export(E.export_rows(saved, html, KEY), out, max_bytes)
    return spark.read.parquet(out).groupBy("snapshot").agg(F.count(F.lit(1)).cast("long").alias("rows"))
