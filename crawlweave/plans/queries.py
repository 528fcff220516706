"""Registered queries: one per operator group of the survey.

Each takes ``(spark, sf_dir)``, derives its crawl-shaped input from the test
tables (``crawlweave.plans.fixtures``) and returns a DataFrame whose column
names and types equal its DuckDB twin in ``crawlweave.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.functions import scalars as S
from crawlweave.operators import metrics as M
from crawlweave.operators import resolve as R
from crawlweave.operators import state as ST
from crawlweave.plans import fixtures as FX
from crawlweave.session import scratch_dir
from crawlweave.sources import cdx

RESOLVE_OUT = ["snapshot_name", "url_raw", "warc_date", "status", "filename", "offset", "length", "capture_ts"]
LIMITED_BUDGET = 100


def _dealt(df: DataFrame) -> DataFrame:
    """Rows whose work is all CPU, dealt out anew (the test tables are single files)."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def q_scan_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = FX.write_cdx_fixture(spark, sf_dir)
    caps = cdx.read_captures(spark, root)
    return caps.select("snapshot_name", "url", "filename", "offset", "length", "capture_ts")


def q_captures_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captures of the next budget of unresolved rows, read from the blocks that hold their keys only."""
    from crawlweave.sources import zipnum as Z

    root = FX.write_block_index(spark, sf_dir)
    rows = ST.unresolved(FX.state_fx(spark, sf_dir), limit=LIMITED_BUDGET)
    caps = Z.captures_of(spark, root, R.candidate_rows(rows, ["ord"]))
    return caps.select("snapshot_name", "url", "filename", "offset", "length", "capture_ts")


def _resolve(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    root = FX.write_cdx_fixture(spark, sf_dir)
    rows = FX.urls_fx(spark, sf_dir)
    out = R.resolve(rows, cdx.read_captures(spark, root), ["ord"], strategy)
    return out.select(*RESOLVE_OUT)


def q_resolve_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolve(spark, sf_dir, "nearest")


def q_resolve_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolve(spark, sf_dir, "priority")


def q_resolve_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = FX.write_cdx_fixture(spark, sf_dir)
    rows = ST.unresolved(FX.state_fx(spark, sf_dir), limit=LIMITED_BUDGET)
    out = R.resolve(rows, cdx.read_captures(spark, root), ["ord"], "nearest")
    return out.select(*RESOLVE_OUT)


def q_resolve_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.resolution_summary(_resolve(spark, sf_dir, "nearest"))


def q_resolve_complete_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot 11 lacks a shard that its manifest names, snapshot 12 has no manifest: only 10 is resolved."""
    root, manifests = FX.write_named_index(spark, sf_dir)
    rows = FX.urls_fx(spark, sf_dir)
    complete = cdx.complete_snapshots(spark, root, manifests, FX.SNAPSHOTS)
    done = R.resolve(rows.where(F.col("snapshot_name").isin(complete)),
                     cdx.read_captures(spark, root, snapshots=complete), ["ord"])
    left = rows.where(~F.col("snapshot_name").isin(complete)).withColumn("capture_ts", F.lit(None).cast("long"))
    return done.select(*RESOLVE_OUT).unionByName(left.select(*RESOLVE_OUT))


def q_ingest_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard table after an incremental and a long-window ingest, shards without records included."""
    from crawlweave.streaming import ingest_stream as IS

    root = scratch_dir(spark, "meta")
    state, shards, ckpt = (scratch_dir(spark, n) for n in ("state", "shards", "stream-ckpt"))
    FX.write_meta_fixture(spark, sf_dir, root, snapshot_dirs=FX.META_DIRS[:2])
    FX.write_idle_shards(spark, sf_dir, root)
    IS.run_ingest_stream(spark, root, state, shards, ckpt)
    lines = FX.meta_lines(spark, sf_dir).where(F.split("rel", "/")[2].isin(list(FX.META_DIRS[2:])))
    FX.write_zstd_files(lines, root, window_log=28).count()      # beyond the native reader
    IS.ingest_batch(spark, root, state, shards, reader="stream")
    return IS.shard_table(spark, shards).select("hf_path", "snapshot_name", "imported", "total_urls")


def q_state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = FX.urls_fx(spark, sf_dir)
    latest = ST.fold_events(state, FX.state_events(spark, sf_dir), key_cols=["ord"])
    return latest.select("snapshot_name", "url_raw", "status", "filename", "offset", "length",
                         "saved_path", "last_error")


def q_progress_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters after the ingest (run -1) and after each of three runs of events, added up from the runs' changes."""
    state = FX.urls_fx(spark, sf_dir)
    events = FX.runs_of_events(spark, sf_dir)
    columns = ["ord", "snapshot_name", "filename", "offset", "length", "status", "saved_path", "last_error"]
    changes = M.counter_changes(None, ST.fold_events(state, events.limit(0), ["ord"]).select(columns)).withColumn(
        "run", F.lit(-1))
    for run in range(FX.RUNS):
        own = events.where(F.col("run") == run).drop("run")
        touched = state.join(own.select("ord").distinct(), "ord", "left_semi")
        before = ST.fold_events(touched, events.where(F.col("run") < run).drop("run"), ["ord"]).select(columns)
        after = ST.fold_events(before, own, ["ord"])
        changes = changes.unionByName(M.counter_changes(before, after).withColumn("run", F.lit(run)))
    runs = spark.createDataFrame([(r, x) for r in range(-1, FX.RUNS) for x in range(-1, r + 1)], "after_run int, run int")
    summed = runs.join(changes, "run", "left").groupBy("after_run")
    return summed.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in M.COUNTERS])


def q_state_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compactions after the ingest and after each run of events: buckets that got events, buckets written anew, and
    how many rows of the state differ from a full fold of all events."""
    from crawlweave import commands as C

    root = scratch_dir(spark, "state")
    FX.write_state_folder(spark, sf_dir, root)
    rows = C.url_rows(spark, root)
    C.compact(spark, root, FX.STATE_BUCKETS)
    events = FX.keyed_runs(spark, sf_dir)
    told = []
    for run in range(FX.RUNS):
        own = events.where(F.col("run") == run).withColumn("run", F.lit(run).cast("long"))
        C._append_events(own.drop("run"), root, run + C._next_seq(root))
        version = C.compact(spark, root)
        state = C.current_state(spark, root)
        full = ST.fold_events(rows, events.where(F.col("run") <= run).drop("run"), C.KEY)
        names = [*C.KEY, "status", "filename", "offset", "length", "saved_path", "last_error"]
        differ = state.select(names).exceptAll(full.select(names)).count() + state.count() - rows.count()
        touched = own.join(rows.select(*C.KEY), C.KEY, "left_semi").select(C.bucket_of(FX.STATE_BUCKETS)).distinct().count()
        written = len(C.IS.folders(f"{root}/compact/v={version}", "bucket"))
        told.append((run, own.count(), touched == written, differ))
    return spark.createDataFrame(told, "run int, events long, only_touched boolean, differing long")


def q_pending_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = FX.state_fx(spark, sf_dir)
    shards = state.select("hf_path", "snapshot_name").distinct()
    urls = ST.with_snapshot_names(state.drop("snapshot_name"), shards)
    plan = ST.range_plan(ST.ready(urls))
    return plan.select("snapshot_name", "url_raw", "archive", "offset", "length", "range_end",
                       "range_valid", "part_name")


def q_archive_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.operators import extract as X

    path = scratch_dir(spark, "paths")
    X.write_path_file(FX.state_fx(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("filename"))


def q_progress_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.progress_stats(FX.state_fx(spark, sf_dir))


def q_safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = FX.urls_fx(spark, sf_dir)
    digest = F.when(F.col("ord") % 6 == 1, F.lit(None).cast("string")).otherwise(F.col("digest"))
    from_pages = u.select(
        F.concat(F.lit("p"), F.col("ord").cast("string")).alias("item"),
        F.concat(S.safe_filename("url_raw", digest), F.lit(".html")).alias("name"),
        S.snapshot_basename("snapshot_name").alias("base"),
    )
    docs = _dealt(FX.table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    from_docs = docs.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("item"),
        F.concat(S.safe_filename(F.concat(F.lit("https://example.org/"), F.col("text")),
                                 F.lit(None).cast("string")), F.lit(".html")).alias("name"),
        S.snapshot_basename(F.col("source")).alias("base"),
    )
    return from_pages.unionByName(from_docs)


INGEST_OUT = ["snapshot_name", "hf_path", "url_raw", "url_norm", "warc_date", "warc_record_id", "digest"]


def q_ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.operators import ingest as IG
    from crawlweave.sources import metadata as MD

    root = FX.write_meta_fixture(spark, sf_dir)
    return IG.ingest(MD.read_records(spark, root)).select(*INGEST_OUT)


def q_ingest_framed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ingest_metadata`` from shards of many frames, each read by several tasks."""
    from crawlweave.operators import ingest as IG
    from crawlweave.sources import frames as FR
    from crawlweave.sources import metadata as MD

    root = FX.write_meta_fixture(spark, sf_dir, frame_bytes=1000)
    return IG.ingest(MD.parse_records(FR.read_framed_lines(spark, root, task_bytes=1000))).select(*INGEST_OUT)


def q_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.sources import metadata as MD

    root = FX.write_meta_fixture(spark, sf_dir)
    return M.ingest_counts(MD.read_records(spark, root, reader="stream"))


def q_ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.streaming import ingest_stream as IS

    root = scratch_dir(spark, "meta")
    state, shards, ckpt = (scratch_dir(spark, n) for n in ("state", "shards", "stream-ckpt"))
    first, later = FX.META_DIRS[:2], FX.META_DIRS[2:]
    FX.write_meta_fixture(spark, sf_dir, root, snapshot_dirs=first)
    IS.run_ingest_stream(spark, root, state, shards, ckpt, max_files_per_trigger=2)
    FX.write_meta_fixture(spark, sf_dir, root, snapshot_dirs=later)
    IS.run_ingest_stream(spark, root, state, shards, ckpt, max_files_per_trigger=2)
    IS.run_ingest_stream(spark, root, state, shards, ckpt)           # nothing new: no-op
    IS.ingest_batch(spark, root, state, shards)                       # every shard imported: no-op
    IS.ingest_batch(spark, root, state, shards, force=True)           # re-read, nothing overwritten
    return IS.read_state(spark, state, shards).select(*INGEST_OUT)


def q_url_normal_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.functions.urls import normal_form

    return FX.url_spellings(spark, sf_dir).select("page_id", normal_form("url").alias("url"))


def q_ingest_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per committed batch: its rows, those whose keys a second crawl of the same shards brings again, and whether
    the key filter says that the batch must be read for it."""
    from crawlweave.operators import ingest as IG
    from crawlweave.streaming import ingest_stream as IS

    state, shards = scratch_dir(spark, "state"), scratch_dir(spark, "shards")
    rows = FX.overlap_records(spark, sf_dir)
    for batch in range(FX.OVERLAP_BATCHES):
        IS.ingest_records(spark, rows.where(F.col("part") == batch), state, shards, batch)
    IS.add_filter(spark, state, 0)  # the first batch of new shards has none by itself
    again = FX.second_crawl(spark, sf_dir)
    which = IS.batches_of_shards(spark, shards, again, -1)
    read = IS.batches_with_keys(spark, state, which, again.select(*IG.KEY))
    held = IS.read_state(spark, state, shards).select(*IG.KEY, "batch")
    hit = held.join(again.select(*IG.KEY).distinct().withColumn("again", F.lit(1)), IG.KEY, "left")
    return hit.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), F.count("again").alias("colliding")).withColumn(
        "read", F.col("batch").isin(read))


def q_html_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.functions.markdown import with_markdown
    pages = _dealt(FX.table(spark, sf_dir, "pages").select("page_id", "html"))
    return with_markdown(pages).select("page_id", "markdown")


def q_markdown_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.functions.markdown import with_markdown

    return with_markdown(_dealt(FX.markdown_cases(spark, sf_dir))).select("page_id", "markdown")


def q_page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.functions.markdown import page_blocks

    pages = _dealt(FX.table(spark, sf_dir, "pages").select("page_id", "html"))
    return page_blocks(pages).drop("markdown")


def q_block_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown of small pages with odd make-up, every text of which must stay (or go, where it is boilerplate)."""
    from crawlweave.functions.markdown import with_markdown

    pages = _dealt(FX.markdown_cases(spark, sf_dir, FX.BLOCK_CASES))
    return with_markdown(pages, th_headers=True).select("page_id", "markdown")


def q_extract_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.operators import extract as X
    from crawlweave.sources import warc as W

    root, locations = FX.write_warc_fixture(spark, sf_dir)
    state = FX.extract_state(spark, sf_dir, locations)
    rows = X.plan_extraction(state, W.list_archives(spark, root))
    results = X.extract_to_table(rows, root, ["ord"], scratch_dir(spark, "extracted"))
    latest = ST.fold_events(state, X.extraction_events(results, ["ord"], seq=1), key_cols=["ord"])
    html = X.html_table(results, ["ord"]).select("ord", "html")
    return latest.join(html, "ord", "left").select(
        "snapshot_name", "url_raw", "status", "saved_path", "last_error", "html")


def q_decode_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.sources import warc as W

    decoded = W.decode_payloads(FX.encoded_records(spark, sf_dir))
    return decoded.select("page_id", S.bytes_to_text("payload").alias("html"), "error")


def q_archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of damaged archives; places and lengths depend on the compression, so that they are summed up here:
    an archive's members cover it from its first to its last byte."""
    from crawlweave.sources import warc as W

    root = FX.write_torn_archives(spark, sf_dir)
    found = W.archive_members(spark, root, range_bytes=64 << 10)
    sizes = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select(F.regexp_extract("path", "(crawl/[^/]*)$", 1).alias("archive"), F.col("length").alias("size")))
    covered = found.groupBy("archive").agg(F.sum("length").alias("bytes"), F.max(F.col("offset") + F.col("length")).alias("end"))
    whole = covered.join(sizes, "archive").select("archive", (
        (F.col("bytes") == F.col("size")) & (F.col("end") == F.col("size"))).alias("covered"))
    return found.join(whole, "archive").select("archive", "url", "state", "covered")


EXPORT_OUT = ["snapshot", "url", "offset", "length", "filename", "html", "markdown"]
EXPORT_LIMIT = 20            # rows per snapshot in the limited export
SPLIT_MB = "0.0625"          # split threshold of the split export, as a user writes it (P14)
SPLIT_BATCH_ROWS = 20        # rows per size check in the split export


def _saved_with_html(spark: SparkSession, sf_dir: str):
    """Saved rows of the state fixture and their HTML store (K3 -> S7):
    the HTML of page_id % 12 == 7 is missing."""
    state = FX.state_fx(spark, sf_dir)
    pages = _dealt(FX.table(spark, sf_dir, "pages"))
    store = scratch_dir(spark, "html")
    (state.where(ST.is_saved()).join(pages.select(F.col("page_id").alias("ord"), "html"), "ord")
     .where(F.col("ord") % 12 != 7)
     .select("snapshot_name", "saved_path", "ord", "html")
     .write.partitionBy("snapshot_name").parquet(store))
    return ST.saved(state), spark.read.parquet(store)


def q_export_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.operators import export as E

    saved, html = _saved_with_html(spark, sf_dir)
    out = scratch_dir(spark, "export")
    E.write_export(E.export_rows(saved, html, ["ord"]), out)
    return spark.read.parquet(out).select(*EXPORT_OUT)


def q_export_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.operators import export as E

    saved, html = _saved_with_html(spark, sf_dir)
    out = scratch_dir(spark, "export")
    first = E.limit_per_snapshot(saved, EXPORT_LIMIT, "snapshot_name")
    E.write_export(E.export_rows(first, html, ["ord"]), out)
    return spark.read.parquet(out).select(*EXPORT_OUT)


def q_export_split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.operators import export as E

    pages = _dealt(FX.table(spark, sf_dir, "pages").select(F.col("page_id").alias("ord"), "html"))
    rows = FX.urls_fx(spark, sf_dir).join(pages, "ord")
    rows = E.export_rows(rows.drop("html"), rows.select("ord", "html"), ["ord"])
    out = scratch_dir(spark, "export-split")
    E.write_export(rows, out, max_bytes=S.parse_split_mb(SPLIT_MB), batch_rows=SPLIT_BATCH_ROWS)
    back = spark.read.parquet(out)
    return back.groupBy("snapshot", "part").agg(
        F.count(F.lit(1)).cast("long").alias("rows"), F.sum(E.row_bytes()).cast("long").alias("bytes"))


def q_shard_manifest_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, local = FX.write_manifest_fixture(spark, sf_dir)
    entries = cdx.manifest_entries(cdx.read_manifests(spark, root))
    missing = cdx.missing_shards(entries, cdx.list_present_shards(spark, local))
    return missing.select("snapshot_name", "rel_path", "basename")


READY_BUDGET = 25            # rows in the ready-range budget (O1)
ARCHIVE_BUDGET = 3           # archives in the extraction budget (O5)


def q_ready_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: ready rows of each snapshot and of all (NULL)."""
    state = FX.state_fx(spark, sf_dir)
    return spark.createDataFrame([(s, ST.count_ready(state, s)) for s in (None, *FX.SNAPSHOTS)],
                                 "snapshot_name string, ready long")


def q_progress_by_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.progress_by_snapshot(FX.state_fx(spark, sf_dir))


def q_export_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.saved_counts(FX.state_fx(spark, sf_dir), limit=EXPORT_LIMIT)


def q_snapshot_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = FX.state_fx(spark, sf_dir)
    return (ST.snapshots_with_unresolved(state).select(F.lit("unresolved").alias("kind"), "snapshot_name")
            .unionByName(ST.snapshots_with_saved(state).select(F.lit("saved").alias("kind"), "snapshot_name")))


def q_ready_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ST.ready(FX.state_fx(spark, sf_dir), limit=READY_BUDGET)
    return rows.select("snapshot_name", "url_raw", "filename", "offset", "length")


def q_saved_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ST.saved(FX.state_fx(spark, sf_dir), snapshot="CC-MAIN-2024-11", limit=READY_BUDGET)
    return rows.select("snapshot_name", "url_raw", "saved_path")


def q_archive_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crawlweave.operators import extract as X
    from crawlweave.sources import warc as W

    root, locations = FX.write_warc_fixture(spark, sf_dir)
    state = FX.extract_state(spark, sf_dir, locations)
    rows = X.plan_extraction(state, W.list_archives(spark, root), limit_archives=ARCHIVE_BUDGET)
    return rows.select("archive", "url_raw", "range_valid")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_captures": q_scan_captures,
    "captures_pruned": q_captures_pruned,
    "shard_manifest_missing": q_shard_manifest_missing,
    "resolve_nearest": q_resolve_nearest,
    "resolve_priority": q_resolve_priority,
    "resolve_limited": q_resolve_limited,
    "resolve_summary": q_resolve_summary,
    "resolve_complete_index": q_resolve_complete_index,
    "state_latest": q_state_latest,
    "progress_deltas": q_progress_deltas,
    "state_buckets": q_state_buckets,
    "pending_ranges": q_pending_ranges,
    "archive_paths": q_archive_paths,
    "progress_stats": q_progress_stats,
    "safe_names": q_safe_names,
    "ingest_metadata": q_ingest_metadata,
    "ingest_framed": q_ingest_framed,
    "ingest_counts": q_ingest_counts,
    "ingest_incremental": q_ingest_incremental,
    "ingest_shards": q_ingest_shards,
    "ingest_overlap": q_ingest_overlap,
    "url_normal_forms": q_url_normal_forms,
    "html_markdown": q_html_markdown,
    "markdown_cases": q_markdown_cases,
    "page_blocks": q_page_blocks,
    "block_cases": q_block_cases,
    "extract_records": q_extract_records,
    "decode_payloads": q_decode_payloads,
    "archive_members": q_archive_members,
    "export_snapshot": q_export_snapshot,
    "export_limited": q_export_limited,
    "export_split_parts": q_export_split_parts,
    "progress_by_snapshot": q_progress_by_snapshot,
    "export_counts": q_export_counts,
    "snapshot_lists": q_snapshot_lists,
    "ready_counts": q_ready_counts,
    "ready_budget": q_ready_budget,
    "saved_budget": q_saved_budget,
    "archive_budget": q_archive_budget,
}
