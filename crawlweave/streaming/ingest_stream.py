"""Incremental shard ingest as a Structured Streaming job.

``run_ingest_stream`` watches a shard folder with the file source; every
micro-batch parses its new shards, keeps the first occurrence of each URL per
shard (W1), drops URLs already in the state (J6) and appends the rest.  The
stream checkpoint remembers which files were read, so a re-run picks up only
new shards (``trigger(availableNow=True)`` processes what is there and stops).

The state is a Parquet folder with one sub-folder per batch
(``batch=<id>``).  A batch writes its rows with ``overwrite``, a filter of its
keys (``<state>_keys``) where one of its shards was read before, then its shard
rows, which commit it: readers take committed batches only.  It reads no other batch than those that saw one of
its shards before and whose filter may hold one of its keys.  A batch re-run
after a failure yields the same rows -- the sink is idempotent and the whole
job exactly-once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.operators import ingest as IG
from crawlweave.operators import keyfilter as KF
from crawlweave.session import cut_lineage, file_path_of, scratch_dir, scratch_scope
from crawlweave.sources import metadata as MD

FORCE_BATCH_BASE = 1 << 40      # batch ids of forced (non-stream) re-ingests
MAX_FILES_PER_TRIGGER = 1000    # bounds the shard list (and work) of one micro-batch


URL_SCHEMA = ("snapshot_name string, hf_path string, url_raw string, url_norm string, warc_date long, "
              "warc_record_id string, digest string, offset long, length long, filename string, status string, "
              "saved_path string, last_error string, ingest_batch long, line_ord long, batch long")
SHARD_SCHEMA = ("hf_path string, snapshot_name string, imported boolean, imported_at timestamp, total_urls long, "
                "batch long")


def _path_exists(spark: SparkSession, path: str) -> bool:
    from crawlweave.session import filesystem_for
    from pyarrow import fs as pafs

    filesystem, inner = filesystem_for(path)
    return filesystem.get_file_info(inner).type != pafs.FileType.NotFound


MARK = "_SUCCESS"


def committed(path: str, name: str) -> list[int]:
    """Values of the ``name=<int>`` folders under ``path`` whose write ended (a listing, no data read).

    A folder whose write stopped half way has no mark and does not count.
    Where not one of the folders with data files has a mark, and none is
    being written, marks are switched off: an error, for all state would read
    as empty.
    """
    from crawlweave.session import filesystem_for
    from pyarrow import fs as pafs

    filesystem, inner = filesystem_for(path)
    if filesystem.get_file_info(inner).type == pafs.FileType.NotFound:
        return []
    found, unmarked = [], []
    for entry in filesystem.get_file_info(pafs.FileSelector(inner)):
        value = entry.base_name.removeprefix(f"{name}=")
        if entry.type == pafs.FileType.Directory and value != entry.base_name and value.isdigit():
            if filesystem.get_file_info(f"{entry.path}/{MARK}").type != pafs.FileType.NotFound:
                found.append(int(value))
            else:
                unmarked.append(entry.path)
    if unmarked and not found:
        inside = [{e.base_name for e in filesystem.get_file_info(pafs.FileSelector(x))} for x in unmarked]
        if any(any(n.startswith("part-") for n in names) for names in inside) and not any(
                "_temporary" in names for names in inside):
            raise RuntimeError(f"{path}: {name} folders hold data files but no {MARK} mark; {_NO_MARK}")
    return sorted(found)


def folders(path: str, name: str) -> list[int]:
    """Values of the ``name=<int>`` folders under ``path``, whole or not."""
    from crawlweave.session import filesystem_for
    from pyarrow import fs as pafs

    filesystem, inner = filesystem_for(path)
    if filesystem.get_file_info(inner).type == pafs.FileType.NotFound:
        return []
    values = (e.base_name.removeprefix(f"{name}=") for e in filesystem.get_file_info(pafs.FileSelector(inner))
              if e.base_name.startswith(f"{name}="))
    return sorted(int(v) for v in values if v.isdigit())


_NO_MARK = ("the output committer must write it (mapreduce.fileoutputcommitter.marksuccessfuljobs), "
            "because a write counts from this mark on")


def write_batch(df: DataFrame, path: str, *partition: str) -> None:
    """Write one state folder; its ``_SUCCESS`` mark, without which it would not count, must be there after it."""
    from crawlweave.session import filesystem_for
    from pyarrow import fs as pafs

    df.write.mode("overwrite").partitionBy(*partition).parquet(path)
    filesystem, inner = filesystem_for(path)
    if filesystem.get_file_info(f"{inner}/{MARK}").type == pafs.FileType.NotFound:
        raise RuntimeError(f"{path} was written without its {MARK} mark; {_NO_MARK}")


def read_batches(spark: SparkSession, path: str, batches: list[int], schema: str, name: str = "batch") -> DataFrame:
    """The rows of the given ``name=<n>`` folders; folders without files give none."""
    if not batches:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("basePath", path)
            .parquet(*[f"{path}/{name}={b}" for b in batches]))


def read_state(spark: SparkSession, state_path: str, shards_path: str, batches: list[int] | None = None) -> DataFrame:
    """URL rows of every committed batch (its shard rows, written last, are there), or of the given ones."""
    batches = committed(shards_path, "batch") if batches is None else batches
    return read_batches(spark, state_path, sorted(set(batches) & set(committed(state_path, "batch"))), URL_SCHEMA)


def filters_path(state_path: str) -> str:
    """Where the key filters of the state's batches are."""
    return f"{state_path}_keys"


def add_filter(spark: SparkSession, state_path: str, batch: int) -> None:
    """Write the key filter of a batch."""
    written = read_batches(spark, state_path, [batch], URL_SCHEMA).select(*IG.KEY)
    write_batch(KF.build(written, IG.KEY, written.count()), f"{filters_path(state_path)}/batch={batch}")


def batches_of_shards(spark: SparkSession, shards_path: str, shards: DataFrame, batch_id: int) -> list[int]:
    """Committed batches (but ``batch_id``) that read one of these shards before."""
    batches = [b for b in committed(shards_path, "batch") if b != batch_id]
    if not batches:
        return []
    return _batches_with(read_batches(spark, shards_path, batches, SHARD_SCHEMA), shards)


def _batches_with(before: DataFrame, shards: DataFrame) -> list[int]:
    again = before.join(shards.select("hf_path").distinct(), "hf_path", "left_semi").select("batch").distinct()
    return sorted(r.batch for r in again.collect())


class ShardsBefore:
    """``batches_of_shards`` for the batches of one stream run, at a cost that does not grow with their number.

    The shard rows committed before the run are gathered once, in the caller's
    scratch folder.  The run's own batches are not asked: the file source
    hands out a path once.  What another writer commits meanwhile has the next
    forced ids, so that one look a batch finds it.
    """

    def __init__(self, spark: SparkSession, shards_path: str):
        self.path, self.meanwhile, self.table = shards_path, [], None
        batches = committed(shards_path, "batch")
        self.next_forced = max([FORCE_BATCH_BASE, *(b + 1 for b in batches)])
        if batches:
            rows = read_batches(spark, shards_path, batches, SHARD_SCHEMA).select("hf_path", "batch").distinct()
            self.table = scratch_dir(spark, "shards-before")
            rows.write.parquet(self.table)

    def batches(self, spark: SparkSession, shards: DataFrame, batch_id: int) -> list[int]:
        while _path_exists(spark, f"{self.path}/batch={self.next_forced}/{MARK}"):
            self.meanwhile.append(self.next_forced)
            self.next_forced += 1
        before = [spark.read.schema("hf_path string, batch long").parquet(self.table)] if self.table else []
        if self.meanwhile:
            before.append(read_batches(spark, self.path, self.meanwhile, SHARD_SCHEMA).select("hf_path", "batch"))
        found = [_batches_with(x.where(F.col("batch") != batch_id), shards) for x in before]
        return sorted({b for one in found for b in one})


def batches_with_keys(spark: SparkSession, state_path: str, batches: list[int], keys: DataFrame) -> list[int]:
    """Those of the batches that may hold one of the keys, by their filters; a batch without a filter may."""
    filtered = sorted(set(batches) & set(committed(filters_path(state_path), "batch")))
    if not filtered:
        return batches
    filters = read_batches(spark, filters_path(state_path), filtered, KF.SCHEMA)
    hit = {r.batch for r in KF.may_hold(filters, keys, IG.KEY).where("found > 0").collect()}
    return [b for b in batches if b in hit or b not in filtered]


def known_rows(spark: SparkSession, state_path: str, shards_path: str, shards: DataFrame, batch_id: int,
               keys: DataFrame | None = None) -> DataFrame | None:
    """State rows that could share a key with this batch.

    A key starts with the shard's path, so only batches that read one of these
    shards before can hold one (for new shards none, and no state is read); of
    those, the ones whose key filter may hold one of ``keys`` are read.
    """
    return _rows_with_keys(spark, state_path, batches_of_shards(spark, shards_path, shards, batch_id), keys)


def _rows_with_keys(spark: SparkSession, state_path: str, which: list[int], keys: DataFrame | None) -> DataFrame | None:
    if which and keys is not None:
        which = batches_with_keys(spark, state_path, which, keys)
    if not which:
        return None
    return read_batches(spark, state_path, sorted(set(which) & set(committed(state_path, "batch"))), URL_SCHEMA)


def ingest_records(spark: SparkSession, records: DataFrame, state_path: str, shards_path: str,
                   batch_id: int, shards: DataFrame | None = None, before: ShardsBefore | None = None) -> None:
    """One ingest batch: parsed lines -> new state rows, then shard rows (which commit the batch).

    ``records`` may hold a row without URL per line without record
    (``every_line``), so that shards without records are seen; ``shards``
    lists the batch's shards where the caller knows them.  The first rows per
    key are written once to the shared scratch folder; all else derives from them.
    ``before`` answers for a run of many batches which of them read a shard.
    """
    with scratch_scope():
        firsts = cut_lineage(IG.first_wins(records), "ingest-firsts")
        keyed = firsts.where(F.col("url_raw").isNotNull())
        listed = firsts if shards is None else shards
        earlier = (batches_of_shards(spark, shards_path, listed, batch_id) if before is None
                   else before.batches(spark, listed, batch_id))
        existing = _rows_with_keys(spark, state_path, earlier, keyed.select(*IG.KEY))
        new = IG.new_rows(keyed, existing)
        write_batch(IG.as_state_rows(new, batch_id), f"{state_path}/batch={batch_id}")
        if earlier:
            # what a shard's first batch holds nearly every later reading repeats; later batches hold little of it
            add_filter(spark, state_path, batch_id)
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        write_batch(IG.shard_rows(shards, firsts, now), f"{shards_path}/batch={batch_id}")


def stream_lines(spark: SparkSession, source_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", MD.SHARD_GLOB)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return (
        reader.load(source_root)
        .select("value", MD.relative_to(file_path_of(F.col("_metadata.file_path")), source_root).alias("hf_path"))
        .where(F.col("hf_path").contains(MD.SHARD_MARK))
    )


def run_ingest_stream(spark: SparkSession, source_root: str, state_path: str, shards_path: str,
                      checkpoint: str, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> None:
    """Ingest every shard not seen by this checkpoint, then stop.

    A file without any line never reaches a batch: the listed shards that are
    not in the shard table afterwards are entered as imported, with no record.
    """
    with scratch_scope():
        _run_stream(spark, source_root, state_path, shards_path, checkpoint, max_files_per_trigger)


def _run_stream(spark: SparkSession, source_root: str, state_path: str, shards_path: str, checkpoint: str,
                max_files_per_trigger: int | None) -> None:
    listed = cut_lineage(MD.list_shards(spark, source_root), "listed-shards")
    before = ShardsBefore(spark, shards_path)

    def each_batch(df: DataFrame, batch_id: int) -> None:
        # a shard file is never split across micro-batches, and zstd files are
        # read whole by one task, so the id below follows the line order
        records = MD.records_from(df, F.monotonically_increasing_id(), every_line=True)
        ingest_records(df.sparkSession, records, state_path, shards_path, batch_id, before=before)

    query = (
        stream_lines(spark, source_root, max_files_per_trigger)
        .writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    blank = IG.pending_shards(listed, shard_table(spark, shards_path))
    if not blank.isEmpty():
        nothing = spark.createDataFrame([], "hf_path string, url_raw string, records long")
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        write_batch(IG.shard_rows(blank, nothing, now), f"{shards_path}/batch={next_forced_batch(shards_path)}")


def shard_table(spark: SparkSession, shards_path: str) -> DataFrame | None:
    """Latest row per shard (K5 upsert semantics over the batch folders)."""
    batches = committed(shards_path, "batch")
    if not batches:
        return None
    rows = read_batches(spark, shards_path, batches, SHARD_SCHEMA)
    latest = rows.groupBy("hf_path").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "batch"]),
                                                  F.col("batch")).alias("r"))
    return latest.select("r.*")


def next_forced_batch(shards_path: str) -> int:
    """A batch id above the stream's and above every earlier forced one."""
    return max([FORCE_BATCH_BASE, *(b + 1 for b in committed(shards_path, "batch"))])


def ingest_batch(spark: SparkSession, source_root: str, state_path: str, shards_path: str,
                 force: bool = False, reader: str = "native") -> int:
    """Batch ingest of the shards not imported yet (all of them with ``force``); no other file is opened.

    Existing URLs are never overwritten, forced or not.  ``reader="stream"``
    takes shards with windows beyond the native reader's.  Returns the batch id.
    """
    batch_id = next_forced_batch(shards_path)
    with scratch_scope():
        todo = cut_lineage(IG.pending_shards(MD.list_shards(spark, source_root), shard_table(spark, shards_path), force),
                           "pending-shards")
        records = MD.read_records(spark, source_root, reader, todo, every_line=True)
        ingest_records(spark, records, state_path, shards_path, batch_id, todo)
    return batch_id
