"""Metadata shards of many zstd frames, read by several tasks.

A zstd file may be a sequence of frames that decompress on their own.  Their
places are found from frame and block headers alone, without decompressing;
a task then takes a run of frames.  Lines do not end with frames: what a frame
holds before its first line feed ends the line that an earlier frame began.
Two passes give exact line numbers: the line feeds of each frame, whose running
sums say at which line a frame begins, then the lines.  Whole lines leave their
task as they are; only the pieces at frame borders are gathered, by line
number, and joined.

A shard of one frame is one task, as with the other readers.  A file that ends
inside a frame is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlweave.functions import scalars as S
from crawlweave.session import filesystem_for
from crawlweave.sources import metadata as MD

#: Compressed bytes of frames that one task reads.
TASK_BYTES = 64 << 20
#: Tasks a core that fewer bytes a task may lead to.
TASKS_PER_CORE = 4
STEP_BYTES = 1 << 20
YIELD_ROWS = 4096

_FRAME = 0xFD2FB528
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_FRAMES = "hf_path string, file_path string, frame long, offset long, length long"


def frame_ends(f, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of each frame, from headers; skippable frames are passed over."""
    import zstandard

    at = 0
    while at < size:
        head = f.read_at(18, at)
        magic = int.from_bytes(head[:4], "little")
        if magic in _SKIPPABLE and len(head) >= 8:
            at += 8 + int.from_bytes(head[4:8], "little")
            continue
        if magic != _FRAME:
            raise ValueError(f"no zstd frame at {at}")
        end = at + zstandard.frame_header_size(head)
        last = False
        while not last:
            block = int.from_bytes(f.read_at(3, end), "little")
            last, kind = bool(block & 1), block >> 1 & 3
            end += 3 + (1 if kind == 1 else block >> 3)  # a run of one byte is stored as that byte
            if end > size or kind == 3:
                raise ValueError(f"the zstd frame at {at} ends early")
        end += 4 * zstandard.get_frame_parameters(head).has_checksum
        yield at, end - at
        at = end


def list_frames(shards: DataFrame) -> DataFrame:
    """Frames of the shards (``file_path, hf_path``): ``hf_path, file_path, frame, offset, length``."""
    n = max(1, min(shards.count(), TASKS_PER_CORE * shards.sparkSession.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, rel in zip(batch.column("file_path").to_pylist(), batch.column("hf_path").to_pylist(), strict=True):
                filesystem, inner = filesystem_for(path)
                with filesystem.open_input_file(inner) as f:
                    found = list(frame_ends(f, f.size()))
                if found:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([rel] * len(found)), pa.array([path] * len(found)),
                        pa.array(range(len(found)), pa.int64()), pa.array([a for a, _ in found], pa.int64()),
                        pa.array([x for _, x in found], pa.int64())],
                        names=["hf_path", "file_path", "frame", "offset", "length"])

    return shards.select("file_path", "hf_path").repartitionByRange(n, "hf_path").mapInArrow(run, _FRAMES)


def _pieces(f, offset: int, length: int) -> Iterator[bytes]:
    """The frame's bytes, a bounded piece at a time."""
    import zstandard

    reader = zstandard.ZstdDecompressor(max_window_size=MD.ZSTD_MAX_WINDOW).stream_reader(_Slice(f, offset, length))
    while piece := reader.read(STEP_BYTES):
        yield piece


class _Slice:
    """A part of a file as a stream."""

    def __init__(self, f, offset: int, length: int):
        self.f, self.at, self.end = f, offset, offset + length

    def read(self, size: int = -1) -> bytes:
        size = self.end - self.at if size < 0 else min(size, self.end - self.at)
        out = self.f.read_at(size, self.at)
        self.at += len(out)
        return out


def _tasks(frames: DataFrame, task_bytes: int) -> DataFrame:
    """Frames dealt to tasks by their bytes, in order.

    A ``task_bytes`` below TASK_BYTES spreads them over ``TASKS_PER_CORE`` tasks a
    core at most: a task costs time, and a file, whatever it reads.
    """
    total = frames.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")).first()
    held, cores = int(total["bytes"] or 0), frames.sparkSession.sparkContext.defaultParallelism
    spread = min(-(-held // task_bytes), TASKS_PER_CORE * cores)
    n = max(1, min(total["n"], max(cores, spread, -(-held // max(task_bytes, TASK_BYTES)))))
    return frames.repartitionByRange(n, "hf_path", "frame").sortWithinPartitions("hf_path", "frame")


def _each_frame(batches: Iterator[pa.RecordBatch]):
    """Each row with its frame's bytes; a file stays open for its frames that follow one another."""
    path, f = None, None
    try:
        for batch in batches:
            for r in batch.to_pylist():
                if r["file_path"] != path:
                    if f is not None:
                        f.close()
                    filesystem, inner = filesystem_for(r["file_path"])
                    path, f = r["file_path"], filesystem.open_input_file(inner)
                yield r, _pieces(f, r["offset"], r["length"])
    finally:
        if f is not None:
            f.close()


def read_framed_lines(spark: SparkSession, root: str, shards: DataFrame | None = None,
                      task_bytes: int = TASK_BYTES) -> DataFrame:
    """Every line of every shard below ``root`` (or of the listed ones): ``hf_path, line_ord, value``.

    Runs jobs when called: the frame scan (written to the scratch folder) and the count of line feeds.
    """
    from crawlweave.session import cut_lineage

    shards = MD.list_shards(spark, root) if shards is None else shards
    frames = cut_lineage(list_frames(shards), "frames")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, pieces in _each_frame(batches):
            feeds = sum(p.count(b"\n") for p in pieces)
            yield pa.RecordBatch.from_pydict({"hf_path": [r["hf_path"]], "frame": [r["frame"]], "feeds": [feeds]})

    counted = cut_lineage(_tasks(frames, task_bytes).mapInArrow(count, "hf_path string, frame long, feeds long"),
                          "frame-lines")
    earlier = Window.partitionBy("hf_path").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    first = counted.select("hf_path", "frame", F.coalesce(F.sum("feeds").over(earlier), F.lit(0)).alias("first"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (line number, value, whether it is only a piece of a line)."""
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
        names = ["hf_path", "frame", "line_ord", "value", "piece"]

        def batch_of(rows):
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for r, pieces in _each_frame(batches):
            out, rest, number = [], b"", r["first"]
            for piece in pieces:
                *whole, rest = (rest + piece).split(b"\n") if b"\n" in piece else [rest + piece]
                for line in whole:
                    out.append((r["hf_path"], r["frame"], number, line, number == r["first"]))
                    number += 1
                if len(out) >= YIELD_ROWS:
                    yield batch_of(out)
                    out = []
            if rest:
                out.append((r["hf_path"], r["frame"], number, rest, True))
            if out:
                yield batch_of(out)

    # what ends with the frame's first line feed is a piece: an earlier frame may have begun it
    placed = _tasks(frames.join(first, ["hf_path", "frame"]), task_bytes)
    rows = placed.mapInArrow(lines, "hf_path string, frame long, line_ord long, value binary, piece boolean")
    joined = F.aggregate(F.sort_array(F.collect_list(F.struct("frame", "value"))), F.lit(b""),
                         lambda a, x: F.concat(a, x["value"]))
    # written once: whole lines and pieces are read from it apart
    rows = cut_lineage(rows, "framed-lines")
    whole = rows.where(~F.col("piece")).select("hf_path", "line_ord", "value")
    stitched = rows.where("piece").groupBy("hf_path", "line_ord").agg(joined.alias("value"))
    return whole.unionByName(stitched).select("hf_path", "line_ord", S.bytes_to_text("value").alias("value"))
