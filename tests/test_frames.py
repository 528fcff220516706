"""Shards of many zstd frames: places, lines across borders, tasks."""

import os
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from crawlweave.session import local_path, scratch_dir
from crawlweave.sources import frames as FR
from crawlweave.sources import metadata as MD


def shard(path, data, cuts, checksum=True, skippable=False, raw=False):
    """``data`` as frames that end at ``cuts``; returns their sizes."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    sizes = []
    with open(path, "wb") as f:
        for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True):
            c = zstandard.ZstdCompressor(level=1, write_checksum=checksum, write_content_size=not raw)
            frame = c.compress(data[a:b]) if not raw else b"".join([(o := c.compressobj()).compress(data[a:b]), o.flush()])
            sizes.append(len(frame))
            f.write(frame)
            if skippable:
                f.write((0x184D2A50).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"12345")
    return sizes


@pytest.mark.parametrize(("checksum", "skippable", "raw"), [(True, False, False), (False, True, False), (True, True, True)])
def test_lines_of_any_frames(spark, checksum, skippable, raw):
    rnd = random.Random(5)
    root = local_path(scratch_dir(spark, "meta"))
    want = {}
    for name, end in (("a", "\n"), ("b", ""), ("c", "\n\n"), ("d", "")):
        lines = ["é" * rnd.randrange(0, 30) + f" {i}" if rnd.random() < 0.9 else "" for i in range(300)]
        if name == "d":
            lines = ["x" * 5000]          # one line over all frames
        data = ("\n".join(lines) + end).encode()
        cuts = sorted(rnd.sample(range(1, len(data)), 40))
        cuts = sorted({*cuts, *([data.index(b"\n") + 1, data.index(b"\n") + 2] if name != "d" else [])})
        sizes = shard(f"{root}/S/tt_meta_{name}.jsonl.zst", data, cuts, checksum, skippable, raw)
        want[f"S/tt_meta_{name}.jsonl.zst"] = (data, sizes)
    shard(f"{root}/S/tt_meta_empty.jsonl.zst", b"", [])
    frames = FR.list_frames(MD.list_shards(spark, root)).collect()
    for rel, (data, sizes) in want.items():
        assert [r.length for r in sorted((r for r in frames if r.hf_path == rel), key=lambda r: r.frame)] == sizes
    got = FR.read_framed_lines(spark, root, task_bytes=100).collect()
    native = MD.read_metadata_lines(spark, root).collect()
    for rel, (data, _) in want.items():
        mine = sorted((r.line_ord, r.value) for r in got if r.hf_path == rel)
        text = data.decode()
        lines = text.split("\n")[:-1] if text.endswith("\n") else text.split("\n")
        assert mine == list(enumerate(lines))
        theirs = [r.value for r in sorted((r for r in native if r.hf_path == rel), key=lambda r: r.line_ord)]
        assert theirs == lines
    assert not [r for r in got if "empty" in r.hf_path]


def test_a_shard_is_read_by_several_tasks(spark):
    root = local_path(scratch_dir(spark, "meta"))
    data = b"".join(b"line %d\n" % i for i in range(20_000))
    shard(f"{root}/S/tt_meta_0.jsonl.zst", data, range(1000, len(data), 1000))
    frames = FR.list_frames(MD.list_shards(spark, root))
    tasks = FR._tasks(frames, 2000).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 3
    lines = FR.read_framed_lines(spark, root, task_bytes=2000)
    assert lines.count() == 20_000 and lines.agg(F.max("line_ord")).first()[0] == 19_999


def test_torn_shards_are_errors(tmp_path):
    path = f"{tmp_path}/x/y.zst"
    sizes = shard(path, os.urandom(5000), [2000])
    data = open(path, "rb").read()

    class File:
        def __init__(self, data):
            self.data = data

        def read_at(self, n, at):
            return self.data[at:at + n]

    assert [x for _, x in FR.frame_ends(File(data), len(data))] == sizes
    with pytest.raises(ValueError, match="ends early"):
        list(FR.frame_ends(File(data[:-9]), len(data) - 9))
    with pytest.raises(ValueError, match="no zstd frame"):
        list(FR.frame_ends(File(data + b"junk" * 5), len(data) + 20))


def test_small_tasks_stay_a_few_a_core(spark):
    root = local_path(scratch_dir(spark, "meta"))
    data = b"".join(b"line %d\n" % i for i in range(20_000))
    for i in range(2):
        shard(f"{root}/S/tt_meta_{i}.jsonl.zst", data, range(1000, len(data), 1000))
    most = FR.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    frames = FR.list_frames(MD.list_shards(spark, root))
    assert frames.count() > 20 * most // 2
    assert most // 2 < FR._tasks(frames, 1).rdd.getNumPartitions() <= most
    lines = FR.read_framed_lines(spark, root, task_bytes=1)
    assert lines.select("hf_path", "line_ord").distinct().count() == lines.count() == 40_000
