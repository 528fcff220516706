"""Greedy size rollover by composed transfer functions.

Batches go in order; a part closes after the first batch at which its bytes
reach the limit, and the next batch opens a new part.  What a run of batches
does depends only on the bytes that the open part already holds when the run
begins, and once a part closes inside the run the rest no longer depends on
it.  So a chunk of consecutive batches is a small map: for each batch that may
be the first to close a part, how many parts the chunk closes and how many
bytes are open at its end.  Chunks are mapped on their own, in any task; one
pass over the maps, a few numbers each, gives every chunk's entry state, with
which its batches are numbered, again chunk by chunk.

A map has at most as many pieces as a chunk has batches, and no more than a
part has, so that the pass reads about one number for every few thousand rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweave.session import cut_lineage

#: Consecutive batches that one map stands for.
CHUNK = 2048
_MAP = "struct<sums: array<bigint>, closed: array<bigint>, held: array<bigint>, total: bigint>"


def transfer_map(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Running sums up to each batch that may close the first part, the parts closed and the bytes held at the
    chunk's end in that case, and the chunk's bytes (held in addition where no part closes)."""
    sums = np.cumsum(sizes)
    m, total = len(sizes), int(sums[-1])
    before = sums - sizes
    ends = np.searchsorted(sums, before + limit)  # the batch that closes a part opened at each batch
    closed, held = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    for b in range(m - 1, -1, -1):
        j = int(ends[b])
        if j == m:
            held[b] = total - before[b]
        else:
            closed[b], held[b] = closed[j + 1] + 1, held[j + 1]
    pieces = min(m, int(np.searchsorted(sums, limit)) + 1)  # an empty part is closed by then at the latest
    return sums[:pieces], closed[1:pieces + 1] + 1, held[1:pieces + 1], total


def step(entry: tuple[int, int], sums, closed, held, total: int, limit: int) -> tuple[int, int]:
    """(part number, bytes it holds) behind a chunk."""
    part, open_ = entry
    first = int(np.searchsorted(sums, limit - open_))
    return (part, open_ + total) if first == len(sums) else (part + int(closed[first]), int(held[first]))


def numbered(sizes: np.ndarray, part: int, held: int, limit: int) -> np.ndarray:
    """Part number of each batch of a chunk that is entered with these."""
    sums = np.cumsum(sizes)
    out, at, gone = np.empty(len(sizes), np.int64), 0, -held
    while at < len(sizes):
        end = min(int(np.searchsorted(sums, gone + limit)), len(sizes) - 1)
        out[at:end + 1] = part
        part, at, gone = part + 1, end + 1, int(sums[end])
    return out


def parts_of_batches(batches: DataFrame, limit: int, chunk: int = CHUNK, n_parts: int | None = None) -> DataFrame:
    """``group, batch, part`` of batches (``group, batch, bytes``; numbered from 0 without gaps in each group)."""
    spark = batches.sparkSession
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def mapped(sizes: pa.Array) -> pa.Array:
        rows = [transfer_map(np.array(x, np.int64), limit) for x in sizes.to_pylist()]
        return pa.array([{"sums": a.tolist(), "closed": b.tolist(), "held": c.tolist(), "total": t}
                         for a, b, c, t in rows], _map_type())

    def entries(tables):
        group, state = None, (0, 0)
        for batch in tables:
            out = []
            for r in batch.to_pylist():
                if r["group"] != group:
                    group, state = r["group"], (0, 0)
                out.append({"group": r["group"], "chunk": r["chunk"], "part": state[0], "held": state[1]})
                m = r["map"]
                state = step(state, m["sums"], m["closed"], m["held"], m["total"], limit)
            yield pa.RecordBatch.from_pylist(out, pa.schema([("group", pa.string()), ("chunk", pa.int64()),
                                                             ("part", pa.int64()), ("held", pa.int64())]))

    def parts(sizes: pa.Array, part: pa.Array, held: pa.Array) -> pa.Array:
        return pa.array([numbered(np.array(x, np.int64), p, h, limit).tolist()
                         for x, p, h in zip(sizes.to_pylist(), part.to_pylist(), held.to_pylist(), strict=True)],
                        pa.list_(pa.int64()))

    mapped.__annotations__ = {"sizes": pa.Array, "return": pa.Array}
    parts.__annotations__ = {"sizes": pa.Array, "part": pa.Array, "held": pa.Array, "return": pa.Array}
    # a chunk is a bounded list; its sizes in order of the batches
    listed = F.sort_array(F.collect_list(F.struct("batch", "bytes")))
    chunks = cut_lineage(batches.groupBy("group", F.floor(F.col("batch") / chunk).cast("long").alias("chunk"))
                         .agg(listed["bytes"].alias("sizes"))
                         .withColumn("map", F.arrow_udf(mapped, _MAP)("sizes")), "rollover-chunks")
    entered = (chunks.select("group", "chunk", "map").repartition(n, "group").sortWithinPartitions("group", "chunk")
               .mapInArrow(entries, "group string, chunk long, part long, held long"))
    done = chunks.select("group", "chunk", "sizes").join(entered, ["group", "chunk"])
    done = done.select("group", "chunk", F.posexplode(F.arrow_udf(parts, "array<bigint>")("sizes", "part", "held"))
                       .alias("at", "part"))
    return done.select("group", (F.col("chunk") * chunk + F.col("at")).alias("batch"),
                       F.col("part").cast("int").alias("part"))


def _map_type() -> pa.DataType:
    return pa.struct([(name, pa.list_(pa.int64())) for name in ("sums", "closed", "held")] + [("total", pa.int64())])
