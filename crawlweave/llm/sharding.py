"""Operator 8 [native]: sixteen shards of near equal bytes, by a minimax contiguous partition.

Law ``bytes``: a row's size is its text's UTF-8 bytes plus 1 (null text: 1).
Groups of equal texts stay together.  They are ordered by the MD5 of the
text; an atom of the partition is all groups that share the first 16 bits of
it, so there are at most 65,536 atoms whatever the table, each about 1 / 65,536
of the bytes unless one text alone is larger.  The smallest shard
capacity for which a greedy walk over the ordered atoms needs no more than the given
shards is found by binary search; then the atoms are cut under it.

The texts are read once.  Sizes are pre-aggregated per atom before the shuffle,
and the driver gets the atoms' sums only.  A slot is a row's place in its
shard in the order of id (null first), checksum and size: the slim rows are
range-partitioned by (shard, that order) - a group with a third of all rows
spreads over many tasks - and the place is the partition's offset plus the
row's number in it.  No window and no group holds a shard.

An empty table gives no rows.  Repeated rows get a slot each.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.llm.common import prepare
from crawlweave.session import scratch_dir

SHARDS = 16
#: Hex digits of the MD5 that name an atom.
ATOM_DIGITS = 4


def shards_needed(sums: list[int], begin: int, capacity: int, most: int) -> int:
    """Shards that a greedy walk from atom ``begin`` fills; ``most + 1`` where more are needed."""
    used, n = 0, len(sums) - 1
    while begin < n:
        used += 1
        after = bisect_right(sums, sums[begin] + capacity) - 1
        if used > most or after == begin:
            return most + 1
        begin = after
    return used


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """The least capacity with which ``shards`` contiguous shards hold all atoms."""
    sums = [0, *accumulate(sizes)]
    low, high = max([0, *sizes, -(-sums[-1] // shards)]), sums[-1]
    while low < high:
        middle = (low + high) // 2
        if shards_needed(sums, 0, middle, shards) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def _even_cuts(sizes: list[int], shards: int) -> list[int]:
    """First atom of each shard: under the smallest capacity, near the mean of what is left."""
    capacity, sums = smallest_capacity(sizes, shards), [0, *accumulate(sizes)]
    cuts, begin = [], 0
    for left in range(shards, 0, -1):
        cuts.append(begin)
        if left == 1:
            break
        furthest = bisect_right(sums, sums[begin] + capacity) - 1
        aim = sums[begin] + (sums[-1] - sums[begin]) / left
        near = max(begin, bisect_right(sums, aim) - 1)
        if near < furthest and sums[near + 1] - aim < aim - sums[near]:
            near += 1
        low, high = near, max(near, furthest)  # the first end from which the rest still fits
        while low < high:
            middle = (low + high) // 2
            if shards_needed(sums, middle, capacity, left - 1) <= left - 1:
                high = middle
            else:
                low = middle + 1
        begin = low
    return cuts


def minimax_cuts(sizes: list[int], shards: int) -> list[int]:
    """First atom of each of ``shards`` contiguous shards whose largest is as small as can be.

    Atoms above the mean of the rest take a shard each; the runs between them
    get the other shards, one after the other to the run with the largest
    mean, and are cut evenly.  Where that would exceed the smallest capacity
    over all, the whole sequence is cut under that capacity.
    """
    capacity = smallest_capacity(sizes, shards)
    large: set[int] = set()
    while len(large) < shards - 1:
        mean = (sum(sizes) - sum(sizes[i] for i in large)) / (shards - len(large))
        more = {i for i, s in enumerate(sizes) if s > mean} - large
        if not more:
            break
        large.add(max(more, key=sizes.__getitem__))
    runs, begin = [], 0
    for i in [*sorted(large), len(sizes)]:
        if i > begin:
            runs.append((begin, i))
        begin = i + 1
    spare = shards - len(large) - len(runs)
    if large and spare >= 0 and runs:
        weight = [sum(sizes[a:b]) for a, b in runs]
        given = [1] * len(runs)
        for _ in range(spare):
            given[max(range(len(runs)), key=lambda r: weight[r] / given[r])] += 1
        cuts = sorted([*large, *(a + c for (a, b), n in zip(runs, given, strict=True)
                                 for c in _even_cuts(sizes[a:b], n))])
        sums = [0, *accumulate(sizes)]
        if max(sums[b] - sums[a] for a, b in zip(cuts, [*cuts[1:], len(sizes)], strict=True)) <= capacity:
            return cuts
    return _even_cuts(sizes, shards)


def atom_of(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, ATOM_DIGITS), 16, 10).cast("int")


def shard_by_bytes(df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` of each row."""
    spark = prepare(df.sparkSession)
    folder = scratch_dir(spark, "shards")
    text = F.coalesce(F.col(text_col), F.lit(""))
    df.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
              F.crc32(text).alias("crc"), atom_of(text).alias("atom")).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")

    atoms = sorted((r.atom, r.size) for r in rows.groupBy("atom").agg(F.sum("size").alias("size")).collect())
    cuts = minimax_cuts([s for _, s in atoms], shards) if atoms else [0]
    # shard: how many cuts lie at or before the row's atom (a cut past the end opens an empty shard)
    firsts = [atoms[c][0] if c < len(atoms) else 1 << 30 for c in cuts[1:]]
    shard = sum([(F.col("atom") >= F.lit(a)).cast("int") for a in firsts], F.lit(0))

    order = [F.col("shard"), F.col("id").asc_nulls_first(), F.col("crc"), F.col("size")]
    (rows.select("id", "size", "crc", shard.cast("int").alias("shard"))
     .repartitionByRange(*order).sortWithinPartitions(*order)
     .withColumn("place", F.monotonically_increasing_id())
     .write.parquet(f"{folder}/ordered"))
    ordered = spark.read.parquet(f"{folder}/ordered").withColumn("part", F.shiftright("place", 33))

    # one row per task and shard in it: how many rows of the shard lie in earlier tasks
    counts = ordered.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0))
                                              - F.col("first")).alias("shift"))
    return ordered.join(F.broadcast(offsets), ["shard", "part"]).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("place") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
