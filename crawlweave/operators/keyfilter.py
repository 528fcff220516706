"""Blocked Bloom filters over keys, built and probed as aggregates and joins.

A filter is a table of blocks of eight 64-bit words.  A key belongs to one
block, by its hash, and sets one bit in each word; a block is the bitwise or
of its keys' words.  Building a filter is one grouped aggregation with partial
sums; probing it is a join of the keys' block numbers with the blocks.  A
key that is in the set is always found; one that is not passes by mistake with a
probability of about 1 in 1,000 at ``KEYS_PER_BLOCK``.

The number of blocks is a power of two, so that filters of many sizes are
probed at once, with one copy of a key per size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
KEYS_PER_BLOCK = 24
SCHEMA = "blocks long, block long, " + ", ".join(f"w{i} long" for i in range(WORDS)) + ", batch long"


def block_count(keys: int) -> int:
    """A power of two that leaves at most KEYS_PER_BLOCK keys to a block on average."""
    return 1 << max(0, -(-keys // KEYS_PER_BLOCK) - 1).bit_length()


def _hashes(key: list[str]) -> tuple[Column, Column]:
    return F.xxhash64(F.lit("block"), *key), F.xxhash64(F.lit("bits"), *key)


def _words(bits: Column) -> list[Column]:
    """One bit in each word, from six bits of the hash each."""
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftright(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def build(keys: DataFrame, key: list[str], count: int) -> DataFrame:
    """The filter of the keys, sized for ``count`` of them: ``blocks`` (their number), ``block``, eight words."""
    blocks = block_count(count)
    place, bits = _hashes(key)
    rows = keys.select(place.bitwiseAND(F.lit(blocks - 1)).alias("block"), *[
        w.alias(f"w{i}") for i, w in enumerate(_words(bits))])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]).select(
        F.lit(blocks).cast("long").alias("blocks"), "block", *[f"w{i}" for i in range(WORDS)])


def may_hold(filters: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """``batch, found``: of each filter (``filters`` has a column ``batch``), how many of the keys it may hold."""
    place, bits = _hashes(key)
    sizes = sorted(r.blocks for r in filters.select("blocks").distinct().collect())  # powers of two: sixty at most
    if not sizes:
        return filters.select("batch", F.lit(0).cast("long").alias("found"))
    probes = keys.select(place.alias("_place"), *[w.alias(f"k{i}") for i, w in enumerate(_words(bits))],
                         F.explode(F.lit(sizes).cast("array<bigint>")).alias("blocks"))
    probes = probes.withColumn("block", F.col("_place").bitwiseAND(F.col("blocks") - 1))
    held = filters.join(probes, ["blocks", "block"])
    for i in range(WORDS):
        held = held.where(F.col(f"w{i}").bitwiseAND(F.col(f"k{i}")) == F.col(f"k{i}"))
    return held.groupBy("batch").agg(F.count(F.lit(1)).alias("found"))
