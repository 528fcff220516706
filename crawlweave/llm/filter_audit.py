"""Operator 13: how text filters interact, over all their orders.

Every document becomes a mask of the filters it fails.  Documents are counted
in cells (part, mask, good, toxic), at most 128 a part.  Each cell then folds
across the array of the 120 orders (a literal that goes out with the plan):
``transform`` over the orders and ``aggregate`` over an order's five steps
give 600 structs weighted by the cell's count; a part's cells are merged by
elementwise sums.

The filters: A fewer than 200 words; B fewer distinct words than half of all;
C more than 2 % capital letters; D any of ``#$%&*|``; E a text that some
smaller id has too.  Words are runs of other than ASCII white space.

E needs the smallest id of each text: ids are reduced per text digest before
anything is shuffled, and rows are joined to their text's smallest id with the
texts of many rows broadcast (see ``common.join_by_group``).

Null texts count as empty, null parts as the empty string.  A null id is
neither smaller than another nor has it labels.  Rows repeated for an id count
each; rows of one id never make each other fail E.  Labels repeated for an id:
good (toxic) if any row says so.  An empty table gives no rows.  Other columns
are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.llm.common import join_by_group
from crawlweave.session import scratch_dir

FILTERS = "ABCDE"
#: All orders of the filters, as strings in ascending order.
ORDERS = ["".join(o) for o in permutations(FILTERS)]
STEPS = len(FILTERS)
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
_STRUCT = "struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">"


def failures(text: Column) -> Column:
    """Bits 0 to 3: whether a text (not null) fails A to D."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    # one array of words for both counts
    counts = F.transform(F.array(words), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))[0]
    return F.transform(F.array(counts), lambda c: (
        F.when(c["n"] < 200, 1).otherwise(0)
        + F.when(100 * c["distinct"] < 50 * c["n"], 2).otherwise(0)
        + F.when(100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 2 * F.length(text), 4).otherwise(0)
        + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)))[0]


def document_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "source") -> DataFrame:
    """``id``, ``part`` and ``mask`` of each document.  Texts are read once; slim rows lie in the scratch folder."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "filter-audit")
    text = F.coalesce(docs[text_col], F.lit(""))
    (docs.select(docs[id_col].alias("id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
                 F.unhex(F.sha2(text, 256)).alias("digest"), failures(text).alias("failed"))
     .write.parquet(folder))
    slim = spark.read.parquet(folder)
    groups = (slim.groupBy("digest").agg(F.min("id").alias("least"), F.count("*").alias("rows"))
              .filter("rows > 1"))
    joined = join_by_group(slim, groups, "digest", "rows", slim.count())
    again = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    return joined.select("id", "part", (F.col("failed") + F.when(again, 16).otherwise(0)).alias("mask"))


def cells(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``part``, ``mask``, ``good``, ``toxic`` (0 or 1) and the number ``n`` of documents."""
    marked = (labels.filter("quality = 1 OR toxic = 1").filter(labels[id_col].isNotNull())
              .groupBy(labels[id_col].alias("id"))
              .agg(F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
                   F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic")))
    # rows repeated for an id are one row before they meet the labels
    counted = masks.groupBy("id", "part", "mask").agg(F.count("*").alias("n"))
    return (counted.join(marked, "id", "left")
            .groupBy("part", "mask", F.coalesce("good", F.lit(0)).alias("good"),
                     F.coalesce("toxic", F.lit(0)).alias("toxic"))
            .agg(F.sum("n").alias("n")))


def _bit(order: Column, step: Column) -> Column:
    """The bit of an order's filter at a step (from 1)."""
    return F.call_function("shiftleft", F.lit(1), F.ascii(F.substr(order, step, F.lit(1))) - ord(FILTERS[0]))


def folded(cell: Column, orders: Column) -> Column:
    """A cell's 600 structs: every order's steps, one after the other."""
    mask, n = cell["mask"], cell["n"]

    def step(state: Column, i: Column, order: Column) -> Column:
        bit, before = _bit(order, i), state["before"]
        fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0
        removed = F.when(fails & ~gone, n).otherwise(F.lit(0).cast("long"))
        counts = F.struct(
            F.when(~fails & ~gone, n).otherwise(0).cast("long").alias("kept"),
            removed.alias("removed"),
            F.when(fails & gone, n).otherwise(0).cast("long").alias("redundant"),
            F.when(mask == bit, n).otherwise(0).cast("long").alias("unique_fails"),
            (removed * cell["good"]).cast("long").alias("good_lost"),
            (removed * cell["toxic"]).cast("long").alias("toxic_lost"))
        return F.struct(before.bitwiseOR(bit).alias("before"),
                        F.concat(state["steps"], F.array(counts)).alias("steps"))

    start = F.struct(F.lit(0).alias("before"), F.array().cast(f"array<{_STRUCT}>").alias("steps"))
    every = F.sequence(F.lit(1), F.lit(STEPS))
    return F.flatten(F.transform(orders, lambda o: F.aggregate(
        every, start, lambda state, i: step(state, i, o), lambda state: state["steps"])))


def audit(counted: DataFrame) -> DataFrame:
    """One row per part, order and step from the cells."""
    orders = F.lit(ORDERS)
    zeros = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS]), len(ORDERS) * STEPS)

    def plus(a: Column, b: Column) -> Column:
        return F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])

    # at most 32 masks x good x toxic in a part's list
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))
    merged = parts.select("part", F.aggregate(
        "cells", zeros, lambda acc, cell: F.zip_with(acc, folded(cell, orders), plus)).alias("merged"))
    order = F.element_at(orders, (F.floor(F.col("at") / STEPS) + 1).cast("int"))
    at_step = (F.col("at") % STEPS + 1).cast("int")
    letter = F.substr(order, at_step, F.lit(1))
    removed_by = F.transform(F.lit([ord(f) for f in FILTERS]), lambda f: F.aggregate(
        F.sequence(F.lit(1), F.lit(len(ORDERS) * STEPS)), F.lit(0).cast("long"),
        lambda acc, i: acc + F.when(
            F.ascii(F.substr(F.element_at(orders, F.floor((i - 1) / STEPS).cast("int") + 1),
                             ((i - 1) % STEPS + 1).cast("int"), F.lit(1))) == f,
            F.element_at("merged", i)["removed"]).otherwise(0)))
    shares = merged.select("part", "merged", removed_by.alias("shapley"))
    exploded = shares.select("part", "shapley", F.posexplode("merged").alias("at", "counts"))
    return exploded.select(
        "part", order.alias("filter_order"), at_step.alias("step"), letter.alias("filter"),
        *[F.col(f"counts.{c}").alias(c) for c in COUNTS],
        F.element_at("shapley", F.ascii(letter) - ord(FILTERS[0]) + 1).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """``part``, ``filter_order``, ``step``, ``filter`` (its letter), the six counts and ``shapley``: the documents
    that the filter removes, summed over all orders (a 120th of it is the filter's Shapley value)."""
    return audit(cells(document_masks(docs, id_col, text_col, part_col), labels, id_col))
