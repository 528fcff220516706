"""The first n rows of an order by distributed selection: nothing is sorted or gathered.

The n-th key is found by refining a count histogram.  A round draws a bounded
sample of the keys in the interval that holds the n-th, takes splitters around
its place there, and counts the keys between them; the interval shrinks to a
few thousandths each time.  Once it holds at most ``LAST`` keys those are
looked at themselves.  The rows up to the n-th key are then a filter on the
input, which stays in its partitions.  Only keys are read, from a persisted
slim copy; samples, counts and the last interval are of bounded size.

Groups (the first n rows of each) are refined together, a row per open group.
Keys compare as Spark orders structs: ascending, nulls first.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys of an interval that are looked at themselves, and drawn for the next splitters.
LAST = 10_000
SAMPLE = 2_000
#: Up to so many rows each task just hands on its own first keys.
TOP = 1_000


@dataclass
class _Interval:
    """Where a group's n-th key is: above ``low``, up to ``high``, the ``need``-th of ``size`` keys."""

    need: int
    size: int
    low: Any = None
    high: Any = None
    found: Any = None


def _splitters(sample: list, interval: _Interval) -> list:
    """Sampled keys around the wanted place, closer together the nearer they are to it."""
    middle = int(interval.need / interval.size * len(sample))
    places, step = {middle}, 1
    while step < len(sample):
        places |= {middle - step, middle + step}
        step *= 2
    out: list = []
    for i in sorted(p for p in places if 0 <= p < len(sample)):
        if not out or sample[i] != out[-1]:
            out.append(sample[i])
    return out


def _inside(keys: DataFrame, open_: dict, schema: T.StructType, **more) -> DataFrame:
    """The keys in their group's interval; ``more``: name -> (type, value by group) to go with them."""
    kinds, values = [k for k, _ in more.values()], [v for _, v in more.values()]
    bounds = keys.sparkSession.createDataFrame(
        [(g, i.low, i.high, *[v[g] for v in values]) for g, i in open_.items()],
        T.StructType([T.StructField("g", schema["g"].dataType), T.StructField("low", schema["k"].dataType),
                      T.StructField("high", schema["k"].dataType),
                      *[T.StructField(n, t) for n, t in zip(more, kinds, strict=True)]]))
    above = F.col("low").isNull() | (F.col("k") > F.col("low"))
    below = F.col("high").isNull() | (F.col("k") <= F.col("high"))
    # one row per group that is still open
    return keys.join(F.broadcast(bounds), keys["g"].eqNullSafe(bounds["g"])).filter(above & below).drop(bounds["g"])


def nth_keys(df: DataFrame, groups: list[str], order: list[str], n: int, last: int = LAST,
             sample: int = SAMPLE) -> dict[Row, Any]:
    """The n-th key (a row of the order's columns) of every group with more than ``n`` rows."""
    group = F.struct(*groups) if groups else F.struct(F.lit(0).alias("all"))
    keys = df.select(group.alias("g"), F.struct(*order).alias("k")).persist()
    try:
        counted = keys.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > n).collect()
        intervals = {r.g: _Interval(n, r.n) for r in counted}
        seed = 1
        while wide := {g: i for g, i in intervals.items() if i.found is None and i.size > last}:
            rates = {g: min(1.0, sample / i.size) for g, i in wide.items()}
            drawn = _inside(keys, wide, keys.schema, rate=(T.DoubleType(), rates)).filter(F.rand(seed) < F.col("rate"))
            seed += 1
            found: dict = {g: [] for g in wide}
            for r in drawn.select("g", "k").orderBy("g", "k").collect():
                found[r.g].append(r.k)
            cuts = {g: _splitters(found[g], i) for g, i in wide.items()}
            at = F.size(F.filter("cuts", lambda c: c < F.col("k")))
            parts = (_inside(keys, wide, keys.schema, cuts=(T.ArrayType(keys.schema["k"].dataType), cuts))
                     .groupBy("g", at.alias("at")).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("least"),
                                                       F.max("k").alias("most")).collect())
            for g, i in wide.items():
                before = 0
                for r in sorted((r for r in parts if r.g == g), key=lambda r: r["at"]):
                    if before + r.n >= i.need:
                        i.low = cuts[g][r["at"] - 1] if r["at"] > 0 else i.low
                        i.high = cuts[g][r["at"]] if r["at"] < len(cuts[g]) else i.high
                        i.need, i.size = i.need - before, r.n
                        i.found = r.most if r.least == r.most else None  # ties
                        break
                    before += r.n
        if narrow := {g: i for g, i in intervals.items() if i.found is None}:
            needs = {g: i.need for g, i in narrow.items()}
            rows = (_inside(keys, narrow, keys.schema, need=(T.IntegerType(), needs)).groupBy("g")
                    .agg(F.element_at(F.sort_array(F.collect_list("k")), F.any_value("need")).alias("k")).collect())
            for r in rows:
                intervals[r.g].found = r.k
        return {g: i.found for g, i in intervals.items()}
    finally:
        keys.unpersist()


def _literal(value: Any, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType) and value is not None:
        return F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields, strict=True)])
    return F.lit(value).cast(kind)


def first_rows(df: DataFrame, order: list[str], n: int, last: int = LAST, sample: int = SAMPLE,
               top: int = TOP) -> DataFrame:
    """The first ``n`` rows in the order (which must be unique), where they are.

    Up to ``top`` rows the n-th key is the last of the first n keys, of which
    every task hands on its own first n; beyond, it is found by rounds of counting.
    """
    if n <= 0:
        return df.where(F.lit(False))
    if n <= top:
        first = df.select(F.struct(*order).alias("k")).orderBy("k").limit(n).collect()
        found = [r.k for r in first[n - 1:]]
    else:
        found = list(nth_keys(df, [], order, n, last, sample).values())
    if not found:
        return df  # no more than n rows
    key = found[0]
    cut = F.struct(*order) <= _literal(key, T.StructType([df.schema[c] for c in order]))
    first = df.schema[order[0]]
    if not isinstance(first.dataType, T.StructType) and key[0] is not None:
        # implied by the cut, but readers can use it to pass over whole files and row groups
        cut &= F.col(first.name).isNull() | (F.col(first.name) <= F.lit(key[0]).cast(first.dataType))
    return df.where(cut)


def first_rows_of_each(df: DataFrame, groups: list[str], order: list[str], n: int, last: int = LAST,
                       sample: int = SAMPLE) -> DataFrame:
    """The first ``n`` rows of each group (the order must be unique in it), where they are.

    One row per group with more than ``n`` rows comes to the driver and is
    broadcast: for groups that are few, as crawl snapshots are.
    """
    if n <= 0:
        return df.where(F.lit(False))
    found = nth_keys(df, groups, order, n, last, sample)
    if not found:
        return df
    kinds = T.StructType([T.StructField("_g", T.StructType([df.schema[c] for c in groups])),
                          T.StructField("_last", T.StructType([df.schema[c] for c in order]))])
    ends = df.sparkSession.createDataFrame(list(found.items()), kinds)
    marked = df.join(F.broadcast(ends), F.struct(*groups).eqNullSafe(F.col("_g")), "left")
    return marked.where(F.col("_last").isNull() | (F.struct(*order) <= F.col("_last"))).drop("_g", "_last")
