"""Exact scans over ordered groups without gathering a group into one task.

Spark's window functions need every row of a window partition in one task;
a snapshot with a third of all rows would then sit in a single task.  These
helpers instead range-partition by (group, order) -- so a large group spreads
over many tasks -- scan each task's rows in order (``mapInPandas``, no
shuffle), and fix up the rows at the start of each task with a carry computed
on a per-task summary.  Only summaries are shuffled; the carry table has at
most one row per task, so broadcasting it is bounded by the task count.

The sorted input is checkpointed (reliable checkpoint in the shared
checkpoint folder) so every pass sees the same partitioning.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from crawlweave.session import checkpoint_root, scratch_dir

PID, POS = "_seq_pid", "_seq_pos"


def _order_cols(order: list) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def sorted_tasks(df: DataFrame, keys: list[str], order: list, n_parts: int | None = None) -> DataFrame:
    """Range-partition by (keys, order), sort inside each task, tag task id and position."""
    spark = df.sparkSession
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(k) for k in keys] + _order_cols(order)
    s = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    s = s.withColumn(PID, F.spark_partition_id()).withColumn(POS, F.monotonically_increasing_id())
    checkpoint_root(spark)
    return s.checkpoint(eager=True)


def _segments(pdf: pd.DataFrame, keys: list[str]) -> pd.Series:
    k = pdf[keys]
    change = (k != k.shift()).any(axis=1)
    return change.cumsum()


def _local_scan(keys: list[str], value: str, out: str, mode: str):
    """Per-task scan in row order: exclusive running sum, or forward fill."""
    def run(batches):
        prev_key, carry = None, None
        for pdf in batches:
            if pdf.empty:
                yield pdf.assign(**{out: pd.Series(dtype="float64")})
                continue
            seg = _segments(pdf, keys)
            first_key = tuple(pdf[keys].iloc[0])
            same = prev_key == first_key
            v = pdf[value]
            if mode == "sum":
                vv = v.fillna(0).astype("int64")
                res = vv.groupby(seg).cumsum() - vv
                if same:
                    res = res.where(seg != 1, res + carry)
                last_total = int(vv[seg == seg.iloc[-1]].sum())
                carry = (carry + last_total) if (same and seg.iloc[-1] == 1) else last_total
                res = res.astype("int64")
            else:
                res = v.groupby(seg).ffill()
                if same and carry is not None:
                    res = res.where(~((seg == 1) & res.isna()), carry)
                last = res[seg == seg.iloc[-1]].dropna()
                if len(last):
                    carry = last.iloc[-1]
                elif not (same and seg.iloc[-1] == 1):
                    carry = None
            prev_key = tuple(pdf[keys].iloc[-1])
            if mode != "sum":
                res = res.astype(object).where(res.notna(), None)
            yield pdf.assign(**{out: res})
    return run


def _with_carry(local: DataFrame, s: DataFrame, keys: list[str], value: str, out: str, mode: str) -> DataFrame:
    """Add the carry from earlier tasks to the first group of each task.

    The per-task summaries come from the sorted input ``s`` (not from the
    Python scan ``local``), so the scan runs once.
    """
    first_key = (
        s.groupBy(PID).agg(F.min_by(F.struct(*keys), F.col(POS)).alias("k"))
        .select(PID, *[F.col("k")[c].alias(c) for c in keys])
    )
    if mode == "sum":
        per_task = s.groupBy(PID, *keys).agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias("t"))
        w = Window.partitionBy(*keys).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
        carried = per_task.select(PID, *keys, F.coalesce(F.sum("t").over(w), F.lit(0)).alias("carry"))
    else:
        per_task = s.groupBy(PID, *keys).agg(
            F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(POS))).alias("t"))
        w = Window.partitionBy(*keys).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
        carried = per_task.select(PID, *keys, F.last("t", ignorenulls=True).over(w).alias("carry"))
    # only the first group of each task can continue from earlier tasks: <= one row per task
    carry = carried.join(first_key, [PID] + keys, "left_semi")
    j = local.join(F.broadcast(carry), [PID] + keys, "left")
    if mode == "sum":
        res = F.col(out) + F.coalesce(F.col("carry"), F.lit(0))
    else:
        res = F.coalesce(F.col(out), F.col("carry"))
    return j.withColumn(out, res.cast(local.schema[value].dataType if mode == "ffill" else "long")).drop("carry")


def segmented_cumsum(df: DataFrame, keys: list[str], order: list, value: str, out: str,
                     n_parts: int | None = None) -> DataFrame:
    """``out`` = sum of ``value`` over the earlier rows of the same ``keys`` group (by ``order``)."""
    s = sorted_tasks(df, keys, order, n_parts)
    schema = T.StructType(s.schema.fields + [T.StructField(out, T.LongType())])
    local = s.mapInPandas(_local_scan(keys, value, out, "sum"), schema)
    return _with_carry(local, s, keys, value, out, "sum").drop(PID, POS)


def segmented_ffill(df: DataFrame, keys: list[str], order: list, value: str, out: str,
                    n_parts: int | None = None) -> DataFrame:
    """``out`` = last non-NULL ``value`` at or before each row in its ``keys`` group."""
    s = sorted_tasks(df, keys, order, n_parts)
    schema = T.StructType(s.schema.fields + [T.StructField(out, s.schema[value].dataType)])
    local = s.mapInPandas(_local_scan(keys, value, out, "ffill"), schema)
    return _with_carry(local, s, keys, value, out, "ffill").drop(PID, POS)


def row_index(df: DataFrame, keys: list[str], order: list, out: str = "idx",
              n_parts: int | None = None) -> DataFrame:
    """0-based position of each row in its group (a distributed zipWithIndex).

    The sorted rows are written once to the shared scratch folder with their
    task and place (for slim rows); a position is the group's rows in earlier
    tasks plus the place in its own.  One row per task and group is summed up.
    """
    spark = df.sparkSession
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(k) for k in keys] + _order_cols(order)
    folder = scratch_dir(spark, "row-index")
    (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
     .withColumn(PID, F.spark_partition_id()).withColumn(POS, F.monotonically_increasing_id()).write.parquet(folder))
    s = spark.read.parquet(folder)
    tasks = s.groupBy(*keys, PID).agg(F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_first"))
    before = Window.partitionBy(*keys).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    shifts = tasks.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(PID).alias("_p"),
                          (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    same = s[PID] == shifts["_p"]
    for i, k in enumerate(keys):
        same &= s[k].eqNullSafe(shifts[f"_k{i}"])
    return s.join(shifts, same).select(*df.columns, (F.col(POS) + F.col("_shift")).alias(out))


def comparable(value):
    """A value that Python orders as Spark does: nulls first, structs field by field."""
    if isinstance(value, dict):
        return True, tuple(comparable(v) for v in value.values())
    return value is not None, value


def spread_by_range(df: DataFrame, cols: list[str], n: int, per_task: int = 40) -> DataFrame:
    """``df`` in ``n`` partitions by ranges of ``cols``, sorted within.

    Like ``repartitionByRange``, but the ranges come from a sample of the slim
    keys (``per_task`` of each task, weighed by its rows): the other columns
    are not computed for it.
    """
    spark = df.sparkSession
    keys = df.select(F.struct(*cols).alias("k"))

    def draw(batches):
        rng, kept, seen = np.random.default_rng(per_task), [], 0
        for batch in batches:
            for value in batch.column("k").to_pylist():
                seen += 1
                if len(kept) < per_task:
                    kept.append(value)
                elif (at := int(rng.integers(seen))) < per_task:
                    kept[at] = value
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(kept, arrow.field("k").type),
                                              pa.array([seen / len(kept)] * len(kept))], names=["k", "weight"])

    schema = T.StructType([keys.schema["k"], T.StructField("weight", T.DoubleType())])
    arrow = to_arrow_schema(schema)
    drawn = keys.mapInArrow(draw, schema).toArrow().to_pylist()  # per_task slim keys of each task
    drawn = sorted((comparable(r["k"]), r["weight"]) for r in drawn)
    whole, sum_, bounds = sum(w for _, w in drawn), 0.0, []
    for key, weight in drawn:
        sum_ += weight
        if len(bounds) < n - 1 and sum_ >= whole * (len(bounds) + 1) / n:
            bounds.append(key)
    place = udf_of(lambda key: bisect.bisect_left(bounds, key), T.IntegerType())
    return (df.withColumn(PID, place(F.struct(*cols))).repartitionById(n, F.col(PID)).drop(PID)
            .sortWithinPartitions(*cols))


def udf_of(f, kind: T.DataType):
    """An Arrow UDF that applies ``f`` to each comparable value of a struct column."""
    def run(keys: pa.Array) -> pa.Array:
        return pa.array([f(comparable(k)) for k in keys.to_pylist()], to_arrow_type(kind))

    run.__annotations__ = {"keys": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, kind)


def first_rows(df: DataFrame, order: list, limit: int, n_parts: int | None = None) -> DataFrame:
    """The first ``limit`` rows in the order (which must be unique), spread over the tasks that hold them."""
    from crawlweave.operators.selection import first_rows as select_first

    return select_first(df, order, int(limit))
