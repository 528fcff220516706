"""Connected components of a link table, by contraction.

Each round links every vertex to its smallest neighbour, follows those links
to their roots by pointer doubling, and renames the links by root; links
within a root go.  The vertices that are left shrink at least by half a
round.  Every round is written to the shared scratch folder, so that a lost
executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweave.session import scratch_dir


def _cut(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def _roots(parent: DataFrame, folder: str, name: str) -> DataFrame:
    """``parent(v, p)`` with p < v or p = v: the root of every v."""
    step = 0
    while True:
        up = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        parent = _cut(parent.join(up, "p", "left").select("v", F.coalesce("pp", "p").alias("p"),
                                                          (F.coalesce("pp", "p") != F.col("p")).alias("moved")),
                      folder, f"{name}-{step}")
        if parent.filter("moved").isEmpty():
            return parent.select("v", "p")
        parent, step = parent.select("v", "p"), step + 1


def connected(links: DataFrame) -> DataFrame:
    """``links(a, b)`` to ``(v, root)``: every vertex that has a link, with the smallest vertex of its component."""
    spark = links.sparkSession
    folder = scratch_dir(spark, "components")
    links = _cut(links.select("a", "b").filter("a <> b"), folder, "links")
    found: DataFrame | None = None
    turn = 0
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("p")).select(
            "v", F.least("v", "p").alias("p"))
        parent = _roots(_cut(parent, folder, f"parent-{turn}"), folder, f"roots-{turn}")
        if found is None:
            found = parent.select("v", F.col("p").alias("root"))
        else:
            up = parent.select(F.col("v").alias("root"), F.col("p").alias("higher"))
            found = _cut(found.join(up, "root", "left").select("v", F.coalesce("higher", "root").alias("root")),
                         folder, f"found-{turn}")
        of_a = parent.select(F.col("v").alias("a"), F.col("p").alias("ra"))
        of_b = parent.select(F.col("v").alias("b"), F.col("p").alias("rb"))
        links = _cut(links.join(of_a, "a").join(of_b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
                     .filter("a <> b").distinct(), folder, f"links-{turn}")
        turn += 1
    if found is None:
        return links.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return found
