"""HTML extraction from archive byte ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweave.operators import state as ST


def ready_archives(state: DataFrame) -> DataFrame:
    """Distinct archive names of rows ready for extraction."""
    return ST.ready(state).select("filename").distinct()


def write_path_file(state: DataFrame, path: str) -> None:
    """K4: the distinct ready archive names, sorted, one per line.

    Written by a global sort: the part files under ``path`` are range
    partitions, so reading them in file-name order gives the sorted list
    (no single writer task).
    """
    ready_archives(state).orderBy("filename").write.mode("overwrite").text(path)


def plan_extraction(state: DataFrame, present: DataFrame, limit_archives: int | None = None) -> DataFrame:
    """Ready rows whose archive exists (J10), optionally only the first
    ``limit_archives`` archives by name (O5)."""
    rows = ST.range_plan(ST.ready(state))
    rows = rows.join(present.select("archive"), "archive", "left_semi")
    if limit_archives is not None:
        first = rows.select("archive").distinct().orderBy("archive").limit(int(limit_archives))
        rows = rows.join(first, "archive", "left_semi")
    return rows


def extract_html(rows: DataFrame, archive_root: str, key_cols: list[str], check_target: bool = True) -> DataFrame:
    """S5 + P23: ``key_cols, html, error`` per row (html NULL when the row failed)."""
    from crawlweave.functions import scalars as S
    from crawlweave.sources import warc as W

    got = W.read_ranges(rows, archive_root, key_cols, check_target)
    return got.select(*key_cols, S.bytes_to_text("payload").alias("html"), "error")


def extract_to_table(rows: DataFrame, archive_root: str, key_cols: list[str], path: str,
                     check_target: bool = True) -> DataFrame:
    """``extract_html`` written once to ``path`` (shared folder) and read back, with what a page's name is made of.

    The events and the HTML table are projections of it: archives are read
    and decoded once, and no page is joined.
    """
    carried = list(dict.fromkeys([*key_cols, "snapshot_name", "url_raw", "digest"]))
    extract_html(rows, archive_root, carried, check_target).write.mode("overwrite").parquet(path)
    schema = rows.select(*carried).withColumn("html", F.lit("")).withColumn("error", F.lit("")).schema
    return rows.sparkSession.read.schema(schema).parquet(path)


def _saved_path() -> F.Column:
    from crawlweave.functions import scalars as S

    return F.concat(F.lit("html/"), F.col("snapshot_name"), F.lit("/"), S.safe_filename("url_raw", "digest"),
                    F.lit(".html"))


def extraction_events(results: DataFrame, key_cols: list[str], seq: int) -> DataFrame:
    """K9/K10 state events out of extraction results."""
    ok = F.col("error").isNull()
    return results.select(
        *key_cols,
        F.lit(seq).cast("long").alias("seq"),
        F.when(ok, F.lit("downloaded")).otherwise(F.lit("error")).alias("kind"),
        F.lit(None).cast("string").alias("filename"),
        F.lit(None).cast("long").alias("offset"),
        F.lit(None).cast("long").alias("length"),
        F.when(ok, _saved_path()).alias("saved_path"),
        F.when(~ok, F.col("error")).alias("message"),
    )


def html_table(results: DataFrame, key_cols: list[str]) -> DataFrame:
    """K3: ``snapshot_name, saved_path, html`` of the saved pages (one row per URL row)."""
    return results.where(F.col("error").isNull()).select(
        *key_cols, "snapshot_name", _saved_path().alias("saved_path"), "html")
