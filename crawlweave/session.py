"""Session defaults and the shared scratch folder.

Scratch data (checkpoints, fixture shards, intermediate tables) always lives
under the folder the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is absent (local tests) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every entry point relies on.  The time zone matters for semantics:
# capture timestamps and WARC dates are both read as UTC.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # pre-filter the big side of selective joins (capture index vs. our URLs)
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # pages handed to a Python worker at once: by bytes, whatever their number
    "spark.sql.execution.arrow.maxBytesPerBatch": "32m",
}


def apply_session_conf(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def get_spark(master: str | None = None, app_name: str = "crawlweave",
              shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **SESSION_CONF,
        **(extra or {}),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_session_conf(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Read from the session; set our own only when the cluster named none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="crawlweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root.

    It belongs to the innermost ``scratch_scope`` around the call; without
    one, to the caller, whose lazy results may still read it.
    """
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    made = _SCOPE.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope():
    """Remove the scratch folders made inside at its end; results that are used later must not read them."""
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        delete_folders(*made)


def cut_lineage(df, name: str):
    """``df`` written once to a scratch folder and read back."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(df):
    """A few rows brought to the driver, as a table that reads nothing any more (counts and summaries)."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def delete_folders(*paths: str) -> None:
    """Remove scratch folders that nothing reads any more; one that is not there is passed over."""
    from pyarrow import fs as pafs

    for path in paths:
        filesystem, inner = filesystem_for(path)
        if filesystem.get_file_info(inner).type == pafs.FileType.Directory:
            filesystem.delete_dir(inner)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs can use the path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def is_local_fs(path: str) -> bool:
    return path.startswith("file:") or "://" not in path


def ensure_local_dir(path: str) -> None:
    if is_local_fs(path):
        os.makedirs(local_path(path), exist_ok=True)


def filesystem_for(path: str):
    """(pyarrow FileSystem, path inside it) for a local path or any URI
    (``file:/x``, ``file:///x``, ``s3://...``, ``hdfs://...``).

    As for Spark, the path is what it says: a space or ``%`` in it stands for itself.
    """
    from urllib.parse import quote

    from pyarrow import fs as pafs

    if is_local_fs(path):
        return pafs.LocalFileSystem(), os.path.abspath(local_path(path))
    scheme, rest = path.split("://", 1)
    return pafs.FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/:@?=&+,;~')}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``crawlweave`` importable in executor Python workers (once per application).

    The package is zipped on the driver and handed out by Spark with
    ``addPyFile`` -- the in-session equivalent of ``--py-files``.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no SparkContext
        sc, app = None, f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    local_zip = os.path.join(tempfile.mkdtemp(prefix="crawlweave-pkg-"), "crawlweave.zip")
    with zipfile.ZipFile(local_zip, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    if sc is not None:
        sc.addPyFile(local_zip)
    else:
        spark.addArtifacts(local_zip, pyfile=True)
    _SHIPPED.add(app)


def file_path_of(metadata_path):
    """Column: Spark's ``_metadata.file_path`` (an encoded URI) as the plain path that listings report."""
    from pyspark.sql import functions as F

    return F.url_decode(F.replace(metadata_path, F.lit("+"), F.lit("%2B")))


def path_below(path_col, root: str):
    """Column: the part of a file path (as Spark reports it, a URI) below ``root``.

    ``root`` may be a plain path or a URI (``file:``, ``s3a://bucket``...);
    its scheme and authority are dropped and its full path is matched, so
    a folder name repeated higher up cannot confuse the match.
    """
    import re

    from pyspark.sql import functions as F

    root_path = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/")
    return F.regexp_extract(path_col, r"\Q" + root_path + r"\E/(.*)$", 1)
