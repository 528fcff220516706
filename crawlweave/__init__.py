"""crawlweave: a Spark-native engine that builds text corpora from web-crawl metadata.

Every public operator takes and returns lazy DataFrames; the heavy lifting
(joins, grouping, windows, shuffles) runs on the cluster.  See README.md for
the module map.
"""

from crawlweave.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
