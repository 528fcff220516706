"""HTML -> markdown with a metadata header (U3), and the blocks behind it.

A page is read in one pass by ``blocks.py``: an Arrow UDF over the HTML column
alone; all other columns stay in the JVM.  The main content is chosen by block
scores (text and link density) and by the page's own structure: an article or
main element that holds most of the text, no navigation, footers, asides or
advertisements.  Headings become ``#`` lines, list items ``-`` or ``1.`` lines
indented by their nesting, table rows ``|`` lines, quotes ``>`` lines, code
blocks fences with their white space kept; links, images, bold, italic and code
their markdown; ``<br>`` and line feeds of the source line breaks.  Entities are
decoded (numeric ones and HTML's names, with their semicolon), other white
space tidied.  A header holds ``title:``, ``author:`` and ``description:`` where
the page states them.  NULL when the HTML is NULL or empty, no text is left or
a page cannot be read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.functions import blocks as B

BLOCK = T.StructType([
    T.StructField("block", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("text_chars", T.LongType()),
    T.StructField("link_chars", T.LongType()),
    T.StructField("text_density", T.DoubleType()),
    T.StructField("link_density", T.DoubleType()),
    T.StructField("kept", T.BooleanType()),
    T.StructField("markdown", T.StringType()),
])


def markdown(html: Column, th_headers: bool = False) -> Column:
    """The page as markdown.

    A table row in ``<thead>`` gets a delimiter line; with ``th_headers`` so
    does a first row of ``<th>`` cells.
    """
    def convert(pages: pa.Array) -> pa.Array:
        return pa.array([_safely(B.markdown_of, x, th_headers) for x in pages.to_pylist()], pa.string())

    convert.__annotations__ = {"pages": pa.Array, "return": pa.Array}
    return F.arrow_udf(convert, T.StringType())(html)


def blocks(html: Column) -> Column:
    """The page's blocks in order (an array of BLOCK): tag, depth, sizes, densities, verdict and markdown."""
    def convert(pages: pa.Array) -> pa.Array:
        from pyspark.sql.pandas.types import to_arrow_type

        return pa.array([_safely(_listed, x) for x in pages.to_pylist()], to_arrow_type(T.ArrayType(BLOCK)))

    convert.__annotations__ = {"pages": pa.Array, "return": pa.Array}
    return F.arrow_udf(convert, T.ArrayType(BLOCK))(html)


def _listed(html: str | None) -> list[dict] | None:
    if not html:
        return None
    return [{"block": i, "tag": b.tag, "depth": b.depth, "text_chars": b.text_chars, "link_chars": b.link_chars,
             "text_density": b.text_density, "link_density": b.link_density, "kept": b.kept,
             "markdown": b.markdown} for i, b in enumerate(B.page_of(html)[0], 1)]


def _safely(f, *args):
    """None for a page that cannot be read: one page never fails its task."""
    try:
        return f(*args)
    except (ValueError, IndexError, KeyError, RecursionError):
        return None


def with_markdown(df: DataFrame, html: str = "html", out: str = "markdown", th_headers: bool = False) -> DataFrame:
    """``df`` plus a ``markdown`` column."""
    return df.withColumn(out, markdown(F.col(html), th_headers))


def page_blocks(df: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """One row per block of each page: the ``keep`` columns (by default all but the HTML), then those of BLOCK."""
    names = [c for c in df.columns if c != html] if keep is None else keep
    made = df.select(*[F.col(c) for c in names], F.explode(blocks(F.col(html))).alias("__block"))
    return made.select(*names, "__block.*")
