"""Line dedup by site-relative frequency: a line that more than a given share of a host's pages contain is boilerplate.

A page is a different text of its host: copies of a page are no reason to call its lines boilerplate, whoever counts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import SPACES, free, numbered, text_or_empty

#: Share of a host's pages above which a line is boilerplate. In the test tables the footer of a host is on 8 to 16 in a hundred of
#: its different pages, the next line of any host on fewer than 5.
RATIO = 0.06
#: Different pages that must contain a line at least: two that share lines may be near copies of each other.
MIN_PAGES = 3


def _line(line: Column) -> Column:
    return F.trim(line, F.lit(SPACES))


def _key(line: Column) -> Column:
    """128 bits for a line, so that lines of a huge table do not meet by chance."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _keys(text: Column) -> Column:
    """The keys of a page's distinct lines; blank lines are no lines."""
    return F.array_distinct(F.transform(F.filter(F.transform(F.split(text, "\n", -1), _line), lambda x: x != ""), _key))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``_host``, ``_key`` and ``n_pages`` of the lines on more than ``ratio`` of their host's pages, and on ``min_pages`` at least.

    A page counts once for a line however often it has it. Pages and counts are put together in the map tasks first, so a
    host, a page or a line that holds a third of all rows moves a few rows a task. Null hosts are one host, and a null text is
    an empty one. A line on exactly ``ratio`` of the pages stays.
    """
    pages = docs.select(F.col(f"`{host}`").cast("string").alias("_host"), _key(text_or_empty(f"`{text}`")).alias("_page"),
                        _keys(text_or_empty(f"`{text}`")).alias("_keys")).dropDuplicates(["_host", "_page"])
    totals = pages.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    counts = pages.select("_host", F.explode("_keys").alias("_key")).groupBy("_host", "_key").agg(F.count(F.lit(1)).alias("n_pages"))
    often = counts.filter(F.col("n_pages") >= min_pages)
    same = often["_host"].eqNullSafe(totals["_host"])
    return often.join(totals, same).filter(F.col("n_pages") > F.col("_pages") * F.lit(ratio)).select(often["_host"], "_key", "n_pages")


def _kept(text: Column, drops: str) -> Column:
    """The lines that stay, as they were and in order."""
    keep = F.filter(F.split(text, "\n", -1), lambda x: ~F.array_contains(F.col(drops), _key(_line(x))))
    return F.when(F.col(drops).isNull(), text).otherwise(F.array_join(keep, "\n"))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; every row and column stays, in the order of columns given, whatever
    the names.

    A null text stays null, an empty one empty, an empty table empty. Blank lines are never dropped. Repeated rows lose the
    same lines and count as one page. Texts of any length are judged whole. Rows are numbered and written once, so that lines
    and texts meet again whatever becomes of the cluster in between.
    """
    row, drops = free(docs, "_row"), free(docs, "_drops")
    whole = numbered(docs, row)
    dropped = boilerplate(whole, host, text, ratio, min_pages).drop("n_pages")
    lines = whole.select(F.col(row).alias("_of"), F.col(f"`{host}`").cast("string").alias("_on"), F.explode(_keys(text_or_empty(f"`{text}`"))).alias("_line"))
    hit = lines.join(dropped, (lines["_line"] == dropped["_key"]) & lines["_on"].eqNullSafe(dropped["_host"]), "left_semi")
    gone = hit.groupBy(F.col("_of").alias(row)).agg(F.collect_set("_line").alias(drops))
    out = whole.join(gone, row, "left")
    return out.select(*[(_kept(F.col(f"`{c}`"), drops) if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns])
