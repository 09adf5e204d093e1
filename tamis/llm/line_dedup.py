"""Line dedup by site-relative frequency: a line that too large a share of a host's pages carry is boilerplate and goes.

Only built-in functions are used. Lines are counted by two 64-bit hashes, so the shuffle carries no text; the lines to drop
are few per host (at most the mean lines per page over the ratio) and reach the pages as one small row per host, broadcast if
their measured size allows it, else by a join whose host key is salted. A page's lines are matched against its host's list by
one hash intersection, so the time is in proportion to lines plus list, not to their product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import cols, join_small, stash, unused

RATIO = 0.08
LEAST_PAGES = 3


def _line_key(line: Column) -> Column:
    """128 bits that stand for a line, or a text."""
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(7), line).alias("h2"))


def boilerplate_lines(pages: DataFrame, host_col: str, text_col: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES, copies_once: bool = False) -> DataFrame:
    """(host, drop array<struct<h1, h2>>): the lines of each host that more than ratio of its pages, and at least least_pages, carry. Empty lines never count. With copies_once, pages of one host with the same text are one page."""
    text = F.col(f"`{text_col}`")
    host = F.col(f"`{host_col}`").cast("string").alias("host")
    page = [_line_key(text).alias("page")] if copies_once else []
    own = pages.select(host, *page)
    totals = (own.distinct() if copies_once else own).groupBy("host").agg(F.count("*").alias("pages"))
    lines = F.filter(F.array_distinct(F.split(text, "\n", -1)), lambda x: x != "")
    seen = pages.select(host, *page, F.explode(lines).alias("line")).select("host", _line_key(F.col("line")).alias("key"), *(["page"] if copies_once else []))
    seen = seen.distinct() if copies_once else seen
    often = seen.groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    # null hosts are one host
    common = often.join(totals.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).where(F.col("n") > F.lit(ratio) * F.col("pages"))
    return common.groupBy("host").agg(F.collect_list("key").alias("drop"))


def drop_boilerplate(pages: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES, copies_once: bool = False) -> DataFrame:
    """The pages with text_col cleared of boilerplate lines, plus n_lines and n_dropped (bigint).

    Every row stays, repeated rows included, with all its other columns. A line goes where the pages of the same host that
    carry it are more than `ratio` of the host's pages and at least `least_pages`; a page counts once however often it repeats
    the line, and with copies_once so do all pages of the host with the same text, so that copies alone make no line
    boilerplate. Lines are split at \\n and rejoined with it; empty lines stay. Null text stays null with 0 lines; null hosts
    form one host; a page of which all lines go has the empty text. An empty table gives no rows. Columns named n_lines or
    n_dropped are replaced; all other names are the caller's.
    """
    common = boilerplate_lines(pages, host_col, text_col, ratio, least_pages, copies_once)
    names = [c for c in pages.columns if c.lower() not in ("n_lines", "n_dropped")]
    host, none, gone, lines, hit, kept = unused(names, "_host", "_none", "_gone", "_lines", "_hit", "_kept")
    common = stash(common.select(F.coalesce("host", F.lit("")).alias(host), F.col("host").isNull().alias(none), F.col("drop").alias(gone)), "boilerplate")
    keyed = pages.select(*cols(names), F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("")).alias(host), F.col(f"`{host_col}`").isNull().alias(none))
    text = F.col(f"`{text_col}`")
    met = join_small(keyed, common, [host, none], F.xxhash64(text)).withColumn(lines, F.split(text, "\n", -1))
    # of the host's list, what this page has by its first hash
    here = F.array_intersect(F.transform(lines, lambda x: F.xxhash64(x)), F.transform(gone, lambda g: g["h1"]))
    met = met.withColumn(hit, F.when(F.col(gone).isNotNull(), here))
    exact = F.filter(gone, lambda g: F.array_contains(hit, g["h1"]))
    met = met.withColumn(hit, F.when(F.size(hit) > 0, exact))
    left = F.when(F.col(hit).isNull(), F.col(lines)).otherwise(F.filter(lines, lambda x: ~F.coalesce(F.array_contains(hit, _line_key(x)), F.lit(False)) | (x == "")))
    met = met.withColumn(kept, left)
    clean = F.when(F.col(hit).isNull(), text).otherwise(F.array_join(kept, "\n"))
    count = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).cast("bigint")
    return met.select(*(clean.alias(c) if c.lower() == text_col.lower() else F.col(f"`{c}`") for c in names), count(lines).alias("n_lines"), (count(lines) - count(kept)).alias("n_dropped"))
