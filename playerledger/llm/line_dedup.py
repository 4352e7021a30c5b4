"""Line dedup by site-relative frequency.

Lines are counted once per page within their host; a line that stands on more
than ``max_ratio`` of the host's pages (and on ``min_pages`` at least) is
boilerplate and is dropped from every page of that host.

Only 16-byte line keys are shuffled, aggregated before the shuffle.  What a host
drops is small whatever its size: it has at most
``mean lines per page / max_ratio`` such lines, so the per-host lists joined to
the pages are bounded, and a hot host is split by the skew join or not shuffled
at all (Spark broadcasts the lists when their stored size is small).

Column expressions and joins only, no Python.

Defined results for odd input: a null host belongs to no site, its pages keep
every line; null text stays null and counts as a page; empty lines are never
dropped; a line repeated in one page counts once and is dropped everywhere; lines
are compared with outer white space removed; a repeated row counts as another
page; ids are not used; empty tables and clashing column names are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerledger.llm.common import SPACE, free_name, stored, with_new

MAX_RATIO = 0.1
MIN_PAGES = 3


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line, F.lit(SPACE))))


def has_word(line: Column) -> Column:
    return F.trim(line, F.lit(SPACE)) != ""


def boilerplate(pages: DataFrame, host: str, text: str,
                max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, keys): the keys of the lines each host drops."""
    site = pages.select(F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").alias("text")).filter("host is not null")
    totals = site.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = site.select("host", F.explode(F.array_distinct(F.transform(
        F.filter(F.split("text", "\n", -1), has_word), line_key))).alias("key"))
    counts = lines.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    return (counts.join(totals, "host").filter(F.col("n") > max_ratio * F.col("pages"))
            .groupBy("host").agg(F.collect_list("key").alias("keys")))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text",
                     max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with ``n_lines``, ``n_dropped`` and ``clean_text``."""
    at, keys = free_name(pages, "site_host"), free_name(pages, "site_keys")
    # a table of its own: its size is known before the join, and the join's sides can be dealt anew
    drops = stored(boilerplate(pages, host, text, max_ratio, min_pages).toDF(at, keys), "boilerplate")
    joined = pages.join(drops, pages[f"`{host}`"] == drops[at], "left")
    lines = F.split(F.col(f"`{text}`"), "\n", -1)
    left = F.filter(lines, lambda x: ~has_word(x) | ~F.array_contains(F.col(keys), line_key(x)))
    found = F.when(F.col(keys).isNull(), lines).otherwise(left)
    out = with_new(joined, n_lines=F.coalesce(F.size(lines), F.lit(0)).cast("long"), __left=found)
    out = with_new(out, n_dropped=F.when(F.col("__left").isNull(), F.lit(0).cast("long"))
                   .otherwise(F.col("n_lines") - F.size("__left")), clean_text=F.array_join("__left", "\n"))
    return out.drop("__left", at, keys)


def without_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", chars: str = "n_chars") -> DataFrame:
    """``docs`` in their own columns, the text without its site's boilerplate lines."""
    out = drop_boilerplate(docs, host, text)
    new = {text: F.col("clean_text")}
    if chars in docs.columns:
        new[chars] = F.when(F.col("n_dropped") > 0, F.length("clean_text").cast("long")).otherwise(F.col(f"`{chars}`"))
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
