"""Site-relative line dedup: lines that many pages of one site carry are boilerplate.

A page is a row, its site the host column. For each (host, line) the pages that contain the line are divided by the host's
pages, and the line goes from every page of the host if that is more than the ratio. Pages with the same text count as one,
so a page that was copied often does not make its own lines boilerplate; and a line must be on two of them at least, since a
line of a single page repeats nothing. Only hashes of lines and texts are shuffled; counting spreads over host, line and
text first, so neither a hot host nor a line on all its pages comes to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formtide.llm.common import let, text_of
from formtide.operators.sizing import broadcast_if_small
from formtide.session import materialize

#: A line on more than this share of a host's pages is boilerplate.
RATIO = 0.1


def _hashes(value: Column) -> Column:
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit(1), value).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate_lines(docs: DataFrame, host: str, ratio: float = RATIO) -> DataFrame:
    """(host, line key, pages, total) of each boilerplate line. A null host is the host of the empty name."""
    text = text_of()
    pages = docs.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), _hashes(text).alias("page"), text.alias("text"))
    totals = pages.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("total"))
    solid = F.filter(_lines(F.col("text")), lambda x: F.trim(x) != "")
    lines = pages.select("host", "page", F.explode(F.array_distinct(F.transform(solid, lambda x: _hashes(F.trim(x))))).alias("line"))
    counts = lines.distinct().groupBy("host", "line").agg(F.count("*").alias("pages")).filter("pages > 1")
    return counts.join(totals, "host").filter(F.col("pages") > ratio * F.col("total"))


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, counts: bool = False) -> DataFrame:
    """``docs`` without boilerplate lines in ``text``; with ``counts`` also n_lines and n_dropped.

    Lines are parted by line feeds and compared without blanks at their ends; blank lines are never counted or dropped. A
    page that is nothing but boilerplate keeps its blank lines. Null texts stay null with zero counts; repeated rows are one
    page; columns called as the counts are replaced.

    A host has fewer than (lines of a mean page) / ratio boilerplate lines, so they are gathered per host as one array
    of bounded length that joins the pages by host. A page's lines meet that array by hashing, not one by one.
    """
    site = F.coalesce(F.col(host).cast("string"), F.lit(""))
    found = boilerplate_lines(docs, host, ratio)
    per_host = found.groupBy("host").agg(F.collect_set("line").alias("known"))
    per_host = broadcast_if_small(materialize(per_host, "boilerplate"))  # measured; shuffled beyond the bound
    added = ("n_lines", "n_dropped")
    names = [c for c in docs.columns if not (counts and c in added)]
    row = F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")
    pages = docs.select(row, site.alias("host"), text_of().alias("text")).join(per_host, "host", "left")
    known = F.coalesce(F.col("known"), F.array().cast("array<struct<a:bigint,b:bigint>>"))
    bare = F.transform(_lines(F.col("text")), lambda x: F.trim(x))
    # Of the host's lines those whose first hash is on this page: few, and found by hashing.
    shared = F.array_intersect(F.transform(bare, lambda x: F.xxhash64(x)), known["a"])
    pages = pages.select("row", "text", F.when(F.size(known) > 0, shared).alias("shared"), known.alias("known"))
    near = F.filter("known", lambda k: F.array_contains("shared", k["a"]))
    pages = pages.select("row", "text", F.when(F.size("shared") > 0, near).alias("near"))

    def flag(line: Column) -> Column:
        solid = F.trim(line) != ""
        hit = F.when(solid & F.col("near").isNotNull(), F.array_contains("near", _hashes(F.trim(line)))).otherwise(F.lit(False))
        return F.struct(line.alias("line"), solid.alias("solid"), hit.alias("hit"))

    def judged(flags: Column) -> Column:
        return F.struct(
            F.size(F.filter(flags, lambda x: x["solid"])).cast("long").alias("n_lines"),
            F.size(F.filter(flags, lambda x: x["hit"])).cast("long").alias("n_dropped"),
            F.array_join(F.transform(F.filter(flags, lambda x: ~x["hit"]), lambda x: x["line"]), "\n").alias("rest"),
        )

    pages = pages.select("row", let(F.transform(_lines(F.col("text")), flag), judged).alias("page"))
    old = F.col("row").getField("text")
    text = F.when(old.isNotNull() & (F.col("page.n_dropped") > 0), F.col("page.rest")).otherwise(old)
    out = [text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in names]
    if counts:
        out += [F.col("page.n_lines"), F.col("page.n_dropped")]
    return pages.select(*out)
