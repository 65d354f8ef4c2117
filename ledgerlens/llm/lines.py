"""Line dedup by site-relative frequency.

A line is boilerplate of a site when the share of the site's pages that hold it passes RATIO and at least LEAST pages hold
it (shares of tiny sites say nothing). Every page keeps its other lines in order, blank ones too. Lines are compared
without blanks at their ends, by 64-bit hash.

Counting shuffles (site, hash) pairs, summed per task first, so a large site or a line on all pages is no hot spot. A site has
at most (lines per page / RATIO) boilerplate lines, so their hashes fit one array for each site; each page's lines are
filtered in place, and no text is taken apart in a shuffle. The table of them is broadcast when it holds at most BROADCAST
hashes and letters; a larger one is joined with salted sites: a site has a salt for every SALT_PAGES pages, and a page's salt is
the hash of all its columns, so copies of a text or null texts part by their ids (rows alike in all columns stay together).

Null texts stay null and have no lines; a null site is a site of its own; repeated rows count as pages each. Other columns
are kept; result columns n_lines and n_dropped replace columns of those names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved

RATIO = 0.1
LEAST = 5
BROADCAST = 1_000_000
SALT_PAGES = 10_000

# Elements whose content is no text, and tags that end a line (fixed values of HTML). What is not closed reaches to the end of the page, and
# a tag ends before the next one begins, so that every pattern goes over a page once.
UNSEEN = r"(?is)<(script|style)\b[^<>]*>.*?(?:</(script|style)>|\z)|<!--.*?(?:-->|\z)"
BLOCK = r"(?i)</?(html|head|body|title|nav|header|footer|main|article|section|aside|div|p|ul|ol|li|h[1-6]|br|hr|table|tr|td|th|pre|blockquote)\b[^<>]*>"
TAG = r"<[^<>]*>"


def html_lines(html: Column) -> Column:
    """The text of a page, a line for each block."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, UNSEEN, ""), BLOCK, "\n"), TAG, "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, r"(?<!\s)\s*\n\s*", "\n"), F.lit("\n "))


def host(url: Column) -> Column:
    """Host of an address in lower case, without user, port and final dot; null if there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.nullif(F.rtrim(found, F.lit(".")), F.lit(""))


def _bare(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r"))


def boilerplate(df: DataFrame, site: str, text: str, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """Hashes of each site's boilerplate lines: __site, __pages (its pages), __lines (sorted array)."""
    hashes = F.array_distinct(F.transform(F.filter(F.split(F.col(text), "\n"), lambda x: _bare(x) != ""), lambda x: F.xxhash64(_bare(x))))
    pages = df.groupBy(F.col(site).alias("__site")).agg(F.count(F.lit(1)).alias("__pages"))
    held = df.select(F.col(site).alias("__key"), F.explode(hashes).alias("__line")).groupBy("__key", "__line").agg(F.count(F.lit(1)).alias("__n"))
    common = held.where(F.col("__n") >= least).join(pages, F.col("__key").eqNullSafe(F.col("__site")))
    return common.where(F.col("__n") > F.lit(ratio) * F.col("__pages")).groupBy("__site", "__pages").agg(F.sort_array(F.collect_list("__line")).alias("__lines"))


def drop_boilerplate(df: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """df with the boilerplate lines taken out of the text, n_lines (lines with a word before) and n_dropped."""
    # Columns have numbers for names here, so that none clashes with another.
    names = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    left = _dropped(df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]), f"c{names.index(site)}", f"c{names.index(text)}", ratio, least)
    return left.toDF(*names, "n_lines", "n_dropped")


def _dropped(rows: DataFrame, site: str, text: str, ratio: float, least: int) -> DataFrame:
    common = saved(boilerplate(rows, site, text, ratio, least), "boilerplate")
    names = rows.columns
    held = common.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("__lines") + F.length(F.coalesce("__site", F.lit("")))), F.lit(0))).first()
    if held[1] + held[0] <= BROADCAST:
        rows = rows.join(F.broadcast(common), rows[site].eqNullSafe(common["__site"]), "left")
    else:
        # Too much for every executor: the pages of a site go to as many tasks as it has salts, and so does a copy of its lines.
        # Only sites of several salts (at most one for every SALT_PAGES pages) are broadcast, with their numbers.
        salts = F.ceil(F.col("__pages") / SALT_PAGES)
        large = common.where(salts > 1).select(F.col("__site").alias("__large"), salts.alias("__salts"))
        own = [f"`{f.name}`" for f in rows.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
        rows = rows.join(F.broadcast(large), rows[site].eqNullSafe(large["__large"]), "left")
        rows = rows.withColumn("__salt", F.pmod(F.xxhash64(*own), F.coalesce("__salts", F.lit(1))))
        copies = common.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
        rows = rows.join(copies, F.col(f"`{site}`").eqNullSafe(copies["__site"]) & (F.col("__salt") == F.col("__part")), "left")
    worded = lambda lines: F.coalesce(F.size(F.filter(lines, lambda x: _bare(x) != "")), F.lit(0)).cast("long")
    lines = F.split(F.col(text), "\n")
    none = F.array().cast("array<bigint>")
    keep = F.filter(F.col("__split"), lambda x: (_bare(x) == "") | ~F.array_contains(F.col("__common"), F.xxhash64(_bare(x))))
    rows = rows.withColumns({"__split": lines, "__common": F.coalesce(F.col("__lines"), none)}).withColumn("__keep", keep)
    columns = [F.array_join("__keep", "\n").alias(text) if c == text else F.col(c) for c in names]
    counted = F.when(F.col(text).isNull(), F.lit(0).cast("long")).otherwise(worded(F.col("__split")))
    left = F.when(F.col(text).isNull(), F.lit(0).cast("long")).otherwise(worded(F.col("__keep")))
    return rows.select(*columns, counted.alias("n_lines"), (counted - left).alias("n_dropped"))
