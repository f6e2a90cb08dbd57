"""Line dedup by site-relative frequency: a line found on too large a share of a host's pages is boilerplate.

Written with DataFrame functions only. Lines are counted by (host, 64-bit hash) with map-side combining, so a host with a
third of all pages is spread like any other; the second pass looks a line up in its host's set of boilerplate hashes. That
set is bounded: if a host's pages have L different lines each on average, at most L / ratio lines can be on more than the
share `ratio` of them. The sets are written to the shared folder first, so the planner knows their size before it joins:
small ones are broadcast and the texts are not shuffled at all; beyond its limit it joins by host and splits a hot one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortspark.llm.common import settle

RATIO = 0.1
MIN_PAGES = 3


def boilerplate(
    docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """One row per host that has boilerplate: host, lines (the 64-bit hashes of its boilerplate lines).

    A line counts once per page. Blank lines (empty or spaces) are never boilerplate. Unknown hosts form one group. A line
    must be on more than the share `ratio` of the host's pages (rows of the host, those without text included) and on at
    least `min_pages` of them, so that a host of one or two pages keeps everything.
    """
    pages = docs.select(F.col(host).alias("host"), F.col(text).alias("text"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).alias("t")
    lines = F.array_distinct(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""))
    hashes = F.transform(lines, lambda x: F.xxhash64(x))
    counts = (
        pages.select("host", F.explode(hashes).alias("line"))
        .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_pages).alias("c")
    )
    frequent = counts.join(totals, F.col("c.host").eqNullSafe(F.col("t.host"))).filter(F.col("n") > ratio * F.col("pages"))
    return frequent.groupBy("c.host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """The rows and columns of `docs` with the boilerplate lines cut out of `text`, plus n_lines and n_dropped (long).

    Every row stays, one whose lines are all boilerplate with an empty text. NULL text stays NULL with no lines; an empty
    text is one blank line and stays. Repeated rows count as pages of their own. Other columns, n_lines or n_dropped of the
    input included, are passed on under their names except that the two new columns replace columns of the same name.
    """
    found = settle(boilerplate(docs, text, host, ratio, min_pages), "boilerplate")
    sets = found.select(F.col("host").alias("_host"), F.col("lines").alias("_lines"))
    joined = docs.join(sets, docs[host].eqNullSafe(sets["_host"]), "left")
    every = F.split(docs[text], "\n")
    kept = F.filter(every, lambda x: ~F.array_contains(F.col("_lines"), F.xxhash64(x)) | (F.trim(x) == ""))
    clean = F.when(F.col("_lines").isNull(), docs[text]).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(docs[text].isNull(), 0).otherwise(F.size(every)).cast("long")
    n_kept = F.when(docs[text].isNull(), 0).when(F.col("_lines").isNull(), F.size(every)).otherwise(F.size(kept)).cast("long")
    others = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(
        *[clean.alias(c) if c == text else docs[c] for c in others],
        n_lines.alias("n_lines"),
        (n_lines - n_kept).alias("n_dropped"),
    )
