"""Breadth-first traversal of a link table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doclathe.runtime import materialize

# Links that are never followed.
SKIP = ("calendar", "chart", "/cart", "/checkout", "/login", "/signin", "/register", "javascript:", "mailto:", "tel:")


def followable(url: Column, skip: Sequence[str] = SKIP) -> Column:
    bad = F.lit(False)
    for s in skip:
        bad = bad | F.contains(url, F.lit(s))
    return ~bad


def crawl(starts: DataFrame, links: DataFrame, pages: DataFrame | None = None, depth: int | None = None) -> DataFrame:
    """(start, url, depth, place): pages reached from each start, by fewest links (at most `depth`, if given), in the order in which a queue meets them.

    starts: start, url. links: from_url, to_url, and pos, the place of a link on its page, if order matters (else by to_url). pages: url, accepted; a page
    that isn't accepted is neither given out nor expanded, unknown pages count as accepted when `pages` is not given and as rejected otherwise. Skipped
    links aren't followed, but a start may be one. place orders the pages of a start: those nearer first, then those whose first link was met earlier; it
    is the list of positions of links on the way, so it grows by one number a level. Visited pages are kept out by an anti join with all levels, each of
    which is written once to the shared folder. Ends when nothing new is met. Cycles and repeated links are harmless."""
    if "pos" not in links.columns:
        links = links.withColumn("pos", F.lit(0))
    edges = links.where("from_url is not null and to_url is not null").where(followable(F.col("to_url"))).groupBy("from_url", "to_url").agg(F.min("pos").alias("pos"))
    known = None if pages is None else pages.where("accepted").select("url", F.lit(True).alias("ok")).distinct()
    judged = (lambda df: df.withColumn("ok", F.lit(True))) if known is None else (lambda df: df.join(known, "url", "left"))
    none = F.array().cast("array<struct<pos:bigint,url:string>>")
    levels = [materialize(judged(starts.where("url is not null").select("start", "url").distinct().withColumn("depth", F.lit(0)).withColumn("place", none)))]
    while (depth is None or len(levels) <= depth) and not (frontier := levels[-1].where("ok")).isEmpty():
        step = F.concat("place", F.array(F.struct(F.col("pos").cast("long").alias("pos"), F.col("to_url").alias("url"))))
        found = frontier.withColumnRenamed("url", "from_url").join(edges, "from_url").select("start", F.col("to_url").alias("url"), step.alias("place")).groupBy("start", "url").agg(F.min("place").alias("place"))
        fresh = found.join(reduce(DataFrame.unionByName, [x.select("start", "url") for x in levels]), ["start", "url"], "left_anti")
        levels.append(materialize(judged(fresh.withColumn("depth", F.lit(len(levels))))))
    return reduce(DataFrame.unionByName, levels).where("ok").select("start", "url", "depth", "place")


def first_pages(reached: DataFrame, limits: DataFrame, default: int = 5) -> DataFrame:
    """The first max_pages pages of each start in the order of discovery. limits: start, max_pages (null means the default). A ranking window with a limit,
    which keeps only that many rows per start and task before the shuffle."""
    rank = F.row_number().over(W.partitionBy("start").orderBy("depth", "place", "url"))
    return reached.join(limits.select("start", F.coalesce("max_pages", F.lit(default)).alias("max_pages")), "start").withColumn("rank", rank).where("rank <= max_pages").drop("max_pages", "place")
