"""Lines repeated across one site's documents: boilerplate blocks from weighted graphs of consecutive lines."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doclathe.runtime import materialize, release, small, spread

#: A line or a pair of consecutive lines is boilerplate if it stands on at least this share of the pages of its source.
SUPPORT = 0.2


def line_key(c: Column) -> Column:
    """Lower case, every run of non-letters one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}]+", " "))


def _rows(df: DataFrame, doc: str, source: str, page: str) -> DataFrame:
    """A null source is one source of its own; a null page stands for the row alone."""
    src = F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))
    pg = F.coalesce(F.concat(F.lit("p"), F.col(page)), F.concat(F.lit("d"), F.col(doc).cast("string")))
    return df.select(F.col(doc).alias("doc"), src.alias("src"), F.xxhash64(src, pg).alias("page"), F.col("text"))


def _lines(rows: DataFrame) -> DataFrame:
    """(doc, src, page, nth, line_no, line): a row per line with letters; nth counts only those. line hashes the source and the line's key."""
    keyed = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("i"), line_key(x).alias("k"))), lambda s: s["k"] != "")
    return rows.where("text is not null").select("doc", "src", "page", F.posexplode(keyed).alias("nth", "s")).select("doc", "src", "page", "nth", F.col("s.i").alias("line_no"), F.xxhash64("src", "s.k").alias("line"))


def _blocks(nodes: pd.DataFrame) -> pd.DataFrame:
    """Union-find over one source's frequent lines and edges. Both lists are bounded: each entry stands on a fifth of the pages, so there are at most 5 times as many as a mean page has lines."""
    at: dict[int, int] = {}

    def top(x: int) -> int:
        while at.setdefault(x, x) != x:
            at[x] = at[at[x]]
            x = at[x]
        return x

    for a, b in zip(nodes["line"].tolist(), nodes["after"].tolist()):
        a, b = top(a), top(b)
        at[max(a, b)] = min(a, b)
    lines = nodes["line"].unique()
    return pd.DataFrame({"src": nodes["src"].iloc[0], "line": lines, "block": [top(x) for x in lines.tolist()]})


def repeated_lines(df: DataFrame, doc: str = "page_id", source: str = "source_id", page: str = "source", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """(doc, line_no, block): every occurrence of a boilerplate line, with the block of its source that it belongs to.

    Nodes are a source's lines weighted by the distinct pages they stand on, edges its pairs of consecutive lines weighted likewise. Nodes and
    edges of at least `support` of the source's pages stay; their connected components are the blocks. Lines are the pieces between line feeds,
    numbered from 0; lines without letters never count and don't separate. Rows with null or empty text count as pages but hold no lines; a page
    fetched twice is one page, and both its rows are searched. Null source: one source; null page: a page per row. Extra columns are never read.

    Support is counted in two aggregations (page, then source), each combined before its shuffle, so a hot source spreads over its lines and pages."""
    rows = _rows(df.select(*{doc, source, page}, F.col(text).alias("text")) if text != "text" else df, doc, source, page)
    rows = spread(rows)
    pages = rows.groupBy("src", "page").agg(F.lit(1).alias("one")).groupBy("src").agg(F.count("*").alias("pages"))
    pages = materialize(pages)
    lines = _lines(rows)
    weights = lines.groupBy("src", "line", "page").agg(F.lit(1).alias("one")).groupBy("src", "line").agg(F.count("*").alias("weight"))
    nodes = materialize(weights.join(small(pages), "src").where(F.col("weight") >= support * F.col("pages") - 1e-9).select("src", "line", "weight"))
    seen = materialize(lines.join(small(nodes.select("line")), "line").select("doc", "src", "page", "nth", "line_no", "line"))
    after = F.lead(F.struct("nth", "line")).over(W.partitionBy("doc").orderBy("nth"))
    pairs = seen.withColumn("next", after).where("next.nth = nth + 1").select("src", "page", "line", F.col("next.line").alias("after"))
    held = pairs.groupBy("src", "line", "after", "page").agg(F.lit(1).alias("one")).groupBy("src", "line", "after").agg(F.count("*").alias("weight"))
    edges = held.join(small(pages), "src").where(F.col("weight") >= support * F.col("pages") - 1e-9).select("src", "line", "after")
    graph = nodes.select("src", "line", F.col("line").alias("after")).unionByName(edges)
    blocks = materialize(graph.groupBy("src").applyInPandas(_blocks, "src string, line long, block long"))
    release(pages, nodes)
    return seen.join(small(blocks.select("line", "block")), "line").select(F.col("doc").alias(doc), "line_no", "block")


def strip_repeated_lines(df: DataFrame, doc: str = "page_id", source: str = "source_id", page: str = "source", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """df with the boilerplate lines deleted from each text. Line numbers travel, texts don't until the last join."""
    found = repeated_lines(df, doc, source, page, text, support).groupBy(doc).agg(F.collect_set("line_no").alias("__drop"))
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col("__drop"), i)), "\n")
    return df.join(found, doc, "left").withColumn(text, F.when(F.col("__drop").isNull(), F.col(text)).otherwise(kept)).drop("__drop")
