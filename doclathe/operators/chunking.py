"""Chunks, packs and sections: folds over the ordered parts of a text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doclathe.functions import text as T
from doclathe.runtime import spread

#: Characters of a chunk, and of a batch of text.
CHUNK, PACK = 1200, 50_000


def _kinds(text: Column, size: int) -> Column:
    """The paragraphs that are no fragments, as (kind, text, section): H heading, B bullet, L longer than a chunk, P other."""
    kept = F.filter(T.paragraphs(text), lambda p: ~T.fragment_of(p))
    headed = F.transform(kept, lambda p: F.struct(p.alias("p"), T.let(T.words(p), lambda w: T.heading_of(p, w)).alias("h")))
    kind = lambda x: F.when(x["h"], "H").when(T.is_bullet(x["p"]), "B").when(F.length(x["p"]) > size, "L").otherwise("P")
    return F.transform(headed, lambda x: F.struct(kind(x).alias("kind"), x["p"].alias("text"), F.when(x["h"], T.clean_section(x["p"])).alias("section")))


def _fold(parts: list[dict], size: int, pending_first: bool) -> list[tuple[str, str, str]]:
    """(section, raw text, site) of each chunk. site: h closed by a heading, l a long paragraph, f full or at the end."""
    out: list[tuple[str, str, str]] = []
    held: list[str] = []
    length, section = 0, "General"

    def close(site: str) -> None:
        nonlocal length
        if held:
            out.append((section, "".join(held), site))
            held.clear()
            length = 0

    for part in parts:
        kind, text = part["kind"], part["text"]
        if kind == "H":
            close("h")
            section = part["section"]
        elif kind == "L":
            if pending_first:
                close("f")
            out.append((section, text, "l"))
        else:
            end, counted = ("\n", 1) if kind == "B" else ("\n\n", 2)
            if length + len(text) + counted > size:
                close("f")
            held.append(text + end)
            length += len(text) + len(end)
    close("f")
    return out


def semantic_chunks(df: DataFrame, keys: list[str], text: str = "text", size: int = CHUNK, pending_first: bool = False) -> DataFrame:
    """(keys, chunk_no, id, section, text, sent): section-aware chunks of each text of up to `size` characters.

    Headings close a chunk and name what follows; fragments are dropped, and chunks that end within a word. A paragraph longer than `size` is a
    chunk of its own, given out before what was pending unless pending_first. The id is the md5 of the text; of chunks closed by a heading, of
    the text with its paragraph breaks. Rules run in the JVM; only the fold over classified paragraphs crosses to Python, in linear time.
    Null and empty texts give no chunks."""
    parts = spread(df.select(*keys, F.col(text).alias("__text"))).select(*keys, _kinds(F.col("__text"), size).alias("__parts"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.select(*keys).schema)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            rows, no, folded = [], [], []
            for i, p in enumerate(batch.column(len(keys)).to_pylist()):
                for n, chunk in enumerate(_fold(p or [], size, pending_first)):
                    rows.append(i)
                    no.append(n)
                    folded.append(chunk)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(len(keys))), pa.array(no, pa.int32()), *(pa.array([c[j] for c in folded], pa.string()) for j in range(3))], names=[*keys, "chunk_no", "section", "raw", "site"])

    folded = parts.mapInArrow(run, f"{fields}, chunk_no int, section string, raw string, site string")
    raw, flat = T.strip(F.col("raw")), T.finalise(F.col("raw"))
    text_ = F.when(F.col("site") == "l", raw).otherwise(flat)
    tested = F.when(F.col("site") == "f", flat).otherwise(raw)
    return folded.where(~T.is_truncated(tested)).select(*keys, "chunk_no", F.md5(tested).alias("id"), "section", text_.alias("text"), F.lit(False).alias("sent"))


def greedy_pack(parts: Column, size: int = PACK, between: str = "\n\n") -> Column:
    """An array of texts packed in order while their lengths, separators apart, sum to at most `size`; a longer one stands alone."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"), F.lit(0).alias("n"))

    def step(a: Column, p: Column) -> Column:
        fits = a["open"].isNotNull() & (a["n"] + F.length(p) <= size)
        done = F.when(fits | a["open"].isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(a["open"])))
        return F.struct(done.alias("done"), F.when(fits, F.concat(a["open"], F.lit(between), p)).otherwise(p).alias("open"), F.when(fits, a["n"] + F.length(p)).otherwise(F.length(p)).alias("n"))

    return F.aggregate(parts, start, step, lambda a: F.when(a["open"].isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(a["open"]))))


def pack_text(c: Column, size: int = PACK) -> Column:
    """A text of up to `size` whole, a longer one packed by paragraphs; blank paragraphs are left out."""
    parts = F.filter(F.split(c, "\n\n"), lambda p: T.strip(p) != "")
    return F.when(F.length(c) <= size, F.array(c)).otherwise(greedy_pack(parts, size))


def assemble(df: DataFrame, per: list[str], order: list[str], section: str = "section", text: str = "text") -> DataFrame:
    """One text per group: section and text of each row with text, in order, with blank lines between. A group's text is one value by definition."""
    has = F.coalesce(T.strip(F.col(text)), F.lit("")) != ""
    piece = T.strip(F.concat(F.coalesce(F.col(section), F.lit("")), F.lit("\n"), F.col(text)))
    rows = df.where(has).groupBy(*per).agg(F.array_sort(F.collect_list(F.struct(*order, piece.alias("piece")))).alias("r"))
    return rows.select(*per, F.size("r").alias("pieces"), F.array_join(F.transform("r", lambda s: s["piece"]), "\n\n").alias("text"))


def is_section_head(c: Column) -> Column:
    """A question, a short title, or a short line in capitals."""
    w = T.words(c)
    title = (F.size(w) > 0) & c.rlike(r"\p{L}") & F.forall(w, lambda x: x.rlike(r"^[^\p{L}]*(\p{Lu}[\p{Ll}\p{M}]*[^\p{L}]*)*\z"))
    return c.endswith("?") | ((F.length(c) < 80) & title) | ((F.length(c) < 60) & T.is_upper(c))


def sections(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, section_no, heading, content): lines after each heading joined; what comes before the first heading is dropped, and headings without lines."""
    rows = df.select(*keys, F.posexplode(F.transform(F.split(text, "\n"), T.strip)).alias("line_no", "line")).where("line <> ''")
    w = W.partitionBy(*keys).orderBy("line_no")
    head = is_section_head(F.col("line"))
    grouped = rows.withColumn("head", head).withColumn("section_no", F.sum(F.col("head").cast("int")).over(w)).where("section_no > 0")
    parts = grouped.groupBy(*keys, "section_no").agg(F.max(F.when(F.col("head"), F.col("line"))).alias("heading"), F.array_sort(F.collect_list(F.when(~F.col("head"), F.struct("line_no", "line")))).alias("l"))
    return parts.where(F.size("l") > 0).select(*keys, F.col("section_no").cast("int").alias("section_no"), "heading", F.array_join(F.transform("l", lambda s: s["line"]), "\n").alias("content"))


def carry_forward(df: DataFrame, keys: list[str], order: str, heading: str = "heading") -> DataFrame:
    """Each row with the nearest heading before it."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("context", F.last(heading, ignorenulls=True).over(w))


def dedupe_blocks(df: DataFrame, keys: list[str], order: str, text: str = "text") -> DataFrame:
    """The first of blocks that agree in lower case with single spaces."""
    from doclathe.operators.records import keep_first

    return keep_first(df, [*keys, F.lower(T.collapse(F.col(text)))], [*keys, order])


def flatten_blocks(df: DataFrame, keys: list[str], order: str, heading: str = "heading", text: str = "text") -> DataFrame:
    """(keys, text): blocks in order with blank lines between; a heading is given out where it changes."""
    w = W.partitionBy(*keys).orderBy(order)
    changed = F.col(heading).isNotNull() & ~F.col(heading).eqNullSafe(F.lag(heading).over(w))
    rows = df.withColumn("__t", F.when(changed, F.concat_ws("\n\n", heading, text)).otherwise(F.col(text)))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "__t"))), lambda s: s["__t"]), "\n\n").alias("text"))
