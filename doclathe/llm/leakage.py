"""Test items inside corpus documents: size-partitioned MinHash containment search, verified by exact shingle containment."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclathe.llm.words import distinct, hashes, mix, words
from doclathe.runtime import materialize, release, small, spread

_U = np.uint64
#: Words of a shingle.
SHINGLE = 5
#: A document holds an item if shingles they share cover this share of the passage's words, or that share of the question's.
PASSAGE, QUESTION = 0.4, 0.75
#: Words of a piece: shared shingles count only where they lie together, along one alignment of item and document (up to SHIFT words of edits between
#: neighbours), and cover so many words, or the whole item where it is shorter. Phrases that texts of one kind have in common are shorter.
PIECE, SHIFT = 10, 6
#: Size classes of documents by shingles; a longer document is cut into windows of the last class's size. Each has twice as many bins as shingles at most.
CLASSES = (64, 128, 256, 512)
#: Chance that a shingle is the least of its bin where there are twice as many bins as shingles, or more.
LEAST = (1 - math.exp(-0.5)) / 0.5
#: An item is looked for by as many common minima as a document that holds it lacks with this chance at most, in the worst case of pieces of five words.
#: Items too short for even one are looked for by all shingles.
MISS = 0.001
#: Shingles of items up to which documents are compared with them before anything travels (8 bytes each); beyond, all minima of documents do.
KNOWN = 4_000_000
#: Items of one document that one task verifies at a time, about.
SLICE = 5000

def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, hash, words per doc): the hash of every run of SHINGLE words, in order. Compatibility forms are made one, invisible characters dropped."""
    plain = pc.replace_substring_regex(pc.utf8_normalize(pc.fill_null(texts, ""), form="NFKC"), "[­​-‍⁠﻿]", "")
    doc, code, vocabulary = words(plain)
    count = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), np.int64)
    if len(doc) < SHINGLE:
        return np.zeros(0, np.int64), np.zeros(0, _U), count
    w, n = hashes(vocabulary)[code], len(code) - SHINGLE + 1
    h = np.zeros(n, _U)
    for i in range(SHINGLE):
        h = mix(h * _U(0x9E3779B97F4A7C15) + w[i : n + i])
    whole = doc[:n] == doc[SHINGLE - 1 :]
    return doc[:n][whole], h[whole], count


def needed(words_: int, repeats: int, least: float) -> tuple[int, bool]:
    """(shingles that candidates must share, whether all shingles count instead of minima) for an item of so many words, of whose shingles some repeat."""
    shared = max(1, math.ceil(math.ceil(least * words_ - 1e-9) / SHINGLE) - repeats)
    chance = [math.comb(shared, n) * LEAST**n * (1 - LEAST) ** (shared - n) for n in range(shared + 1)]
    fits = [k for k in range(1, shared + 1) if sum(chance[:k]) <= MISS]
    return (max(fits), False) if fits else (shared, True)


def _needles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items with their distinct shingles; those of fewer than SHINGLE words are left out."""
    for batch in batches:
        part, h, size = shingles(batch.column(2))
        n = batch.num_rows
        order = np.lexsort((h, part))
        part, h = part[order], h[order]
        first = np.r_[True, (part[1:] != part[:-1]) | (h[1:] != h[:-1])] if len(h) else np.zeros(0, bool)
        every, kinds = np.bincount(part, minlength=n), np.bincount(part[first], minlength=n)
        need = [needed(w, e - k, least) for w, e, k, least in zip(size.tolist(), every.tolist(), kinds.tolist(), batch.column(3).to_pylist())]
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(kinds)].astype(np.int32)), pa.array(h[first].view(np.int64)))
        out = pa.RecordBatch.from_arrays([*batch.columns, pa.array([k for k, _ in need], pa.int32()), pa.array([a for _, a in need], pa.bool_()), lists], names=["needle", "item", "text", "least", "need", "all", "hashes"])
        yield out.filter(pa.array(size >= SHINGLE))


def sketch(texts: pa.Array, known: np.ndarray | None, others: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, hash, minimum): the minima of each document, and its other shingles if wanted; only those in known if that is given (sorted).

    One-permutation MinHash: the bin is the hash's first bits; of each window and bin the least hash is kept."""
    doc, h, _ = shingles(texts)
    if known is not None and len(doc):
        at = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
        hit = known[at] == h if len(known) else np.zeros(len(h), bool)
        some = np.zeros(len(texts), bool)
        some[doc[hit]] = True
        inside = some[doc]  # a document that shares nothing has no minima to look at
        doc, h, hit = doc[inside], h[inside], hit[inside]
    if not len(doc):
        return doc, h, np.zeros(0, bool)
    n = np.bincount(doc)[doc]
    window = (np.arange(len(doc)) - np.searchsorted(doc, doc)) // CLASSES[-1]
    bits = 1 + np.ceil(np.log2(np.clip(n, CLASSES[0], CLASSES[-1]))).astype(np.int64)
    part = np.cumsum(np.r_[True, (doc[1:] != doc[:-1]) | (window[1:] != window[:-1])]) - 1
    order = np.lexsort((h, part))  # bins are ranges of hashes, so this sorts by bin as well
    bin_ = (h >> (64 - bits).astype(_U)).astype(np.int64)[order]
    part = part[order]
    least = np.r_[True, (part[1:] != part[:-1]) | (bin_[1:] != bin_[:-1])]
    kept = least | others
    if known is not None:
        kept &= hit[order]
    return doc[order][kept], h[order][kept], least[kept]


def _matches(sorted_: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) with value[i] == sorted_[j], all of them."""
    low, high = np.searchsorted(sorted_, value, "left"), np.searchsorted(sorted_, value, "right")
    n = high - low
    return np.repeat(np.arange(len(value)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def holds(texts: pa.Array, of: np.ndarray, needles: pa.Array, least: np.ndarray) -> np.ndarray:
    """Whether text of[i] holds needle i: exact containment of shingles."""
    doc, h, _ = shingles(texts)
    pair, g, size = shingles(needles)
    if not len(h) or not len(g):
        return np.zeros(len(needles), bool)
    place, spot = np.arange(len(doc)) - np.searchsorted(doc, doc), np.arange(len(pair)) - np.searchsorted(pair, pair)
    key = lambda x, d: mix(x + d.astype(_U) * _U(0x9E3779B97F4A7C15))
    mine = key(h, doc)
    order = np.argsort(mine, kind="stable")
    i, j = _matches(mine[order], key(g, of[pair]))
    if not len(i):
        return np.zeros(len(needles), bool)
    at, start, shift = pair[i], spot[i], place[order][j] - spot[i]
    order = np.lexsort((shift, at))
    at, start, shift = at[order], start[order], shift[order]
    piece = np.cumsum(np.r_[True, (at[1:] != at[:-1]) | (shift[1:] - shift[:-1] > SHIFT)]) - 1
    spread_ = lambda x, y: distinct((x[:, None] * (1 << 32) + y[:, None] + np.arange(SHINGLE)).ravel()) >> 32
    long = (np.bincount(spread_(piece, start), minlength=piece[-1] + 1) >= np.minimum(PIECE, size[at[np.searchsorted(piece, np.arange(piece[-1] + 1))]]))[piece]
    covered = np.bincount(spread_(at[long], start[long]), minlength=len(needles)) if long.any() else np.zeros(len(needles))
    return covered >= least * size - 1e-9


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, item) of (doc, text, candidate items) where the text holds the item."""
    for batch in batches:
        size = pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False)
        cuts = distinct(np.r_[0, np.flatnonzero(np.diff(np.cumsum(size) // 4_000_000)) + 1, batch.num_rows])
        for at, to in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            part = batch.slice(at, to - at)
            of = pc.list_parent_indices(part.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
            item, text, least = pc.list_flatten(part.column(2)).flatten()
            ok = holds(part.column(1), of, text, least.to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(of[ok])), item.filter(pa.array(ok))], names=["doc", "item"])


def candidates(docs: DataFrame, needles: DataFrame) -> DataFrame:
    """(doc, needle) of documents that share enough minima (all shingles, for short items) with an item. docs: doc, text; needles as _needles makes them."""
    spark = docs.sparkSession
    each = materialize(needles.select("needle", "need", "all", F.explode("hashes").alias("h")))
    known = None
    if each.limit(KNOWN + 1).count() <= KNOWN:
        known = spark.sparkContext.broadcast(distinct(each.select("h").distinct().toPandas()["h"].to_numpy(np.int64).view(_U)))
    others = not each.where("all").isEmpty()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False)
            cuts = distinct(np.r_[0, np.flatnonzero(np.diff(np.cumsum(size) // 4_000_000)) + 1, batch.num_rows])
            for at, to in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                d, h, least = sketch(batch.column(1).slice(at, to - at), None if known is None else known.value, others)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at).take(pa.array(d, pa.int64())), pa.array(h.view(np.int64)), pa.array(least)], names=["doc", "h", "least"])

    hits = docs.mapInArrow(run, f"doc {docs.schema['doc'].dataType.simpleString()}, h long, least boolean").join(small(each), "h").where("least or all")
    return hits.groupBy("doc", "needle", "need").agg(F.count("*").alias("n")).where("n >= need").select("doc", "needle")


def needles_of(items: DataFrame, item: str, passage: str, question: str) -> DataFrame:
    part = lambda c, least: items.select(F.col(item).cast("string").alias("item"), F.col(c).cast("string").alias("text"), F.lit(least).alias("least"))
    rows = part(passage, PASSAGE).unionByName(part(question, QUESTION)).where("item is not null and text is not null").distinct()
    return rows.select(F.xxhash64("item", "text", "least").alias("needle"), "item", "text", "least").mapInArrow(_needles, "needle long, item string, text string, least double, need int, all boolean, hashes array<long>")


def leaked_items(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", passage: str = "passage", question: str = "question") -> DataFrame:
    """(doc, item): every document that holds at least PASSAGE of the words of an item's passage in runs of SHINGLE words or more, or its whole question.

    Words count in pieces of PIECE words or more, or of the whole item. Case, punctuation, spacing and layout don't count, and a changed word costs only
    itself where five words stand on both its sides. Documents are cut into size classes, each shingle is the least of its bin with a chance of at least
    LEAST; a document becomes a candidate by the number of an item's shingles among its minima, and only candidates are compared shingle by shingle. Short
    items, for which minima would miss too much, are looked for by all shingles. The corpus is read once for candidates of any number of items, and once
    more, as far as there are candidates, to verify. Null texts, null ids and items of fewer than SHINGLE words are never found. Repeated item ids give
    one row. Extra columns are never read."""
    source = spread(docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).where("doc is not null and text is not null"))
    needles = materialize(needles_of(items, item, passage, question))
    slices = max(1, -(-needles.count() // SLICE))
    met = materialize(candidates(source, needles))
    listed = met.join(needles.select("needle", "item", "text", "least"), "needle").groupBy("doc", F.pmod("needle", F.lit(slices)).alias("slice")).agg(F.collect_list(F.struct("item", "text", "least")).alias("items"))
    named = source.join(small(materialize(met.select("doc").distinct())), "doc", "left_semi")
    found = materialize(named.join(listed, "doc").select("doc", "text", "items").mapInArrow(_verify, f"doc {docs.schema[doc].dataType.simpleString()}, item string").distinct())
    release(met, needles)
    return found.select(F.col("doc").alias(doc), F.col("item").alias(item))
