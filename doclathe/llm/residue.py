"""Template residue, filler and error pages: candidates by shared prefixes of 4-grams, SimHashes and texts of passages, trusted labels propagated through their components."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclathe.llm.residue_rules import FILL, MESSAGE, OTHER, has_placeholder, labels
from doclathe.llm.visible import visible
from doclathe.llm.words import distinct, mix
from doclathe.runtime import materialize, release, small, spread

_U = np.uint64
#: Passages that meet are near-duplicates within this Hamming distance and from this share of common character 4-grams.
HAMMING, SIMILARITY = 14, 0.8
#: Beside its messages a page of messages holds at most a title and link texts: passages of at most so many words, together at most that many.
SHORT, BESIDE = 8, 18
#: A passage that a row repeats so often is filler.
REPEATS = 4
#: The 4-grams of trusted passages whose counts order all 4-grams, the most frequent first; any order gives the same pairs, this one the fewest candidates.
ORDERED = 200_000

_split = re.compile(r"(?<=[.!?])\s+|[\r\n]+")
_digits = re.compile(r"\d+")
_name = re.compile(r"(?<![.!?:] )(?<!^)\b[A-ZȘȚÎÂĂ][\w'’.-]*[a-z]\w*")


def shown(text: str | None, html: str | None) -> str:
    """What is judged of a row: its text, or where that is null or blank what its html shows."""
    return text if text and text.strip() else visible(html) if html else ""


def masked(passage: str) -> str:
    """A passage without names and numbers, in lower case."""
    return " ".join(_digits.sub("0", _name.sub("N", passage)).lower().split())


def passages(seen: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(row, masked passage, label, words) of the passages of texts, by the trusted rules and by repetition within the row."""
    found, row = [], []
    for i, text in enumerate(seen):
        own = [s for x in _split.split(text) if (s := x.strip())]
        found += own
        row += [i] * len(own)
    masks = [masked(s) for s in found]
    size = np.fromiter((len(s.split()) for s in found), np.int64, len(found))
    often = Counter(zip(row, masks))
    again = np.fromiter((often[x] >= REPEATS for x in zip(row, masks)), bool, len(found))
    mark = labels(found)
    mark[again & (size > 1) & (size <= 12)] = FILL
    return np.array(row, np.int64), masks, mark, size


def _keys(masks: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(masks, dtype=object), categorize=False).view(np.int64) if masks else np.zeros(0, np.int64)


def grams(masks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(passage, gram): the distinct character 4-grams of each passage as 40-bit hashes, in order of passage and hash. A blank stands at both ends."""
    texts = [f" {m} ".ljust(4, "\0") for m in masks]
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(_U)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    n = size - 3
    first = np.repeat(np.cumsum(size) - size - (np.cumsum(n) - n), n) + np.arange(n.sum())
    h = code[first]
    for i in range(1, 4):
        h = h * _U(0x9E3779B97F4A7C15) + code[first + i]
    both = distinct((np.repeat(np.arange(len(masks)), n).astype(_U) << _U(40)) | (mix(h) >> _U(24)))
    return (both >> _U(40)).astype(np.int64), both & _U((1 << 40) - 1)


_PAIR_OF_BITS = np.array([0, 1, 1 << 32, 1 + (1 << 32)], _U)


def simhashes(passage: np.ndarray, gram: np.ndarray, n: int) -> np.ndarray:
    """64-bit SimHash of each of n passages: the majority of each bit of its 4-grams' hashes."""
    if not n:
        return np.zeros(0, _U)
    size = np.bincount(passage, minlength=n)
    start, h, out = np.cumsum(size) - size, mix(gram), np.zeros(n, _U)
    for at in range(0, 64, 2):  # two counters in one sum
        two = np.add.reduceat(_PAIR_OF_BITS[(h >> _U(at)) & _U(3)], start)
        out |= (2 * (two & _U(0xFFFFFFFF)) > size.astype(_U)).astype(_U) << _U(at)
        out |= (2 * (two >> _U(32)) > size.astype(_U)).astype(_U) << _U(at + 1)
    return out


def prefixes(passage: np.ndarray, gram: np.ndarray, n: int, common: tuple[np.ndarray, np.ndarray] | None = None) -> pa.ListArray:
    """Of each passage its first 4-grams in one order for all (rare among trusted passages first, then by hash), one more than it may lack of a near
    one: passages whose share of common 4-grams reaches SIMILARITY have one of these in common, so no near pair is missed."""
    size = np.bincount(passage, minlength=n)
    rank = np.zeros(len(gram), np.int64)
    if common is not None and len(common[0]):
        at = np.minimum(np.searchsorted(common[0], gram), len(common[0]) - 1)
        rank = np.where(common[0][at] == gram, common[1][at], 0)
    ordered = gram[np.lexsort((gram, rank, passage))]
    kept = size - np.ceil(SIMILARITY * size - 1e-9).astype(np.int64) + (size > 0)
    place = np.arange(len(gram)) - np.repeat(np.cumsum(size) - size, size)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(kept)].astype(np.int32)), pa.array(ordered[place < np.repeat(kept, size)].view(np.int64)))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row with anything to judge: whether the rules alone make it residue, its passages' keys, labels and words, and those passages that
    the batch shows for the first time. The texts are read this once."""
    for batch in batches:
        ids, seen = [], []
        for i, text, html in zip(*(batch.column(c).to_pylist() for c in range(3))):
            if (one := shown(text, html)).strip():
                ids.append(i)
                seen.append(one)
        row, masks, mark, size = passages(seen)
        keys = _keys(masks)
        first = np.lexsort((np.arange(len(keys)), -mark, keys))  # of each key the place of its greatest label
        first = np.sort(first[np.r_[True, np.diff(keys[first]) != 0]]) if len(keys) else first
        units = pa.StructArray.from_arrays([pa.array(keys), pa.array(mark.astype(np.int8)), pa.array(size.astype(np.int32))], names=["key", "label", "words"])
        fresh = pa.StructArray.from_arrays([pa.array(keys[first]), pa.array([masks[i] for i in first.tolist()], pa.string()), pa.array(mark[first].astype(np.int8))], names=["key", "mask", "label"])
        ends = lambda r: pa.array(np.searchsorted(r, np.arange(len(ids) + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends(r), v) for r, v in ((row, units), (row[first], fresh))]
        yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(has_placeholder(seen), pa.bool_()), *lists], names=["id", "sure", "units", "fresh"])


def _trusted_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gram = np.sort(grams(batch.column(0).to_pylist())[1])
        start = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]]) if len(gram) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(gram[start].view(np.int64)), pa.array(np.diff(np.r_[start, len(gram)]))], names=["gram", "n"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose passages share enough character 4-grams: (key, label of the trusted one)."""
    for batch in batches:
        n = batch.num_rows
        sides = [grams(batch.column(c).to_pylist()) for c in (1, 3)]
        both = np.sort(np.concatenate([(p.astype(_U) << _U(40)) | g for p, g in sides]))
        pair = (both >> _U(40)).astype(np.int64)
        common = np.bincount(pair[1:][both[1:] == both[:-1]], minlength=n)
        union = np.bincount(pair, minlength=n) - common
        ok = pa.array(common >= SIMILARITY * union - 1e-9)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(2).filter(ok)], names=["key", "label"])


def _propagated(units: DataFrame) -> DataFrame:
    """(key, label) of the passages that a chain of near ones joins to a trusted one, without the trusted ones. Each round carries labels over one link;
    only what was reached last looks for neighbours, so passages of ordinary content are never paired with each other. Ends when nothing new is reached."""
    frontier = units.where(F.col("label") != OTHER).select("key", "mask", "sim", "prefix", "label")
    others = units.where(F.col("label") == OTHER)
    entries = others.select("key", "sim", F.explode("prefix").alias("gram"))
    levels: list[DataFrame] = []
    while True:
        near = materialize(frontier.select(F.col("key").alias("near"), F.col("label").alias("from"), F.col("sim").alias("other"), F.explode("prefix").alias("gram")))
        met = entries.join(small(near), "gram").where(F.bit_count(F.col("sim").bitwiseXOR(F.col("other"))) <= HAMMING).select("key", "near", "from").distinct()
        for level in levels:
            met = met.join(level.select("key"), "key", "left_anti")
        met = materialize(met)
        pairs = met.join(others.select("key", "mask"), "key").join(frontier.select(F.col("key").alias("near"), F.col("mask").alias("near_mask")), "near").select("key", "mask", "from", "near_mask")
        new = pairs.mapInArrow(_alike, "key long, label tinyint").groupBy("key").agg(F.max("label").alias("label"))
        level = materialize(others.drop("label").join(new, "key").select("key", "mask", "sim", "prefix", "label"))
        release(near, met)
        if level.isEmpty():
            break
        levels.append(level)
        frontier = level
    return reduce(DataFrame.unionByName, [x.select("key", "label") for x in levels or [others.limit(0)]])


def residue_rows(df: DataFrame, key: str = "scrape_id", text: str = "text", html: str = "html") -> DataFrame:
    """(key, reason, by) of the rows that hold template residue or filler, or that consist of a message instead of content; reason is placeholder, filler or message, by is rule, or
    likeness where no trusted passage decides but only passages near one.

    `text` is judged, or where it is null or blank what `html` shows. Placeholders and unfilled values are decided by rules alone, since the same
    sentence with a value is content; filler and messages also by likeness to trusted ones. Rows without anything to judge never count; very long
    texts are judged whole. Repeated keys are judged each for itself; a null key is kept. Extra columns are never read; an empty table gives no rows."""
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(html).alias("html")).where("text is not null or html is not null")
    rows = spread(rows)
    kind = df.schema[key].dataType.simpleString()
    judged = materialize(rows.mapInArrow(_rows, f"id {kind}, sure boolean, units array<struct<key:bigint,label:tinyint,words:int>>, fresh array<struct<key:bigint,mask:string,label:tinyint>>"))
    distinct = materialize(judged.select(F.explode("fresh").alias("f")).select("f.*").groupBy("key").agg(F.first("mask").alias("mask"), F.max("label").alias("label")))
    counted = distinct.where(F.col("label") != OTHER).select("mask").mapInArrow(_trusted_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    frequent = sorted((r.gram, r.n) for r in counted.orderBy(F.desc("n"), "gram").limit(ORDERED).collect())
    order = spark.sparkContext.broadcast((np.array([g for g, _ in frequent], np.int64).view(_U), np.array([n for _, n in frequent], np.int64)))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, (passage, gram) = batch.num_rows, grams(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(simhashes(passage, gram, n).view(np.int64)), prefixes(passage, gram, n, order.value)], names=["key", "mask", "label", "sim", "prefix"])

    units = materialize(distinct.mapInArrow(signed, "key long, mask string, label tinyint, sim long, prefix array<long>"))
    more = small(materialize(_propagated(units).withColumnRenamed("label", "learnt")))
    own = judged.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "sure", F.explode_outer("units").alias("u"))
    each = own.select("row", "id", "sure", F.col("u.key").alias("key"), F.col("u.label").alias("label"), F.col("u.words").alias("words")).join(more, "key", "left")
    rule = F.coalesce("label", F.lit(OTHER)).cast("int")
    mark = F.greatest(rule, F.coalesce("learnt", F.lit(OTHER)).cast("int"))
    beside = F.when(mark == OTHER, F.col("words")).otherwise(0)
    per = each.groupBy("row").agg(
        F.first("id").alias("id"), F.first("sure").alias("sure"), F.max(mark == FILL).alias("fill"), F.max(mark == MESSAGE).alias("message"), F.max(beside).alias("longest"), F.sum(beside).alias("beside"),
        F.max(rule == FILL).alias("filled"), F.min((mark == OTHER) | (rule != OTHER)).alias("told"),
    )
    reason = F.when(F.col("sure"), "placeholder").when(F.col("fill"), "filler").when(F.col("message") & (F.col("longest") <= SHORT) & (F.col("beside") <= BESIDE), "message")
    by = F.when(F.col("sure") | F.col("filled") | (~F.col("fill") & F.col("told")), "rule").otherwise("likeness")
    return per.select(F.col("id").alias(key), reason.alias("reason"), by.alias("by")).where("reason is not null")
