"""The main body of web pages: a linear-chain CRF over the lines of each page."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclathe.llm.crf import Crf, train
from doclathe.llm.page_rules import BODY, FEATURES, SHARES, Shares, features, key_hash, rule_labels, simples, undecorated
from doclathe.llm.words import distinct
from doclathe.runtime import spread

_U = np.uint64
#: Pages that the model is trained on: those with the least hash of their id. Of these, so many stretches of at most LENGTH lines, which bounds what the driver holds.
SAMPLE, LENGTH = 800, 200
#: Lines of one page that are decoded at once; longer pages are decoded in overlapping stretches.
STRETCH, OVERLAP = 2000, 100
#: Pages whose features are made at once.
PAGES = 2000


def split(text: str) -> tuple[list[int], list[str]]:
    """Numbers and texts of the non-blank lines between line feeds."""
    every = text.split("\n")
    at = [i for i, s in enumerate(every) if s.strip()]
    return at, [every[i] for i in at]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(line, pages with it plain, pages with it dressed) of each batch; lines of any length count, by the hash of their key."""
    for batch in batches:
        lines = [split(t)[1] for t in batch.column(0).to_pylist()]
        coded = pa.array([x for p in lines for x in p], pa.string()).dictionary_encode()
        code, every = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
        page = np.repeat(np.arange(len(lines)), [len(p) for p in lines])
        keys, bare = simples(every), undecorated(every)
        counts = []
        for names in (keys, [x or "" for x in bare]):
            h, has = key_hash(names), np.array([bool(x) for x in names], bool)
            each = distinct(h)
            once = distinct(page[has[code]] * len(each) + np.searchsorted(each, h)[code][has[code]]) % max(1, len(each))
            n = np.bincount(once, minlength=len(each))
            counts.append((each[n > 0], n[n > 0]))
        line = distinct(np.concatenate([c[0] for c in counts]))
        out = np.zeros((2, len(line)), np.int64)
        for i, (each, n) in enumerate(counts):
            out[i, np.searchsorted(line, each)] = n
        yield pa.RecordBatch.from_arrays([pa.array(line.view(np.int64)), pa.array(out[0]), pa.array(out[1])], names=["line", "plain", "dressed"])


def line_shares(pages: DataFrame) -> Shares:
    """On how many pages a line stands, for lines that stand plain on at least SHARES[0] of all pages; of these also on how many in a teaser's dress, be
    it a single one. There are at most 1 / SHARES[0] times as many such lines as a mean page has, whatever the number of pages; that bounds what the
    driver gets and sends."""
    n = pages.count()
    counts = pages.select("text").mapInArrow(_counts, "line long, plain long, dressed long").groupBy("line").agg(F.sum("plain").alias("plain"), F.sum("dressed").alias("dressed"))
    known = counts.where(F.col("plain") >= SHARES[0] * n).where("plain > 1").toPandas()
    line = known["line"].to_numpy(np.int64).view(_U)
    order = np.argsort(line)
    return Shares(line[order], known["plain"].to_numpy(np.int64)[order], known["dressed"].to_numpy(np.int64)[order], n)


@dataclass
class PageModel:
    """What body_lines needs of a corpus: the trained model, and the lines that its pages share. Can be kept and applied to later pages."""

    crf: Crf
    shares: Shares

    def to_json(self) -> str:
        return json.dumps({name: {k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in asdict(part).items()} for name, part in (("crf", self.crf), ("shares", self.shares))})

    @classmethod
    def from_json(cls, text: str) -> PageModel:
        held = json.loads(text)
        s = held["shares"]
        return cls(Crf(**{k: np.array(v) for k, v in held["crf"].items()}), Shares(np.array(s["line"], _U), np.array(s["plain"], np.int64), np.array(s["dressed"], np.int64), s["pages"]))


def fit(pages: DataFrame, sample: int = SAMPLE) -> PageModel:
    """Train on the sample: its lines are labelled by trusted rules. Features and labels are made on the executors, a byte each."""
    shares = line_shares(pages)
    sent = pages.sparkSession.sparkContext.broadcast(shares)
    hashed = pages.withColumn("h", F.xxhash64("id"))
    most = hashed.select("h").orderBy("h").limit(sample).agg(F.max("h").alias("h")).first().h

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [split(t)[1] for t in batch.column(2).to_pylist()]
            urls = batch.column(1).to_pylist()
            x, labels = features(lines, urls, sent.value).astype(np.uint8), rule_labels(lines, urls, sent.value)
            out, end = [], 0
            for h, own in zip(batch.column(0).to_pylist(), labels):
                for at in range(0, len(own), LENGTH):
                    part = own[at : at + LENGTH]
                    out.append((h, at, x[end + at : end + at + len(part)].tobytes(), bytes(part)))
                end += len(own)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else ([],) * 4, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["h", "at", "x", "y"])

    found = [] if most is None else hashed.where(F.col("h") <= most).select("h", "url", "text").mapInArrow(stretches, "h long, at long, x binary, y binary").orderBy(F.xxhash64("h", "at"), "h", "at", "x").limit(sample).collect()
    if not found:
        return PageModel(Crf(np.zeros((FEATURES, 3)), np.zeros((3, 3)), np.zeros(3)), shares)
    x = np.concatenate([np.frombuffer(r.x, np.uint8).reshape(-1, FEATURES) for r in found])
    y = np.concatenate([np.frombuffer(r.y, np.uint8) for r in found]).astype(np.int64)
    return PageModel(train(x, y, np.array([len(r.y) for r in found]), 3), shares)


def decode(model: Crf, pages: list[np.ndarray]) -> list[np.ndarray]:
    """States of the lines of each page. Pages of like length are decoded together; longer ones than STRETCH in overlapping stretches."""
    parts = []
    for p, x in enumerate(pages):
        for at in range(0, max(1, len(x)), STRETCH - OVERLAP):
            parts.append((p, at, x[at : at + STRETCH]))
            if at + STRETCH >= len(x):
                break
    out = [np.zeros(len(x), np.int64) for x in pages]
    order = sorted(range(len(parts)), key=lambda i: len(parts[i][2]))
    for i in range(0, len(order), 256):
        group = [parts[j] for j in order[i : i + 256] if len(parts[j][2])]
        if group:
            found = model.decode(np.concatenate([g[2] for g in group]).astype(float), np.array([len(g[2]) for g in group]))
            ends = np.cumsum([len(g[2]) for g in group])
            for (p, at, x), end in zip(group, ends):
                skip = OVERLAP // 2 if at else 0
                out[p][at + skip : at + len(x)] = found[end - len(x) + skip : end]
    return out


def body_lines(df: DataFrame, key: str = "page_id", url: str = "source", text: str = "text", sample: int = SAMPLE, model: PageModel | None = None) -> DataFrame:
    """(key, line_no, body) of every non-blank line of each page: whether it belongs to the main body. Lines are the pieces between line feeds, from 0.

    The blocks are lines, since the pages come as text: in place of ancestor tags the features use bullets, separators, dates, the share of pages a
    line stands on, the page's URL and the kinds of the lines around. Without a model one is trained on the first `sample` pages by hash of their id;
    line shares are counted over all pages. Null and blank texts give no rows; a null url only lacks the title feature; pages of any length are decoded
    whole. Repeated keys are decoded each for itself. Extra columns are never read; an empty table gives no rows."""
    spark = df.sparkSession
    pages = df.select(F.col(key).alias("id"), F.col(url).alias("url"), F.col(text).alias("text")).where(F.col("text").rlike(r"\S"))
    pages = spread(pages)
    sent = spark.sparkContext.broadcast(model or fit(pages, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf, shares = sent.value.crf, sent.value.shares
        for whole in batches:
            for at in range(0, whole.num_rows, PAGES):
                batch = whole.slice(at, PAGES)
                found = [split(t) for t in batch.column(2).to_pylist()]
                x = features([lines for _, lines in found], batch.column(1).to_pylist(), shares)
                n = [len(no) for no, _ in found]
                states = decode(crf, np.split(x, np.cumsum(n)[:-1]))
                state = np.concatenate(states) if states else np.zeros(0)
                rows = np.repeat(np.arange(len(n)), n)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array([i for no, _ in found for i in no], pa.int32()), pa.array(state == BODY, pa.bool_())], names=["id", "line_no", "body"])

    kind = df.schema[key].dataType.simpleString()
    return pages.mapInArrow(run, f"id {kind}, line_no int, body boolean").select(F.col("id").alias(key), "line_no", "body")


def main_text(df: DataFrame, key: str = "page_id", url: str = "source", text: str = "text") -> DataFrame:
    """df with only the body lines left of each text; null and blank texts stay. Keys must be unique."""
    drop = body_lines(df, key, url, text).where("not body").groupBy(key).agg(F.collect_set("line_no").alias("__drop"))
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col("__drop"), i)), "\n")
    return df.join(drop, key, "left").withColumn(text, F.when(F.col("__drop").isNull(), F.col(text)).otherwise(kept)).drop("__drop")
