"""Enrichment by a model behind an interface: batches go out as JSON, replies come back as text and are validated in the JVM."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclathe.functions import text as T
from doclathe.operators import jsonops as J
from doclathe.operators.chunking import assemble, pack_text
from doclathe.operators.records import batches, keep_first


class Backend(Protocol):
    """Anything that answers a batch of texts; made once per task, must be picklable."""

    def __call__(self, request: str) -> str: ...


class SentenceBackend:
    """A deterministic stand-in: splits each chunk of a request by sentences, keeping section and parent."""

    def __call__(self, request: str) -> str:
        out = []
        for chunk in json.loads(request):
            for s in re.split(r"(?<=[.!?])\s+", chunk.get("text") or ""):
                if s.strip():
                    out.append({"section": chunk.get("section") or "General", "text": s.strip(), "parent_id": chunk.get("id")})
        return "Here you are:\n" + json.dumps(out, ensure_ascii=False)


class KeywordBackend:
    """A deterministic stand-in: a service for each keyword that stands in the text, described by the first sentence with it."""

    def __init__(self, services: dict[str, str]):
        self.services = services

    def __call__(self, request: str) -> str:
        found = []
        sentences = [s.strip() for s in re.split(r"(?<=[.!?])\s+|\n+", request) if s.strip()]
        for word, kind in self.services.items():
            hit = next((s for s in sentences if word in s.lower()), None)
            if hit:
                found.append({"type": kind, "description": {"en": hit, "ro": ""}, "is_presented": True})
        return json.dumps(found, ensure_ascii=False)


def ask(df: DataFrame, request: str, backend: Backend, tries: int = 3, wait: float = 1.0, pause: float = 0.0) -> DataFrame:
    """df with reply: the backend's answer to each row's request, tried again after a growing wait, null after the last failure. Rows cross by Arrow;
    the number of partitions is the number of calls at a time."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    at = df.columns.index(request)

    def one(text: str | None) -> str | None:
        for n in range(tries):
            try:
                return None if text is None else backend(text)
            except Exception:  # whatever a backend raises counts as a failed try
                if n + 1 < tries:
                    time.sleep(wait * 2**n)
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            replies = []
            for text in batch.column(at).to_pylist():
                replies.append(one(text))
                time.sleep(pause)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(replies, pa.string())], names=[*batch.schema.names, "reply"])

    return df.mapInArrow(run, f"{fields}, reply string")


def refine(chunks: DataFrame, backend: Backend, size: int = 30, per: tuple[str, ...] = ("source_id",), order: tuple[str, ...] = ("chunk_no",)) -> DataFrame:
    """(per, batch, pos, id, parent_id, section, text): unsent chunks refined batch by batch, the first of equal prefix and section kept, in batch order.
    Batches are slices of `size` chunks of each source in order; a source of any size spreads over tasks."""
    rows = chunks.where(~F.coalesce("sent", F.lit(False))).where(F.col("text").isNotNull()).select(*per, *order, "id", "section", "text")
    placed = batches(rows, list(per), list(order), size)
    each = F.struct("pos", "id", "section", "text")
    requests = placed.groupBy(*per, "batch").agg(F.to_json(F.transform(F.array_sort(F.collect_list(each)), lambda s: F.struct(s["id"].alias("id"), s["section"].alias("section"), s["text"].alias("text")))).alias("request"))
    replies = ask(requests, "request", backend)
    found = replies.select(*per, "batch", F.posexplode(J.valid_chunks(J.salvage(F.col("reply")))).alias("pos", "c")).select(*per, "batch", "pos", "c.*")
    return keep_first(found, [*per, F.substring("text", 1, 200), "section"], ["batch", "pos"])


def extract_services(chunks: DataFrame, backend: Backend, per: tuple[str, ...] = ("source_id",), order: tuple[str, ...] = ("chunk_no",), size: int = 50_000, rows: int = 500) -> DataFrame:
    """(per, type, description, is_presented): services of each source, asked in packs of its text, the first of each type kept.

    The text of a source is assembled from `rows` chunks at a time, so that no value holds a whole source; packs of up to `size` characters end there."""
    parts = batches(chunks.select(*per, *order, "section", "text"), list(per), list(order), rows)
    texts = assemble(parts, [*per, "batch"], ["pos"]).select(*per, "batch", F.posexplode(pack_text(F.col("text"), size)).alias("pack", "request"))
    replies = ask(texts, "request", backend, tries=5)
    found = replies.select(*per, "batch", "pack", F.posexplode(J.valid_services(J.salvage(F.col("reply")))).alias("pos", "s")).select(*per, "batch", "pack", "pos", "s.*")
    return keep_first(found, [*per, F.lower(T.strip(F.col("type")))], ["batch", "pack", "pos"]).drop("batch", "pack", "pos")


def entities(chunks: DataFrame, services: DataFrame, order: str = "chunk_no") -> DataFrame:
    """(source_id, entity_name, entity_type, source_url, services): one row per source with services; name and type of its first chunk, the name
    falling back to the source's id."""
    first = chunks.groupBy("source_id").agg(F.min(F.struct(order, "entity", "entity_type", "source")).alias("f"))
    listed = services.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("type", "description", "is_presented"))).alias("services"))
    return first.join(listed, "source_id").select("source_id", F.coalesce(F.when(F.col("f.entity") != "", F.col("f.entity")), "source_id").alias("entity_name"), F.col("f.entity_type").alias("entity_type"), F.col("f.source").alias("source_url"), "services")
