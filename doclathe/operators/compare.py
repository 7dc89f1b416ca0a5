"""Differences between two copies of a data set: shared range split points and streamed two-pointer merges."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclathe.functions.unicode import nfc, squeeze
from doclathe.runtime import materialize, parallelism, stored_bytes

#: Bytes of stored rows, compressed, that one partition of a merge holds.
PART_BYTES = 32_000_000

_OUT = pa.schema([(c, pa.string()) for c in ("entity_id", "service_type", "field_name", "diff")])


def _latest(df: DataFrame, side: int, key: str, changed: str, name: str, services: str) -> DataFrame:
    """One row per key: the latest state, ties by greatest content. Partial aggregation keeps hot keys from travelling."""
    body = F.struct(F.col(changed).alias("at"), F.col(name).alias("name"), F.col(services).alias("services"))
    rows = df.select(F.col(key).alias("entity_id"), body.alias("b")).where("entity_id is not null")
    return rows.groupBy("entity_id").agg(F.max("b").alias("b")).select("entity_id", F.lit(side).alias("side"), "b.name", "b.services")


def _canonical(name: Column, services: Column) -> tuple[Column, Column]:
    """The comparable name, and the services as sorted distinct 'type US en US ro US flag' strings (without composition)."""
    text = lambda c: F.coalesce(squeeze(c), F.lit(""))
    one = lambda s: F.concat_ws("\x1f", F.regexp_replace(F.lower(text(s["type"])), " ", "_"), text(s["description"]["en"]), text(s["description"]["ro"]), F.coalesce(s["is_presented"].cast("string"), F.lit("")))
    kept = F.filter(F.coalesce(services, F.array().cast("array<struct<type:string,description:struct<en:string,ro:string>,is_presented:boolean>>")), lambda s: s.isNotNull())
    return text(name), F.array_sort(F.array_distinct(F.transform(kept, one)))


def _by_type(services: list[str]) -> dict[str, list[tuple[str, str, str]]]:
    out: dict[str, list[tuple[str, str, str]]] = {}
    for s in services:
        kind, en, ro, flag = s.split("\x1f")
        out.setdefault(kind, []).append((en, ro, flag))
    return out


def _differences(key: str, a: tuple[str, list[str]], b: tuple[str, list[str]]) -> Iterator[tuple[str, str, str, str]]:
    if a[0] != b[0]:
        yield key, "", "entity_name", "differs"
    if a[1] == b[1]:
        return
    x, y = _by_type(a[1]), _by_type(b[1])
    for kind in sorted(x.keys() | y.keys()):
        if kind not in y:
            yield key, kind, "service", "only_clean"
        elif kind not in x:
            yield key, kind, "service", "only_store"
        else:
            for i, field in enumerate(("description_en", "description_ro", "is_presented")):
                if {s[i] for s in x[kind]} != {s[i] for s in y[kind]}:
                    yield key, kind, field, "differs"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge of one partition, sorted by key and side: two neighbours with one key are the two copies of it. Holds one row between batches."""
    held = None
    for batch in batches:
        out: list[tuple[str, str, str, str]] = []
        for key, side, name, services in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if held is not None and held[0] == key:
                out += _differences(key, held[2:], (name, services))
                held = None
                continue
            if held is not None:
                out.append((held[0], "", "row", ("only_clean", "only_store")[held[1]]))
            held = (key, side, name, services)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], schema=_OUT)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in (held[0], "", "row", ("only_clean", "only_store")[held[1]])], schema=_OUT)


def compare_copies(clean: DataFrame, store: DataFrame, key: str = "entity_id", changed: str = "updated_at", name: str = "entity_name", services: str = "services", partitions: int | None = None) -> DataFrame:
    """(entity_id, service_type, field_name, diff): keys missing on a side and every unequal field of the latest states.

    Texts are compared after NFC and single white space; null equals empty, for texts and service lists. Null service entries don't count.
    Of several unlike services of one type, a field differs if its set of values does. A null flag differs from true and false.
    Rows with a null key are left out; an empty side gives one `row` per key of the other. Other columns are never read."""
    spark = clean.sparkSession
    both = _latest(clean, 0, key, changed, name, services).unionByName(_latest(store, 1, key, changed, name, services))
    n, s = _canonical(F.col("name"), F.col("services"))
    joined = F.concat_ws("\x1d", n, F.concat_ws("\x1e", s))  # one text, so that composition is one call
    flat = both.select("entity_id", "side", joined.alias("t")).select("entity_id", "side", nfc(F.col("t")).alias("t"))
    parts = F.split("t", "\x1d")
    rows = flat.select("entity_id", "side", parts[0].alias("name"), F.when(parts[1] == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.split(parts[1], "\x1e"))).alias("services"))
    rows = materialize(rows)  # split points are drawn from the rows, which would else be made twice
    spread = rows.repartitionByRange(partitions or max(parallelism(spark), stored_bytes(rows) // PART_BYTES), "entity_id").sortWithinPartitions("entity_id", "side")
    return spread.mapInArrow(_merge, "entity_id string, service_type string, field_name string, diff string")
