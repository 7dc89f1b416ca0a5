"""Keyed stores kept as tables: upserts, partial updates, deletes and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclathe.functions import text as T
from doclathe.operators.matching import token_match
from doclathe.operators.records import keep_first


def upsert(store: DataFrame, changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The store with each changed key's whole row replaced or added; of several changes of a key the last counts, those without key none.

    Idempotent: the same changes again give the same store. One anti join and a union; unchanged rows aren't rewritten field by field."""
    last = keep_first(changes.where(F.col(key).isNotNull()), [key], order, last=True)
    return store.join(last.select(key), key, "left_anti").select(*store.columns).unionByName(last.select(*store.columns))


def outcomes(changes: DataFrame, key: str) -> DataFrame:
    """(total, updated, errors): rows without key are errors."""
    return changes.agg(F.count("*").alias("total"), F.count(key).alias("updated"), (F.count("*") - F.count(key)).alias("errors"))


def push_services(entities: DataFrame, docs: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, entity_name, entity_type, services, outcome) of entities pushed to a store of documents (doc_id, entity_type, services).

    An entity updates only the services of the document its name finds in the index (by whole name, then by word, within its type); one that finds
    none is inserted under its name; types other than airline and airport are skipped. Of several entities that find one document the last in
    entity_no counts; documents that none finds stay. index: key, doc, kind."""
    known = entities.where(F.col("entity_type").isin("airline", "airport"))
    found = None
    for kind in ("airline", "airport"):
        part = token_match(known.where(F.col("entity_type") == kind), index.where(F.col("kind") == kind).select("key", "doc"), "entity_name")
        found = part if found is None else found.unionByName(part)
    target = F.coalesce("doc", F.concat(F.lit("new:"), T.name_key(F.coalesce("entity_name", F.lit("")))))
    pushed = found.select(target.alias("doc_id"), "entity_name", "entity_type", "services", F.when(F.col("doc").isNull(), "inserted").otherwise("updated").alias("outcome"), "entity_no")
    last = keep_first(pushed, ["doc_id"], ["entity_no"], last=True).drop("entity_no")
    skipped = entities.where(~F.coalesce(F.col("entity_type").isin("airline", "airport"), F.lit(False))).select(F.lit(None).cast("string").alias("doc_id"), "entity_name", "entity_type", "services", F.lit("skipped").alias("outcome"))
    kept = docs.join(last.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.lit(None).cast("string").alias("entity_name"), "entity_type", "services", F.lit("kept").alias("outcome"))
    return last.unionByName(skipped).unionByName(kept)


# The fields of a new document of each kind that are empty until somebody fills them.
NEW_DOCUMENT = {
    "airline": ("rules", "sub_rules", "accessibility_info", "accessibility_contacts", "icon", "background_image"),
    "airport": ("full_name", "accessibility_url", "airport_url", "code", "image", "background_image", "phone"),
}


def push_documents(entities: DataFrame, docs: DataFrame, index: DataFrame, at: str) -> DataFrame:
    """The store after a push: (doc_id, entity_type, name, services, updated_at, fields).

    A document that an entity finds gets its services and the time, its other fields stay; an entity that finds none becomes a document with empty fields
    (the full name of an airport is its name). docs: the same columns, fields a map of texts. Matching and ties as in push_services."""
    pushed = push_services(entities, docs, index)
    now = pushed.where("outcome in ('updated', 'inserted')").select("doc_id", "entity_name", F.col("entity_type").alias("__type"), F.col("services").alias("__services"), "outcome")
    none = F.create_map().cast("map<string,string>")
    made = none
    for kind, names in NEW_DOCUMENT.items():
        values = [x for n in names for x in (F.lit(n), F.col("entity_name") if n == "full_name" else F.lit(""))]
        made = F.when(F.col("__type") == kind, F.create_map(*values)).otherwise(made)
    new = now.where("outcome = 'inserted'").select("doc_id", F.col("__type").alias("entity_type"), F.col("entity_name").alias("name"), F.col("__services").alias("services"), F.lit(at).alias("updated_at"), made.alias("fields"))
    changed = now.where("outcome = 'updated'").select("doc_id", "__services", F.lit(True).alias("__hit"))
    kept = docs.join(changed, "doc_id", "left")
    old = kept.select("doc_id", "entity_type", "name", F.when(F.col("__hit"), F.col("__services")).otherwise(F.col("services")).alias("services"), F.when(F.col("__hit"), F.lit(at)).otherwise(F.col("updated_at")).alias("updated_at"), "fields")
    return old.unionByName(new)


def push_report(entities: DataFrame) -> DataFrame:
    """(total, updated, skipped, errors) of a push: entities of a known type are updated, whether their document was there or made; other types are skipped;
    known ones without name and services are errors."""
    known = F.coalesce(F.col("entity_type").isin(*NEW_DOCUMENT), F.lit(False))
    broken = known & F.col("services").isNull() & (F.coalesce("entity_name", F.lit("")) == "")
    return entities.agg(F.count("*").alias("total"), F.count_if(known & ~broken).alias("updated"), F.count_if(~known).alias("skipped"), F.count_if(broken).alias("errors"))


def delete_keys(store: DataFrame, keys: list[str], key: str = "doc_id") -> DataFrame:
    """The store without the rows of a short list of keys; rows with a null key stay."""
    return store.where(F.col(key).isNull() | ~F.col(key).isin(*keys)) if keys else store


def listing(airlines: DataFrame, airports: DataFrame, regulations: DataFrame) -> DataFrame:
    """One row per stored document: entity_name, entity_type, source_id, n_services, updated_at (the day), collection.

    Each: doc_id, name, services, updated_at; airports may have full_name, regulations entity_type. A blank name falls back to the full name, then the id."""
    n = F.when(F.col("services").isNull(), 0).otherwise(F.size("services"))
    day = F.coalesce(F.substring(F.col("updated_at").cast("string"), 1, 10), F.lit(""))

    def rows(df: DataFrame, names: list[str], kind, collection: str) -> DataFrame:
        name = F.coalesce(*(F.when(F.col(c) != "", F.col(c)) for c in names), F.col("doc_id"))
        return df.select(name.alias("entity_name"), kind.alias("entity_type"), F.col("doc_id").alias("source_id"), n.alias("n_services"), day.alias("updated_at"), F.lit(collection).alias("collection"))

    out = rows(airlines, ["name"], F.lit("airline"), "airlines").unionByName(rows(airports, ["name", "full_name"], F.lit("airport"), "airports"))
    return out.unionByName(rows(regulations, ["name"], F.coalesce("entity_type", F.lit("reference")), "regulations"))


def sync_metadata(known: DataFrame, docs: DataFrame, dynamic: list[str], key: str = "doc_id") -> DataFrame:
    """known keys with the document's fields but the dynamic ones, and state: present or placeholder."""
    fields = [c for c in docs.columns if c not in {*dynamic, key}]
    d = docs.select(F.col(key), *(F.col(c) for c in fields), F.lit(True).alias("__has"))
    return known.select(key).distinct().join(d, key, "left").withColumn("state", F.when(F.col("__has").isNull(), "placeholder").otherwise("present")).drop("__has")
