"""Name matching by rules: exact then token, any shared token, and the partitions and registries built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclathe.functions import text as T
from doclathe.runtime import materialize, small


def name_index(docs: DataFrame, names: Sequence[Column], doc: str = "doc_id", order: str = "doc_no", skip: Sequence[str] = ()) -> DataFrame:
    """(key, doc): normalised names of documents; of several documents with one name the last in order counts. Blank names and skipped ids are left out."""
    rows = docs.where(~F.col(doc).isin(*skip)) if skip else docs
    each = rows.select(F.explode(F.array(*(T.name_key(n) for n in names))).alias("key"), F.col(doc).alias("doc"), F.col(order).alias("no")).where("key <> ''")
    return each.groupBy("key").agg(F.max(F.struct("no", "doc"))["doc"].alias("doc"))


def token_match(names: DataFrame, index: DataFrame, name: str = "name") -> DataFrame:
    """names with doc: of the index key that equals the whole name, else of the first word that is a key; null if neither.

    Looked up per distinct name, so a name on a third of all rows is one lookup; the index is broadcast if it is small."""
    distinct = names.select(F.col(name).alias("__name")).where(F.col(name).isNotNull()).distinct()
    key = T.name_key(F.col("__name"))
    tries = distinct.select("__name", F.posexplode(F.concat(F.array(key), T.words(key))).alias("pos", "key"))
    hits = tries.join(small(materialize(index)), "key").groupBy("__name").agg(F.min(F.struct("pos", "doc"))["doc"].alias("doc"))
    return names.join(hits, names[name] == hits["__name"], "left").drop("__name")


def shared_token_match(names: DataFrame, others: DataFrame, name: str = "name", other: str = "other", order: str = "no") -> DataFrame:
    """names with match: the first of the others, in order, that equals the name or shares a word with it; null if none does.

    Of each word only the first other name that holds it can win, so the others shrink to one row per word before the join."""
    first = others.where(F.col(other).isNotNull()).select(F.explode(F.array_distinct(T.words(T.name_key(F.col(other))))).alias("word"), F.struct(F.col(order).alias("no"), F.col(other).alias("name")).alias("o"))
    first = first.groupBy("word").agg(F.min("o").alias("o"))
    distinct = names.select(F.col(name).alias("__name")).where(F.col(name).isNotNull()).distinct()
    each = distinct.select("__name", F.explode(F.array_distinct(T.words(T.name_key(F.col("__name"))))).alias("word"))
    hits = each.join(first, "word").groupBy("__name").agg(F.min("o")["name"].alias("match"))
    return names.join(hits, names[name] == hits["__name"], "left").drop("__name")


def tri_partition(local: DataFrame, store: DataFrame, name: str = "name", order: str = "no") -> DataFrame:
    """(name, state): in_sync or not_pushed for local names, only_in_db for stored names that no local name matched."""
    local, store = local.where(F.coalesce(F.col(name), F.lit("")) != ""), store.where(F.coalesce(F.col(name), F.lit("")) != "")
    matched = shared_token_match(local, store.withColumnRenamed(name, "other"), name, "other", order)
    matched = materialize(matched.select(F.col(name).alias("name"), "match"))
    here = matched.select("name", F.when(F.col("match").isNotNull(), "in_sync").otherwise("not_pushed").alias("state"))
    taken = matched.select(T.name_key(F.col("match")).alias("key")).distinct()
    there = store.select(F.col(name).alias("name"), T.name_key(F.col(name)).alias("key")).join(taken, "key", "left_anti").select("name", F.lit("only_in_db").alias("state"))
    return here.unionByName(there)


def registry_match(df: DataFrame, registry: Sequence[tuple[str, str]], host: Column) -> Column:
    """The entry of the first registered pattern that the host contains; null if none. The registry is a short ordered list in code, so this is one CASE."""
    out = None
    for pattern, entry in registry:
        hit = F.contains(host, F.lit(pattern))
        out = F.when(hit, entry) if out is None else out.when(hit, entry)
    return F.lit(None).cast("string") if out is None else out


def allowed(host: Column, domains: Column) -> Column:
    """The host contains any allowed domain; an empty or null list allows all."""
    return (F.size(F.coalesce(domains, F.array())) == 0) | F.exists(domains, lambda d: F.contains(host, d))
