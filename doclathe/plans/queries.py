"""Queries of the core operators: name -> (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclathe.functions.quality import reason
from doclathe.functions.text import WS
from doclathe.operators.chunking import semantic_chunks
from doclathe.operators.compare import compare_copies
from doclathe.operators.records import chunk_dedupe
from doclathe.operators.snapshots import snapshot_changes
from doclathe.plans import record_queries, site_queries, text_queries
from doclathe.runtime import spread, table

Query = Callable[[SparkSession, str], DataFrame]


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_changes(table(spark, d, "rule_snapshots")).select("snapshot_no", F.col("key").alias("rule_id"), "change")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return compare_copies(table(spark, d, "clean_entities"), table(spark, d, "store_entities"))


def chunk_counts(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: documents that pass the quality gate, chunked, the first of like chunks kept, counted by source."""
    docs = spread(table(spark, d, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source_id"), "text"))
    passed = docs.withColumn("text", F.when(reason(F.col("text")) == "ok", F.col("text")))  # no filter: that would run before the rows are spread
    chunks = semantic_chunks(passed, ["source_id", "doc_id"])
    return chunk_dedupe(chunks, ["doc_id", "chunk_no"]).groupBy("source_id").agg(F.count("*").alias("chunks"), F.sum(F.length("text")).alias("characters"))


QUERIES: dict[str, Query] = {"chunk_counts": chunk_counts, "p5_found": p5_found, "p6_found": p6_found} | text_queries.QUERIES | record_queries.QUERIES | site_queries.QUERIES

# --- SQL of the queries above ---

_norm = lambda c: f"trim(regexp_replace(lower(nfc_normalize(coalesce({c}, ''))), {text_queries.lit(WS + '+')}, ' ', 'g'))"
_P5 = f"""
    WITH r AS (SELECT snapshot_no AS no, upper({text_queries.strip('rule_id')}) AS k, loaded_at, md5({_norm('title')} || chr(31) || {_norm('description')}) AS h FROM rule_snapshots WHERE coalesce({text_queries.strip('rule_id')}, '') <> ''),
    l AS (SELECT no, k, h FROM r QUALIFY row_number() OVER (PARTITION BY no, k ORDER BY loaded_at DESC NULLS LAST, h DESC) = 1),
    n AS (SELECT no FROM (SELECT DISTINCT snapshot_no AS no FROM rule_snapshots) x WHERE no - 1 IN (SELECT snapshot_no FROM rule_snapshots))
    SELECT no AS snapshot_no, k AS rule_id, change FROM (
      SELECT n.no, coalesce(a.k, b.k) AS k, CASE WHEN b.h IS NULL THEN 'added' WHEN a.h IS NULL THEN 'removed' WHEN a.h <> b.h THEN 'changed' END AS change
      FROM n JOIN (SELECT DISTINCT k FROM l) keys ON true LEFT JOIN l a ON a.no = n.no AND a.k = keys.k LEFT JOIN l b ON b.no = n.no - 1 AND b.k = keys.k WHERE a.k IS NOT NULL OR b.k IS NOT NULL) WHERE change IS NOT NULL"""
_text = lambda c: f"trim(regexp_replace(nfc_normalize(coalesce({c}, '')), {text_queries.lit(WS + '+')}, ' ', 'g'))"
_side = f"""SELECT entity_id, {_text('entity_name')} AS name, services FROM @T WHERE entity_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY updated_at DESC NULLS LAST, entity_name DESC NULLS LAST) = 1"""
_flat = f"SELECT entity_id, replace({_text('lower(s.type)')}, ' ', '_') AS t, {_text('s.description.en')} AS en, {_text('s.description.ro')} AS ro, coalesce(s.is_presented::VARCHAR, '') AS p FROM (SELECT entity_id, unnest(services) AS s FROM @T) WHERE s IS NOT NULL"
_P6 = f"""
    WITH c AS ({_side.replace('@T', 'clean_entities')}), s AS ({_side.replace('@T', 'store_entities')}),
    cs AS (SELECT entity_id, t, list_sort(list_distinct(list(en))) AS en, list_sort(list_distinct(list(ro))) AS ro, list_sort(list_distinct(list(p))) AS p FROM ({_flat.replace('@T', 'c')}) WHERE entity_id IN (SELECT entity_id FROM s) GROUP BY ALL),
    ss AS (SELECT entity_id, t, list_sort(list_distinct(list(en))) AS en, list_sort(list_distinct(list(ro))) AS ro, list_sort(list_distinct(list(p))) AS p FROM ({_flat.replace('@T', 's')}) WHERE entity_id IN (SELECT entity_id FROM c) GROUP BY ALL)
    SELECT entity_id, '' AS service_type, 'row' AS field_name, 'only_clean' AS diff FROM c WHERE entity_id NOT IN (SELECT entity_id FROM s)
    UNION ALL SELECT entity_id, '', 'row', 'only_store' FROM s WHERE entity_id NOT IN (SELECT entity_id FROM c)
    UNION ALL SELECT c.entity_id, '', 'entity_name', 'differs' FROM c JOIN s USING (entity_id) WHERE c.name <> s.name
    UNION ALL SELECT entity_id, t, 'service', 'only_clean' FROM cs ANTI JOIN ss USING (entity_id, t) UNION ALL SELECT entity_id, t, 'service', 'only_store' FROM ss ANTI JOIN cs USING (entity_id, t)
    UNION ALL SELECT entity_id, t, 'description_en', 'differs' FROM cs JOIN ss USING (entity_id, t) WHERE cs.en <> ss.en
    UNION ALL SELECT entity_id, t, 'description_ro', 'differs' FROM cs JOIN ss USING (entity_id, t) WHERE cs.ro <> ss.ro
    UNION ALL SELECT entity_id, t, 'is_presented', 'differs' FROM cs JOIN ss USING (entity_id, t) WHERE cs.p <> ss.p"""
_GATE = text_queries._gated("doc_id, source, text", "documents")
_CHUNKS = f"""{_GATE.replace('WITH a AS', 'WITH RECURSIVE a AS')}, passed AS (SELECT doc_id, coalesce(source, '') AS source_id, text FROM c WHERE {text_queries._why} = 'ok'),
    {text_queries.chunks_sql('passed', 'doc_id').strip().removeprefix('RECURSIVE ')},
    f AS (SELECT source_id, chunk.text, row_number() OVER (PARTITION BY source_id, substr(chunk.text, 1, 200), section ORDER BY key, chunk_no) AS no FROM chunk JOIN passed ON doc_id = key)
    SELECT source_id, count(*) AS chunks, sum(length(text))::BIGINT AS characters FROM f WHERE no = 1 GROUP BY source_id"""
ORACLES: dict[str, str] = {"chunk_counts": _CHUNKS, "p5_found": _P5, "p6_found": _P6} | text_queries.ORACLES | record_queries.ORACLES | site_queries.ORACLES
