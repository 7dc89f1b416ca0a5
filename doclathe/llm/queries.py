"""Queries of the corpus operators: name -> (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclathe.llm.keyword_spam import spam_shares
from doclathe.llm.leakage import leaked_items
from doclathe.llm.linkage import CONFIDENCE, match_entities
from doclathe.llm.near_duplicates import near_duplicate_classes, near_duplicate_rows
from doclathe.llm.page_body import body_lines
from doclathe.llm.residue import residue_rows
from doclathe.llm.site_lines import repeated_lines
from doclathe.llm.tokenizer import encode
from doclathe.runtime import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines(table(spark, d, "page_texts")).select("page_id", "line_no")


def p2_matches(spark: SparkSession, d: str) -> DataFrame:
    """Entities against airlines and airports: (entity_id, ref_id, confidence)."""
    kind = F.when(F.trim("entity_type") != "", F.lower(F.trim("entity_type")))
    entities = table(spark, d, "clean_entities").select(F.col("entity_id").alias("entity"), kind.alias("kind"), F.col("entity_name").alias("name"), "code", "city", "country", "phone", F.col("website").alias("web"))
    fields = ["name", "full", "code", "city", "country", "phone", F.col("source").alias("web")]
    airlines = table(spark, d, "airlines").withColumn("full", F.lit(None).cast("string")).select(F.col("airline_id").alias("ref"), F.lit("airline").alias("kind"), *fields)
    airports = table(spark, d, "airports").withColumnRenamed("full_name", "full").select(F.col("airport_id").alias("ref"), F.lit("airport").alias("kind"), *fields)
    found = match_entities(entities, airlines.unionByName(airports)).where(F.col("confidence") >= CONFIDENCE)
    return found.select(F.col("entity").alias("entity_id"), F.col("ref").alias("ref_id"), F.round("confidence", 3).alias("confidence"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_matches(spark, d).select("entity_id", "ref_id")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return body_lines(table(spark, d, "raw_pages")).where("not body").select("page_id", "line_no")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    classes = near_duplicate_classes(table(spark, d, "semantic_chunks"))
    a, b = classes.select(F.col("id").alias("chunk_a"), "class"), classes.select(F.col("id").alias("chunk_b"), "class")
    return a.join(b, "class").where("chunk_a < chunk_b").select("chunk_a", "chunk_b")


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    """One row per row of a class, with its class and number of links: (chunk_no, class, links)."""
    return near_duplicate_rows(table(spark, d, "semantic_chunks")).select(F.col("id").alias("chunk_no"), "class", "links")


def p4_rules(spark: SparkSession, d: str) -> DataFrame:
    """Classes of the distinct rule descriptions that share 85 % of their words: (text_id, class)."""
    texts = table(spark, d, "rule_snapshots").select(F.lower(F.trim("description")).alias("text")).distinct().select(F.xxhash64("text").alias("text_id"), "text")
    return near_duplicate_classes(texts, "text_id", "text", similarity=0.85).select(F.col("id").alias("text_id"), "class")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return residue_rows(table(spark, d, "scrape_results")).select("scrape_id")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam_shares(table(spark, d, "documents")).where("share > 0.5").select("doc_id")


QUERIES: dict[str, Query] = {"p1_found": p1_found, "p2_found": p2_found, "p2_matches": p2_matches, "p3_found": p3_found, "p4_found": p4_found, "p4_classes": p4_classes, "p4_rules": p4_rules, "p7_found": p7_found, "p8_ids": p8_ids, "p9_found": p9_found, "p10_found": p10_found}

# --- SQL of the queries above; the others are tested against brute force or held-out rows in tests/llm ---

_KEY = "trim(regexp_replace(lower(line), '[^\\p{L}]+', ' ', 'g'))"
_P1 = f"""
    WITH p AS (SELECT page_id, source_id, source, string_split(text, chr(10)) AS l FROM page_texts WHERE text IS NOT NULL),
    l AS (SELECT page_id, source_id, source, (i - 1)::INT AS line_no, l[i] AS line FROM (SELECT *, unnest(range(1, 1 + len(l))) AS i FROM p)), k AS (SELECT *, {_KEY} AS k FROM l),
    n AS (SELECT source_id, count(DISTINCT source) AS pages FROM page_texts GROUP BY source_id), w AS (SELECT source_id, k, count(DISTINCT source) AS w FROM k WHERE k <> '' GROUP BY ALL)
    SELECT page_id, line_no FROM k JOIN w USING (source_id, k) JOIN n USING (source_id) WHERE 5 * w >= pages"""
ORACLES: dict[str, str] = {"p1_found": _P1}
