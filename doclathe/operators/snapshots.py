"""Change events between periodic full snapshots of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doclathe.functions.unicode import nfc, squeeze


def text_hash(*cols: Column) -> Column:
    """md5 of the texts after NFC, lower case and single spaces; null equals empty."""
    return F.md5(F.concat_ws("\x1f", *(F.lower(squeeze(nfc(c))) for c in cols)))


def latest_states(df: DataFrame, snapshot: str, key: Column, loaded: str, row_hash: Column) -> DataFrame:
    """One (snapshot_no, key, row_hash) per snapshot and key: the row loaded last; among rows loaded at once the greatest hash.

    Combined before the shuffle, so a key that holds a large share of all rows leaves each task as one row.
    Rows without snapshot number or key are left out; a null load time counts as the earliest."""
    rows = df.select(F.col(snapshot).alias("snapshot_no"), key.alias("key"), F.col(loaded).alias("at"), row_hash.alias("h"))
    rows = rows.where(F.col("snapshot_no").isNotNull() & (F.coalesce("key", F.lit("")) != ""))
    best = rows.groupBy("snapshot_no", "key").agg(F.max(F.struct(F.col("at"), F.col("h"))).alias("m"))
    return best.select("snapshot_no", "key", F.col("m.h").alias("row_hash"))


def validity_intervals(states: DataFrame) -> DataFrame:
    """(key, row_hash, valid_from, valid_to): maximal runs of adjacent snapshot numbers in which a key keeps its hash (gaps and islands).

    Expects one row per snapshot and key, so a key's window holds at most one row per snapshot."""
    w = W.partitionBy("key").orderBy("snapshot_no")
    starts = (F.lag("snapshot_no").over(w).eqNullSafe(F.col("snapshot_no") - 1)) & F.lag("row_hash").over(w).eqNullSafe(F.col("row_hash"))
    islands = states.withColumn("new", (~starts).cast("int")).withColumn("island", F.sum("new").over(w))
    return islands.groupBy("key", "island").agg(F.first("row_hash").alias("row_hash"), F.min("snapshot_no").alias("valid_from"), F.max("snapshot_no").alias("valid_to")).drop("island")


def change_events(intervals: DataFrame, delivered: DataFrame) -> DataFrame:
    """(snapshot_no, key, change) from validity intervals and the delivered snapshot numbers.

    A start that adjoins the key's previous interval is `changed`, another start `added`; an end that no interval adjoins is `removed` one
    snapshot later. A snapshot is compared only with the one numbered one less; if that wasn't delivered (or for the first) it gives no events."""
    w = W.partitionBy("key").orderBy("valid_from")
    x = intervals.withColumn("before", F.lag("valid_to").over(w)).withColumn("after", F.lead("valid_from").over(w))
    at_start = F.struct(F.col("valid_from").alias("snapshot_no"), F.when(F.col("before") == F.col("valid_from") - 1, "changed").otherwise("added").alias("change"))
    at_end = F.when(~F.col("after").eqNullSafe(F.col("valid_to") + 1), F.struct((F.col("valid_to") + 1).cast("int").alias("snapshot_no"), F.lit("removed").alias("change")))
    events = x.select("key", F.explode(F.array(at_start, at_end)).alias("e")).where("e is not null").select(F.col("e.snapshot_no").alias("snapshot_no"), "key", F.col("e.change").alias("change"))
    nos = delivered.select(F.col("snapshot_no")).distinct()
    comparable = nos.join(nos.select((F.col("snapshot_no") + 1).cast("int").alias("snapshot_no")), "snapshot_no", "left_semi")
    return events.join(comparable, "snapshot_no", "left_semi")


def snapshot_changes(df: DataFrame, snapshot: str = "snapshot_no", key: str = "rule_id", loaded: str = "loaded_at", compared: Sequence[str] = ("title", "description")) -> DataFrame:
    """(snapshot_no, key, change) between each snapshot and the one numbered one less. Keys are trimmed and in upper case.

    Empty table: no rows. Rows with null or blank key or null number: ignored, but a delivered number counts even if all its keys are blank.
    Repeated and superseded rows: only the one loaded last counts. Extra columns are never read."""
    k = F.upper(squeeze(F.col(key)))
    states = latest_states(df, snapshot, k, loaded, text_hash(*(F.col(c) for c in compared)))
    delivered = df.select(F.col(snapshot).alias("snapshot_no")).where("snapshot_no is not null").distinct()
    return change_events(validity_intervals(states), delivered)
