"""Skipping what is unchanged, detecting changes against a snapshot, and versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclathe.functions.text import content_hash
from doclathe.operators.records import keep_first


def source_hashes(rows: DataFrame, source: str, order: list[str], value: str) -> DataFrame:
    """(source, content_hash): one hash per source of its rows' hashes in order. Values are hashed before they travel, 32 characters each."""
    each = rows.select(F.col(source).alias("source"), F.struct(*order, F.md5(F.coalesce(F.col(value), F.lit("\x00"))).alias("h")).alias("r"))
    return each.groupBy("source").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["h"]), ""), 256).alias("content_hash"))


def plan_reuse(current: DataFrame, manifest: DataFrame, cached: DataFrame) -> DataFrame:
    """(source, content_hash, action): reuse if the hash is known and a result cached; skip if the source is empty; else extract, or new for unknown sources.

    current: source, content_hash, n_rows. manifest: source, content_hash. cached: source."""
    m = manifest.select("source", F.col("content_hash").alias("old")).groupBy("source").agg(F.max("old").alias("old"))
    c = cached.select("source").distinct().withColumn("has", F.lit(True))
    j = current.join(m, "source", "left").join(c, "source", "left")
    same = F.col("old").eqNullSafe(F.col("content_hash")) & F.col("old").isNotNull()
    action = F.when(same & F.col("has").isNotNull(), "reuse").when(F.col("n_rows") == 0, "skip").when(F.col("old").isNull(), "new").otherwise("extract")
    return j.select("source", "content_hash", action.alias("action"))


def merge_results(plan: DataFrame, cached: DataFrame, fresh: DataFrame, keep_stale: bool = False) -> DataFrame:
    """Results of all sources: cached rows of those reused, fresh rows of the rest. With keep_stale a source whose extraction gave nothing keeps its
    old cache; by default the old result is dropped. Both tables have a column source and else the same columns."""
    reused = cached.join(plan.where("action = 'reuse'").select("source"), "source", "left_semi")
    out = reused.unionByName(fresh.join(plan.where("action <> 'reuse'").select("source"), "source", "left_semi"))
    if keep_stale:
        lost = plan.where("action <> 'reuse'").select("source").join(fresh.select("source").distinct(), "source", "left_anti")
        out = out.unionByName(cached.join(lost, "source", "left_semi"))
    return out


def pending(todo: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """What is still to do."""
    return todo.join(done.select(*on).distinct(), on, "left_anti")


def snapshot(rules: DataFrame, order: list[str], per: Sequence[str] = ()) -> DataFrame:
    """(per, rule_id, content_hash, title, category, source, version) of a rule set; the last row of an id in order counts."""
    rows = keep_first(rules.where("rule_id is not null"), [*per, "rule_id"], order, last=True)
    return rows.select(*per, "rule_id", content_hash(F.col("title"), F.col("description")).alias("content_hash"), "title", "category", "source", F.coalesce("version", F.lit(1)).alias("version"))


def ruleset_hash(rules: DataFrame) -> DataFrame:
    """(ruleset_hash) of a snapshot's rules: one hash over the sorted pairs of id and content."""
    entry = F.concat(F.lit('{"hash": "'), "content_hash", F.lit('", "rule_id": "'), "rule_id", F.lit('"}'))
    each = rules.select("rule_id", "content_hash", entry.alias("e"))
    listed = each.agg(F.array_sort(F.collect_list(F.struct("rule_id", "content_hash", "e"))).alias("l"))
    return listed.select(F.sha2(F.concat(F.lit("["), F.array_join(F.transform("l", lambda x: x["e"]), ", "), F.lit("]")), 256).alias("ruleset_hash"))


SNAPSHOT_SCHEMA = "rule_id string, content_hash string, title string, category string, source string, version int, snapshot_at string, ruleset_hash string"


def save_snapshot(rules: DataFrame, folder: str, at: str) -> str:
    """Write a snapshot to a folder of its own below `folder`, named by its time; returns that folder. The hash of the whole set stands on each row.
    Written again, a snapshot replaces itself; others are never touched."""
    out = f"{folder}/at={at}"
    rules.crossJoin(F.broadcast(ruleset_hash(rules))).withColumn("snapshot_at", F.lit(at)).select(*(c.split()[0] for c in SNAPSHOT_SCHEMA.split(", "))).write.mode("overwrite").json(out)
    return out


def load_snapshot(spark: SparkSession, folder: str, at: str | None = None) -> DataFrame:
    """The rules of the snapshot of a time, or of the latest; none if there is no complete one."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    whole = lambda p: fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
    held = sorted(s.getPath().getName()[3:] for s in fs.listStatus(root) if s.getPath().getName().startswith("at=") and whole(s.getPath())) if fs.exists(root) else []
    wanted = [x for x in held if at is None or x == at][-1:]
    return spark.read.schema(SNAPSHOT_SCHEMA).json(f"{folder}/at={wanted[0]}") if wanted else spark.createDataFrame([], SNAPSHOT_SCHEMA)


def detect_changes(current: DataFrame, previous: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """(per, rule_id, change) between two snapshots: added, removed, modified or unchanged. An empty previous snapshot makes all added. With per, many
    pairs of snapshots at once."""
    keys = [*per, "rule_id"]
    a, b = current.select(*keys, F.col("content_hash").alias("now")), previous.select(*keys, F.col("content_hash").alias("old"))
    j = a.join(b, keys, "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("old") != F.col("now"), "modified").otherwise("unchanged")
    return j.select(*keys, change.alias("change"))


def change_report(changes: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """(per, change, n) for all four changes."""
    counts = changes.groupBy(*per).agg(*(F.count_if(F.col("change") == c).alias(c) for c in ("added", "removed", "modified", "unchanged")))
    return counts.select(*per, F.explode(F.map_from_arrays(F.array(*(F.lit(c) for c in ("added", "removed", "modified", "unchanged"))), F.array("added", "removed", "modified", "unchanged"))).alias("change", "n"))


def apply_versions(current: DataFrame, previous: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """current with its version: 1 for new rules, one more than its own if the content changed, else its own (1 if null)."""
    old = previous.select(*per, "rule_id", F.col("content_hash").alias("__old"))
    own = F.coalesce("version", F.lit(1))
    version = F.when(F.col("__old").isNull(), 1).when(F.col("__old") != F.col("content_hash"), own + 1).otherwise(own)
    return current.join(old, [*per, "rule_id"], "left").withColumn("version", version).drop("__old")


def version_states(rules: DataFrame, previous: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """rules with state: updated if version is over 1; new if its hash is in no rule of the snapshot; else unchanged."""
    known = previous.select(*per, "content_hash").where("content_hash is not null").distinct().withColumn("__known", F.lit(True))
    state = F.when(F.col("version") > 1, "updated").when(F.col("__known").isNull(), "new").otherwise("unchanged")
    return rules.join(known, [*per, "content_hash"], "left").withColumn("state", state).drop("__known")
