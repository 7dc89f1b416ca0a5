"""Keep-first deduplication, sequences and batches: always by a stated order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from doclathe.runtime import materialize, small


def keep_first(df: DataFrame, keys: Sequence[Column | str], order: Sequence[str], last: bool = False) -> DataFrame:
    """The first (or last) row of each key in the given order; nulls are a key like any other. The order must be unique within a key, else ties
    are broken by the whole row.

    An aggregation, not a window: each task keeps one row per key before the shuffle, so a key with a third of all rows does no harm."""
    named = [(k if isinstance(k, Column) else F.col(f"`{k}`")).alias(f"__k{i}") for i, k in enumerate(keys)]
    row = F.struct(*(F.col(f"`{c}`") for c in dict.fromkeys([*order, *df.columns])))
    best = (F.max if last else F.min)(row)
    return df.groupBy(*named).agg(best.alias("__row")).select(*(F.col(f"__row.`{c}`").alias(c) for c in df.columns))


def chunk_dedupe(df: DataFrame, order: Sequence[str], per: Sequence[str] = ("source_id",), prefix: int = 200) -> DataFrame:
    """The first chunk of each source, section and text prefix."""
    return keep_first(df, [*per, F.substring("text", 1, prefix), "section"], order)


def numbered(df: DataFrame, order: Sequence[str], name: str = "no") -> DataFrame:
    """Rows numbered from 1 in order, without one task for all: partitions by range, counted, then offset.

    Only the partitions' counts reach the driver, one number each."""
    parts = df.repartitionByRange(*(F.col(c) for c in order)).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__id", F.monotonically_increasing_id())
    parts = materialize(parts)  # a lost task must not draw other split points
    counts = parts.groupBy("__part").agg(F.count("*").alias("n"), F.min("__id").alias("first"))
    offsets = counts.select("__part", "first", (F.sum("n").over(W.orderBy("__part")) - F.col("n")).alias("offset"))
    return parts.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__id") - F.col("first") + F.col("offset") + 1).drop("__part", "__id", "first", "offset")


def resequence(df: DataFrame, order: Sequence[str], name: str = "rule_id", prefix: str = "R", width: int = 3) -> DataFrame:
    """Fresh ids R001, R002, ... in order."""
    return numbered(df, order, "__no").withColumn(name, F.concat(F.lit(prefix), F.when(F.length(F.col("__no").cast("string")) >= width, F.col("__no").cast("string")).otherwise(F.lpad(F.col("__no").cast("string"), width, "0")))).drop("__no")


def batches(df: DataFrame, per: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    """Rows of each group in slices of `size`: columns pos (from 0, long) and batch. Rows that agree in group and order are numbered in any order.

    Rows travel once: to range partitions over group and order, so a large group spreads over tasks, where they are written in order. The place of a row
    is its place in its partition, from where its group begins there, plus what the group has in partitions before; only these counts, one row per group
    and partition, are grouped and joined."""
    cols = [F.col(f"`{c}`") for c in [*per, *order]]
    parts = df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("__part", F.spark_partition_id()).withColumn("__id", F.monotonically_increasing_id())
    parts = materialize(parts)  # a lost task must not draw other split points
    counts = parts.groupBy(*per, "__part").agg(F.count("*").alias("__c"), F.min("__id").alias("__first"))
    before = counts.withColumn("__before", F.sum("__c").over(W.partitionBy(*per).orderBy("__part")) - F.col("__c"))
    before = small(materialize(before.select(*(F.col(f"`{c}`").alias(f"__per{i}") for i, c in enumerate(per)), F.col("__part").alias("__at"), "__first", "__before")))
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"__per{i}")) for i, c in enumerate(per)]
    joined = parts.join(before, [*same, F.col("__part") == F.col("__at")])
    pos = F.col("__id") - F.col("__first") + F.col("__before")
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), pos.alias("pos"), F.floor(pos / size).alias("batch"))
