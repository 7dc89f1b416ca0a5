"""Incremental ingest with Structured Streaming: deduplicated by content, applied to a keyed table batch by batch."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from doclathe.operators.records import keep_first
from doclathe.runtime import materialize, release


def read_files(spark: SparkSession, path: str, schema: StructType, files: int = 100) -> DataFrame:
    """A stream of the parquet files that appear under a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def unseen(stream: DataFrame, text: str, time: str, late: str) -> DataFrame:
    """Rows whose content wasn't seen within the watermark; state is bounded by it."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withColumn("content_id", F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32)).withWatermark(time, late).dropDuplicatesWithinWatermark(["content_id"])


def windowed_counts(stream: DataFrame, time: str, by: list[str], late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Counts per window and group; rows later than the watermark are left out."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, window), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), *by, "n")


class VersionedTable:
    """A keyed parquet table in buckets by the hash of the key: a version is a list of folders, one per bucket, and a reader takes the last complete list.

    A batch rewrites only the buckets that its keys fall in; the others' folders are taken over from the version before. A batch that is run again writes
    its folders again from the state before it, so a restart neither loses nor doubles a change. The last `keep` versions stay, so that readers of one
    may finish; folders that none of these names are removed."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64, keep: int = 3):
        self.spark, self.path, self.key, self.buckets, self.keep = spark, path, key, buckets, keep
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(self.conf)

    def _names(self, folder: str) -> list[str]:
        p = self.jvm.org.apache.hadoop.fs.Path(self.path, folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def versions(self) -> list[int]:
        return sorted(int(n[1:]) for n in self._names("versions") if "_SUCCESS" in self._names(f"versions/{n}"))

    def folders(self, version: int) -> dict[int, str]:
        rows = self.spark.read.schema("bucket int, folder string").json(os.path.join(self.path, f"versions/v{version}")).collect()
        return {r.bucket: r.folder for r in rows}

    def _read(self, folders: list[str]) -> DataFrame | None:
        return self.spark.read.schema(self._schema()).parquet(*(os.path.join(self.path, f) for f in folders)) if folders else None

    def _schema(self) -> StructType:
        text = self.spark.read.text(os.path.join(self.path, "schema"), wholetext=True).first().value
        return StructType.fromJson(json.loads(text))

    def read(self, before: int | None = None) -> DataFrame | None:
        held = [v for v in self.versions() if before is None or v < before]
        return self._read(sorted(self.folders(held[-1]).values())) if held else None

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def apply(self, rows: DataFrame, version: int, merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> None:
        """Write a version: what merge makes of the touched buckets' rows before and the new rows, which hold each key once."""
        rows = materialize(rows)
        held = [v for v in self.versions() if v < version]
        old = self.folders(held[-1]) if held else {}
        if not held:
            self.spark.createDataFrame([(rows.schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(self.path, "schema"))
        touched = sorted(r.b for r in rows.select(self.bucket().alias("b")).distinct().collect())
        merged = merge(self._read([old[b] for b in touched if b in old]), rows)
        merged.withColumn("__b", self.bucket()).repartition("__b").write.mode("overwrite").partitionBy("__b").parquet(os.path.join(self.path, f"data/v{version}"))
        now = old | {b: f"data/v{version}/__b={b}" for b in touched}
        self.spark.createDataFrame(sorted(now.items()), "bucket int, folder string").coalesce(1).write.mode("overwrite").json(os.path.join(self.path, f"versions/v{version}"))
        release(rows)
        self._prune()

    def _prune(self) -> None:
        every = self.versions()
        for v in every[: -self.keep]:
            self.fs.delete(self.jvm.org.apache.hadoop.fs.Path(self.path, f"versions/v{v}"), True)
        named = {f for v in every[-self.keep :] for f in self.folders(v).values()}
        for v in self._names("data"):
            for part in self._names(f"data/{v}"):
                if part.startswith("__b=") and f"data/{v}/{part}" not in named:
                    self.fs.delete(self.jvm.org.apache.hadoop.fs.Path(self.path, f"data/{v}/{part}"), True)


def upsert_sink(table: VersionedTable, order: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that upserts each batch: of several rows of a key, held or new, the last in order counts; rows without key are left out."""
    last = lambda df: keep_first(df, [table.key], order, last=True)

    def apply(batch: DataFrame, number: int) -> None:
        table.apply(last(batch.where(F.col(table.key).isNotNull())), number, lambda held, rows: rows if held is None else last(held.unionByName(rows)))

    return apply


def run_available(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None] | None = None, out: str | None = None) -> None:
    """Process what is there now and stop."""
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    query = writer.foreachBatch(apply).start() if apply else writer.format("parquet").option("path", out).outputMode("append").start()
    query.awaitTermination()
