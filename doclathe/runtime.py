"""Session plumbing shared by all operators: tables, scratch space, size-checked broadcasts."""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side of proven row width (a few dozen bytes) is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000


def visible_to_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies, if it isn't installed."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    held = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in held:
        env["PYTHONPATH"] = os.pathsep.join([here, *held])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    visible_to_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. The cluster names it in spark.checkpoint.dir; a local one is made only where that is unset."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="doclathe-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named


_written: dict[str, SparkSession] = {}


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _remove_all() -> None:
    for path, spark in list(_written.items()):
        try:
            _remove(spark, path)
        except Exception:  # the JVM is gone; the cluster's own clean-up of the shared folder applies
            pass


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage: write df to the shared folder and read it back. Survives the loss of executors."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"doclathe-{uuid.uuid4().hex}.parquet")
    df.write.option("compression", "zstd").parquet(path)
    _written[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def stored_bytes(df: DataFrame) -> int:
    """The size of a table that materialize() wrote."""
    jvm = df.sparkSession.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(df._scratch)
    return p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def release(*dfs: DataFrame) -> None:
    """Delete tables that materialize() wrote and that nothing reads any more."""
    for df in dfs:
        path = getattr(df, "_scratch", None)
        if path and _written.pop(path, None) is not None:
            _remove(df.sparkSession, path)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of ended steps now, instead of when the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A materialised df with a broadcast hint if it holds at most so many rows, else without (the join then shuffles, and AQE splits hot keys)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


#: Bytes of input per core below which a scan may leave cores idle.
SPREAD_BYTES = 1_000_000


def spread(df: DataFrame) -> DataFrame:
    """df over all cores if it is too small for its scan to reach them all (one small file is one task); larger input is left as it lies."""
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(parallelism(spark)) if size < SPREAD_BYTES * spark.sparkContext.defaultParallelism else df


__all__ = ["BROADCAST_ROWS", "drop_shuffles", "materialize", "parallelism", "release", "shared_dir", "small", "spread", "stored_bytes", "table", "visible_to_workers"]
