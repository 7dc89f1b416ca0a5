"""Joins by time and range that no single key expresses: as-of, interval and band joins over buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _bucket(time: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(time.cast("timestamp")) / (seconds * 1_000_000))


def as_of(left: DataFrame, right: DataFrame, on: Sequence[str], time: str, seconds: int = 86_400, name: str = "last") -> DataFrame:
    """left with a column `name`: the row of right (as a struct) with the same key and the latest time not after its own; null if there is none.

    Of several such rows of right the greatest by its other columns counts. Null keys match nulls; a null time has no match and is none. A key is cut into
    buckets of time, so a key with a third of all rows spreads over tasks: within a bucket a running last, before it the last of each earlier bucket, of
    which there is one row per key and bucket. Extra columns of left may have any name but `name`."""
    rest = [c for c in right.columns if c not in on]
    row = F.struct(F.col(f"`{time}`").alias("__t"), *(F.col(f"`{c}`") for c in rest))
    keys = [F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(on)]
    names = [f"__k{i}" for i in range(len(on))]
    r = right.where(F.col(f"`{time}`").isNotNull()).select(*keys, _bucket(F.col(f"`{time}`"), seconds).alias("__b"), F.col(f"`{time}`").alias("__t"), row.alias("__row"))
    mine = left.select(F.struct(*(F.col(f"`{c}`") for c in left.columns)).alias("__left"), *keys, _bucket(F.col(f"`{time}`"), seconds).alias("__b"), F.col(f"`{time}`").alias("__t"))
    last = r.groupBy(*names, "__b").agg(F.max("__row").alias("__row"))
    wanted = mine.select(*names, "__b").distinct().withColumn("__row", F.lit(None).cast(last.schema["__row"].dataType))
    before = W.partitionBy(*names).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    carried = last.unionByName(wanted).groupBy(*names, "__b").agg(F.max("__row").alias("__row")).select(*names, "__b", F.last("__row", ignorenulls=True).over(before).alias("__carry"))
    both = mine.withColumn("__row", F.lit(None).cast(r.schema["__row"].dataType)).unionByName(r.withColumn("__left", F.lit(None).cast(mine.schema["__left"].dataType)))
    run = W.partitionBy(*names, "__b").orderBy("__t").rangeBetween(W.unboundedPreceding, 0)
    own = both.withColumn("__last", F.max("__row").over(run)).where("__left is not null")
    same = [own[n].eqNullSafe(carried[n]) for n in names] + [own["__b"] == carried["__b"]]
    joined = own.join(carried, same, "left")
    found = F.when(own["__t"].isNotNull(), F.coalesce("__last", "__carry"))
    return joined.select("__left.*", F.when(found.isNotNull(), F.struct(*(found[c].alias(c) for c in rest))).alias(name))


def interval_join(points: DataFrame, intervals: DataFrame, time: str, start: str, end: str, on: Sequence[str] = (), seconds: int = 86_400) -> DataFrame:
    """Points with every interval that holds them (start included, end not), by equal keys in `on` if given; columns of both but the keys once.

    An interval is given out once per bucket of time that it touches, a point once; the join is by bucket, so neither side is compared with all of the
    other. Choose buckets of about the usual length of an interval. Null ends match nothing."""
    p = points.withColumn("__b", _bucket(F.col(time), seconds))
    i = intervals.where(F.col(start) < F.col(end)).withColumn("__b", F.explode(F.sequence(_bucket(F.col(start), seconds), _bucket(F.col(end), seconds))))
    joined = p.join(i, ["__b", *on])
    return joined.where((p[time] >= i[start]) & (p[time] < i[end])).drop("__b")


def band_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, within: int, on: Sequence[str] = ()) -> DataFrame:
    """Pairs of rows whose times differ by at most `within` seconds, by equal keys in `on` if given. The right side is an interval around its time."""
    edge = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(within)))
    wide = right.withColumn("__from", F.col(right_time) - edge).withColumn("__to", F.col(right_time) + edge + F.expr("interval 1 microsecond"))
    return interval_join(left, wide, left_time, "__from", "__to", on, max(1, 2 * within)).drop("__from", "__to")
