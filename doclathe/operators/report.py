"""Queries of a monitoring page: browses, counts, statuses and progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclathe.functions import text as T


def browse(df: DataFrame, among: dict[str, Sequence[str]], search: str = "", within: Sequence[str] = ()) -> DataFrame:
    """Rows whose columns hold one of the given values, and of which any searched column contains the text, case aside. Empty choices allow all."""
    for column, values in among.items():
        if values:
            df = df.where(F.col(column).isin(*values))
    if search:
        hit = F.lit(False)
        for column in within:
            hit = hit | F.contains(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(search.lower()))
        df = df.where(hit)
    return df


def first_values(df: DataFrame, column: str, n: int = 3) -> DataFrame:
    """The first values of a column in order: a default choice."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(n)


def top_counts(df: DataFrame, column: str, order: str, n: int = 8) -> DataFrame:
    """(column, n): the most frequent values, ties by their first row in order; null is a value."""
    counted = df.groupBy(column).agg(F.count("*").alias("n"), F.min(order).alias("__first"))
    return counted.orderBy(F.desc("n"), "__first").limit(n).drop("__first")


def distinct_count(c: Column) -> Column:
    """Distinct values, null among them."""
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


def source_status(sources: DataFrame, done: DataFrame, begun: DataFrame) -> DataFrame:
    """(id, label, website, status, segments): Processed with the count of done rows, else Partial if anything was begun, else Pending. done and begun have a source_id."""
    count = lambda df, name: df.groupBy(F.col("source_id").alias("id")).agg(F.count("*").alias(name))
    t = sources.join(count(done, "__done"), "id", "left").join(count(begun, "__begun"), "id", "left")
    status = F.when(F.col("__done") > 0, "Processed").when(F.col("__begun") > 0, "Partial").otherwise("Pending")
    return t.select("id", T.label(F.col("id")).alias("label"), T.domain(F.col("url")).alias("website"), status.alias("status"), F.coalesce("__done", F.lit(0)).alias("segments"))


def status_totals(status: DataFrame) -> DataFrame:
    """(processed, pending, segments)."""
    return status.agg(F.count_if(F.col("status") == "Processed").alias("processed"), F.count_if(F.col("status") == "Pending").alias("pending"), F.coalesce(F.sum("segments"), F.lit(0)).alias("segments"))


def progress(logs: DataFrame, markers: Sequence[tuple[str, float, str]], run: str = "run", output: str = "output") -> DataFrame:
    """(run, share, label) of the last listed marker that the run's output contains; 0 and '' if none does. markers: (text, share, label), in order."""
    listed = F.array(*(F.when(F.contains(F.col(output), F.lit(m)), F.struct(F.lit(float(share)).alias("share"), F.lit(label).alias("label"))) for m, share, label in markers))
    seen = F.filter(listed, lambda x: x.isNotNull())
    last = F.get(seen, F.size(seen) - 1)
    return logs.select(run, F.coalesce(last["share"], F.lit(0.0)).alias("share"), F.coalesce(last["label"], F.lit("")).alias("label"))


def tail_lines(c: Column, n: int = 60) -> Column:
    """The last n lines of a text."""
    lines = F.split(c, "\n")
    return F.array_join(F.slice(lines, F.greatest(F.size(lines) - n + 1, F.lit(1)), F.lit(n)), "\n")


def tail(c: Column, n: int = 3000) -> Column:
    """The last n characters of a text."""
    return F.when(F.length(c) > n, F.substring(c, -n, n)).otherwise(c)


def text_report(counts: DataFrame, label: str, n: str = "n") -> DataFrame:
    """(line): a table of counts as text, in order of the label."""
    return counts.select(F.concat(F.rpad(F.coalesce(F.col(label), F.lit("-")), 24, " "), F.lit(" "), F.lpad(F.col(n).cast("string"), 10, " ")).alias("line"))
