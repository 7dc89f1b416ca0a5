"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclathe.runtime import materialize, release


def _large_star(e: DataFrame) -> DataFrame:
    """Each node's larger neighbours are hung on its smallest neighbour (or itself)."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are hung on the smallest of them."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """(id, component) for every id that a link names; component is the smallest id in reach.

    Links are undirected; repeated and self links and those with a null end are fine (a node named only by itself is its own component).
    Rounds grow with the logarithm of the longest path; each is written to the shared folder, and nothing is collected. The groupings are
    combined before each shuffle, and a star of any size is held as one row per node, never as a list."""
    named = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    nodes = named.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    edges = materialize(named.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = lambda e: e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    before = state(edges)
    for _ in range(most):
        after = materialize(_small_star(_large_star(edges)))
        release(edges)
        edges, now = after, state(after)
        if now == before:
            return nodes.join(edges, nodes["id"] == edges["a"], "left").select("id", F.coalesce("b", "id").alias("component"))
        before = now
    raise RuntimeError(f"no convergence in {most} rounds")
