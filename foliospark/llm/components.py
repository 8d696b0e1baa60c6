"""Connected components over edges held as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import spread_lookup
from foliospark.session import staged


def _mark(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    near = spread_lookup(both, least, ["a"], ["b"]).where("b > a")
    return near.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    near = spread_lookup(down, least, ["a"], ["b"])
    moved = near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``edges(a, b)``; the component is named by its smallest id.

    Alternates large and small stars until the edges no longer change, which takes about the logarithm of the
    longest path in rounds. Each round's edges are written to the shared folder, so a lost executor costs a re-read.
    Edges from an id to itself count as the id alone. An empty table gives no rows.
    """
    alone = edges.where("a = b").select("a")
    held = staged(edges.where("a <> b").select("a", "b").distinct(), "edges", short=True)
    before = _mark(held)
    while before[0]:
        held = staged(_small_star(_large_star(held)), "edges", short=True)
        after = _mark(held)
        if after == before:
            break
        before = after
    labels = held.select(F.col("a").alias("id"), F.col("b").alias("component"))
    heads = held.select(F.col("b").alias("id"), F.col("b").alias("component"))
    lone = alone.select(F.col("a").alias("id"), F.col("a").alias("component"))
    return labels.union(heads).union(lone).groupBy("id").agg(F.min("component").alias("component"))
