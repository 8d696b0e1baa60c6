"""Hybrid search: keyword and vector rankings fused by reciprocal rank."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.functions.scoring import RRF_CONSTANT, reciprocal_rank
from foliospark.operators.keyword import keyword_passes, keyword_scores
from foliospark.operators.topk import ranked, top, with_rank
from foliospark.operators.vector import batch_vector_search, vector_search
from foliospark.session import local_rows, staged

VECTOR_POOL = 50


def fuse(keyword_ranks: DataFrame, vector_ranks: DataFrame, constant: int = RRF_CONSTANT) -> DataFrame:
    """(id, score): a row in either list counts, each list adds 1 / (constant + rank)."""
    left = keyword_ranks.select("id", F.col("rank").alias("_kw"))
    right = vector_ranks.select("id", F.col("rank").alias("_vec"))
    both = left.join(right, "id", "full_outer")
    score = reciprocal_rank(F.col("_kw"), constant) + reciprocal_rank(F.col("_vec"), constant)
    return both.select("id", score.alias("score"))


def ranks_of(scores: DataFrame, wanted: list) -> DataFrame:
    """(id, rank) within all of ``scores`` for the few ids in ``wanted``.

    A global ``row_number`` would sort every match in one task. The wanted rows, in ranked
    order, cut the ranking into sections instead; each match falls into one section, sections
    are counted with map-side combining, and the running total at a wanted row is its rank.
    """
    spark, kind = scores.sparkSession, scores.schema["id"].dataType.simpleString()
    ids = local_rows(spark, [(i,) for i in wanted], f"id {kind}")
    # At most as many rows as ``wanted``.
    found = scores.join(F.broadcast(ids), "id").select("id", "score").collect()
    marks = sorted(((r["score"], r["id"]) for r in found), key=lambda m: (-m[0], m[1]))
    if not marks:
        return scores.select("id", F.lit(0).alias("rank")).limit(0)

    def section(low: int, high: int) -> Column:
        """How many marks rank before a row, by binary search among marks low to high."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        score, name = F.lit(marks[middle][0]), F.lit(marks[middle][1])
        behind = (F.col("score") < score) | ((F.col("score") == score) & (F.col("id") > name))
        return F.when(behind, section(middle + 1, high)).otherwise(section(low, middle))

    counted = scores.select(section(0, len(marks)).alias("pos")).groupBy("pos").count()
    totals = counted.select("pos", F.sum("count").over(Window.orderBy("pos")).cast("int").alias("rank"))
    placed = local_rows(spark, [(pos, name) for pos, (_, name) in enumerate(marks)], f"pos int, id {kind}")
    return placed.join(F.broadcast(totals), "pos").select("id", "rank")


def all_ranks(scores: DataFrame) -> DataFrame:
    """(id, rank) of every row of ``scores``, a stored table, by score and then id.

    A range shuffle brings the rows into order; rows are numbered inside their range and the number of rows of the
    ranges before, one number for each, is added, so no task holds more than its range.
    """
    order = [F.desc("score"), F.col("id")]
    parts = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = staged(scores.repartitionByRange(parts, *order).select("id", "score", F.spark_partition_id().alias("part")), "ranges")
    sizes = dealt.groupBy("part").count()
    before = F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ahead = sizes.select("part", F.coalesce(before, F.lit(0)).alias("ahead"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return dealt.withColumn("inside", inside).join(ahead, "part").select("id", (F.col("inside") + F.col("ahead")).cast("int").alias("rank"))


def hybrid_search(table: DataFrame, query: str, vector: Sequence[float] | DataFrame, k: int = 5,
                  fields: Sequence[str] = ("content",), id_col: str = "id", vector_col: str = "contentVector",
                  where: Column | None = None, pool: int = VECTOR_POOL, scores: DataFrame | None = None) -> DataFrame:
    """The k best by fused rank of the keyword list and the ``pool`` nearest vectors.

    The whole keyword list takes part. Only rows that can reach the top k need a rank,
    though: those in the vector pool, and the first ``k`` + ``pool`` of the keyword list. The
    keyword scores are written once, so the text is read and tokenised a single time; ``scores``
    may bring them from a written term index instead.
    """
    if scores is None:
        scores = keyword_scores(table, query, fields, id_col, where)
    scores = staged(scores, "scores")
    near = with_rank(vector_search(table, vector, pool, id_col, vector_col, where))
    # At most ``pool`` rows.
    near_rows = near.collect()
    near = local_rows(table.sparkSession, near_rows, near.schema)
    first = with_rank(top(scores, k + pool)).select("id", "rank")
    rest = ranks_of(scores, [r["id"] for r in near_rows]).join(F.broadcast(first), "id", "left_anti")
    return top(fuse(first.unionByName(rest), near), k)


def batch_hybrid_search(table: DataFrame, queries: DataFrame, k: int = 5, fields: Sequence[str] = ("content",),
                        id_col: str = "id", vector_col: str = "contentVector", where: Column | None = None,
                        pool: int = VECTOR_POOL) -> DataFrame:
    """(query_id, id, score, rank) for a table of queries (query_id, text, vector).

    Per block of queries: one pass for the nearest vectors, one for word statistics, one for
    the keyword leaders and the keyword scores of the vector pools, and one that counts the exact
    rank of pool members behind the leaders. Blocks and pools are bounded, a block's ranks are written before
    the next one begins, and only per-task leaders and counts are shuffled.
    """
    near = batch_vector_search(table, queries.select("query_id", "vector"), pool, id_col, vector_col, where)
    lists = []
    for one in keyword_passes(table, queries.select("query_id", "text"), fields, id_col, where):
        # pool rows per query of this bounded block
        block = local_rows(table.sparkSession, [(q,) for q in one.query_ids], T.StructType([near.schema["query_id"]]))
        mine = near.join(F.broadcast(block), "query_id", "left_semi").select("query_id", "id").collect()
        wanted: dict = {}
        for row in mine:
            wanted.setdefault(row["query_id"], []).append(row["id"])
        leading = staged(ranked(one.leaders(k + pool), k + pool).select("query_id", "id", "rank"), "leading")
        known = {(r["query_id"], r["id"]) for r in leading.select("query_id", "id").collect()}
        marks: dict = {}
        for row in one.scores_of(wanted).collect():
            if (row["query_id"], row["id"]) not in known:
                marks.setdefault(row["query_id"], []).append((row["id"], row["score"]))
        lists += [leading, staged(one.ranks_of(marks), "ranks")] if marks else [leading]
        one.shared.unpersist()
    words = reduce(DataFrame.unionByName, lists, near.select("query_id", "id", "rank").limit(0))
    both = words.withColumnRenamed("rank", "_kw").join(
        near.select("query_id", "id", F.col("rank").alias("_vec")), ["query_id", "id"], "full_outer")
    score = reciprocal_rank(F.col("_kw")) + reciprocal_rank(F.col("_vec"))
    return ranked(both.select("query_id", "id", score.alias("score")), k)
