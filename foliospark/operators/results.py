"""What is done with hits: fetching fields, merging lists, formatting, boosting."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.scoring import rounded
from foliospark.functions.text import iso_time, preview
from foliospark.schemas import SORTABLE

DEFAULT_TOP = 5
RECENT_DAYS = 30
RECENT_BOOST = 1.2
MIN_RELEVANCE = 0.7

# Fields returned by default for each search type, with totalChunks added for display.
DEFAULT_SELECT = {
    "keyword": ["title", "chunk", "name", "filePath", "extension", "modifiedDateTime", "totalChunks"],
    "vector": ["title", "chunk", "name", "filePath", "chunkNumber", "modifiedDateTime", "totalChunks"],
    "hybrid": ["title", "chunk", "name", "filePath", "extension", "chunkNumber", "modifiedDateTime", "totalChunks"],
    "semantic": ["title", "chunk", "name", "filePath", "extension", "chunkNumber", "modifiedDateTime", "totalChunks"],
}


def default_fields(search_type: str, table: DataFrame) -> list[str]:
    """Default fields that the table has; a table without chunks shows its content instead."""
    wanted = DEFAULT_SELECT.get(search_type, DEFAULT_SELECT["hybrid"])
    if "chunk" not in table.columns:
        wanted = ["content" if f == "chunk" else f for f in wanted]
    return [f for f in wanted if f in table.columns]


def fetch_fields(hits: DataFrame, table: DataFrame, fields: Sequence[str], id_col: str = "id",
                 few: bool = False) -> DataFrame:
    """Join hits back to their rows; the search itself never carries these columns.

    ``few`` states that the hits are the k rows of one query and may be broadcast. The hits
    of a table of queries have no such bound; Spark then chooses by measured size.
    """
    extra = [c for c in hits.columns if c != "id"]
    rows = table.select(F.col(id_col).alias("id"), *[f for f in fields if f != id_col])
    found = rows.join(F.broadcast(hits) if few else hits, "id")
    return found.select("id", *[f for f in fields if f != id_col], *extra)


def sort_by(table: DataFrame, field: str, descending: bool = False) -> DataFrame:
    """Order by a sortable field, ties by id."""
    if field not in SORTABLE:
        raise ValueError(f"{field} is not sortable")
    return table.orderBy(F.desc(field) if descending else F.asc(field), "id")


def union_hits(*lists: DataFrame) -> DataFrame:
    """Hits of several queries one after another, duplicates kept."""
    return reduce(DataFrame.unionByName, lists)


def _one_per(hits: DataFrame, key: str, order: list[Column]) -> DataFrame:
    # The row limit also runs before the shuffle, so a file with very many hits sends one row per task.
    chosen = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return hits.withColumn("_n", chosen).filter(F.col("_n") == 1).drop("_n")


def best_per_file(hits: DataFrame, key: str = "filePath") -> DataFrame:
    """One hit per file, that of the highest score (then lowest query, then rank)."""
    return _one_per(hits, key, [F.desc("score"), F.asc("query_id"), F.asc("rank")])


def first_per_file(hits: DataFrame, key: str = "filePath") -> DataFrame:
    """One hit per file, the first in the order of queries and ranks."""
    return _one_per(hits, key, [F.asc("query_id"), F.asc("rank")])


def boost_recent(hits: DataFrame, as_of: Column, days: int = RECENT_DAYS, factor: float = RECENT_BOOST) -> DataFrame:
    """Multiply the score of rows modified after ``as_of`` minus ``days``, then sort again."""
    cutoff = as_of - F.lit(timedelta(days=days))
    boosted = F.when(F.col("modifiedDateTime") > cutoff, F.col("score") * factor).otherwise(F.col("score"))
    return hits.withColumn("score", rounded(boosted)).orderBy(F.desc("score"), "id")


def above_score(hits: DataFrame, threshold: float = MIN_RELEVANCE, extension: str | None = None) -> DataFrame:
    kept = hits.filter(F.col("score") > threshold)
    return kept if extension is None else kept.filter(F.col("extension") == extension)


def newest(hits: DataFrame, k: int = DEFAULT_TOP) -> DataFrame:
    return hits.orderBy(F.desc("modifiedDateTime"), "id").limit(k)


def fall_back(preferred: DataFrame, other: DataFrame, threshold: float = MIN_RELEVANCE) -> DataFrame:
    """``preferred`` unless all its scores are below ``threshold``, then ``other``.

    The choice is one scalar computed inside the job; both lists are top-k results.
    """
    good = preferred.agg(F.coalesce(F.max("score") >= threshold, F.lit(False)).alias("ok"))
    chosen = preferred.withColumn("_ok", good.scalar()).filter("_ok").drop("_ok")
    spare = other.withColumn("_ok", good.scalar()).filter("NOT _ok").drop("_ok")
    return chosen.unionByName(spare)


def _line(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"   {label}: "), value)


def format_hits(hits: DataFrame, show_scores: bool = True) -> DataFrame:
    """(ordinal, block): the display text of each hit of a ranked top-k list."""
    have = set(hits.columns)
    ordinal = F.row_number().over(Window.orderBy(F.desc("score"), "id"))

    def text(name: str, missing: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(missing)) if name in have else F.lit(missing)

    lines = [F.concat(F.col("ordinal").cast("string"), F.lit(". "), text("name", "Unknown"))]
    if "chunkNumber" in have:
        lines.append(_line("Chunk", F.concat((F.col("chunkNumber") + 1).cast("string"), F.lit("/"),
                                             text("totalChunks", "?"))))
    lines.append(_line("Path", text("filePath", "Unknown")))
    lines.append(_line("Extension", text("extension", "Unknown")))
    if "modifiedDateTime" in have:
        lines.append(_line("Modified", iso_time("modifiedDateTime")))
    if show_scores and "score" in have:
        lines.append(_line("Score", F.format_string("%.4f", "score")))
    if "reranker_score" in have:
        lines.append(_line("Reranker Score", F.format_string("%.4f", "reranker_score")))
    if "caption" in have:
        lines.append(_line("Caption", F.col("caption")))
    body = [F.nullif(F.col(c), F.lit("")) for c in ("chunk", "content") if c in have]
    if body:
        lines.append(_line("Preview", F.concat(preview(F.coalesce(*body)), F.lit("..."))))
    return hits.withColumn("ordinal", ordinal).select("ordinal", F.concat_ws("\n", *lines).alias("block"))


def answer_context(hits: DataFrame, text: str = "chunk", k: int = 3, length: int = 500) -> DataFrame:
    """One row with the first ``length`` characters of the ``k`` best hits, each under its file name."""
    best = hits.orderBy(F.desc("score"), "id").limit(k)
    part = F.concat(F.lit("From "), F.col("name"), F.lit(":\n"), F.left(F.col(text), F.lit(length)))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id", part.alias("part"))))
    return best.agg(F.array_join(F.transform(ordered, lambda h: h["part"]), "\n\n").alias("context"))
