"""Second-stage ranking by field priority, and extractive captions and answers."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.scoring import rounded
from foliospark.functions.text import SENTENCE_END, query_terms, strip, word_tokens

CANDIDATES = 50
# Field groups by priority: title first, then the text, then name and type as keywords.
PRIORITIES: tuple[tuple[float, tuple[str, ...]], ...] = (
    (3.0, ("title",)),
    (2.0, ("chunk", "content")),
    (1.0, ("name", "extension")),
)

Scorer = Callable[[list[str], list[str]], Column]


def coverage(terms: list[str], text: Column) -> Column:
    """Share of the query words that a text holds."""
    words = F.array(*[F.lit(t) for t in terms]).cast("array<string>")
    return F.size(F.array_intersect(words, word_tokens(text))) / F.lit(float(max(1, len(terms))))


def priority_coverage(terms: list[str], columns: list[str]) -> Column:
    """Weighted word coverage over the prioritised fields that the table has, between 0 and 1."""
    parts, weights = [], 0.0
    for weight, names in PRIORITIES:
        present = [F.coalesce(n, F.lit("")) for n in names if n in columns]
        if present:
            parts.append(coverage(terms, F.concat_ws(" ", *present)) * weight)
            weights += weight
    return reduce(lambda a, b: a + b, parts) / F.lit(weights)


def rerank(hits: DataFrame, table: DataFrame, query: str, k: int = 5, id_col: str = "id",
           scorer: Scorer = priority_coverage) -> DataFrame:
    """Reorder a bounded candidate list by ``scorer`` over the candidates' fields.

    ``hits`` (id, score) has at most a few dozen rows, so the fields are fetched by a
    broadcast of the hits; ties keep the first-stage order.
    """
    terms = query_terms(table.sparkSession, query)
    rows = table.withColumnRenamed(id_col, "id") if id_col != "id" else table
    fetched = rows.join(F.broadcast(hits.select("id", "score")), "id")
    scored = fetched.withColumn("reranker_score", rounded(scorer(terms, rows.columns)))
    return scored.orderBy(F.desc("reranker_score"), F.desc("score"), "id").limit(k)


def passages(text: Column | str) -> Column:
    """Trimmed, non-empty sentences or lines of a text."""
    pieces = F.split(F.col(text) if isinstance(text, str) else text, SENTENCE_END)
    return F.filter(F.transform(pieces, lambda s: strip(s)), lambda s: s != "")


def best_passage(terms: list[str], text: Column | str) -> Column:
    """struct(covered, passage): most query words, the earliest on ties; null without passages."""
    words = F.array(*[F.lit(t) for t in terms]).cast("array<string>")
    rated = F.transform(passages(text), lambda s, i: F.struct(
        F.size(F.array_intersect(words, word_tokens(s))).alias("covered"), (-i).alias("order"), s.alias("passage")))
    return F.array_max(rated)


def with_captions(hits: DataFrame, query: str, text: str = "content") -> DataFrame:
    """Add ``caption`` and ``covered``, the best passage of each hit."""
    terms = query_terms(hits.sparkSession, query)
    return hits.withColumn("_best", best_passage(terms, text)).select(
        *hits.columns, F.col("_best.passage").alias("caption"), F.col("_best.covered").alias("covered"))


def extract_answer(captioned: DataFrame) -> DataFrame:
    """The one best passage over all hits: most words, then best hit, then id."""
    return captioned.filter(F.col("caption").isNotNull()) \
        .orderBy(F.desc("covered"), F.desc("score"), "id").limit(1) \
        .select("id", F.col("caption").alias("answer"), "covered")


