"""Keyword search: any query word matches, rows are ranked by BM25."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliospark.functions.scoring import BM25_B, BM25_K1, bm25, idf_value, rounded
from foliospark.functions.text import query_terms, word_tokens
from foliospark.operators.topk import MATRIX_CELLS, BetterCounts, Finder, Leaders, query_passes, ranked, top
from foliospark.session import local_rows, staged

QUERIES_PER_MATRIX = 256
TERMS_PER_PASS = 200_000
MATCH_ALL = "*"


def field_tokens(fields: Sequence[str]) -> Column:
    """Word tokens of one or several text fields as one bag; a null field has none."""
    return F.concat(*[word_tokens(F.coalesce(f, F.lit(""))) for f in fields])


def corpus_stats(docs: DataFrame, fields: Sequence[str] = ("content",)) -> DataFrame:
    """One row: number of documents, their mean token count, all tokens."""
    lengths = docs.select(F.size(field_tokens(fields)).alias("length"))
    return lengths.agg(
        F.count(F.lit(1)).alias("documents"), F.avg("length").alias("mean_length"),
        F.sum("length").alias("tokens"))


def term_frequencies(docs: DataFrame, fields: Sequence[str] = ("content",)) -> DataFrame:
    """(term, doc_freq): equal terms are counted per task before the shuffle."""
    return docs.select(F.explode(F.array_distinct(field_tokens(fields))).alias("term")) \
        .groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))


def term_hits(docs: DataFrame, terms: list[str], fields: Sequence[str], id_col: str,
              where: Column | None = None) -> tuple[DataFrame, dict]:
    """The rows that hold a query word and pass ``where``, as (id, length, one count per term), and the statistics.

    The text is read and tokenised once and nothing is shuffled: words are counted in each row, rows without any are
    dropped by the task that read them, and the others are written as a few numbers each. Number of documents, mean
    length and document frequencies of the whole table are observed by the same pass.
    """
    keep = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    tokens = docs.select(F.col(id_col).alias("id"), keep.alias("keep"), field_tokens(fields).alias("_tokens"))
    found = tokens.filter(F.col("id").isNotNull()).select(
        "id", "keep", F.size("_tokens").alias("length"), F.filter("_tokens", lambda t: t.isin(terms)).alias("_found"))
    def occurrences(word: str) -> Column:
        return F.size(F.filter("_found", lambda t: t == word))

    counts = [occurrences(w).alias(f"tf{i}") for i, w in enumerate(terms)]
    seen = Observation()
    rows = found.select("id", "keep", "length", *counts).observe(
        seen, F.count(F.lit(1)).alias("documents"), F.avg("length").alias("mean_length"),
        *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])
    hit = reduce(lambda a, b: a | b, [F.col(f"tf{i}") > 0 for i in range(len(terms))])
    return staged(rows.filter(F.col("keep") & hit).drop("keep"), "hits"), seen.get


def keyword_scores(docs: DataFrame, query: str, fields: Sequence[str] = ("content",), id_col: str = "id",
                   where: Column | None = None) -> DataFrame:
    """(id, score) of every row that holds a query word and passes ``where``.

    Statistics cover the whole table, so a filter changes which rows are ranked and not how
    they score. ``*`` matches every row with score 1.
    """
    if query.strip() == MATCH_ALL:
        rows = docs if where is None else docs.filter(where)
        return rows.select(F.col(id_col).alias("id"), F.lit(1.0).alias("score"))
    terms = query_terms(docs.sparkSession, query)
    if not terms:
        return docs.select(F.col(id_col).alias("id"), F.lit(0.0).alias("score")).limit(0)
    hits, stats = term_hits(docs, terms, fields, id_col, where)
    score = reduce(lambda a, b: a + b, [
        bm25(F.col(f"tf{i}"), F.col("length"), F.lit(stats["mean_length"]), F.lit(stats["documents"]), F.lit(stats[f"df{i}"]))
        for i in range(len(terms))])
    return hits.select("id", rounded(score).alias("score"))


def keyword_search(docs: DataFrame, query: str, k: int = 5, fields: Sequence[str] = ("content",),
                   id_col: str = "id", where: Column | None = None) -> DataFrame:
    return top(keyword_scores(docs, query, fields, id_col, where), k)


def bm25_weights(docs: DataFrame, terms: list[str], fields: Sequence[str] = ("content",),
                 id_col: str = "id") -> DataFrame:
    """(id, term, tf, weight) of every given term in every document that holds it."""
    hits, stats = term_hits(docs, terms, fields, id_col)
    pairs = F.array(*[F.struct(
        F.lit(w).alias("term"), F.col(f"tf{i}").cast("int").alias("tf"),
        rounded(bm25(F.col(f"tf{i}"), F.col("length"), F.lit(stats["mean_length"]), F.lit(stats["documents"]), F.lit(stats[f"df{i}"])))
        .alias("weight")) for i, w in enumerate(terms)])
    return hits.select("id", F.inline(pairs)).filter(F.col("tf") > 0)


class _QueryBlock:
    """Up to 256 queries with their own vocabulary."""

    def __init__(self, queries: list[list[str]], doc_freq: dict[str, int], documents: int):
        words = sorted({w for q in queries for w in q if w in doc_freq})
        place = {w: i for i, w in enumerate(words)}
        self.words = words
        self.idf = np.array([idf_value(documents, doc_freq[w]) for w in words])
        self.uses = np.zeros((len(words), len(queries)))
        for column, query in enumerate(queries):
            for w in query:
                if w in place:
                    self.uses[place[w], column] = 1.0

    def scores(self, tokens: pa.ListArray, lengths: np.ndarray, mean_length: float) -> np.ndarray:
        width = len(self.words)
        codes = pc.fill_null(pc.index_in(tokens.flatten(), value_set=pa.array(self.words, pa.string())), -1)
        codes = codes.to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        hit = codes >= 0
        tf = np.bincount(owner[hit] * width + codes[hit], minlength=len(lengths) * width)
        tf = tf.reshape(len(lengths), width).astype(np.float64)
        damp = BM25_K1 * (1 - BM25_B + BM25_B * lengths / mean_length)
        return (tf * (BM25_K1 + 1) / (tf + damp[:, None]) * self.idf) @ self.uses


def batch_keyword_search(docs: DataFrame, queries: DataFrame, k: int = 5, fields: Sequence[str] = ("content",),
                         id_col: str = "id", where: Column | None = None) -> DataFrame:
    """(query_id, id, score, rank) for a whole table of queries (query_id, text).

    Repeated query texts are searched once. Reads the corpus twice per pass over the
    queries: for the document frequencies of the query words, then for the scores. A pass writes its
    leaders before the next one begins, so the driver and the executors hold one block of queries.
    """
    text_key = F.md5(F.col("text").cast("binary"))
    texts = queries.select(text_key.alias("query_id"), "text").dropDuplicates(["query_id"])
    written = []
    for one in keyword_passes(docs, texts, fields, id_col, where):
        written.append(staged(one.leaders(k), "leaders"))
        one.shared.unpersist()
    hits = reduce(DataFrame.unionByName, written, _no_hits(docs, texts, id_col))
    best = ranked(hits, k).withColumnRenamed("query_id", "_text")
    return queries.select("query_id", text_key.alias("_text")).join(best, "_text") \
        .select("query_id", "id", "score", "rank")


def _hit_schema(docs: DataFrame, queries: DataFrame, id_col: str) -> T.StructType:
    return T.StructType([queries.schema["query_id"], docs.select(F.col(id_col).alias("id")).schema[0],
                         T.StructField("score", T.DoubleType())])


def _no_hits(docs: DataFrame, queries: DataFrame, id_col: str) -> DataFrame:
    return local_rows(docs.sparkSession, [], _hit_schema(docs, queries, id_col))


def keyword_passes(docs: DataFrame, queries: DataFrame, fields: Sequence[str], id_col: str,
                   where: Column | None = None) -> Iterator[KeywordPass]:
    """One pass over the corpus per bounded block of queries (query_id, text), each made when the one before is done."""
    worded = queries.select("query_id", F.array_distinct(word_tokens("text")).alias("terms")) \
        .filter(F.size("terms") > 0)
    tokens = docs.select(F.col(id_col).alias("id"), field_tokens(fields).alias("tokens"),
                         (F.lit(True) if where is None else F.coalesce(where, F.lit(False))).alias("keep"))
    schema = _hit_schema(docs, queries, id_col)
    for rows in query_passes(worded, F.size("terms"), TERMS_PER_PASS):
        yield KeywordPass(tokens, rows, schema)


class KeywordPass:
    """A block of queries with the corpus statistics of their words, ready to score documents."""

    def __init__(self, tokens: DataFrame, rows: list, schema: T.StructType):
        spark, self.tokens, self.schema = tokens.sparkSession, tokens, schema
        self.query_ids = [r["query_id"] for r in rows]
        vocabulary = local_rows(spark, [(w,) for w in sorted({w for r in rows for w in r["terms"]})], "term string")
        per_doc = tokens.select(F.size("tokens").alias("length"), F.array_distinct("tokens").alias("words"))
        # One aggregation gives both: a row per query word, and the row of the null word that
        # every document brings once for the corpus totals. Its result is bounded by the query words.
        words = per_doc.select(
            F.explode(F.concat(F.array(F.lit(None).cast("string")), F.col("words"))).alias("term"), "length")
        counted = words.join(F.broadcast(vocabulary.withColumn("_known", F.lit(True))), "term", "left") \
            .filter(F.col("_known") | F.col("term").isNull()) \
            .groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"))
        found = {r["term"]: r for r in counted.collect()}
        corpus = found.pop(None, None)
        doc_freq = {term: r["n"] for term, r in found.items()}
        blocks = [(first, _QueryBlock([r["terms"] for r in rows[first:first + QUERIES_PER_MATRIX]], doc_freq,
                                      corpus["n"] if corpus else 0))
                  for first in range(0, len(rows), QUERIES_PER_MATRIX)]
        self.shared = spark.sparkContext.broadcast((blocks, corpus["mean"] if corpus else 0.0))

    def scan(self, visitor: Callable[[], object], schema: T.StructType) -> DataFrame:
        """Score every document against every query; each task's ``visitor`` decides what is kept."""
        shared, arrow = self.shared, to_arrow_schema(schema)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks, mean_length = shared.value
            seen = visitor()
            for batch in batches:
                for first, block in blocks:
                    if not block.words:
                        continue
                    step = max(1, MATRIX_CELLS // max(len(block.words), block.uses.shape[1]))
                    for start in range(0, batch.num_rows, step):
                        part = batch.slice(start, step)
                        lists = part.column("tokens")
                        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                        scores = block.scores(lists, lengths, mean_length)
                        ids = np.array(part.column("id").to_pylist())
                        seen.offer_matrix(scores, scores > 0, ids, first)
            yield from seen.batches(arrow)

        return self.tokens.filter("keep").select("id", "tokens").mapInArrow(search, schema)

    def leaders(self, k: int) -> DataFrame:
        """(query_id, id, score): the k best of each task."""
        query_ids = self.query_ids
        return self.scan(lambda: Leaders(k, query_ids), self.schema)

    def scores_of(self, wanted: dict[object, list]) -> DataFrame:
        """(query_id, id, score) of the matches among the wanted query-to-ids pairs."""
        place = {q: i for i, q in enumerate(self.query_ids)}
        pairs: dict[object, list[int]] = {}
        for query, ids in wanted.items():
            for one in ids if query in place else ():
                pairs.setdefault(one, []).append(place[query])
        shared, query_ids = self.tokens.sparkSession.sparkContext.broadcast(pairs), self.query_ids
        return self.scan(lambda: Finder(shared.value, query_ids), self.schema)

    def ranks_of(self, marks: dict[object, list[tuple]]) -> DataFrame:
        """(query_id, id, rank) of marked matches, given as query to (id, score) pairs: how many
        matches are better is counted per task and then added up."""
        place = {q: i for i, q in enumerate(self.query_ids)}
        placed = {place[q]: (np.array([s for _, s in m]), np.array([i for i, _ in m]))
                  for q, m in marks.items() if q in place and m}
        shared, query_ids = self.tokens.sparkSession.sparkContext.broadcast(placed), self.query_ids
        schema = T.StructType([*self.schema.fields[:2], T.StructField("better", T.LongType())])
        counted = self.scan(lambda: BetterCounts(shared.value, query_ids), schema)
        return counted.groupBy("query_id", "id").agg((F.sum("better") + 1).cast("int").alias("rank"))
