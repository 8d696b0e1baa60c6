"""Top-k per query over a whole table, keeping only k candidates per query and task.

A batch search relates every query to every matching row. Emitting those pairs would make
the shuffle grow with queries times rows; here each task scores its rows against a bounded
block of queries as one matrix product and lets only its k best per query through, so the
shuffle carries ``k`` rows per query and task whatever the table size. The result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from foliospark.functions.scoring import SCORE_DIGITS

MATRIX_CELLS = 4_000_000


def query_passes(queries: DataFrame, weight: Column, budget: int) -> Iterator[list[Row]]:
    """The query table in blocks of about ``budget`` by summed ``weight``.

    Usually one block; a larger query table takes one pass over the corpus per block, so
    nothing unbounded is held by the driver or shipped to the executors.
    """
    total = queries.agg(F.sum(weight).alias("w")).first()["w"] or 0
    blocks = max(1, -(-int(total) // budget))
    for block in range(blocks):
        part = F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block
        rows = queries.filter(part).collect() if blocks > 1 else queries.collect()
        if rows:
            yield rows


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by (score descending, id ascending)."""
    if len(scores) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        sure, tied = np.flatnonzero(scores > bar), np.flatnonzero(scores == bar)
        tied = tied[np.argsort(ids[tied], kind="stable")][: k - len(sure)]
        return np.concatenate([sure, tied])
    return np.arange(len(scores))


class Leaders:
    """The running k best per query of one task."""

    def __init__(self, k: int, query_ids: list):
        self.k, self.query_ids = k, query_ids
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if query in self.kept:
            old_scores, old_ids = self.kept[query]
            if len(old_scores) == self.k:
                # Equal scores stay in: the id may still win the tie.
                near = scores >= old_scores.min(initial=np.inf)
                scores, ids = scores[near], ids[near]
            if not len(scores):
                return
            scores, ids = np.concatenate([old_scores, scores]), np.concatenate([old_ids, ids])
        top = best_rows(scores, ids, self.k)
        self.kept[query] = scores[top], ids[top]

    def offer_matrix(self, scores: np.ndarray, matched: np.ndarray, ids: np.ndarray, first_query: int = 0) -> None:
        """``scores`` and ``matched`` are rows by queries."""
        scores = np.round(scores, SCORE_DIGITS)
        for q in np.flatnonzero(matched.any(axis=0)):
            rows = matched[:, q]
            self.offer(first_query + int(q), scores[rows, q], ids[rows])

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for query, (scores, ids) in self.kept.items():
            yield _result(schema, [self.query_ids[query]] * len(ids), ids.tolist(), scores)


class Finder:
    """The scores of given (id, query) pairs."""

    def __init__(self, pairs: dict[object, list[int]], query_ids: list):
        self.pairs, self.query_ids = pairs, query_ids
        self.found: list[tuple] = []

    def offer_matrix(self, scores: np.ndarray, matched: np.ndarray, ids: np.ndarray, first_query: int = 0) -> None:
        last = first_query + scores.shape[1]
        for row, one in enumerate(ids.tolist()):
            for query in self.pairs.get(one, ()):
                if first_query <= query < last and matched[row, query - first_query]:
                    score = round(float(scores[row, query - first_query]), SCORE_DIGITS)
                    self.found.append((self.query_ids[query], one, score))

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if self.found:
            yield _result(schema, *map(list, zip(*self.found)))


class BetterCounts:
    """For given (query, score, id) marks, how many rows of one task rank before each."""

    def __init__(self, marks: dict[int, tuple[np.ndarray, np.ndarray]], query_ids: list):
        self.marks, self.query_ids = marks, query_ids
        self.counts = {q: np.zeros(len(ids), dtype=np.int64) for q, (_, ids) in marks.items()}

    def offer_matrix(self, scores: np.ndarray, matched: np.ndarray, ids: np.ndarray, first_query: int = 0) -> None:
        scores = np.round(scores, SCORE_DIGITS)
        for column in range(scores.shape[1]):
            query = first_query + column
            if query in self.marks:
                rows = matched[:, column]
                mine, names = scores[rows, column][:, None], ids[rows][:, None]
                mark_scores, mark_ids = self.marks[query]
                better = (mine > mark_scores) | ((mine == mark_scores) & (names < mark_ids))
                self.counts[query] += better.sum(axis=0)

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for query, counts in self.counts.items():
            yield _result(schema, [self.query_ids[query]] * len(counts), self.marks[query][1].tolist(), counts)


def _result(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """The k best of the per-task candidates, with ``rank``; Spark limits each map task too."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of one query."""
    return hits.orderBy(F.desc("score"), "id").limit(k)


def with_rank(top_hits: DataFrame) -> DataFrame:
    """Ordinals for a result already cut to k rows."""
    return top_hits.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "id")))
