"""Ranking formulas as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

BM25_K1 = 1.2
BM25_B = 0.75
RRF_CONSTANT = 60
SCORE_DIGITS = 6


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when either vector is all zeros."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def rounded(score: Column) -> Column:
    """Scores are ranked on six digits so that ties fall to the id, not to summation order."""
    return F.round(score, SCORE_DIGITS)


def idf(total: Column, doc_freq: Column) -> Column:
    return F.log(F.lit(1.0) + (total - doc_freq + 0.5) / (doc_freq + 0.5))


def saturation(tf: Column, length: Column, mean_length: Column,
               k1: float = BM25_K1, b: float = BM25_B) -> Column:
    """The term-frequency part of BM25."""
    tf = tf.cast("double")
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean_length))


def bm25(tf: Column, length: Column, mean_length: Column, total: Column, doc_freq: Column) -> Column:
    return idf(total, doc_freq) * saturation(tf, length, mean_length)


def idf_value(total: int, doc_freq: int) -> float:
    return math.log(1.0 + (total - doc_freq + 0.5) / (doc_freq + 0.5))


def reciprocal_rank(rank: Column, constant: int = RRF_CONSTANT) -> Column:
    """1 / (constant + rank); a missing rank adds nothing."""
    return F.coalesce(F.lit(1.0) / (F.lit(constant) + rank), F.lit(0.0))
