"""Lookups that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1000
MIN_HOT_ROWS = 100_000
#: Rows of a hot key that one salt takes.
ROWS_PER_SALT = 50_000


def hot_keys(facts: DataFrame, key: str, share: int = HOT_SHARE, min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """(key, count) of the keys holding more than 1/``share`` of all rows: fewer than ``share`` by
    arithmetic, whatever the data, so this table may be broadcast."""
    counts = facts.groupBy(key).count()
    total = counts.agg(F.sum("count").alias("n"))
    limit = F.greatest(total.scalar() / F.lit(share), F.lit(min_rows).cast("double"))
    return counts.filter(F.col("count") > limit).select(key, "count")


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, spread_by: Column, how: str = "left",
                salts: int | None = None, share: int = HOT_SHARE, min_rows: int = MIN_HOT_ROWS,
                rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Join ``lookup`` (one row per key) to ``facts`` on ``key``.

    Rows of a hot key are dealt by a hash of ``spread_by`` over as many salts as its count asks
    for (``rows_per_salt``), or ``salts`` if given, and only the lookup rows of hot keys are
    repeated per salt; all other keys join as usual. Spark may still broadcast the lookup if it
    is under its size threshold.
    """
    parts = F.ceil(F.col("count") / F.lit(rows_per_salt)) if salts is None else F.lit(salts)
    hot = F.broadcast(hot_keys(facts, key, share, min_rows).select(key, parts.cast("int").alias("_hot")))
    salt = F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("_hot")), F.lit(0)).cast("int")
    left = facts.join(hot, key, "left").withColumn("_salt", salt).drop("_hot")
    repeats = F.sequence(F.lit(0), F.coalesce(F.col("_hot"), F.lit(1)) - 1)
    right = lookup.join(hot, key, "left").withColumn("_salt", F.explode(repeats)).drop("_hot")
    return left.join(right, [key, "_salt"], how).drop("_salt")
