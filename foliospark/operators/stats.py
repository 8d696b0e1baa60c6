"""Run statistics, facets, reports and coverage checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.schemas import FACETABLE

FAILURE_LIMIT = 10


def facet(rows: DataFrame, name: str) -> DataFrame:
    """(value, count) over the matching rows, largest first."""
    return _facet_counts(rows, [name]).select("value", "count").orderBy(F.desc("count"), "value")


def facets(rows: DataFrame, names: list[str]) -> DataFrame:
    """(facet, value, count) of several facets in one pass over the rows."""
    return _facet_counts(rows, names).orderBy("facet", F.desc("count"), "value")


def _facet_counts(rows: DataFrame, names: list[str]) -> DataFrame:
    for name in names:
        if name not in FACETABLE:
            raise ValueError(f"{name} is not facetable")
    pairs = F.array(*[F.struct(F.lit(n).alias("facet"), F.col(n).alias("value")) for n in names])
    # A missing value belongs to no facet value.
    return rows.select(F.inline(pairs)).filter(F.col("value").isNotNull()) \
        .groupBy("facet", "value").agg(F.count(F.lit(1)).alias("count"))


def mebibytes(size: Column) -> Column:
    return F.round(F.coalesce(F.sum(size), F.lit(0)) / F.lit(1048576.0), 2)


def run_summary(outcomes: DataFrame, seconds: float | Column | None = None, group: list[str] | None = None) -> DataFrame:
    """Counters of a run from one row per listed file (status, size).

    ``status`` is successful, failed, skipped or oversize; only successful files add to the
    size. With ``seconds`` also the rate, null for a run without duration.
    """
    done = F.col("status") == "successful"
    columns = [
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(done).alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "oversize").alias("oversize"),
        mebibytes(F.when(done, F.col("size"))).alias("total_size_mb"),
    ]
    out = outcomes.groupBy(*(group or [])).agg(*columns)
    if seconds is None:
        return out
    duration = seconds if isinstance(seconds, Column) else F.lit(float(seconds))
    return out.withColumn("duration_seconds", duration).withColumn(
        "files_per_second", F.round(F.col("successful") / F.nullif(F.col("duration_seconds"), F.lit(0.0)), 2))


def vector_run_summary(outcomes: DataFrame, seconds: float | Column | None = None,
                       group: list[str] | None = None) -> DataFrame:
    """:func:`run_summary` plus chunk and embedding counters from (chunks, embeddings, new_embeddings)."""
    base = run_summary(outcomes, seconds, group)
    extra = outcomes.groupBy(*(group or [])).agg(
        F.coalesce(F.sum("chunks"), F.lit(0)).alias("total_chunks"),
        F.coalesce(F.sum("embeddings"), F.lit(0)).alias("total_embeddings"),
        F.coalesce(F.sum("new_embeddings"), F.lit(0)).alias("embedding_calls"))
    if group:
        return base.join(extra, group)
    # Two one-row results side by side.
    return base.withColumn("_e", extra.select(F.struct("*")).scalar()).select(*base.columns, "_e.*")


def extraction_by_type(outcomes: DataFrame) -> DataFrame:
    """(extension, extracted, failed) rows."""
    return outcomes.groupBy("extension").agg(
        F.count_if(F.col("error").isNull()).alias("extracted"),
        F.count_if(F.col("error").isNotNull()).alias("failed"))


def extraction_statistics(outcomes: DataFrame) -> DataFrame:
    """One row: total_extracted, failed and the map of extracted files by type."""
    per_type = extraction_by_type(outcomes)
    counted = F.collect_list(F.when(F.col("extracted") > 0, F.struct("extension", "extracted")))
    return per_type.agg(
        F.coalesce(F.sum("extracted"), F.lit(0)).alias("total_extracted"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
        F.map_from_entries(counted).alias("by_type"))


def failure_alert(outcomes: DataFrame, directory: Column, limit: int = FAILURE_LIMIT) -> DataFrame:
    """Directories with more than ``limit`` failed files."""
    return outcomes.groupBy(directory.alias("directory")) \
        .agg(F.count_if(F.col("status") == "failed").alias("failed")).filter(F.col("failed") > limit)


def weekly_report(outcomes: DataFrame, moment: str = "ts") -> DataFrame:
    """Counters per week, weeks start on Monday."""
    return outcomes.groupBy(F.date_trunc("week", moment).alias("week")).agg(
        F.count_if(F.col("status") == "successful").alias("files_indexed"),
        F.count_if(F.col("status") == "failed").alias("files_failed"),
        F.sum("chunks").alias("chunks_created"),
        F.round(F.sum("size_mb"), 2).alias("total_size_mb"))


def run_report(outcomes: DataFrame, run: str = "run") -> DataFrame:
    """(run, report): validated, indexed and failed files of each run as one JSON text."""
    counted = outcomes.groupBy(run).agg(
        F.count_if(F.col("status") != "oversize").alias("validated"),
        F.count_if(F.col("status") == "successful").alias("indexed"),
        F.count_if(F.col("status") == "failed").alias("failed"))
    return counted.select(run, F.to_json(F.struct("validated", "indexed", "failed")).alias("report"))


def cache_savings(chunks: DataFrame, text_hash: Column) -> DataFrame:
    """One row: chunks, distinct texts and the embedding calls saved by embedding each text once.

    Distinct hashes are found by grouping, which combines equal texts before the shuffle.
    """
    per_text = chunks.groupBy(text_hash.alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return per_text.agg(F.sum("n").alias("chunks"), F.count(F.lit(1)).alias("distinct_texts"),
                        (F.sum("n") - F.count(F.lit(1))).alias("calls_saved"))


def verify_coverage(source: DataFrame, indexed: DataFrame, path: str = "filePath") -> DataFrame:
    """(path, problem): files of the source that the table lacks, and the reverse."""
    wanted, present = source.select(path).distinct(), indexed.select(path).distinct()
    missing = wanted.join(present, path, "left_anti").withColumn("problem", F.lit("missing in table"))
    orphaned = present.join(wanted, path, "left_anti").withColumn("problem", F.lit("missing in source"))
    return missing.unionByName(orphaned)


def range_digests(rows: DataFrame, path: str, value: Column, ranges: int) -> DataFrame:
    """(range, digest): number, sum and exclusive or of 64-bit hashes over the rows of each range of paths, in any order.

    Each task adds up its own rows, so that a shuffle carries at most ``ranges`` rows for each task.
    """
    return rows.groupBy(_range_of(path, ranges).alias("range")).agg(F.struct(
        F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(path, value).cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit("x"), value, F.col(path))).alias("parity")).alias("digest"))


def _range_of(path: str, ranges: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("range"), F.col(path)), F.lit(ranges)).cast("int")


def differing_ranges(one: DataFrame, other: DataFrame, path: str, value: Column, ranges: int) -> DataFrame:
    """The ranges whose digests differ; at most ``ranges`` numbers."""
    left, right = (range_digests(rows, path, value, ranges) for rows in (one, other))
    both = left.join(right.withColumnRenamed("digest", "_other"), "range", "full")
    return both.filter(~F.col("digest").eqNullSafe(F.col("_other"))).select("range")


def verify_versions(source: DataFrame, indexed: DataFrame, path: str = "filePath", version: str | None = None, ranges: int = 4096) -> DataFrame:
    """(path, problem) like :func:`verify_coverage`, with ``other version`` where ``version`` differs, for nearly equal tables.

    Both sides hold one row for each path. Digests of ranges of paths are compared first; only rows of ranges that
    differ are shuffled and joined, so a check of a table that is in order moves no rows. Null versions are equal.
    Two ranges of equal digests hold the same rows but for a chance of 2 to the power of -128.
    """
    value = F.lit(0) if version is None else F.col(version)
    differing = differing_ranges(source, indexed, path, value, ranges)

    def rows_in(rows: DataFrame, name: str) -> DataFrame:
        chosen = rows.select(path, value.alias(name), F.lit(True).alias(f"{name}_has"), _range_of(path, ranges).alias("range"))
        return chosen.join(F.broadcast(differing), "range", "left_semi").drop("range")  # at most ``ranges`` numbers

    both = rows_in(source, "_wanted").join(rows_in(indexed, "_held"), path, "full")
    problem = F.when(F.col("_held_has").isNull(), "missing in table").when(F.col("_wanted_has").isNull(), "missing in source") \
        .when(~F.col("_wanted").eqNullSafe(F.col("_held")), "other version")
    return both.select(path, problem.alias("problem")).filter(F.col("problem").isNotNull())
