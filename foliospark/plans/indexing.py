"""Indexing of directory trees: list, gate, extract, build, write, record."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.functions.text import word_tokens
from foliospark.operators.build import (CONTENT_CAP, admitted, attach_content, build_chunk_rows, build_documents, has_meaning,
                                        with_custom_fields, with_vectors)
from foliospark.operators.embedding import CACHE_DIGITS, MAX_TOKENS, Embedder, HashingEmbedder
from foliospark.operators.stats import run_summary, vector_run_summary, verify_coverage
from foliospark.schemas import CHUNK_DOCUMENT, INDEX_STATE, STORED_DOCUMENT
from foliospark.session import scratch, staged
from foliospark.sinks.cache import EmbeddingCache, fill, look_up
from foliospark.sinks.export import audit_append, audit_rows
from foliospark.sinks.store import TableStore
from foliospark.sources.extract import EXTRACTORS, Extractor, extract, file_metadata, property_columns
from foliospark.sources.files import (DEFAULT_EXTENSIONS, DEFAULT_MAX_MB, changed_files, fetch_contents,
                                      scan_files, within_size)
from foliospark.sources.walk import walk

RUN_STATISTICS = T.StructType([
    T.StructField("run_at", T.TimestampType()),
    T.StructField("kind", T.StringType()),
    *[T.StructField(n, T.LongType()) for n in ("total_files", "successful", "failed", "skipped", "oversize")],
    T.StructField("total_size_mb", T.DoubleType()),
    *[T.StructField(n, T.LongType()) for n in ("total_chunks", "total_embeddings", "embedding_calls")],
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("files_per_second", T.DoubleType()),
])


@dataclass
class IndexSettings:
    """Parameters of an indexing run."""

    extensions: tuple[str, ...] = DEFAULT_EXTENSIONS
    exclude_directories: tuple[str, ...] = ()
    recursive: bool = True
    max_mb: float = DEFAULT_MAX_MB
    incremental: bool = True
    chunk_size: int = 1000
    chunk_overlap: int = 200
    tokenizer: str = "whitespace"
    content_in_first_chunk_only: bool = True
    content_limit: int | None = CONTENT_CAP  # characters of a text that are stored; None stores it whole
    max_tokens: int | None = MAX_TOKENS  # tokens of a chunk that the model sees; None passes it whole
    cache_digits: int = CACHE_DIGITS  # the vectors by text hash lie in 16 ** cache_digits folders
    rows_per_file: int | None = None
    registry: dict[str, Extractor] = field(default_factory=lambda: dict(EXTRACTORS))
    hooks: tuple[Column, ...] = ()  # a file for which one of them is not true is not indexed
    metadata: tuple[Callable[[DataFrame], DataFrame], ...] = ()  # each adds columns to the extracted metadata
    custom_fields: tuple[T.StructField, ...] = ()  # those of these columns that the table stores
    after: tuple[Callable[[DataFrame], None], ...] = ()  # each is given the outcomes (path, size, status)
    audit: str | None = None  # a folder that gets one audit row for each file of a run


class _Run:
    """The part both kinds of indexing share: listing, gates, extraction, metadata."""

    def __init__(self, spark: SparkSession, listing: DataFrame, table_path: str, schema: T.StructType,
                 settings: IndexSettings, manifest: DataFrame | None, folders: list[str]):
        self.spark, self.settings, self.started = spark, settings, time.monotonic()
        self.folders = folders  # copies of the texts that only this run reads
        schema = T.StructType([*schema.fields, *settings.custom_fields])
        self.table = TableStore(spark, f"{table_path}/documents", schema, rows_per_file=settings.rows_per_file)
        self.state = TableStore(spark, f"{table_path}/state", INDEX_STATE)
        self.statistics = f"{table_path}/statistics"
        # Listing is metadata only; it is kept because every later step starts from it.
        self.listing = staged(admitted(listing.select("path", "modificationTime", "length"), settings.hooks), "listing", self.folders)
        fitting = self.listing.filter(within_size("length", settings.max_mb))
        todo = changed_files(fitting, self.state.read()) if settings.incremental else fitting
        self.todo = staged(todo, "todo", self.folders)
        size = self.todo.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
        extracted = extract(self.todo, settings.registry, lambda files: fetch_contents(files, size))
        self.extracted = staged(extracted, "extracted", self.folders)
        properties = self.extracted.select(F.col("path").alias("file_path"), "content", "error", *property_columns())
        metadata = file_metadata(self.todo, manifest).join(properties, "file_path", "left")
        self.metadata = with_custom_fields(metadata, *settings.metadata)

    def with_custom(self, rows: DataFrame) -> DataFrame:
        """Add the custom fields of a row's file, if there are any."""
        names = [f.name for f in self.settings.custom_fields]
        return rows.join(self.metadata.select(F.col("file_path").alias("filePath"), *names), "filePath", "left") if names else rows

    def tell(self, outcomes: DataFrame) -> None:
        """Call the hooks that follow a run and write its audit rows."""
        if self.settings.audit:
            rows = audit_rows(outcomes, F.lit("index"), F.lit("system"), F.col("path"), F.col("status"), F.current_timestamp(),
                              F.create_map(F.lit("size"), F.col("size").cast("string")))
            audit_append(rows, self.settings.audit)
        for hook in self.settings.after:
            hook(outcomes)

    def outcomes(self, successful: DataFrame) -> DataFrame:
        """(path, size, status) per listed file; ``successful`` holds the paths that were written."""
        tried = self.todo.select("path", F.lit(True).alias("_tried"))
        done = successful.select("path", F.lit(True).alias("_done"))
        status = (
            F.when(~within_size("length", self.settings.max_mb), "oversize")
            .when(F.col("_tried").isNull(), "skipped")
            .when(F.col("_done"), "successful").otherwise("failed"))
        return self.listing.join(tried, "path", "left").join(done, "path", "left") \
            .select("path", F.col("length").alias("size"), status.alias("status"))

    def record(self, successful: DataFrame) -> None:
        """Remember the files that were written; all others are tried again next time."""
        times = self.todo.join(successful, "path", "left_semi")
        self.state.upsert(times.select(F.col("path").alias("filePath"), F.col("modificationTime").alias("mtime")))

    def finish(self, summary: DataFrame, kind: str) -> DataFrame:
        row = summary.withColumn("run_at", F.current_timestamp()).withColumn("kind", F.lit(kind))
        known = set(row.columns)
        row.select(*[(F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name)
                     for f in RUN_STATISTICS.fields]).write.mode("append").parquet(self.statistics)
        return run_statistics(self.spark, self.statistics)

    def seconds(self) -> float:
        return time.monotonic() - self.started


def _scan(spark: SparkSession, roots: str | Iterable[str] | DataFrame, settings: IndexSettings, written: list[str] | None = None) -> DataFrame:
    if isinstance(roots, DataFrame):
        return roots
    return walk(spark, roots, settings.recursive, settings.exclude_directories, settings.extensions, written=written)


def index_standard(spark: SparkSession, roots: str | Iterable[str] | DataFrame, table_path: str,
                   settings: IndexSettings | None = None, manifest: DataFrame | None = None) -> DataFrame:
    """Index one or several trees, one row per file, and return the run's statistics row.

    ``roots`` may also be a listing (path, modificationTime, length).
    """
    settings = settings or IndexSettings()
    with scratch(spark) as folders:
        run = _Run(spark, _scan(spark, roots, settings, folders), table_path, STORED_DOCUMENT, settings, manifest, folders)
        good = run.metadata.filter(F.col("error").isNull() & F.col("content").isNotNull())
        run.table.upsert(run.with_custom(build_documents(good, settings.content_limit)), unique=True)
        written = run.extracted.filter(F.col("error").isNull() & F.col("content").isNotNull()).select("path")
        run.record(written)
        outcomes = run.outcomes(written)
        run.tell(outcomes)
        return run.finish(run_summary(outcomes, run.seconds()), "standard")


def index_vector(spark: SparkSession, roots: str | Iterable[str] | DataFrame, table_path: str,
                 settings: IndexSettings | None = None, embedder: Embedder | None = None,
                 manifest: DataFrame | None = None) -> DataFrame:
    """Index trees with chunks and vectors and return the run's statistics row.

    Chunks, new vectors and rows are each written once and read back by the following
    steps; the state is recorded last, so a run that dies is simply repeated.
    """
    settings = settings or IndexSettings()
    embedder = embedder or HashingEmbedder()
    with scratch(spark) as folders:
        run = _Run(spark, _scan(spark, roots, settings, folders), table_path, CHUNK_DOCUMENT, settings, manifest, folders)
        cache = EmbeddingCache(spark, f"{table_path}/embeddings", settings.cache_digits)
        good = run.metadata.filter(F.col("error").isNull() & has_meaning("content"))
        with scratch(spark) as cut:  # the chunks lie beside their vectors afterwards
            chunks = staged(build_chunk_rows(good, settings.chunk_size, settings.chunk_overlap, settings.tokenizer), "chunks", cut)
            calls = fill(cache, chunks, embedder, settings.max_tokens)
            tried = staged(look_up(cache, chunks), "embedded", run.folders)
        embedded = with_vectors(tried)
        contents = run.extracted.select(F.col("path").alias("filePath"), "content")
        rows = attach_content(embedded, contents, settings.content_in_first_chunk_only, settings.content_limit)
        run.table.upsert(run.with_custom(rows), unique=True)
        per_file = embedded.groupBy(F.col("filePath").alias("path")).agg(F.count(F.lit(1)).alias("chunks"))
        run.record(complete_files(tried))
        outcomes = run.outcomes(per_file).join(per_file, "path", "left") \
            .withColumn("embeddings", F.col("chunks")).withColumn("new_embeddings", F.lit(0))
        run.tell(outcomes.select("path", "size", "status"))
        summary = vector_run_summary(outcomes, run.seconds()).withColumn("embedding_calls", F.lit(calls))
        return run.finish(summary, "vector")


def complete_files(tried: DataFrame) -> DataFrame:
    """(path) of the files whose chunks with words all have a vector; the others are tried again by the next run."""
    failed = F.col("contentVector").isNull() & (F.size(word_tokens("chunk")) > 0)
    per_file = tried.groupBy(F.col("filePath").alias("path")).agg(
        F.count_if(failed).alias("failed"), F.count_if(F.col("contentVector").isNotNull()).alias("done"))
    return per_file.filter("failed = 0 AND done > 0").select("path")


def index_files(spark: SparkSession, paths: list[str], table_path: str, vectors: bool = False, **options) -> DataFrame:
    """Index exactly the named files."""
    job = index_vector if vectors else index_standard
    return job(spark, scan_files(spark, paths), table_path, **options)


def recover_table(spark: SparkSession, roots: str | Iterable[str] | DataFrame, table_path: str,
                  settings: IndexSettings | None = None, vectors: bool = False, **options) -> DataFrame:
    """Build a table anew at ``table_path`` and verify it: (filePath, problem) for each file that fits and is not in it.

    Everything is indexed, whatever an earlier state says; an empty result is a complete table.
    """
    settings = replace(settings or IndexSettings(), incremental=False)
    listing = _scan(spark, roots, settings)
    # The listing stays as long as the result that is compared with it.
    listing = staged(listing.select("path", "modificationTime", "length"), "recovery")
    (index_vector if vectors else index_standard)(spark, listing, table_path, settings=settings, **options)
    fitting = listing.filter(within_size("length", settings.max_mb)).select(F.col("path").alias("filePath"))
    table = TableStore(spark, f"{table_path}/documents", CHUNK_DOCUMENT if vectors else STORED_DOCUMENT)
    return verify_coverage(fitting, table.read())


def run_statistics(spark: SparkSession, path: str) -> DataFrame:
    """The statistics row of the latest run."""
    return spark.read.schema(RUN_STATISTICS).parquet(path).orderBy(F.desc("run_at")).limit(1)


