"""Rows of the search tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.chunking import explode_chunks
from foliospark.functions.text import chunk_id, document_id, strip, text_hash, title_or_stem
from foliospark.schemas import CHUNK_DOCUMENT, CONTENT_HASH, STORED_DOCUMENT, conform

CONTENT_CAP = 50_000
MIN_CONTENT = 10


def capped(content: Column | str, limit: int | None = CONTENT_CAP) -> Column:
    """The stored copy of a text, whole without a limit; chunks are always cut from the whole text."""
    content = F.col(content) if isinstance(content, str) else content
    return content if limit is None else F.left(content, F.lit(limit))


def is_truncated(content: Column | str, limit: int = CONTENT_CAP) -> Column:
    return F.length(content) > limit


def has_meaning(content: Column | str, minimum: int = MIN_CONTENT) -> Column:
    """At least ``minimum`` characters without the surrounding whitespace."""
    return F.coalesce(F.length(strip(content)) >= minimum, F.lit(False))


def all_of(predicates: Iterable[Column]) -> Column:
    """Conjunction of the present predicates; without any, everything passes."""
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def admitted(files: DataFrame, hooks: Iterable[Column]) -> DataFrame:
    """Rows that no pre-index hook vetoes."""
    return files.filter(all_of(hooks))


def with_custom_fields(metadata: DataFrame, *extractors: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply user functions that add metadata columns."""
    return reduce(DataFrame.transform, extractors, metadata)


def _header_columns() -> dict[str, Column]:
    path = F.col("file_path")
    return {
        "title": title_or_stem("document_title", path),
        "name": F.col("file_name"),
        "filePath": path,
        "extension": F.col("file_extension"),
        "size": F.col("file_size_bytes"),
        "createdDateTime": F.col("created_time"),
        "modifiedDateTime": F.col("modified_time"),
        "createdBy": F.coalesce("owner", F.lit("Unknown")),
        "lastModifiedBy": F.coalesce("owner", F.lit("Unknown")),
        "fileType": F.lit("File"),
        "url": path,
        "author": F.col("document_author"),
        "keywords": F.col("document_keywords"),
    }


def build_documents(metadata: DataFrame, content_limit: int | None = CONTENT_CAP) -> DataFrame:
    """One search-table row per file from metadata columns and ``content``, with the hash of the whole text."""
    rows = metadata.select(
        document_id("file_path").alias("id"), capped("content", content_limit).alias("content"),
        text_hash("content").alias(CONTENT_HASH.name), *[c.alias(n) for n, c in _header_columns().items()])
    return conform(rows, STORED_DOCUMENT)


def build_chunk_rows(metadata: DataFrame, size: int | None = None, overlap: int | None = None,
                     tokenizer: str = "whitespace") -> DataFrame:
    """One row per chunk, still without vector and without the copied file content."""
    headed = metadata.filter(has_meaning("content")).select(
        *[c.alias(n) for n, c in _header_columns().items()], "content")
    chunks = explode_chunks(headed, "content", size, overlap, tokenizer)
    return chunks.withColumn("id", chunk_id("filePath", "chunkNumber"))


def attach_content(chunks: DataFrame, contents: DataFrame, first_only: bool = True,
                   content_limit: int | None = CONTENT_CAP) -> DataFrame:
    """Add the file content to one chunk row of a file, the one with the smallest number that ``chunks`` has, or to every
    row without ``first_only``.

    That is not always chunk 0, which may have no vector. ``contents`` (filePath, content) is unique per file; ``chunks``
    is read twice, the first time its numbers only, and should be a stored table. The long texts are shuffled once, by file:
    they meet one small row per file and stay where they are for the join with the chunks, in which the number is
    a range so that it is no key to shuffle by. Content in every row makes a table many times larger.
    """
    full = contents.select(F.col("filePath").alias("_file"), capped("content", content_limit).alias("content"))
    match = F.col("filePath") == F.col("_file")
    if first_only:
        full = full.join(chunks.groupBy(F.col("filePath").alias("_file")).agg(F.min("chunkNumber").alias("_first")), "_file")
        match = match & F.col("chunkNumber").between(F.col("_first"), F.col("_first"))
    return conform(chunks.join(full, match, "left"), CHUNK_DOCUMENT)


def with_vectors(embedded: DataFrame) -> DataFrame:
    """Drop chunks whose embedding failed; numbers and totals of the others stay."""
    return embedded.filter(F.col("contentVector").isNotNull() & (F.size("contentVector") > 0))
