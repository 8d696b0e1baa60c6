"""Dispatch of files to extractors by extension, and metadata."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import extension, file_name, size_mb
from foliospark.schemas import DOCUMENT_PROPERTIES, EXTRACTED, conform
from foliospark.sources.files import decode_text
from foliospark.sources.html import html_to_text
from foliospark.sources.office import extract_docx, extract_xlsx

Extractor = Callable[[DataFrame], DataFrame]


def extract_plain(files: DataFrame) -> DataFrame:
    """Text files, decoded without leaving the JVM."""
    return conform(files.select("path", decode_text("content").alias("content")), EXTRACTED)


def extract_html(files: DataFrame) -> DataFrame:
    """Web pages as their text nodes, decoded and stripped of tags without leaving the JVM."""
    return conform(files.select("path", html_to_text(decode_text("content"), " ").alias("content")), EXTRACTED)


EXTRACTORS: dict[str, Extractor] = {
    ".txt": extract_plain,
    ".md": extract_plain,
    ".log": extract_plain,
    ".docx": extract_docx,
    ".xlsx": extract_xlsx,
    ".html": extract_html,
    ".htm": extract_html,
}


def unsupported(path: Column | str) -> Column:
    return F.concat(F.lit("Unsupported file type: "), extension(path))


def extract(files: DataFrame, registry: dict[str, Extractor] | None = None,
            contents: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Text, properties and errors of every file, one output row per input row.

    Files are split by extension and each branch runs its own extractor, so text files stay
    JVM-side. With ``contents`` the branches take a listing without bytes and load only
    the files they extract.
    """
    registry = EXTRACTORS if registry is None else registry
    load = contents or (lambda df: df)
    by_extractor: dict[Extractor, list[str]] = {}
    for suffix, extractor in registry.items():
        by_extractor.setdefault(extractor, []).append(suffix)
    branches = [
        conform(extractor(load(files.filter(extension("path").isin(suffixes)))), EXTRACTED)
        for extractor, suffixes in by_extractor.items()
    ]
    rest = files.filter(~extension("path").isin(list(registry)))
    branches.append(conform(rest.select("path", unsupported("path").alias("error")), EXTRACTED))
    return reduce(DataFrame.unionByName, branches)


def file_metadata(files: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Filesystem columns of a listing.

    Creation time, access time and owner are not known to Spark's file sources; they come
    from an optional manifest table (path, created_time, accessed_time, owner).
    """
    base = files.select(
        file_name("path").alias("file_name"),
        F.col("path").alias("file_path"),
        extension("path").alias("file_extension"),
        F.col("length").alias("file_size_bytes"),
        size_mb("length").alias("file_size_mb"),
        F.col("modificationTime").alias("modified_time"),
    )
    if manifest is None:
        return base.select(
            "*", F.lit(None).cast("timestamp").alias("created_time"),
            F.lit(None).cast("timestamp").alias("accessed_time"), F.lit("Unknown").alias("owner"))
    known = manifest.select(F.col("path").alias("file_path"), "created_time", "accessed_time", "owner")
    return base.join(known, "file_path", "left").withColumn("owner", F.coalesce("owner", F.lit("Unknown")))


def merge_metadata(base: DataFrame, extracted: DataFrame, key: str = "file_path") -> DataFrame:
    """Left join of document properties onto filesystem metadata; a document field wins
    where both sides have it, and a file without properties keeps what it has."""
    shared = [c for c in extracted.columns if c != key and c in base.columns]
    new = [c for c in extracted.columns if c != key and c not in base.columns]
    renamed = extracted.select(key, *new, *[F.col(c).alias(f"_doc_{c}") for c in shared])
    joined = base.join(renamed, key, "left")
    return joined.select(*[
        F.coalesce(F.col(f"_doc_{c}"), F.col(c)).alias(c) if c in shared else F.col(c)
        for c in [*base.columns, *new]
    ])


def property_columns() -> list[str]:
    return [f.name for f in DOCUMENT_PROPERTIES]
