"""Declared schemas of every table the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_LISTING = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

DOCUMENT_PROPERTIES = [
    T.StructField("document_title", T.StringType()),
    T.StructField("document_author", T.StringType()),
    T.StructField("document_subject", T.StringType()),
    T.StructField("document_keywords", T.StringType()),
    T.StructField("document_category", T.StringType()),
    T.StructField("document_comments", T.StringType()),
    T.StructField("document_description", T.StringType()),
    T.StructField("document_creator", T.StringType()),
    T.StructField("document_producer", T.StringType()),
    T.StructField("document_created", T.StringType()),
    T.StructField("document_modified", T.StringType()),
    T.StructField("paragraph_count", T.IntegerType()),
    T.StructField("table_count", T.IntegerType()),
    T.StructField("page_count", T.IntegerType()),
    T.StructField("sheet_count", T.IntegerType()),
    T.StructField("sheet_names", T.ArrayType(T.StringType())),
]

EXTRACTED = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("metadata_error", T.StringType()),
    *DOCUMENT_PROPERTIES,
])

STANDARD_DOCUMENT = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("content", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("filePath", T.StringType()),
    T.StructField("extension", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("createdDateTime", T.TimestampType()),
    T.StructField("modifiedDateTime", T.TimestampType()),
    T.StructField("createdBy", T.StringType()),
    T.StructField("lastModifiedBy", T.StringType()),
    T.StructField("fileType", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("keywords", T.StringType()),
])

# Hash of the whole text of a file, kept beside the stored copy, which may be cut.
CONTENT_HASH = T.StructField("contentHash", T.StringType())
STORED_DOCUMENT = T.StructType([*STANDARD_DOCUMENT.fields, CONTENT_HASH])

CHUNK_DOCUMENT = T.StructType([
    *[f for f in STANDARD_DOCUMENT.fields if f.name != "keywords"],
    T.StructField("chunk", T.StringType()),
    T.StructField("contentVector", T.ArrayType(T.FloatType())),
    T.StructField("chunkNumber", T.IntegerType()),
    T.StructField("totalChunks", T.IntegerType()),
])

INDEX_STATE = T.StructType([
    T.StructField("filePath", T.StringType(), False),
    T.StructField("mtime", T.TimestampType()),
])

EMBEDDING_CACHE = T.StructType([
    T.StructField("text_hash", T.StringType(), False),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

AUDIT = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("action", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("resource", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("details", T.MapType(T.StringType(), T.StringType())),
])

# Fields a query may filter, sort or facet on, as declared for the search tables.
FILTERABLE = {
    "title", "name", "filePath", "extension", "size", "createdDateTime", "modifiedDateTime",
    "createdBy", "lastModifiedBy", "fileType", "chunkNumber", "totalChunks",
}
SORTABLE = {"title", "size", "createdDateTime", "modifiedDateTime", "chunkNumber"}
FACETABLE = {"extension", "createdBy", "lastModifiedBy", "fileType"}
SEARCHABLE = {"content", "chunk", "title", "name", "filePath"}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the columns of ``schema``; missing ones become typed nulls."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
