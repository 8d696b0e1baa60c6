"""Inputs that Spark derives from the given tables so that every operator has data to run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.text import document_id, text_hash
from foliospark.session import read_table, staged

FILES_SQL = """
    *, text AS content,
    CASE lang WHEN 'en' THEN '.txt' WHEN 'fr' THEN '.docx' WHEN 'de' THEN '.pdf' ELSE '.xlsx' END AS extension,
    CAST(octet_length(text) AS BIGINT) AS size,
    concat('doc', CAST(doc_id AS STRING), extension) AS name,
    concat('/share/', source, '/', name) AS filePath,
    timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, CAST(doc_id AS INT)) AS modifiedDateTime,
    concat('owner', CAST(doc_id % 7 AS STRING)) AS createdBy,
    CASE WHEN doc_id % 3 = 0 THEN concat('Title ', CAST(doc_id AS STRING)) END AS document_title
"""


_HANDLES: dict[tuple, tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """A given table. The handle is kept per session, which saves reading the schema again."""
    key = (id(spark), sf_dir, name, spread_by)
    if key not in _HANDLES or _HANDLES[key][0] is not spark:
        _HANDLES[key] = spark, read_table(spark, f"{sf_dir}/{name}.parquet", spread_by)
    return _HANDLES[key][1]


def files(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Documents as files with path, type, size, time, owner and title."""
    docs = table(spark, sf_dir, "documents", "doc_id" if spread else None)
    return docs.selectExpr(*_split(FILES_SQL)).withColumn("id", document_id("filePath"))


def _split(sql: str) -> list[str]:
    """The select items of a comma-separated list with nested parentheses."""
    items, depth, start = [], 0, 0
    for place, ch in enumerate(sql):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            items.append(sql[start:place])
            start = place + 1
    return [i.strip() for i in [*items, sql[start:]]]


def metadata(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The same files with the column names of extracted metadata."""
    return files(spark, sf_dir, spread).select(
        "doc_id", F.col("filePath").alias("file_path"), F.col("name").alias("file_name"),
        F.col("extension").alias("file_extension"), F.col("size").alias("file_size_bytes"),
        F.lit(None).cast("timestamp").alias("created_time"), F.col("modifiedDateTime").alias("modified_time"),
        F.col("createdBy").alias("owner"), "document_title",
        F.concat(F.lit("author "), F.col("lang")).alias("document_author"),
        F.lit(None).cast("string").alias("document_keywords"), "content")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as a directory listing."""
    return files(spark, sf_dir).select(
        F.col("filePath").alias("path"), F.col("modifiedDateTime").alias("modificationTime"),
        F.col("size").alias("length"), "doc_id")


def index_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even documents are known; those divisible by four unchanged, the others since modified."""
    known = files(spark, sf_dir).filter("doc_id % 2 = 0")
    mtime = F.when(F.col("doc_id") % 4 == 0, F.col("modifiedDateTime")) \
        .otherwise(F.col("modifiedDateTime") - F.expr("INTERVAL 1 HOUR"))
    return known.select("filePath", mtime.alias("mtime"))


def embedding_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of every fifth document's text."""
    return table(spark, sf_dir, "documents").filter("doc_id % 5 = 0") \
        .select(text_hash("text").alias("text_hash")).distinct()


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("contentVector"))


def one_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").filter("vec_id = 0").select("embedding")


def search_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with their vectors, where they have one: a stored table, written once per session.

    A search reads its table several times; the join behind it would carry all texts through a shuffle each time. Texts are
    not sorted for the join, the vectors of a partition are looked up.
    """
    key = (id(spark), sf_dir, "search_table", None)
    if key not in _HANDLES or _HANDLES[key][0] is not spark:
        embeddings = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("contentVector"))
        rows = files(spark, sf_dir).join(embeddings.hint("shuffle_hash"), "doc_id", "left").select(
            "id", "doc_id", "content", F.coalesce("document_title", F.concat(F.lit("doc"), F.col("doc_id"))).alias("title"),
            "name", "filePath", "extension", "size", "modifiedDateTime", "createdBy", "contentVector")
        _HANDLES[key] = spark, staged(rows, "search")
    return _HANDLES[key][1]


def query_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per item of the query table."""
    return hybrid_queries(spark, sf_dir).select("query_id", "vector")


def hybrid_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every query text with the vector of the same number."""
    embeddings = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return query_texts(spark, sf_dir).join(embeddings, "query_id")


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per file with a run status: labels decide pass or fail, other files were unchanged."""
    labels = table(spark, sf_dir, "labels")
    status = F.when(F.col("size") > 40000, "oversize").when(F.col("quality").isNull(), "skipped") \
        .when(F.col("quality") == 1, "successful").otherwise("failed")
    return files(spark, sf_dir).join(labels, "doc_id", "left").select(
        "doc_id", "filePath", "extension", "source", "size", status.alias("status"),
        F.when(status == "successful", F.ceil(F.col("n_chars") / 500)).alias("chunks"))
