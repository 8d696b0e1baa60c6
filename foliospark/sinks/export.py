"""Exports, audit trail and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.schemas import AUDIT
from foliospark.session import local_rows

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
CSV_FIELDS = ("name", "filePath", "extension", "score")

# Which document sets take which file types; a type may go to several sets.
ROUTES = {
    "hr-documents": (".pdf", ".docx"),
    "financial-reports": (".xlsx",),
    "technical-docs": (".pdf", ".md"),
}


def export_json(hits: DataFrame, path: str) -> None:
    hits.write.json(path)


def export_csv(hits: DataFrame, path: str) -> None:
    """Name, path, extension and score with a header; quotes and line ends are escaped."""
    hits.select(*CSV_FIELDS).write.option("header", True).option("escape", '"').csv(path)


def export_schema(table: DataFrame, path: str) -> None:
    """The table's schema as one JSON text."""
    local_rows(table.sparkSession, [(table.schema.json(),)], "value string").coalesce(1).write.text(path)


def audit_rows(rows: DataFrame, action: Column, user: Column, resource: Column, status: Column,
               timestamp: Column, details: Column | None = None) -> DataFrame:
    """Audit entries; missing details become an empty map."""
    empty = F.create_map().cast("map<string,string>")
    return rows.select(
        timestamp.cast("timestamp").alias("timestamp"), action.alias("action"), user.alias("user"),
        resource.alias("resource"), status.alias("status"),
        (empty if details is None else F.coalesce(details, empty)).alias("details"))


def audit_append(entries: DataFrame, path: str) -> None:
    """Append entries as JSON lines."""
    entries.select(*AUDIT.fieldNames()).write.mode("append").option("timestampFormat", TIME_FORMAT).json(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT).option("timestampFormat", TIME_FORMAT).json(path)


def routed(rows: DataFrame, routes: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Add ``route``: one output row per document set that takes the row's extension."""
    routes = ROUTES if routes is None else routes
    targets = F.array_compact(F.array(*[
        F.when(F.col("extension").isin(list(suffixes)), F.lit(name)) for name, suffixes in routes.items()]))
    return rows.withColumn("route", F.explode(targets))


def write_routed(rows: DataFrame, path: str, routes: dict[str, tuple[str, ...]] | None = None) -> None:
    """One folder per document set. Rows are brought together by set first, large sets over several tasks, so that a
    folder gets a few files and not one of every task."""
    routed(rows, routes).hint("rebalance", "route").write.partitionBy("route").parquet(path)


def write_by_directory(rows: DataFrame, path: str, directory: Column) -> None:
    """One folder per top-level directory; one that holds most of the rows is split over several tasks."""
    rows.withColumn("directory", directory).hint("rebalance", "directory").write.partitionBy("directory").parquet(path)
