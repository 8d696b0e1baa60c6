"""Named search tables in the session catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.schemas import CHUNK_DOCUMENT, STORED_DOCUMENT, conform
from foliospark.sinks.store import checked_vectors

DEFAULT_DIMENSIONS = 3072
# Bytes of one value of each fixed-width type.
WIDTHS = {"int": 4, "bigint": 8, "double": 8, "float": 4, "timestamp": 8, "timestamp_ntz": 8}


def value_bytes(field: T.StructField) -> Column:
    """Uncompressed size of one value."""
    kind, column = field.dataType.simpleString(), F.col(field.name)
    if kind == "string":
        size = F.octet_length(column)
    elif isinstance(field.dataType, T.ArrayType):
        size = F.size(column) * WIDTHS.get(field.dataType.elementType.simpleString(), 8)
    else:
        size = F.lit(WIDTHS.get(kind, 8))
    return F.when(column.isNull(), 0).otherwise(size).cast("bigint")


def table_stats(table: DataFrame) -> DataFrame:
    """One row: documentCount and storageSize in bytes."""
    per_row = reduce(lambda a, b: a + b, [value_bytes(f) for f in table.schema.fields])
    return table.agg(F.count(F.lit(1)).alias("documentCount"),
                     F.coalesce(F.sum(per_row), F.lit(0)).alias("storageSize"))


def table_stats_list(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, documents, storage_mb) of several tables."""
    return reduce(DataFrame.unionByName, [
        table_stats(df).select(
            F.lit(name).alias("table"), F.col("documentCount").alias("documents"),
            F.round(F.col("storageSize") / F.lit(1048576.0), 2).alias("storage_mb"))
        for name, df in tables.items()])


class SearchTableCatalog:
    """Create, fill, list, measure and drop search tables.

    With ``location`` the tables are kept in folders below it, otherwise in the warehouse.
    """

    def __init__(self, spark: SparkSession, database: str = "default", location: str | None = None):
        self.spark, self.database, self.location = spark, database, location

    def _name(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def _create(self, name: str, schema: T.StructType, **properties: str) -> bool:
        if not self.exists(name):
            nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
            path = f"{self.location}/{name}" if self.location else None
            self.spark.catalog.createTable(self._name(name), path=path, source="parquet", schema=nullable)
            for key, value in properties.items():
                self.spark.sql(f"ALTER TABLE {self._name(name)} SET TBLPROPERTIES ('{key}' = '{value}')")
        return True

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self._name(name))

    def create_standard(self, name: str) -> bool:
        """One row per file, with the hash of its whole text; an existing table is left as it is."""
        return self._create(name, STORED_DOCUMENT)

    def create_vector(self, name: str, dimensions: int = DEFAULT_DIMENSIONS) -> bool:
        """One row per chunk with a vector of fixed dimension."""
        return self._create(name, CHUNK_DOCUMENT, dimensions=str(dimensions))

    def dimensions(self, name: str) -> int | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self._name(name)}").collect()
        return next((int(r["value"]) for r in rows if r["key"] == "dimensions"), None)

    def insert(self, name: str, rows: DataFrame) -> None:
        schema = self.spark.table(self._name(name)).schema
        rows = conform(rows, schema)
        dimensions = self.dimensions(name)
        if dimensions is not None:
            rows = checked_vectors(rows, dimensions)
        rows.write.insertInto(self._name(name))

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._name(name))

    def delete(self, name: str) -> bool:
        """False when there is no such table."""
        if not self.exists(name):
            return False
        self.spark.sql(f"DROP TABLE {self._name(name)}")
        return True

    def names(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.database) if not t.isTemporary)

    def statistics(self, name: str) -> DataFrame:
        return table_stats(self.table(name))

    def all_statistics(self) -> DataFrame:
        return table_stats_list({name: self.table(name) for name in self.names()})
