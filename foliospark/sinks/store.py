"""Versioned tables of parquet folders with upsert, erasure and compaction.

A commit writes its rows (and the keys it replaces) to a folder of its own and then adds one
row to the commit log, so readers only ever see finished commits and nothing that is being
read is overwritten. An upsert costs as much as its own rows; the older versions are hidden
when reading, by a join with the replaced keys, until ``compact`` writes one clean folder.
One writer at a time.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.operators.embedding import valid_dimensions
from foliospark.schemas import AUDIT, conform
from foliospark.session import freeing_shuffles, local_rows, remove_folder, scratch, staged

LOG = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("folder", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("tag", T.StringType()),
])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return local_rows(spark, [], schema)


def latest_version(rows: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key, that of the highest version. The row limit also runs before the
    shuffle, so a key with very many versions sends one row per task."""
    order = Window.partitionBy(key).orderBy(F.desc(version))
    return rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == 1).drop("_n")


def checked_vectors(rows: DataFrame, dim: int, column: str = "contentVector") -> DataFrame:
    """Fail the write when a vector has another dimension than the table."""
    wrong = F.raise_error(F.concat(F.lit(f"{column} must have {dim} dimensions, found "),
                                   F.size(column).cast("string")))
    return rows.withColumn(column, F.when(valid_dimensions(column, dim), F.col(column)).otherwise(wrong))


class TableStore:
    """A table at ``path`` whose rows are replaced by ``key``.

    With ``folders`` a join on that column reads only the folders that the other side asks for.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "filePath",
                 rows_per_file: int | None = None, compact_after: int = 50, row_id: str = "id",
                 version: str = "modifiedDateTime", folders: tuple[str, Column] | None = None):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.rows_per_file, self.compact_after = rows_per_file, compact_after
        self.row_id = row_id if row_id in schema.fieldNames() else key
        self.version = version if version in schema.fieldNames() else None
        # A string column (name, expression) by whose values rows are written in folders; ``read`` returns it as well.
        self.folders = folders

    def _entries(self) -> list[Row]:
        """The whole log, oldest first: one small row per commit."""
        log = read_or_empty(self.spark, f"{self.path}/log", LOG)
        return sorted(log.collect(), key=lambda r: r["version"])

    def commits(self) -> list[Row]:
        """Commits since the last clean folder, oldest first."""
        return _since_base(self._entries())

    def rows_of(self, commit: Row) -> DataFrame:
        """The rows that one commit wrote."""
        return self.spark.read.schema(self._stored()).parquet(f"{self.path}/{commit['folder']}/rows")

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(self.folders[0], T.StringType())]) if self.folders else self.schema

    def replaced_keys(self, commit: Row) -> DataFrame:
        """The keys whose earlier rows one commit replaced or erased."""
        return self.spark.read.parquet(f"{self.path}/{commit['folder']}/keys")

    def read(self) -> DataFrame:
        commits = self.commits()
        parts = [self.rows_of(c).withColumn("_version", F.lit(c["version"]))
                 for c in commits if c["kind"] in ("base", "rows")]
        if not parts:
            return local_rows(self.spark, [], self._stored())
        table = reduce(DataFrame.unionByName, parts)
        for key in sorted({c["key"] for c in commits if c["key"]}):
            replaced = reduce(DataFrame.unionByName, [
                self.replaced_keys(c).withColumn("_at", F.lit(c["version"]))
                for c in commits if c["key"] == key])
            newest = replaced.groupBy(key).agg(F.max("_at").alias("_at"))
            table = table.join(newest, key, "left").filter(F.col("_at").isNull() | (F.col("_version") >= F.col("_at")))
            table = table.drop("_at")
        return table.select(*self._stored().fieldNames())

    def upsert(self, rows: DataFrame, key: str | None = None, tag: str | None = None, unique: bool = False) -> int:
        """Replace all rows that share a key with ``rows``; returns the number of rows written.

        By default the key is the file, so a file that now has fewer chunks leaves none
        behind; ``key="id"`` replaces row by row and keeps them. Of several rows with one id the
        one with the latest version stays; ``unique`` says that there are none, which saves a
        shuffle. A commit with a known ``tag`` is not repeated.
        """
        if not unique and self.row_id in rows.columns:
            if self.version is not None and self.version in rows.columns:
                rows = latest_version(rows, self.row_id, self.version)
            else:
                rows = rows.dropDuplicates([self.row_id])
        return self._commit(rows, key or self.key, tag)

    def append(self, rows: DataFrame, tag: str | None = None) -> int:
        """Add rows whose keys are known to be new."""
        return self._commit(rows, None, tag)

    def erase(self, keys: DataFrame, key: str | None = None, tag: str | None = None) -> None:
        """Remove all rows with the given keys."""
        key = key or self.key
        folder = self._folder()
        self._write_keys(keys, key, folder)
        self._log("erase", folder, key, tag)

    def compact(self, retain: int = 0) -> None:
        """Write the current content as one clean folder and delete what it supersedes.

        The folders of the last ``retain`` commits before it stay, for readers that began with them.
        """
        entries, folder = self._entries(), self._folder()
        self._write(self.read().select(*self.schema.fieldNames()), folder)
        self._log("base", folder, None, None, entries)
        for old in entries[:max(0, len(entries) - retain)]:
            remove_folder(self.spark, f"{self.path}/{old['folder']}")

    def _commit(self, rows: DataFrame, key: str | None, tag: str | None) -> int:
        entries = self._entries()
        if tag is not None and any(e["tag"] == tag for e in entries):
            return 0
        folder = self._folder()
        self._write(conform(rows, self.schema), folder)
        written = self.spark.read.schema(self._stored()).parquet(f"{self.path}/{folder}/rows")
        earlier = _since_base(entries)
        if not any(e["kind"] in ("base", "rows") for e in earlier):
            key = None  # nothing to replace, so the first load needs no keys and no join when reading
        if key is not None:
            self._write_keys(written, key, folder)
        self._log("rows", folder, key, tag, entries)
        count = written.count()
        if len(earlier) >= self.compact_after:
            # Those who read the table now go on with its present folders; the next compaction removes them.
            self.compact(retain=len(earlier) + 1)
        return count

    def _write(self, rows: DataFrame, folder: str) -> None:
        if self.folders:
            name, value = self.folders
            writer = rows.withColumn(name, value).repartition(name).write.partitionBy(name)
        else:
            writer = rows.write
        if self.rows_per_file:
            writer = writer.option("maxRecordsPerFile", self.rows_per_file)
        with freeing_shuffles(rows.sparkSession):
            writer.option("compression", "zstd").parquet(f"{self.path}/{folder}/rows")

    def _write_keys(self, rows: DataFrame, key: str, folder: str) -> None:
        with freeing_shuffles(rows.sparkSession):
            rows.select(key).distinct().write.parquet(f"{self.path}/{folder}/keys")

    @staticmethod
    def _folder() -> str:
        return f"commit-{uuid.uuid4().hex}"

    def _log(self, kind: str, folder: str, key: str | None, tag: str | None, entries: list[Row] | None = None) -> None:
        entries = self._entries() if entries is None else entries
        row = (entries[-1]["version"] + 1 if entries else 0, kind, folder, key, tag)
        local_rows(self.spark, [row], LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")


def _since_base(entries: list[Row]) -> list[Row]:
    bases = [i for i, e in enumerate(entries) if e["kind"] == "base"]
    return entries[bases[-1]:] if bases else entries


def erase_owner(table: TableStore, cache: TableStore, owner: str, text_hash, audit: str | None = None) -> None:
    """Remove an owner's rows from the table and the vectors of their texts from the cache, in the files as well.

    ``text_hash`` is the hash of the whole text as the cache knows it. A vector stays while a row of somebody else has
    the same text. With ``audit``, a path, the erasure leaves an audit row there.
    """
    rows = table.read().select(table.key, "createdBy", text_hash.alias("text_hash"))
    with scratch(table.spark) as folders:  # paths, owner and hashes of what is erased do not stay behind
        mine = staged(rows.filter(F.col("createdBy") == owner), "erased", folders)
        others = rows.filter(~F.col("createdBy").eqNullSafe(F.lit(owner))).select("text_hash")
        cache.erase(mine.select("text_hash").join(others, "text_hash", "left_anti"))
        table.erase(mine.select(table.key))
        table.compact()
        cache.compact()
        if audit:
            erased = mine.agg(F.count("*").alias("rows"))
            conform(erased.select(
                F.current_timestamp().alias("timestamp"), F.lit("erase").alias("action"), F.lit(owner).alias("user"),
                F.lit(table.path).alias("resource"), F.lit("success").alias("status"),
                F.create_map(F.lit("rows"), F.col("rows").cast("string")).alias("details")), AUDIT).write.mode("append").parquet(audit)
