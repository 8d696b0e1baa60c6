"""Indexing of files and rows as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from foliospark.operators.build import admitted, attach_content, build_chunk_rows, has_meaning, with_vectors
from foliospark.operators.embedding import Embedder
from foliospark.plans.indexing import IndexSettings, complete_files
from foliospark.schemas import FILE_LISTING
from foliospark.session import bounded_batches, folder_bytes, remove_folder, scratch, setting, staged
from foliospark.sinks.cache import fill, look_up
from foliospark.sinks.store import TableStore, latest_version, read_or_empty
from foliospark.sources.extract import extract, file_metadata, property_columns
from foliospark.sources.files import DEFAULT_EXTENSIONS, name_glob, changed_files, open_path, plain_path, within_reach, within_size

#: Bytes in the inbox of a stream, as stored, from which on its files are indexed.
GROUP_BYTES = 256 << 20
#: Files of a batch up to which the driver asks for their state itself; Spark starts a job for it from 32 files on.
LISTED_BY_DRIVER = 256
LANDED = T.StructType([*FILE_LISTING.fields, T.StructField("batch", T.LongType())])


def stream_files(spark: SparkSession, root: str, extensions: Iterable[str] = DEFAULT_EXTENSIONS,
                 files_per_batch: int | None = None) -> DataFrame:
    """A stream of files under ``root``; the checkpoint of its query remembers which were read."""
    reader = spark.readStream.format("binaryFile").schema(FILE_LISTING) \
        .option("recursiveFileLookup", "true").option("pathGlobFilter", name_glob(list(extensions)))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(root).withColumn("path", plain_path("path"))


def fresh_rows(batch: DataFrame, state: TableStore, version: str, key: str = "filePath") -> DataFrame:
    """The newest row per key of a batch, unless the state already has that version or a newer one."""
    newest = latest_version(batch, key, version)
    return changed_files(newest, state.read(), path=key, mtime=version)


def run_available(stream: DataFrame, handle: Callable[[DataFrame, str], None], checkpoint: str) -> StreamingQuery:
    """Process everything that has arrived since the last run, batch by batch, then stop.

    ``handle`` gets each batch with a tag that stays the same if the batch is repeated after
    a failure, so that a store can refuse to commit it twice.
    """
    def each(batch: DataFrame, number: int) -> None:
        handle(batch, f"{checkpoint}#{number}")

    # The source reads the settings of its session for each batch.
    with setting(stream.sparkSession, "spark.sql.sources.parallelPartitionDiscovery.threshold", str(LISTED_BY_DRIVER)):
        query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint) \
            .trigger(availableNow=True).start()
        query.awaitTermination()
    return query


def upsert_stream(stream: DataFrame, table: TableStore, checkpoint: str, version: str | None = None,
                  state: TableStore | None = None) -> StreamingQuery:
    """Upsert a stream of rows. With ``version`` and ``state`` rows that are not newer than
    what the state records are dropped."""
    def handle(batch: DataFrame, tag: str) -> None:
        if state is None or version is None:
            table.upsert(batch, tag=tag)
            return
        with scratch(batch.sparkSession) as folders:
            rows = staged(fresh_rows(batch, state, version, table.key), "batch", folders)
            table.upsert(rows, tag=tag)
            state.upsert(rows.select(F.col(table.key).alias("filePath"), F.col(version).alias("mtime")), tag=tag)

    return run_available(stream, handle, checkpoint)


def land_files(files: DataFrame, folder: str) -> int:
    """Write the rows of a small batch to a folder, in place of what an earlier try left there; returns the bytes stored.

    The tasks write by the file system of the path, one file each, for the reason given in `write_text_files`: Spark's
    writer starts a program for each file and folder, which takes longer than the rows of a small batch. A file gets its
    name when it is whole. Of the rows one Arrow batch is held. Where pyarrow does not know the scheme Spark writes.
    """
    spark, files = files.sparkSession, files.select(*FILE_LISTING.fieldNames())
    if not within_reach(folder):
        files.write.mode("overwrite").option("compression", "zstd").parquet(folder)
        return folder_bytes(spark, folder)
    remove_folder(spark, folder)
    bounded_batches(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, (system, inner) = TaskContext.get(), open_path(plain)
        name, writer = f"part-{context.partitionId():05d}.parquet", None
        hidden = f"{inner}/.{name}-{context.taskAttemptId()}"
        for batch in batches:
            if writer is None:
                system.create_dir(inner, recursive=True)
                writer = pq.ParquetWriter(hidden, batch.schema, filesystem=system, compression="zstd")
            writer.write_batch(batch)
        if writer is not None:
            writer.close()
            system.move(hidden, f"{inner}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([system.get_file_info(f"{inner}/{name}").size], pa.int64())], names=["bytes"])

    plain = folder.removeprefix("file://").removeprefix("file:")
    sizes = files.coalesce(spark.sparkContext.defaultParallelism).mapInArrow(write, "bytes long").collect()
    return sum(r["bytes"] for r in sizes)  # one number per task


def ingest_stream(stream: DataFrame, table: TableStore, state: TableStore, cache: TableStore, embedder: Embedder,
                  checkpoint: str, settings: IndexSettings | None = None, group_bytes: int = GROUP_BYTES) -> StreamingQuery:
    """Extract, chunk, embed and upsert each newly arrived file.

    A batch of the stream only writes its files to an inbox beside the checkpoint. They are indexed together when
    ``group_bytes`` lie there, as stored, and when nothing more has arrived, so that commits follow the bytes and not
    the number of batches. A file leaves the inbox after the state has recorded it: what an interrupted run leaves is
    indexed first by the next one, and a batch that is repeated finds its files recorded or replaces their rows. Of
    several arrivals of one path the newest stays.
    """
    settings = settings or IndexSettings()
    spark, inbox, waiting = table.spark, f"{checkpoint}-inbox", 0

    def land(batch: DataFrame, tag: str) -> None:
        nonlocal waiting
        fitting = admitted(batch.filter(within_size("length", settings.max_mb)), settings.hooks)
        waiting += land_files(fitting, f"{inbox}/batch={tag.rpartition('#')[2]}")
        if waiting >= group_bytes:
            index()
            waiting = 0

    def index() -> None:
        # What only this group reads is deleted with it, so that a stream that runs for ever fills no disk.
        with scratch(spark) as folders:
            landed = read_or_empty(spark, inbox, LANDED)
            newest = landed.groupBy("path").agg(F.max(F.struct("modificationTime", "batch", "length")).alias("last")).select("path", "last.*")
            files = staged(changed_files(newest, state.read()), "files", folders)
            if not files.isEmpty():
                extracted = staged(extract(files, settings.registry, lambda some: landed.join(some.select("path", "batch"), ["path", "batch"], "left_semi")),
                                   "extracted", folders)
                properties = extracted.select(F.col("path").alias("file_path"), "content", "error", *property_columns())
                metadata = file_metadata(files).join(properties, "file_path", "left")
                good = metadata.filter(F.col("error").isNull() & has_meaning("content"))
                with scratch(spark) as cut:
                    chunks = staged(build_chunk_rows(good, settings.chunk_size, settings.chunk_overlap, settings.tokenizer), "chunks", cut)
                    fill(cache, chunks, embedder, settings.max_tokens)
                    tried = staged(look_up(cache, chunks), "embedded", folders)
                embedded = with_vectors(tried)
                contents = extracted.select(F.col("path").alias("filePath"), "content")
                table.upsert(attach_content(embedded, contents, settings.content_in_first_chunk_only, settings.content_limit), unique=True)
                written = files.join(complete_files(tried), "path", "left_semi")
                state.upsert(written.select(F.col("path").alias("filePath"), F.col("modificationTime").alias("mtime")))
        remove_folder(spark, inbox)

    index()
    query = run_available(stream, land, checkpoint)
    index()
    return query
