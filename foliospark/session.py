"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "foliospark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; keyword arguments override them (dots as ``__``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SESSION_DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a fresh temporary
    folder, which would not survive the loss of a machine on a cluster.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="foliospark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that holds inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def freeing_shuffles(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Inside the block a write deletes its shuffle files when it ends.

    Else they stay until the driver happens to collect its garbage, so that a run of many writes holds the shuffles of
    them all. A lost executor costs the stages of the write that runs, as before.
    """
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder by the file system that Spark itself uses for it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files in a folder, by the file system that Spark itself uses for it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getContentSummary(folder).getLength()


#: Shuffle partitions for each file of a table of short rows.
WIDTH_PER_FILE = 32


def in_few_files(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over as many partitions as there are cores, or a share of the shuffle width if that is more.

    For tables of short rows that are about to be written: a shuffle of few rows can have hundreds of partitions, and each
    would become a file, whose creation takes longer than its rows. The number follows the width, and so the input.
    """
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, min(width, max(spark.sparkContext.defaultParallelism, width // WIDTH_PER_FILE))))


def staged(df: DataFrame, name: str, written: list[str] | None = None, short: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several later jobs need the same costly result: they read columns they need
    from parquet, and a lost executor costs a re-read instead of a re-extraction. ``written``
    gets the path, for a caller that removes it when its work is done. Tables of ``short`` rows are
    written in few files.
    """
    path = scratch_path(df.sparkSession, f"stage-{name}")
    if written is not None:
        written.append(path)
    with freeing_shuffles(df.sparkSession):
        (in_few_files(df) if short else df).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """A list for the paths that ``staged`` writes; their folders are deleted at the end, also after a failure."""
    folders: list[str] = []
    try:
        yield folders
    finally:
        for folder in folders:
            remove_folder(spark, folder)


def local_rows(spark: SparkSession, rows: Sequence[Sequence], schema: StructType | str) -> DataFrame:
    """A handful of rows of the driver as a table, without starting Python workers for them."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.fieldNames()), schema)


#: Bytes of data that one Arrow batch may hold, so that long texts do not fill a Python worker.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes as well as by rows."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) != str(BATCH_BYTES):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def read_table(spark: SparkSession, path: str, spread_by: str | None = None) -> DataFrame:
    """Read one parquet table.

    A table that is a single file often has one row group, which one task would read and
    process alone. With ``spread_by`` it is written once, dealt over the cores by that column,
    and read from there. A table with a file for each core is read as it is.
    """
    df = spark.read.parquet(path)
    if not spread_by or len(df.inputFiles()) >= spark.sparkContext.defaultParallelism:
        return df
    return staged(df.repartition(spark.sparkContext.defaultParallelism, spread_by), "spread")


def ship_packages(spark: SparkSession, *packages: str) -> None:
    """Send pure-Python packages to the executors of a session started without ``--py-files``.

    Done once per context; ``packages`` are folders, by default this library's own.
    """
    context = spark.sparkContext
    folders = packages or (os.path.dirname(os.path.abspath(__file__)),)
    sent = context.__dict__.setdefault("_shipped_packages", set())
    for folder in folders:
        if folder in sent:
            continue
        sent.add(folder)
        parent, name = os.path.split(folder)
        archive = os.path.join(tempfile.mkdtemp(prefix="foliospark-py-"), f"{name}.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for base, _, files in os.walk(folder):
                for file in files:
                    if file.endswith(".py"):
                        path = os.path.join(base, file)
                        out.write(path, os.path.relpath(path, parent))
        context.addPyFile(archive)
