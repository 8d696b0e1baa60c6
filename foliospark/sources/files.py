"""Directory scans, gates on the listing, and reading of file contents."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.functions.text import extension
from foliospark.session import BATCH_BYTES, bounded_batches, local_rows

# File types taken by default and the size limit in MiB.
DEFAULT_EXTENSIONS = (".txt", ".docx", ".pdf", ".xlsx", ".pptx")
DEFAULT_MAX_MB = 50

READ_BYTES_PER_TASK = 128 * 2**20


def plain_path(path: Column | str) -> Column:
    """Drop the ``file:`` scheme that file listings carry, so ids equal those of the bare path."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(path, r"^file:(?://)?(?=/)", "")


def relative_path(path: Column | str, root: str) -> Column:
    path = F.col(path) if isinstance(path, str) else path
    prefix = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(prefix)), F.substring(path, F.lit(len(prefix) + 1), F.length(path))) \
        .otherwise(path)


def outside_directories(relative: Column | str, excluded: Iterable[str]) -> Column:
    """True when no directory of the relative path bears an excluded name (exact, any depth)."""
    excluded = list(excluded)
    if not excluded:
        return F.lit(True)
    relative = F.col(relative) if isinstance(relative, str) else relative
    parts = F.split(relative, "/")
    directories = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return ~F.arrays_overlap(directories, F.array(*[F.lit(d) for d in excluded]))


def has_extension(path: Column | str, allowed: Iterable[str]) -> Column:
    return extension(path).isin([e.lower() for e in allowed])


def within_size(length: Column | str, max_mb: float = DEFAULT_MAX_MB) -> Column:
    """A file of exactly the limit still passes."""
    length = F.col(length) if isinstance(length, str) else length
    return length <= F.lit(int(max_mb * 2**20))


def name_glob(allowed: Iterable[str]) -> str:
    """A case-insensitive glob, so that other files are dropped while listing."""
    def either(ch: str) -> str:
        return f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch
    return "*{" + ",".join("".join(either(c) for c in ext) for ext in allowed) + "}"


def scan_directory(spark: SparkSession, root: str, recursive: bool = True,
                   exclude: Iterable[str] = (), extensions: Iterable[str] | None = DEFAULT_EXTENSIONS) -> DataFrame:
    """Files under ``root``: path, modificationTime, length, content.

    The tree is listed by `walk`, so the driver holds no listing. ``content`` is read by the tasks, and only when it is
    selected; a file that is gone by then fails the task. Names that start with ``_`` or ``.`` are skipped. Roots with a
    scheme that pyarrow does not know, and patterns, are listed by Spark's own reader, which holds the listing in the driver.
    """
    from foliospark.sources.walk import walk  # which needs this module

    if not within_reach(root) or any(c in root for c in "*?[{"):
        return _scanned_by_spark(spark, root, recursive, exclude, extensions)
    return walk(spark, root, recursive, exclude, extensions).withColumn("content", _contents_of(spark)("path"))


def _contents_of(spark: SparkSession) -> Callable[[str], Column]:
    """The bytes of each file of a column of paths, a few files at a time; not run where nothing needs them."""
    bounded_batches(spark)

    @F.arrow_udf("binary")
    def contents(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for paths in batches:
            held, size = [], 0
            for path in paths.to_pylist():
                system, inner = open_path(path)
                with system.open_input_file(inner) as stream:
                    held.append(stream.readall())
                size += len(held[-1])
                if size >= BATCH_BYTES:
                    yield pa.array(held, pa.binary())
                    held, size = [], 0
            yield pa.array(held, pa.binary())

    return contents


def _scanned_by_spark(spark: SparkSession, root: str, recursive: bool, exclude: Iterable[str], extensions: Iterable[str] | None) -> DataFrame:
    """The file type is pushed into Spark's listing as a glob; names that start with ``_`` or ``.`` are skipped by it."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if extensions is not None:
        extensions = list(extensions)
        reader = reader.option("pathGlobFilter", name_glob(extensions))
    files = reader.load(root).select("path", "modificationTime", "length", "content")
    files = files.withColumn("path", plain_path("path"))
    relative = relative_path("path", root.removeprefix("file://").removeprefix("file:"))
    keep = outside_directories(relative, exclude) if recursive else ~F.contains(relative, F.lit("/"))
    if extensions is not None:
        keep = keep & has_extension("path", extensions)
    return files.filter(keep)


def scan_roots(spark: SparkSession, roots: Iterable[str], **options) -> DataFrame:
    """Union of several scans."""
    return reduce(DataFrame.unionByName, [scan_directory(spark, r, **options) for r in roots])


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path inside it, for use in a task."""
    if path.startswith(("s3a://", "s3n://")):  # the names that Spark's readers have for it
        path = "s3" + path[3:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def within_reach(path: str) -> bool:
    """Whether pyarrow knows the scheme of a path; if not, only Spark's own readers and writers reach it."""
    try:
        open_path(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def scan_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A listing (path, modificationTime, length) of exactly the named files, whatever their names.

    The tasks ask for size and time of each path; a missing file has length 0 and fails later.
    """
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                           T.StructField("length", T.LongType())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("path").to_pylist()
            found = [system.get_file_info(inner) for system, inner in map(open_path, names)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array([(i.mtime_ns or 0) // 1000 for i in found], pa.timestamp("us", "UTC")),
                 pa.array([i.size or 0 for i in found], pa.int64())], names=schema.fieldNames())

    listed = local_rows(spark, [(p,) for p in paths], "path string").select(plain_path("path").alias("path"))
    return listed.mapInArrow(look, schema)


def listed_in(files: DataFrame, paths: DataFrame) -> DataFrame:
    """Files whose path is in a table of paths of any size."""
    return files.join(paths.select("path").distinct(), "path", "left_semi")


def changed_files(files: DataFrame, state: DataFrame, path: str = "path", mtime: str = "modificationTime") -> DataFrame:
    """Files that are new or newer than the recorded run; an equal time counts as unchanged.

    Both sides are unique per path, so the join cannot skew; a small state is broadcast by
    Spark under its own size threshold.
    """
    known = state.groupBy(F.col("filePath").alias(path)).agg(F.max("mtime").alias("_seen"))
    return (
        files.join(known, path, "left")
        .filter(F.col("_seen").isNull() | (F.col(mtime) > F.col("_seen")))
        .drop("_seen")
    )


def fetch_contents(files: DataFrame, total_bytes: int) -> DataFrame:
    """Add ``content`` to a listing by reading only the files that are in it.

    A scan that selects ``content`` reads every file it lists; after the incremental gate
    only the survivors should be read. Paths are dealt out so that a task reads about
    128 MiB; the paths must be reachable from all executors. A file that is gone or closed to
    us has no content; other read errors fail the task, so that Spark tries it again.
    """
    others = [c for c in files.columns if c != "content"]
    schema = T.StructType([*[files.schema[c] for c in others], T.StructField("content", T.BinaryType())])
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-total_bytes // READ_BYTES_PER_TASK))

    def read(path: str) -> bytes | None:
        system, inner = open_path(path)
        try:
            with system.open_input_file(inner) as stream:
                return stream.readall()
        except (FileNotFoundError, PermissionError):
            return None

    def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                yield pa.RecordBatch.from_arrays(
                    [*one.columns, pa.array([read(paths[row])], pa.binary())], names=[*others, "content"])

    return files.select(*others).repartition(int(tasks), "path").mapInArrow(read_batches, schema)


def _is_utf16(content: Column) -> Column:
    """A byte-order mark, whole code units, and no surrogate outside a high-low pair."""
    digits = F.hex(content)

    def sound(high: str, low: str, surrogate: str) -> Column:
        # Most texts have no surrogate at all, which one scan shows; else the proper pairs are removed first.
        units = F.regexp_replace(digits, "(....)", "$1 ")
        return F.when(~F.rlike(digits, F.lit(f"^(?:....)*?{surrogate}")), True) \
            .otherwise(~F.rlike(F.regexp_replace(units, f"{high} {low} ", ""), F.lit(f"{surrogate} ")))

    mark = F.hex(F.substring(content, 1, 2))
    sound_units = F.when(mark == "FFFE", sound("..D[89AB]", "..D[C-F]", "..D[89A-F]")) \
        .when(mark == "FEFF", sound("D[89AB]..", "D[C-F]..", "D[89A-F]..")).otherwise(False)
    return (F.octet_length(content) % 2 == 0) & sound_units


def decode_text(content: Column | str) -> Column:
    """Bytes to text: UTF-8 when valid, else UTF-16 when a byte-order mark says so, else Latin-1.

    Line ends are folded to ``\\n``.
    """
    content = F.col(content) if isinstance(content, str) else content
    text = (
        F.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "UTF-8"))
        .when(_is_utf16(content), F.decode(content, "UTF-16"))
        .otherwise(F.decode(content, "ISO-8859-1"))
    )
    return F.regexp_replace(text, "\r\n?", "\n")
