"""Listing of directory trees level by level, each level one job over the directories found by the last."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.text import file_name
from foliospark.session import local_rows, staged
from foliospark.sources.files import DEFAULT_EXTENSIONS, has_extension, open_path, plain_path

ENTRY = "path string, modificationTime timestamp, length long, directory boolean"
ROWS_PER_BATCH = 10_000
#: Directories that one task lists, unless there are more than so many tasks for each core.
DIRECTORIES_PER_TASK, TASKS_PER_CORE = 16, 8


def _entries(directory: str) -> list[tuple[str, int, int, bool]]:
    """Visible entries of one directory: path, time in milliseconds, size, whether it is a directory."""
    system, inner = open_path(directory)
    scheme = directory[:len(directory) - len(inner)] if directory.endswith(inner) else directory.partition("://")[0] + "://"
    found = []
    for entry in system.get_file_info(fs.FileSelector(inner)):
        if not entry.base_name.startswith(("_", ".")) and entry.type in (fs.FileType.File, fs.FileType.Directory):
            found.append((scheme + entry.path, (entry.mtime_ns or 0) // 10**6, entry.size or 0, entry.type == fs.FileType.Directory))
    return found


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for directory in batch.column("path").to_pylist():
            found = _entries(directory)
            for first in range(0, len(found), ROWS_PER_BATCH):
                paths, times, sizes, kinds = zip(*found[first:first + ROWS_PER_BATCH])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(paths, pa.string()), pa.array([t * 1000 for t in times], pa.timestamp("us", "UTC")),
                     pa.array(sizes, pa.int64()), pa.array(kinds, pa.bool_())], names=["path", "modificationTime", "length", "directory"])


def walk(spark: SparkSession, roots: str | Iterable[str], recursive: bool = True, exclude: Iterable[str] = (),
         extensions: Iterable[str] | None = DEFAULT_EXTENSIONS, where: Column | None = None,
         written: list[str] | None = None) -> DataFrame:
    """Files below the roots: path, modificationTime, length.

    The directories of a level are dealt over the tasks, which ask for their entries; what they find is written, and
    its directories are the next level. So neither the driver nor a task holds the listing of a tree, only that of one
    directory, and there are as many jobs as levels. A directory with an excluded name (exact, at any depth below a
    root) is never listed; without ``recursive`` no directory but the roots is. Names that start with ``_`` or ``.``
    are skipped, a directory that cannot be listed ends the walk with its error, a root given twice is listed once.
    ``where`` is a further condition on files; ``written`` gets the folders of the levels.
    """
    roots = sorted({r.removeprefix("file://").removeprefix("file:").rstrip("/") or "/" for r in ([roots] if isinstance(roots, str) else roots)})
    exclude, most = list(exclude), spark.sparkContext.defaultParallelism * TASKS_PER_CORE
    keep = F.lit(True) if where is None else where
    if extensions is not None:
        keep = keep & has_extension("path", list(extensions))
    enter = F.lit(recursive)
    if exclude:
        enter = enter & ~file_name("path").isin(exclude)
    frontier, count, levels = local_rows(spark, [(r,) for r in roots], "path string"), len(roots), []
    while count:
        dealt = frontier.repartition(min(most, -(-count // DIRECTORIES_PER_TASK)), "path")
        level = dealt.mapInArrow(_list, ENTRY).filter(F.when(F.col("directory"), enter).otherwise(keep))
        levels.append(staged(level, "level", written))
        frontier = levels[-1].filter("directory").select("path").distinct()
        count = frontier.count() if recursive else 0
    files = reduce(DataFrame.unionByName, levels) if levels else local_rows(spark, [], ENTRY)
    # Roots may lie in each other; a file is listed once.
    files = files.filter("NOT directory").select(plain_path("path").alias("path"), "modificationTime", "length")
    return files.dropDuplicates(["path"]) if len(roots) > 1 else files
