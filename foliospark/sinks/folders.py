"""Trees of small text files, one for each row."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.session import bounded_batches
from foliospark.sources.files import open_path

#: The name that Spark gives to the folder of null and of an empty text.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def _folder(names: Sequence[str], values: Sequence[str | None]) -> str:
    """The folder below the root as Spark names it: ``name=value`` for each column."""
    return "/".join(f"{n}={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', v) if v else NO_VALUE}" for n, v in zip(names, values))


def write_text_files(rows: DataFrame, root: str, text: str = "text", by: Sequence[str] = ()) -> int:
    """Write each row's text and a line end to a file of its own, in folders by the columns ``by``; returns the number of files.

    Spark's own writer asks the operating system to start a program for the rights of each new file on a local disk,
    which takes far longer than the file; here the tasks write by the file system of the path. A file is named by its
    task and its place in it, so a task that is tried again writes the same files: ``rows`` must come in a fixed order,
    as they do from a table that is read. Of the texts one batch is held; only counts come to the driver.
    """
    root, names = root.removeprefix("file://").removeprefix("file:").rstrip("/"), list(by)
    bounded_batches(rows.sparkSession)
    store, top = open_path(root)
    store.create_dir(top, recursive=True)  # also where there are no rows

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner = open_path(root)
        made, task, number = set(), TaskContext.get().partitionId(), 0
        for batch in batches:
            folders = zip(*[c.to_pylist() for c in batch.columns[1:]]) if names else [()] * batch.num_rows
            for value, own in zip(batch.column(0), folders):
                folder = "/".join(p for p in (inner, _folder(names, own)) if p)
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(f"{folder}/part-{task:05d}-{number:07d}.txt") as out:
                    out.write((value.as_py() or "").encode("utf-8", "surrogatepass") + b"\n")
                number += 1
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64())], names=["files"])

    chosen = rows.select(F.col(text).cast("string"), *[F.col(n).cast("string") for n in names])
    return chosen.mapInArrow(write, "files long").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
