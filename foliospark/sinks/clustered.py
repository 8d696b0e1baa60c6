"""Tables written so that rows with near values of several columns share files, for scans that skip the others."""

from __future__ import annotations

import os
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CURVE = "_curve"
#: Each column is cut into 2 to the power of so many parts of about equal size.
BITS = 4
_TEXT_BYTES = 7


def _shared_prefix(low: str | None, high: str | None) -> int:
    return len(os.path.commonprefix([low or "", high or ""]).encode())


def ordinal(column: Column, kind: T.DataType, skip: int = 0) -> Column:
    """A whole number or double in the order of the values; of a text the seven bytes after its first ``skip`` ones."""
    if isinstance(kind, T.StringType):
        part = F.substring(column.cast("binary"), skip + 1, _TEXT_BYTES)
        return F.conv(F.rpad(F.hex(part), 2 * _TEXT_BYTES, "0"), 16, 10).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp"))
    return F.unix_date(column).cast("long") if isinstance(kind, T.DateType) else column.cast("double")


def curve(df: DataFrame, columns: list[str], bits: int = BITS) -> Column:
    """The place of a row on a curve through all parts of the columns, their bits taken in turn; null is in the first part.

    The bounds of the parts are approximate percentiles of all rows: 2 ** ``bits`` numbers for each column come to the
    driver, and for text columns the smallest and largest value, whose common beginning tells nothing.
    """
    kinds = {c: df.schema[c].dataType for c in columns}
    texts = [c for c in columns if isinstance(kinds[c], T.StringType)]
    ends = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(texts) for n, f in (("low", F.min), ("high", F.max))]).first() if texts else {}
    skips = {c: _shared_prefix(ends[f"low{i}"], ends[f"high{i}"]) for i, c in enumerate(texts)}
    values = {c: ordinal(F.col(c), kinds[c], skips.get(c, 0)) for c in columns}
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    bounds = df.agg(*[F.percentile_approx(values[c], shares, 10_000).alias(str(i)) for i, c in enumerate(columns)]).first()
    place = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        above = [F.coalesce(values[c] >= F.lit(b), F.lit(False)).cast("int") for b in sorted(set(bounds[str(i)] or []))]
        part = reduce(add, above, F.lit(0))
        for bit in range(bits):
            taken = F.shiftright(part, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place + F.shiftleft(taken, bit * len(columns) + i)
    return place


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int, spread_by: str = "id", bits: int = BITS) -> None:
    """Write ``df`` in about ``files`` files, each with a range of the curve through ``columns``.

    Filters on any of the columns are then answered from few files and row groups, whose smallest and largest values
    Parquet keeps. A place on the curve that holds very many rows is dealt over several files by ``spread_by``.
    """
    placed = df.withColumn(CURVE, curve(df, columns, bits))
    ranged = placed.repartitionByRange(files, CURVE, F.xxhash64(spread_by))
    ranged.sortWithinPartitions(CURVE, *columns).drop(CURVE).write.parquet(path)


def value_ranges(table: DataFrame, columns: list[str]) -> DataFrame:
    """Smallest and largest value of each column for each file: ``file``, ``low_<column>``, ``high_<column>``."""
    ends = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(*ends)
