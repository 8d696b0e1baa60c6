"""Helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliospark.session import BATCH_BYTES, bounded_batches  # noqa: F401 - the operators import them from here

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shuffle_width(spark: SparkSession) -> int:
    """The number of shuffle partitions, which is also the number of ways a hot key is split."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def salt_of(spark: SparkSession, *columns: str) -> Column:
    """A number per row below the shuffle width; with it, rows of one key spread over all tasks."""
    return F.pmod(F.xxhash64(*columns), F.lit(shuffle_width(spark))).cast("int")


def spread_lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], spread_by: Sequence[str],
                  how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``table``, which has one row per key, also where a third of ``rows`` has the same key.

    Rows get a salt. The pairs of key and salt that occur, at most one per key and task after the partial
    aggregation, fetch the table's row first; then the rows meet it by key and salt, spread over all tasks.
    ``rows`` is evaluated twice and should be a stored table or cheap.
    """
    salted = rows.withColumn("_salt", salt_of(rows.sparkSession, *spread_by))
    wanted = salted.groupBy(*keys, "_salt").agg(F.lit(1).alias("_one")).drop("_one")
    return salted.join(wanted.join(table, list(keys)), [*keys, "_salt"], how).drop("_salt")


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, by ``modulus``; the rule that holds rows out of training."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


_KEPT: dict[tuple, object] = {}


def once(key: tuple, make: Callable[[], object]):
    """What ``make`` returns, built once per Python process and shared by the tasks that run in it, one at a time."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def map_rows(df: DataFrame, make: Callable[[], Callable[[tuple], tuple]], schema: str | StructType) -> DataFrame:
    """Apply a function to each row inside Arrow batches; ``make`` builds it once per task.

    The function gets the row's values in column order and returns the values of one output row.
    """
    bounded_batches(df.sparkSession)
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            made = [one(row) for row in zip(*columns, strict=True)]
            if made:
                arrays = [pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), target, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)
    return df.mapInArrow(run, schema)


def fill_missing(df: DataFrame, column: str) -> Column:
    """A text column with null as empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


# ---- hashes of words, computed for a whole text at once

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Classes of bytes; 0 is white space. A token is a run of bytes of one class.
WORDS = np.ones(256, np.uint8)
WORDS[[0x20, *range(0x09, 0x0E)]] = 0
#: Letters, digits and all bytes of other alphabets apart from signs.
WORDS_AND_SIGNS = WORDS.copy()
WORDS_AND_SIGNS[[b for b in range(33, 127) if not chr(b).isalnum()]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers so that all bits depend on all bits."""
    out = values ^ (values >> np.uint64(30))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int, base: np.uint64, name: str) -> np.ndarray:
    """Powers 0 .. n-1 of ``base`` modulo 2^64, kept for the next text."""
    held = _POWERS.get(name)
    if held is None or held.size < n:
        held = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 1 << 16), base, np.uint64)]), dtype=np.uint64)
        _POWERS[name] = held
    return held[:n]


def word_hashes(text: str, lower: bool, classes: np.ndarray = WORDS, block: int = 1 << 20) -> np.ndarray:
    """One 64-bit hash per token, that is per run of bytes of one class other than 0, in text order.

    A token's hash is a polynomial of its bytes, taken from one running sum over the text, so there is no loop over
    tokens. Long texts go block by block; a token that crosses a block's end is moved to the next block.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if lower:
        data = _LOWER[data]
    found, at = [], 0
    while at < data.size:
        end = min(data.size, at + block)
        kind = classes[data[at:end]]
        if end < data.size and kind[-1]:
            holes = np.flatnonzero(kind == 0)
            if holes.size == 0:
                block *= 2
                continue
            end = at + int(holes[-1]) + 1
            kind = kind[:end - at]
        part = data[at:end]
        edges = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1], [True]]))
        real = kind[edges[:-1]] != 0
        starts, ends = edges[:-1][real], edges[1:][real]
        if starts.size:
            n = part.size
            total = np.zeros(n + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _powers(n, _BASE, "up"), dtype=np.uint64, out=total[1:])
            found.append(mix((total[ends] - total[starts]) * _powers(n, _INVERSE, "down")[starts] + (ends - starts).astype(np.uint64)))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; a text of fewer words counts as one run, an empty one as none."""
    if words.size == 0:
        return words
    k = min(k, words.size)
    n = words.size - k + 1
    out = words[:n].copy()
    for j in range(1, k):
        out = out * _BASE + words[j:j + n]
    return mix(out)
