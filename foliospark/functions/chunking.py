"""Overlapping token windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.functions.text import space_tokens, spaced_pieces

DEFAULT_SIZE = 1000
DEFAULT_OVERLAP = 200
# Chunk size and overlap recommended for short, general and long-form texts.
PRESETS = {"small": (500, 50), "medium": (1000, 200), "large": (1500, 300)}

# Tokenisers by name: how to split, and what joins the tokens of a window again.
TOKENIZERS: dict[str, tuple[Callable[[Column], Column], str]] = {
    "whitespace": (space_tokens, " "),
    "lossless": (spaced_pieces, ""),
}


def checked_window(size: int | None, overlap: int | None) -> tuple[int, int]:
    size = DEFAULT_SIZE if size is None else size
    overlap = DEFAULT_OVERLAP if overlap is None else overlap
    if size < 1:
        raise ValueError("chunk size must be positive")
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and smaller than the chunk size")
    return size, overlap


def chunk_total(tokens: Column, size: int, step: int) -> Column:
    return F.when(tokens <= size, 1).otherwise(F.ceil(tokens / step)).cast("int")


def explode_chunks(df: DataFrame, text: str = "content", size: int | None = None,
                   overlap: int | None = None, tokenizer: str = "whitespace") -> DataFrame:
    """One row per chunk: adds ``chunkNumber``, ``totalChunks`` and ``chunk``, drops ``text``.

    Windows start at 0, step, 2*step ... below the token count. A text of at most ``size``
    tokens is one chunk and stays untouched. Runs without a shuffle: tokenising, windowing
    and exploding are one map stage.
    """
    size, overlap = checked_window(size, overlap)
    step = size - overlap
    split, joiner = TOKENIZERS[tokenizer]
    others = [c for c in df.columns if c != text]
    tokens = F.col("_tokens")
    windows = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - 1, F.lit(step)),
        lambda start: F.array_join(F.slice(tokens, start + 1, F.lit(size)), joiner))
    pieces = F.when(F.size(tokens) <= size, F.array(F.col(text))).otherwise(windows)
    return (
        df.filter(F.col(text).isNotNull())
        .withColumn("_tokens", split(F.col(text)))
        .select(*others, chunk_total(F.size(tokens), size, step).alias("totalChunks"),
                F.posexplode(pieces).alias("chunkNumber", "chunk"))
        .select(*others, "chunkNumber", "totalChunks", "chunk")
    )


def explode_chunks_with_codec(df: DataFrame, codec: Callable[[], object], text: str = "content",
                              size: int | None = None, overlap: int | None = None) -> DataFrame:
    """Same windows over the token ids of a codec such as a byte-pair vocabulary.

    ``codec`` is called once per task and returns an object with ``encode(str) -> list[int]``
    and ``decode(list[int]) -> str``.
    """
    size, overlap = checked_window(size, overlap)
    step = size - overlap
    others = [c for c in df.columns if c != text]
    schema = T.StructType([
        *[df.schema[c] for c in others],
        T.StructField("chunkNumber", T.IntegerType()),
        T.StructField("totalChunks", T.IntegerType()),
        T.StructField("chunk", T.StringType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec()
        for batch in batches:
            rows, numbers, totals, chunks = [], [], [], []
            for row, value in enumerate(batch.column(text).to_pylist()):
                ids = tool.encode(value)
                pieces = [value] if len(ids) <= size else [
                    tool.decode(ids[s:s + size]) for s in range(0, len(ids), step)]
                rows += [row] * len(pieces)
                numbers += range(len(pieces))
                totals += [len(pieces)] * len(pieces)
                chunks += pieces
            kept = batch.select(others).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(numbers, pa.int32()), pa.array(totals, pa.int32()),
                 pa.array(chunks, pa.string())],
                names=[*others, "chunkNumber", "totalChunks", "chunk"])

    return df.filter(F.col(text).isNotNull()).select(*others, text).mapInArrow(cut, schema)
