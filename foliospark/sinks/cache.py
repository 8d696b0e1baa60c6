"""The table of vectors by text hash, laid out so that a run reads the part it needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliospark.operators.embedding import CACHE_DIGITS, CACHE_FOLDER, Embedder, attach_vectors, hash_folder, needed_part, new_embeddings
from foliospark.schemas import EMBEDDING_CACHE
from foliospark.sinks.store import TableStore


class EmbeddingCache(TableStore):
    """Vectors of all texts ever embedded, in folders by the first ``digits`` hexadecimal digits of the hash.

    Hashes are spread evenly, so folders are of one size, and an increment of n texts reads at most n of the 16 **
    digits folders. Raise ``digits`` when a folder grows beyond what an increment may read; a compaction lays the
    table out anew.
    """

    def __init__(self, spark: SparkSession, path: str, digits: int = CACHE_DIGITS, **options):
        super().__init__(spark, path, EMBEDDING_CACHE, key="text_hash", folders=(CACHE_FOLDER, hash_folder("text_hash", digits)), **options)
        self.digits = digits


def fill(cache: TableStore, chunks: DataFrame, embedder: Embedder, max_tokens: int | None, tag: str | None = None) -> int:
    """Embed the texts of ``chunks`` that the cache lacks and append their vectors; returns how many there were."""
    return cache.append(new_embeddings(chunks, embedder, _part(cache, chunks), max_tokens=max_tokens), tag=tag)


def look_up(cache: TableStore, chunks: DataFrame) -> DataFrame:
    """``chunks`` with ``contentVector``, null where the cache has none."""
    return attach_vectors(chunks, _part(cache, chunks))


def _part(cache: TableStore, chunks: DataFrame) -> DataFrame:
    """What the cache may have for these chunks: its folders, or all of a cache without folders."""
    return needed_part(cache.read(), chunks, cache.digits) if isinstance(cache, EmbeddingCache) else cache.read()
