"""Vector search by cosine similarity: exact, batched, and over cells of near vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliospark.operators.embedding import valid_dimensions
from foliospark.operators.topk import MATRIX_CELLS, Leaders, query_passes, ranked, top
from foliospark.session import local_rows, staged

BYTES_PER_PASS = 64 * 2**20
QUERIES_PER_MATRIX = 256


def query_table(spark: SparkSession, vector: Sequence[float] | DataFrame) -> DataFrame:
    """A query vector, given as numbers or as a one-row, one-column table, as a table of one query."""
    if isinstance(vector, DataFrame):
        rows = vector.select(F.col(vector.columns[0]).cast("array<double>")).limit(2).collect()
        if len(rows) > 1:
            raise ValueError("a search takes one query vector; use batch_vector_search for a table of them")
        return local_rows(spark, [("q", r[0]) for r in rows], "query_id string, vector array<double>")
    return local_rows(spark, [("q", [float(x) for x in vector])], "query_id string, vector array<double>")


def vector_search(table: DataFrame, vector: Sequence[float] | DataFrame, k: int = 5, id_col: str = "id",
                  vector_col: str = "contentVector", where: Column | None = None) -> DataFrame:
    """(id, score) of the k nearest rows, exact; a batch search with one query."""
    queries = query_table(table.sparkSession, vector)
    return top(batch_vector_search(table, queries, k, id_col, vector_col, where).select("id", "score"), k)


def _rows_of(lists: pa.ListArray) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1).astype(np.float64)


def _scaled(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows, and which rows have a direction at all."""
    length = np.linalg.norm(matrix, axis=1)
    sound = length > 0
    return matrix / np.where(sound, length, 1.0)[:, None], sound


def batch_vector_search(table: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "id",
                        vector_col: str = "contentVector", where: Column | None = None) -> DataFrame:
    """(query_id, id, score, rank) for a table of queries (query_id, vector), exact."""
    rows = table if where is None else table.filter(where)
    return _search_passes(rows, queries, k, id_col, vector_col, None)


def _search_passes(rows: DataFrame, queries: DataFrame, k: int, id_col: str, vector_col: str,
                   cells: tuple[np.ndarray, int] | None) -> DataFrame:
    spark = rows.sparkSession
    wanted = queries.select("query_id", F.col("vector").cast("array<double>").alias("vector")) \
        .filter(F.size("vector") > 0)
    extra = [] if cells is None else ["cell"]
    rows = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), *extra)
    schema = T.StructType([wanted.schema["query_id"], rows.schema["id"], T.StructField("score", T.DoubleType())])
    results = []
    for block in query_passes(wanted, F.size("vector") * 8, BYTES_PER_PASS):
        for dim in sorted({len(q["vector"]) for q in block}):
            # A block's leaders are written before the next block begins, so the driver and the executors hold one block.
            results.append(staged(_search_pass(rows, [q for q in block if len(q["vector"]) == dim], k, schema, cells), "leaders"))
    hits = reduce(DataFrame.unionByName, results) if results else local_rows(spark, [], schema)
    return ranked(hits, k)


def _probes(block: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    """Queries by cells: True for the ``probes`` cells whose centre is nearest to the query.

    Distances come from a matrix product, for some queries at a time.
    """
    mask = np.zeros((len(block), len(centroids)), dtype=bool)
    half = (centroids ** 2).sum(axis=1) / 2
    step = max(1, MATRIX_CELLS // len(centroids))
    for first in range(0, len(block), step):
        away = half - block[first:first + step] @ centroids.T
        near = np.argsort(away, axis=1, kind="stable")[:, :probes]
        np.put_along_axis(mask[first:first + step], near, True, axis=1)
    return mask


def _search_pass(rows: DataFrame, queries: list[Row], k: int, schema: T.StructType,
                 cells: tuple[np.ndarray, int] | None) -> DataFrame:
    dim = len(queries[0]["vector"])
    matrix, sound = _scaled(np.array([q["vector"] for q in queries]))
    query_ids = [q["query_id"] for q in queries]
    probe = None if cells is None else _probes(matrix, *cells)
    shared = rows.sparkSession.sparkContext.broadcast((query_ids, matrix, sound, probe))
    out_schema = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix, query_sound, probe = shared.value
        leaders = Leaders(k, query_ids)
        step = max(1, MATRIX_CELLS // max(dim, QUERIES_PER_MATRIX))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                vectors, row_sound = _scaled(_rows_of(part.column("vector")))
                ids = np.array(part.column("id").to_pylist())
                for first in range(0, len(query_ids), QUERIES_PER_MATRIX):
                    block = slice(first, first + QUERIES_PER_MATRIX)
                    matched = row_sound[:, None] & query_sound[None, block]
                    if probe is not None:
                        cell = part.column("cell").to_numpy(zero_copy_only=False)
                        matched = matched & probe[block, :][:, cell].T
                    leaders.offer_matrix(vectors @ matrix[block].T, matched, ids, first)
        yield from leaders.batches(out_schema)

    kept = rows.filter(valid_dimensions("vector", dim))
    if probe is not None:
        # With a table written by cell this reads only the probed folders.
        kept = kept.filter(F.col("cell").isin([int(c) for c in np.flatnonzero(probe.any(axis=0))]))
    return kept.mapInArrow(search, schema)


def train_cells(table: DataFrame, cells: int, vector_col: str = "contentVector", seed: int = 7) -> np.ndarray:
    """Cell centres by distributed k-means on all vectors, scaled to unit length."""
    length = F.sqrt(F.aggregate(vector_col, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    unit = table.withColumn("_n", length).filter(F.col("_n") > 0).select(
        array_to_vector(F.transform(vector_col, lambda x: x.cast("double") / F.col("_n"))).alias("features"))
    model: KMeansModel = KMeans(k=cells, seed=seed, maxIter=10).fit(unit)
    return np.array(model.clusterCenters())


def assign_cells(table: DataFrame, centroids: np.ndarray, vector_col: str = "contentVector") -> DataFrame:
    """Add ``cell``, the nearest centre of each vector."""
    shared = table.sparkSession.sparkContext.broadcast(centroids)
    schema = T.StructType([*table.schema.fields, T.StructField("cell", T.IntegerType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        half = (centres ** 2).sum(axis=1) / 2
        for batch in batches:
            if batch.num_rows:
                unit, _ = _scaled(_rows_of(batch.column(vector_col)))
                nearest = np.argmax(unit @ centres.T - half, axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest)],
                                                 names=[*batch.schema.names, "cell"])

    return table.filter(valid_dimensions(vector_col, centroids.shape[1])).mapInArrow(assign, schema)


def write_cells(table: DataFrame, path: str, cells: int, vector_col: str = "contentVector", seed: int = 7) -> None:
    """Train cells on a table and write it with one folder for each cell, large cells in several files."""
    centroids = train_cells(table, cells, vector_col, seed)
    schema = "cell int, centre array<double>"
    local_rows(table.sparkSession, [(i, [float(x) for x in c]) for i, c in enumerate(centroids)], schema).write.parquet(f"{path}/centres")
    assign_cells(table, centroids, vector_col).hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/rows")


def read_cells(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray]:
    """The table that `write_cells` wrote and its centres; a search reads the folders of the cells that it probes."""
    centres = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()  # as many rows as cells
    return spark.read.parquet(f"{path}/rows"), np.array([r["centre"] for r in centres])


def ann_search(celled: DataFrame, centroids: np.ndarray, queries: DataFrame, k: int = 5, probes: int = 4,
               id_col: str = "id", vector_col: str = "contentVector") -> DataFrame:
    """Approximate batch search: each query looks only into its ``probes`` nearest cells.

    With ``probes`` equal to the number of cells the result is the exact one.
    """
    return _search_passes(celled, queries, k, id_col, vector_col, (centroids, probes))


def probed(celled: DataFrame, centroids: np.ndarray, queries: DataFrame, probes: int) -> DataFrame:
    """The rows of the cells that a block of queries probes; on a table written by cell a filter on folders."""
    rows = queries.select(F.col("vector").cast("array<double>")).collect()
    mask = _probes(_scaled(np.array([r[0] for r in rows]))[0], centroids, probes)
    return celled.filter(F.col("cell").isin([int(c) for c in np.flatnonzero(mask.any(axis=0))]))


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the share of exact hits that the approximate search also returned."""
    found = approximate.select("query_id", "id", F.lit(1).alias("_hit"))
    return exact.join(found, ["query_id", "id"], "left").agg(
        F.avg(F.coalesce("_hit", F.lit(0))).alias("recall"))
