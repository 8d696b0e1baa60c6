"""One search table with all query types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import text_hash
from foliospark.operators.embedding import MAX_TOKENS, Embedder, model_input
from foliospark.operators.filters import metadata_filter
from foliospark.operators.hybrid import batch_hybrid_search, hybrid_search
from foliospark.operators.keyword import MATCH_ALL, batch_keyword_search, keyword_scores
from foliospark.operators.postings import posting_scores
from foliospark.operators.rerank import CANDIDATES, extract_answer, rerank, with_captions
from foliospark.operators.results import DEFAULT_TOP, boost_recent, default_fields, fall_back, fetch_fields, format_hits
from foliospark.operators.stats import facets
from foliospark.operators.term_index import TermIndex, TermSnapshot
from foliospark.operators.topk import top as best_of
from foliospark.operators.vector import batch_vector_search, vector_search
from foliospark.schemas import SEARCHABLE
from foliospark.session import local_rows
from foliospark.sinks.store import TableStore

Vector = Sequence[float] | DataFrame


class SearchTable:
    """Keyword, vector, hybrid, semantic and filtered search over one table.

    Without vectors, vector search raises and the hybrid types fall back to keyword search;
    with reranking off, semantic search is hybrid search. With ``postings`` keyword scores come from a term index of
    this table: the folder of one written from it, or a snapshot of one that follows it; see `of_store`.
    """

    def __init__(self, table: DataFrame, embedder: Embedder | None = None, fields: Sequence[str] | None = None,
                 id_col: str = "id", vector_col: str = "contentVector", reranking: bool = True,
                 postings: str | TermSnapshot | None = None, max_tokens: int | None = MAX_TOKENS):
        self.max_tokens = max_tokens
        self.table, self.embedder, self.id_col, self.vector_col = table, embedder, id_col, vector_col
        self.fields = list(fields) if fields else [c for c in table.columns if c in SEARCHABLE]
        self.reranking, self.postings = reranking, postings
        self.text = "chunk" if "chunk" in table.columns else "content"

    @classmethod
    def of_store(cls, store: TableStore, index: TermIndex, embedder: Embedder | None = None, refresh: bool = True, **options) -> SearchTable:
        """The table as it is now with its term index. Commits that the index lacks are taken in first, or, without
        ``refresh``, raise `StaleIndex`; what is committed later is seen neither by the table nor by the index."""
        if refresh:
            index.refresh(store)
        return cls(store.read(), embedder, fields=index.fields, id_col=index.id_col, postings=index.snapshot(store), **options)

    @property
    def has_vectors(self) -> bool:
        return self.vector_col in self.table.columns

    def query_embedding(self, query: str) -> DataFrame:
        """The query's vector, from the same embedder as the documents, as a one-row table."""
        if self.embedder is None:
            raise ValueError("vector search needs an embedder or a query vector")
        one = local_rows(self.table.sparkSession, [(query,)], "text string")
        return self.embedder(one.select(text_hash("text").alias("text_hash"), model_input("text", self.max_tokens).alias("text"))).select("embedding")

    def _vector(self, query: str, vector: Vector | None) -> Vector:
        return self.query_embedding(query) if vector is None else vector

    def _keyword_scores(self, query: str, where: Column | None, fields: Sequence[str] | None = None) -> DataFrame:
        indexed = self.postings is not None and (fields is None or list(fields) == self.fields)
        if not indexed or query.strip() == MATCH_ALL:
            return keyword_scores(self.table, query, list(fields) if fields else self.fields, self.id_col, where)
        allowed = None if where is None else self.table.filter(where).select(F.col(self.id_col).alias("id"))
        if isinstance(self.postings, TermSnapshot):
            return self.postings.scores(query, allowed)
        return posting_scores(self.table.sparkSession, self.postings, query, allowed)

    def _finish(self, hits: DataFrame, search_type: str, select: Sequence[str] | None) -> DataFrame:
        fields = list(select) if select else default_fields(search_type, self.table)
        return fetch_fields(hits, self.table, fields, self.id_col, few=True).orderBy(F.desc("score"), "id")

    def keyword(self, query: str, top: int | None = None, where: Column | None = None,
                select: Sequence[str] | None = None, fields: Sequence[str] | None = None) -> DataFrame:
        """Rows by keyword score; ``fields`` limits this search to some of the table's text fields."""
        k = DEFAULT_TOP if top is None else top
        return self._finish(best_of(self._keyword_scores(query, where, fields), k), "keyword", select)

    def facets(self, query: str, names: Sequence[str], where: Column | None = None) -> DataFrame:
        """(facet, value, count) over all rows that match the query and the filter, not only the best ones."""
        matching = self._keyword_scores(query, where).select("id")
        rows = self.table.select(F.col(self.id_col).alias("id"), *names)
        return facets(rows.join(matching, "id", "left_semi"), list(names))

    def keyword_batch(self, queries: DataFrame, top: int | None = None, where: Column | None = None) -> DataFrame:
        """(query_id, id, score, rank) for a table of queries (query_id, text)."""
        return batch_keyword_search(self.table, queries, DEFAULT_TOP if top is None else top, self.fields, self.id_col, where)

    def vector_batch(self, queries: DataFrame, top: int | None = None, where: Column | None = None) -> DataFrame:
        """The same by vector; queries without a ``vector`` column get one from the table's embedder."""
        if not self.has_vectors:
            raise ValueError("this table has no vectors; use keyword search")
        asked = self._with_vectors(queries).select("query_id", "vector")
        return batch_vector_search(self.table, asked, DEFAULT_TOP if top is None else top, self.id_col, self.vector_col, where)

    def hybrid_batch(self, queries: DataFrame, top: int | None = None, where: Column | None = None) -> DataFrame:
        if not self.has_vectors:
            return self.keyword_batch(queries, top, where)
        return batch_hybrid_search(self.table, self._with_vectors(queries), DEFAULT_TOP if top is None else top, self.fields,
                                   self.id_col, self.vector_col, where)

    def _with_vectors(self, queries: DataFrame) -> DataFrame:
        if "vector" in queries.columns:
            return queries
        if self.embedder is None:
            raise ValueError("vector search needs an embedder or query vectors")
        hashed = queries.select("query_id", "text", text_hash("text").alias("text_hash"))
        inputs = hashed.select("text_hash", model_input("text", self.max_tokens).alias("text")).dropDuplicates(["text_hash"])
        vectors = self.embedder(inputs).withColumnRenamed("embedding", "vector")
        return hashed.join(vectors, "text_hash").select("query_id", "text", "vector")

    def vector(self, query: str, top: int | None = None, where: Column | None = None,
               select: Sequence[str] | None = None, vector: Vector | None = None) -> DataFrame:
        if not self.has_vectors:
            raise ValueError("this table has no vectors; use keyword search")
        k = DEFAULT_TOP if top is None else top
        hits = vector_search(self.table, self._vector(query, vector), k, self.id_col, self.vector_col, where)
        return self._finish(hits, "vector", select)

    def _hybrid_hits(self, query: str, k: int, where: Column | None, vector: Vector | None) -> DataFrame:
        return hybrid_search(self.table, query, self._vector(query, vector), k, self.fields, self.id_col,
                             self.vector_col, where, scores=self._keyword_scores(query, where))

    def hybrid(self, query: str, top: int | None = None, where: Column | None = None,
               select: Sequence[str] | None = None, vector: Vector | None = None) -> DataFrame:
        if not self.has_vectors:
            return self.keyword(query, top, where, select)
        k = DEFAULT_TOP if top is None else top
        return self._finish(self._hybrid_hits(query, k, where, vector), "hybrid", select)

    def semantic(self, query: str, top: int | None = None, where: Column | None = None,
                 select: Sequence[str] | None = None, vector: Vector | None = None) -> DataFrame:
        """Hybrid candidates reordered by field priority, with captions."""
        if not self.has_vectors:
            return self.keyword(query, top, where, select)
        if not self.reranking:
            return self.hybrid(query, top, where, select, vector)
        k = DEFAULT_TOP if top is None else top
        hits = self._hybrid_hits(query, CANDIDATES, where, vector)
        best = with_captions(rerank(hits, self.table, query, k, self.id_col), query, self.text)
        fields = list(select) if select else default_fields("semantic", self.table)
        return best.orderBy(F.desc("reranker_score"), F.desc("score"), "id").select(
            "id", *[f for f in fields if f != "id"], "score", "reranker_score", "caption", "covered")

    def answer(self, query: str, top: int | None = None, where: Column | None = None,
               vector: Vector | None = None) -> DataFrame:
        """The best passage over the semantic hits."""
        return extract_answer(self.semantic(query, top, where, vector=vector))

    def filtered(self, query: str, extension: str | None = None, date_from: str | None = None,
                 date_to: str | None = None, author: str | None = None, top: int | None = None,
                 search_type: str = "hybrid", vector: Vector | None = None) -> DataFrame:
        """Search within a metadata filter; an unknown type means hybrid."""
        where = metadata_filter(extension, date_from, date_to, author)
        if search_type == "keyword":
            return self.keyword(query, top, where)
        kinds = {"vector": self.vector, "hybrid": self.hybrid, "semantic": self.semantic}
        return kinds.get(search_type, self.hybrid)(query, top, where, vector=vector)

    def adaptive(self, query: str, as_of: Column, top: int | None = None, vector: Vector | None = None) -> DataFrame:
        """Vector search, keyword search instead if all scores are low, then recent rows first."""
        fields = default_fields("hybrid", self.table)
        preferred = self.vector(query, top, select=fields, vector=vector)
        return boost_recent(fall_back(preferred, self.keyword(query, top, select=fields)), as_of)


def render_results(hits: DataFrame, show_scores: bool = True) -> str:
    """The display text of a top-k result."""
    blocks = [r["block"] for r in format_hits(hits, show_scores).orderBy("ordinal").collect()]
    if not blocks:
        return "No results found."
    rule = "=" * 80
    body = "".join(f"\n{b}\n" for b in blocks)
    return f"\nFound {len(blocks)} results:\n\n{rule}\n{body}\n{rule}"
