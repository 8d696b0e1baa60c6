"""Registry of queries with the SQL that must give the same rows, and shared SQL parts."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliospark.session import ship_packages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

QUERY = "Thea rely, ernt ingre NICHT"
TERMS = ["thea", "rely", "ernt", "ingre", "nicht"]
CHUNK_SIZE, CHUNK_OVERLAP = 100, 20


def register(name: str, sql: str | None = None):
    """Register a query; the SQL counterpart is left out where SQL cannot express it."""
    def add(function: Callable[[SparkSession, str], DataFrame]):
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_packages(spark)
            ship_packages(spark, os.path.dirname(os.path.abspath(__file__)))
            return function(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function
    return add


def words_sql(text: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


TERM_LIST = "[" + ", ".join(f"'{t}'" for t in TERMS) + "]"
TERM_SET = "(" + ", ".join(f"'{t}'" for t in TERMS) + ")"
STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
STEP = CHUNK_SIZE - CHUNK_OVERLAP

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "files": ("""
        SELECT *, text AS content,
          CASE lang WHEN 'en' THEN '.txt' WHEN 'fr' THEN '.docx' WHEN 'de' THEN '.pdf' ELSE '.xlsx' END AS extension,
          CAST(octet_length(encode(text)) AS BIGINT) AS size,
          concat('doc', CAST(doc_id AS VARCHAR), extension) AS name,
          concat('/share/', source, '/', name) AS filePath,
          TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id) AS modifiedDateTime,
          concat('owner', CAST(doc_id % 7 AS VARCHAR)) AS createdBy,
          CASE WHEN doc_id % 3 = 0 THEN concat('Title ', CAST(doc_id AS VARCHAR)) END AS document_title,
          md5(filePath) AS id
        FROM documents""", ()),
    "titled": ("""
        SELECT *, coalesce(document_title, concat('doc', CAST(doc_id AS VARCHAR))) AS title FROM files""", ("files",)),
    "index_state": ("""
        SELECT filePath, CASE WHEN doc_id % 4 = 0 THEN modifiedDateTime
                         ELSE modifiedDateTime - INTERVAL 1 HOUR END AS mtime
        FROM files WHERE doc_id % 2 = 0""", ("files",)),
    "embedding_cache": ("SELECT DISTINCT md5(text) AS text_hash FROM documents WHERE doc_id % 5 = 0", ()),
    "ws": (r"""
        SELECT *, list_filter(regexp_split_to_array(content, '\s+'), lambda x: x <> '') AS w FROM files""", ("files",)),
    "chunks": (f"""
        SELECT ws.*, CAST(t.s // {STEP} AS INTEGER) AS chunkNumber,
          CAST(CASE WHEN len(w) <= {CHUNK_SIZE} THEN 1 ELSE ceil(len(w) / {STEP}.0) END AS INTEGER) AS totalChunks,
          CASE WHEN len(w) <= {CHUNK_SIZE} THEN content
               ELSE array_to_string(w[t.s + 1 : t.s + {CHUNK_SIZE}], ' ') END AS chunk
        FROM ws, unnest(CASE WHEN len(w) <= {CHUNK_SIZE} THEN [0] ELSE range(0, len(w), {STEP}) END) AS t(s)
        """, ("ws",)),
    "long_chunks": (f"SELECT * FROM chunks WHERE length({STRIP.format('content')}) >= 10", ("chunks",)),
    "words": (f"SELECT id, extension, {words_sql('content')} AS toks FROM files", ("files",)),
    "stats": ("SELECT count(*) AS n, avg(len(toks)) AS m FROM words", ("words",)),
    "postings": ("""
        SELECT id, dl, term, count(*) AS tf
        FROM (SELECT id, len(toks) AS dl, unnest(toks) AS term FROM words) GROUP BY id, dl, term""", ("words",)),
    "dfs": ("SELECT term, count(*) AS df FROM postings GROUP BY term", ("postings",)),
    "weights": ("""
        SELECT id, term, tf, ln(1 + (n - df + 0.5) / (df + 0.5)) * (tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / m))) AS weight
        FROM postings JOIN dfs USING (term), stats""", ("postings", "dfs", "stats")),
    "scores": (f"""
        SELECT id, round(sum(weight), 6) AS score FROM weights WHERE term IN {TERM_SET} GROUP BY id""", ("weights",)),
    "hits": ("SELECT id, score FROM scores ORDER BY score DESC, id LIMIT 10", ("scores",)),
    "cosines": ("""
        SELECT vec_id AS id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]),
            (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 6) AS score FROM embeddings""", ()),
    "near": ("""
        SELECT f.id, c.score, row_number() OVER (ORDER BY c.score DESC, f.id) AS r
        FROM cosines c JOIN files f ON f.doc_id = c.id QUALIFY r <= 50""", ("cosines", "files")),
    "kw_ranked": ("SELECT id, row_number() OVER (ORDER BY score DESC, id) AS r FROM scores", ("scores",)),
    "fused": ("""
        SELECT coalesce(k.id, v.id) AS id,
          coalesce(1.0 / (60 + k.r), 0.0) + coalesce(1.0 / (60 + v.r), 0.0) AS score
        FROM kw_ranked k FULL JOIN near v ON k.id = v.id""", ("kw_ranked", "near")),
    "candidates": ("SELECT id, score FROM fused ORDER BY score DESC, id LIMIT 50", ("fused",)),
    "reranked": (f"""
        SELECT id, score, round((3.0 * len(list_intersect({TERM_LIST}, {words_sql('title')})) / 5.0
            + 2.0 * len(list_intersect({TERM_LIST}, {words_sql('content')})) / 5.0
            + len(list_intersect({TERM_LIST}, {words_sql("concat_ws(' ', name, extension)")})) / 5.0) / 6.0, 6)
            AS reranker_score
        FROM candidates JOIN titled USING (id)""", ("candidates", "titled")),
    "passages": (f"""
        SELECT id, score, i, s, len(list_intersect({TERM_LIST}, {words_sql('s')})) AS covered
        FROM (SELECT id, score, i, {STRIP.format('s')} AS s
              FROM (SELECT id, score, unnest(parts) AS s, generate_subscripts(parts, 1) AS i
                    FROM (SELECT id, score, regexp_split_to_array(content, '[.!?\n]+') AS parts
                          FROM hits JOIN files USING (id))))
        WHERE s <> ''""", ("hits", "files")),
    "captions": ("""
        SELECT * FROM passages QUALIFY row_number() OVER (PARTITION BY id ORDER BY covered DESC, i) = 1""", ("passages",)),
    "query_terms": (f"SELECT item_id AS query_id, unnest(list_distinct({words_sql('text')})) AS term FROM benchmark", ()),
    "batch_hits": ("""
        SELECT query_id, id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank
        FROM (SELECT query_id, id, round(sum(weight), 6) AS score FROM weights JOIN query_terms USING (term)
              GROUP BY query_id, id) QUALIFY rank <= 5""", ("weights", "query_terms")),
    "outcomes": ("""
        SELECT doc_id, filePath, extension, source, size,
          CASE WHEN size > 40000 THEN 'oversize' WHEN quality IS NULL THEN 'skipped'
               WHEN quality = 1 THEN 'successful' ELSE 'failed' END AS status,
          CASE WHEN status = 'successful' THEN CAST(ceil(n_chars / 500.0) AS BIGINT) END AS chunks
        FROM files LEFT JOIN labels USING (doc_id)""", ("files",)),
}


def with_parts(body: str, *parts: str) -> str:
    """``body`` preceded by the named common tables and all they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][1]:
            visit(needed)
        if name not in order:
            order.append(name)

    for part in parts:
        visit(part)
    if not order:
        return body
    # Each table is computed once, also where several others read it.
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n][0]})" for n in order) + "\n" + body
