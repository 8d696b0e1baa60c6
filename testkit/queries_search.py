"""Searches, ranking, result handling, facets and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as X
from foliospark.functions.chunking import explode_chunks
from foliospark.functions.scoring import cosine, rounded
from foliospark.operators import embedding as E
from foliospark.operators import filters as C
from foliospark.operators import hybrid, keyword, postings, rerank, results, stats, term_index, vector
from foliospark.operators.topk import top, with_rank
from foliospark.plans.search import SearchTable
from foliospark.schemas import STANDARD_DOCUMENT
from foliospark.session import scratch_path, staged
from foliospark.sinks import store
from foliospark.sinks.clustered import value_ranges, write_clustered
from testkit import relations as rel
from testkit.registry import CHUNK_OVERLAP, CHUNK_SIZE, QUERY, TERM_LIST, TERM_SET, TERMS, register, with_parts, words_sql

AS_OF = "2024-02-10 00:00:00"

# ---------------------------------------------------------------- keyword search


@register("corpus_stats", with_parts("""
    SELECT n AS documents, round(m, 6) AS mean_length, CAST((SELECT sum(len(toks)) FROM words) AS BIGINT) AS tokens FROM stats""", "stats"))
def _(spark, d):
    return keyword.corpus_stats(rel.files(spark, d, spread=True)).withColumn("mean_length", F.round("mean_length", 6))


@register("term_df", with_parts("SELECT term, df AS doc_freq FROM dfs", "dfs"))
def _(spark, d):
    return keyword.term_frequencies(rel.files(spark, d, spread=True))


@register("bm25_weights", with_parts(f"""
    SELECT id, term, CAST(tf AS INTEGER) AS tf, round(weight, 6) AS weight FROM weights WHERE term IN {TERM_SET}""", "weights"))
def _(spark, d):
    return keyword.bm25_weights(rel.files(spark, d, spread=True), TERMS)


@register("keyword_search", with_parts("SELECT id, name, score FROM hits JOIN files USING (id)", "hits", "files"))
def _(spark, d):
    table = rel.files(spark, d, spread=True)
    return results.fetch_fields(keyword.keyword_search(table, QUERY, 10), rel.files(spark, d), ["name"], few=True)


@register("keyword_search_indexed", with_parts("""
    SELECT 'all' AS way, id, score FROM hits UNION ALL
    SELECT 'pdf', id, score FROM (SELECT id, score FROM scores JOIN files USING (id) WHERE extension = '.pdf' ORDER BY score DESC, id LIMIT 5)""",
    "hits", "scores", "files"))
def _(spark, d):
    path, table = scratch_path(spark, "postings"), rel.files(spark, d, spread=True)
    postings.write_postings(table, path, buckets=8)
    allowed = rel.files(spark, d).filter(C.equals("extension", ".pdf")).select("id")
    return postings.posting_search(spark, path, QUERY, 10).select(F.lit("all").alias("way"), "id", "score").unionByName(
        postings.posting_search(spark, path, QUERY, 5, allowed).select(F.lit("pdf").alias("way"), "id", "score"))


def _moving_table(spark, d, compacted: bool, fan_in: int = 3) -> tuple[store.TableStore, term_index.TermIndex]:
    """A table of all files that took many commits, and the index that followed it.

    Every file comes first with a wrong text; then the files are replaced in three groups, one of which was erased and
    comes back, another one twice, with a compaction in between. At last some files are erased.
    """
    table = store.TableStore(spark, scratch_path(spark, "moving"), STANDARD_DOCUMENT)
    index = term_index.TermIndex(spark, scratch_path(spark, "terms"), per_file=20_000, fan_in=fan_in)
    rows = rel.files(spark, d, spread=True)
    groups = [rows.filter(F.col("doc_id") % 3 == g) for g in range(3)]
    table.upsert(rows.withColumn("content", F.concat(F.lit("thea thea rely "), F.reverse("content"))), unique=True)
    index.refresh(table)
    table.erase(groups[0].select("filePath"))
    table.upsert(groups[0], unique=True)
    index.refresh(table)  # two commits at once
    table.upsert(groups[1].withColumn("content", F.concat(F.col("content"), F.lit(" nicht"))), unique=True)
    index.refresh(table)
    if compacted:
        table.upsert(groups[1], unique=True)
        table.compact()  # the index has not seen the last commit
    else:
        table.upsert(groups[1], unique=True)
    index.refresh(table)
    table.upsert(groups[2], unique=True)
    table.erase(rows.filter(F.col("doc_id") % 11 == 3).select("filePath"))
    return table, index


_ERASED = """
    live AS MATERIALIZED (SELECT * FROM words JOIN (SELECT id, doc_id FROM files) USING (id) WHERE doc_id % 11 <> 3),
    live_stats AS (SELECT count(*) AS n, avg(len(toks)) AS m, CAST(sum(len(toks)) AS BIGINT) AS tokens FROM live),
    live_tf AS (SELECT id, extension, dl, term, count(*) AS tf FROM (SELECT id, extension, len(toks) AS dl, unnest(toks) AS term FROM live) GROUP BY ALL),
    live_df AS (SELECT term, count(*) AS df FROM live_tf GROUP BY term),
    live_scores AS (SELECT id, extension, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * (tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / m)))), 6) AS score
      FROM live_tf JOIN live_df USING (term), live_stats WHERE term IN """ + TERM_SET + " GROUP BY id, extension)"


@register("postings_after_upsert", with_parts(f""", {_ERASED}
    SELECT 'all' AS way, id, score FROM live_scores
    UNION ALL SELECT 'pdf', id, score FROM (SELECT * FROM live_scores WHERE extension = '.pdf' ORDER BY score DESC, id LIMIT 5)""", "words", "files"))
def _(spark, d):
    table, index = _moving_table(spark, d, compacted=True)
    asked = SearchTable.of_store(table, index)
    pdf = table.read().filter(C.equals("extension", ".pdf")).select("id")
    return asked.postings.scores(QUERY).select(F.lit("all").alias("way"), "id", "score").unionByName(
        asked.postings.search(QUERY, 5, pdf).select(F.lit("pdf").alias("way"), "id", "score"))


@register("maintained_statistics", with_parts(f""", {_ERASED}
    SELECT term, df AS doc_freq, n AS documents, tokens FROM live_df, live_stats WHERE term IN {TERM_SET}""", "words", "files"))
def _(spark, d):
    # Added and subtracted commit by commit, equal to a recount of what the table holds now.
    table, index = _moving_table(spark, d, compacted=False, fan_in=2)
    index.refresh(table)
    now = index.snapshot(table)
    return now.document_frequencies(TERMS).select(
        "term", "doc_freq", F.lit(now.documents).cast("long").alias("documents"), F.lit(now.tokens).cast("long").alias("tokens"))


@register("match_all", with_parts("SELECT id, 1.0::DOUBLE AS score FROM files ORDER BY id LIMIT 10", "files"))
def _(spark, d):
    return keyword.keyword_search(rel.files(spark, d), "*", 10)


@register("search_fields", with_parts(f"""
    SELECT id, score FROM (
      SELECT id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / m))), 6) AS score
      FROM (SELECT id, dl, term, count(*) AS tf FROM (SELECT id, len(t) AS dl, unnest(t) AS term FROM short) GROUP BY ALL)
        JOIN (SELECT term, count(DISTINCT id) AS df FROM (SELECT id, unnest(t) AS term FROM short) GROUP BY term) USING (term),
        (SELECT count(*) AS n, avg(len(t)) AS m FROM short)
      WHERE term IN ('title', 'src7', 'docx') GROUP BY id)
    ORDER BY score DESC, id LIMIT 10""".replace("short", f"""(SELECT id, list_concat({words_sql('title')}, {words_sql('filePath')}) AS t
      FROM titled)"""), "titled"))
def _(spark, d):
    return keyword.keyword_search(rel.search_table(spark, d), "title src7 docx", 10, fields=("title", "filePath"))


@register("prefilter_vs_post", with_parts("""
    SELECT 'before' AS way, id, score FROM (SELECT id, score FROM scores JOIN files USING (id) WHERE extension = '.pdf'
      ORDER BY score DESC, id LIMIT 10)
    UNION ALL SELECT 'after', id, score FROM hits JOIN files USING (id) WHERE extension = '.pdf'""", "scores", "hits", "files"))
def _(spark, d):
    table = rel.files(spark, d, spread=True)
    before = keyword.keyword_search(table, QUERY, 10, where=C.equals("extension", ".pdf"))
    after = results.fetch_fields(keyword.keyword_search(table, QUERY, 10), rel.files(spark, d), ["extension"], few=True)
    return before.select(F.lit("before").alias("way"), "id", "score").unionByName(
        after.filter(C.equals("extension", ".pdf")).select(F.lit("after").alias("way"), "id", "score"))


@register("batch_keyword_search", with_parts("SELECT query_id, id, score, rank FROM batch_hits", "batch_hits"))
def _(spark, d):
    return keyword.batch_keyword_search(rel.files(spark, d, spread=True), rel.query_texts(spark, d), 5)


@register("distinct_queries", with_parts("""
    SELECT CAST(q.item_id AS BIGINT) AS query_id, id, score, rank FROM batch_hits JOIN
      (SELECT item_id, item_id AS base FROM benchmark UNION ALL SELECT item_id + 1000000, item_id FROM benchmark) q ON q.base = query_id""",
    "batch_hits"))
def _(spark, d):
    once = rel.query_texts(spark, d)
    twice = once.unionByName(once.select((F.col("query_id") + 1000000).alias("query_id"), "text"))
    return keyword.batch_keyword_search(rel.files(spark, d, spread=True), twice, 5)


# ---------------------------------------------------------------- vector search


@register("cosine_pairs", """
    SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS score
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def _(spark, d):
    table = rel.table(spark, d, "embeddings")
    following = table.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return table.join(following, "vec_id").select("vec_id", rounded(cosine(F.col("embedding"), F.col("other"))).alias("score"))


@register("vector_search", with_parts("SELECT id, score FROM cosines ORDER BY score DESC, id LIMIT 10", "cosines"))
def _(spark, d):
    return vector.vector_search(rel.vectors(spark, d), rel.one_vector(spark, d), 10)


_BATCH_VECTOR = """
    SELECT q.vec_id AS query_id, v.vec_id AS id,
      round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 6) AS score,
      CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY score DESC, v.vec_id) AS INTEGER) AS rank
    FROM embeddings q JOIN benchmark ON item_id = q.vec_id, embeddings v QUALIFY rank <= 10"""


@register("batch_vector_search", _BATCH_VECTOR)
def _(spark, d):
    return vector.batch_vector_search(rel.vectors(spark, d), rel.query_vectors(spark, d), 10)


@register("ann_search")
def _(spark, d):
    table = rel.vectors(spark, d)
    centroids = vector.train_cells(table, 16)
    return vector.ann_search(vector.assign_cells(table, centroids), centroids, rel.query_vectors(spark, d), 10, probes=6)


@register("ann_recall", """
    SELECT count(*) AS queries, true AS found, true AS folders_pruned FROM benchmark JOIN embeddings ON vec_id = item_id""")
def _(spark, d):
    # Written by cell once; a search reads probed folders only. Shares of the exact hits are measured query by query.
    path, queries = scratch_path(spark, "cells"), rel.query_vectors(spark, d)
    vector.write_cells(rel.vectors(spark, d), path, 16)
    rows, centres = vector.read_cells(spark, path)
    near = vector.ann_search(rows, centres, queries, 10, probes=12).select("query_id", "id", F.lit(1).alias("hit"))
    exact = vector.batch_vector_search(rel.vectors(spark, d), queries, 10)
    shares = exact.join(near, ["query_id", "id"], "left").groupBy("query_id").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("share"))
    one = queries.orderBy("query_id").limit(1)
    pruned = vector.probed(rows, centres, one, probes=2).select("cell").distinct().count() <= 2
    return shares.agg(F.count("*").alias("queries"), (F.avg("share") >= 0.95).alias("found")).withColumn("folders_pruned", F.lit(pruned))


@register("ann_search_all_cells", _BATCH_VECTOR)
def _(spark, d):
    # Probing every cell must give the exact result.
    table = rel.vectors(spark, d)
    centroids = vector.train_cells(table, 8)
    return vector.ann_search(vector.assign_cells(table, centroids), centroids, rel.query_vectors(spark, d), 10, probes=8)


# ---------------------------------------------------------------- hybrid, rerank, captions


def _hybrid(spark, d, k: int) -> DataFrame:
    return hybrid.hybrid_search(rel.search_table(spark, d), QUERY, rel.one_vector(spark, d), k)


@register("hybrid_search", with_parts("""
    SELECT id, name, round(score, 6) AS score FROM (SELECT * FROM fused ORDER BY score DESC, id LIMIT 10) JOIN files USING (id)""",
    "fused", "files"))
def _(spark, d):
    return results.fetch_fields(_hybrid(spark, d, 10), rel.files(spark, d), ["name"], few=True).withColumn("score", F.round("score", 6))


@register("rrf_fusion", with_parts("""
    SELECT coalesce(k.id, v.id) AS id, round(coalesce(1.0 / (60 + k.r), 0.0) + coalesce(1.0 / (60 + v.r), 0.0), 6) AS score
    FROM kw_ranked k FULL JOIN near v ON k.id = v.id""", "kw_ranked", "near"))
def _(spark, d):
    table = rel.search_table(spark, d)
    words = hybrid.all_ranks(staged(keyword.keyword_scores(table, QUERY), "scores"))
    near = with_rank(vector.vector_search(table, rel.one_vector(spark, d), 50))
    return hybrid.fuse(words, near).withColumn("score", F.round("score", 6))


@register("search_facets", with_parts("""
    SELECT 'extension' AS facet, extension AS value, count(*) AS count FROM scores JOIN files USING (id) GROUP BY extension
    UNION ALL SELECT 'createdBy', createdBy, count(*) FROM scores JOIN files USING (id) GROUP BY createdBy""", "scores", "files"))
def _(spark, d):
    return SearchTable(rel.search_table(spark, d), fields=["content"]).facets(QUERY, ["extension", "createdBy"])


@register("rerank_search", with_parts("""
    SELECT id, reranker_score, round(score, 6) AS score FROM reranked ORDER BY reranker_score DESC, reranked.score DESC, id LIMIT 10""",
    "reranked"))
def _(spark, d):
    ranked = rerank.rerank(_hybrid(spark, d, 50), rel.search_table(spark, d), QUERY, 10)
    return ranked.select("id", "reranker_score", F.round("score", 6).alias("score"))


def _captioned(spark, d) -> DataFrame:
    table = rel.files(spark, d, spread=True)
    hits = results.fetch_fields(keyword.keyword_search(table, QUERY, 10), rel.files(spark, d), ["content"], few=True)
    return rerank.with_captions(hits, QUERY)


@register("extract_captions", with_parts("SELECT id, s AS caption, CAST(covered AS INTEGER) AS covered FROM captions", "captions"))
def _(spark, d):
    return _captioned(spark, d).select("id", "caption", "covered")


@register("extract_answer", with_parts("""
    SELECT id, s AS answer, CAST(covered AS INTEGER) AS covered FROM captions ORDER BY covered DESC, score DESC, id LIMIT 1""", "captions"))
def _(spark, d):
    return rerank.extract_answer(_captioned(spark, d))


@register("filter_skipping", with_parts("""
    SELECT id, extension, true AS most_files_skipped FROM files
    WHERE extension = '.txt' AND createdBy = 'owner1' AND modifiedDateTime >= TIMESTAMP '2024-01-02 00:00:00'""", "files"))
def _(spark, d):
    # Written along a curve through the columns of the filter; of most files the smallest and largest values rule out a hit.
    path, columns = scratch_path(spark, "clustered"), ["extension", "modifiedDateTime", "createdBy"]
    write_clustered(rel.files(spark, d).select("id", *columns), path, columns, files=32)
    table = spark.read.parquet(path)
    wanted = C.metadata_filter(".txt", "2024-01-02T00:00:00", author="owner1")
    may_hold = F.expr("""low_extension <= '.txt' AND high_extension >= '.txt' AND low_createdBy <= 'owner1' AND high_createdBy >= 'owner1'
        AND high_modifiedDateTime >= timestamp_ntz'2024-01-02 00:00:00'""")
    skipped = value_ranges(table, columns).agg((F.count_if(may_hold) * 2 < F.count("*")).alias("most")).first()["most"]
    return table.filter(wanted).select("id", "extension").withColumn("most_files_skipped", F.lit(skipped))


@register("filtered_search", with_parts("""
    WITH f AS (SELECT * FROM titled WHERE extension = '.txt' AND modifiedDateTime >= TIMESTAMP '2024-01-02 00:00:00'
          AND createdBy IN ('owner1', 'owner2', 'owner3')),
      k AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS r FROM scores SEMI JOIN f USING (id)),
      v AS (SELECT f.id, c.score, row_number() OVER (ORDER BY c.score DESC, f.id) AS r FROM cosines c JOIN f ON f.doc_id = c.id QUALIFY r <= 50),
      h AS (SELECT coalesce(k.id, v.id) AS id, coalesce(1.0 / (60 + k.r), 0.0) + coalesce(1.0 / (60 + v.r), 0.0) AS score
            FROM k FULL JOIN v ON k.id = v.id)
    SELECT kind, id, title, round(score, 6) AS score FROM (
      SELECT 'hybrid' AS kind, * FROM (SELECT id, score FROM h ORDER BY score DESC, id LIMIT 7)
      UNION ALL SELECT 'keyword', * FROM (SELECT id, score FROM scores SEMI JOIN f USING (id) ORDER BY score DESC, id LIMIT 7)
      UNION ALL SELECT 'vector', * FROM (SELECT id, score FROM v ORDER BY score DESC, id LIMIT 7)) JOIN f USING (id)"""
    .replace("WITH f", ", f", 1), "titled", "scores", "cosines"))
def _(spark, d):
    table = SearchTable(rel.search_table(spark, d), fields=["content"])
    parts = [table.filtered(QUERY, extension=".txt", date_from="2024-01-02T00:00:00", author="owner1,owner2,owner3", top=7,
                            search_type=kind, vector=rel.one_vector(spark, d))
             .select(F.lit(label).alias("kind"), "id", "title", F.round("score", 6).alias("score"))
             for kind, label in (("something else", "hybrid"), ("keyword", "keyword"), ("vector", "vector"))]
    return results.union_hits(*parts)


@register("filtered_search_maintained", with_parts("""
    , f AS (SELECT * FROM titled WHERE extension = '.txt' AND modifiedDateTime >= TIMESTAMP '2024-01-02 00:00:00' AND createdBy IN ('owner1', 'owner2', 'owner3'))
    SELECT 'hit' AS kind, id AS name, score AS value FROM (SELECT id, score FROM scores SEMI JOIN f USING (id) ORDER BY score DESC, id LIMIT 7)
    UNION ALL SELECT 'facet', createdBy, CAST(count(*) AS DOUBLE) FROM f SEMI JOIN scores USING (id) GROUP BY createdBy""", "titled", "scores"))
def _(spark, d):
    # Statistics and scores come from the index that follows the table; of the table only the filter's columns are read.
    table = store.TableStore(spark, scratch_path(spark, "filtered"), STANDARD_DOCUMENT)
    table.upsert(rel.files(spark, d, spread=True), unique=True)
    asked = SearchTable.of_store(table, term_index.TermIndex(spark, scratch_path(spark, "terms")))
    where = C.metadata_filter(".txt", "2024-01-02T00:00:00", None, "owner1,owner2,owner3")
    hits = asked.keyword(QUERY, 7, where, select=["id"]).select(F.lit("hit").alias("kind"), F.col("id").alias("name"), F.col("score").alias("value"))
    counts = asked.facets(QUERY, ["createdBy"], where)
    return hits.unionByName(counts.select(F.lit("facet").alias("kind"), F.col("value").alias("name"), F.col("count").cast("double").alias("value")))


@register("search_fallback", with_parts("SELECT id, score FROM hits ORDER BY score DESC, id LIMIT 5", "hits"))
def _(spark, d):
    # A table without vectors answers semantic search by keywords.
    table = rel.files(spark, d, spread=True).withColumn("title", X.title_or_stem("document_title", "filePath"))
    return SearchTable(table, fields=["content"]).semantic(QUERY).select("id", "score")


@register("adaptive_search", with_parts("""
    SELECT 'vector' AS used, id, round(score * CASE WHEN modifiedDateTime > TIMESTAMP '2024-01-11 00:00:00' THEN 1.2 ELSE 1 END, 6) AS score
      FROM (SELECT n.id, n.score, modifiedDateTime FROM near n JOIN files USING (id) WHERE r <= 5)
    UNION ALL
    SELECT 'keyword', id, round(score * CASE WHEN modifiedDateTime > TIMESTAMP '2024-01-11 00:00:00' THEN 1.2 ELSE 1 END, 6)
      FROM (SELECT id, score FROM scores ORDER BY score DESC, id LIMIT 5) JOIN files USING (id)""", "near", "scores", "files"))
def _(spark, d):
    # The stored vector of a document scores 1 with itself; turned round it is far from everything.
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    table = SearchTable(rel.search_table(spark, d), fields=["content"])
    near = table.adaptive(QUERY, as_of, 5, rel.one_vector(spark, d))
    orthogonal = rel.one_vector(spark, d).select(F.transform("embedding", lambda x: x * 0 + 0.125).alias("v"))
    far = table.adaptive(QUERY, as_of, 5, orthogonal)
    return near.select(F.lit("vector").alias("used"), "id", "score").unionByName(
        far.select(F.lit("keyword").alias("used"), "id", "score"))


@register("query_embedding", """
    SELECT item_id AS query_id, 64 AS dimensions, 1.0::DOUBLE AS length, 1.0::DOUBLE AS same_as_document FROM benchmark""")
def _(spark, d):
    # The vector of a query text must equal that of a document with the same text.
    texts = rel.query_texts(spark, d).select("query_id", X.text_hash("text").alias("text_hash"), "text")
    embedder = E.HashingEmbedder(64)
    as_query = embedder(texts.select("text_hash", "text").distinct())
    as_document = E.new_embeddings(texts.withColumnRenamed("text", "chunk"), embedder).withColumnRenamed("embedding", "other")
    return texts.join(as_query, "text_hash").join(as_document, "text_hash").select(
        "query_id", F.size("embedding").alias("dimensions"), F.round(F.sqrt(F.aggregate(
            "embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))), 5).alias("length"),
        F.round(cosine(F.col("embedding"), F.col("other")), 5).alias("same_as_document"))


_BATCH_HYBRID = """,
    qc AS (SELECT q.vec_id AS query_id, f.id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 6) AS s
      FROM embeddings q JOIN benchmark ON item_id = q.vec_id, embeddings v JOIN files f ON f.doc_id = v.vec_id),
    qv AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS r FROM qc QUALIFY r <= 50),
    qk AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS r FROM
      (SELECT query_id, id, round(sum(weight), 6) AS s FROM weights JOIN query_terms USING (term) GROUP BY query_id, id)),
    qh AS (SELECT coalesce(k.query_id, v.query_id) AS query_id, coalesce(k.id, v.id) AS id,
      coalesce(1.0 / (60 + k.r), 0.0) + coalesce(1.0 / (60 + v.r), 0.0) AS score
      FROM qk k FULL JOIN qv v ON k.query_id = v.query_id AND k.id = v.id),
    qt AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM qh QUALIFY rank <= 5)
    """


@register("batch_hybrid_search", with_parts(_BATCH_HYBRID + "SELECT query_id, id, round(score, 6) AS score, rank FROM qt",
                                            "weights", "query_terms", "files"))
def _(spark, d):
    hits = hybrid.batch_hybrid_search(rel.search_table(spark, d), rel.hybrid_queries(spark, d), 5)
    return hits.withColumn("score", F.round("score", 6))


@register("multi_query_search", with_parts(_BATCH_HYBRID + """
    SELECT filePath, query_id, id, round(score, 6) AS score, rank FROM qt JOIN files USING (id) WHERE rank <= 3
    QUALIFY row_number() OVER (PARTITION BY filePath ORDER BY score DESC, query_id, rank) = 1""", "weights", "query_terms", "files"))
def _(spark, d):
    hits = hybrid.batch_hybrid_search(rel.search_table(spark, d), rel.hybrid_queries(spark, d), 3)
    best = results.best_per_file(results.fetch_fields(hits, rel.files(spark, d), ["filePath"]))
    return best.withColumn("score", F.round("score", 6))


# ---------------------------------------------------------------- hits


def _owner_hits(spark, d) -> DataFrame:
    """Batch hits, with the owner standing for the file so that several hits share one."""
    hits = keyword.batch_keyword_search(rel.files(spark, d, spread=True), rel.query_texts(spark, d), 5)
    return results.fetch_fields(hits, rel.files(spark, d), ["createdBy"])


@register("dedupe_best", with_parts("""
    SELECT createdBy, query_id, id, score, rank FROM batch_hits JOIN files USING (id)
    QUALIFY row_number() OVER (PARTITION BY createdBy ORDER BY score DESC, query_id, rank) = 1""", "batch_hits", "files"))
def _(spark, d):
    return results.best_per_file(_owner_hits(spark, d), "createdBy")


@register("dedupe_first", with_parts("""
    SELECT createdBy, query_id, id, score, rank FROM batch_hits JOIN files USING (id)
    QUALIFY row_number() OVER (PARTITION BY createdBy ORDER BY query_id, rank) = 1""", "batch_hits", "files"))
def _(spark, d):
    return results.first_per_file(_owner_hits(spark, d), "createdBy")


@register("multi_query_union", with_parts("""
    SELECT id, score FROM hits UNION ALL SELECT id, score FROM hits
    UNION ALL (SELECT id, score FROM scores JOIN files USING (id) WHERE extension = '.pdf' ORDER BY score DESC, id LIMIT 3)""",
    "hits", "scores", "files"))
def _(spark, d):
    table = rel.files(spark, d, spread=True)
    one = keyword.keyword_search(table, QUERY, 10)
    return results.union_hits(one, one, keyword.keyword_search(table, QUERY, 3, where=C.equals("extension", ".pdf")))


def _hits(spark, d, *fields: str, k: int = 10) -> DataFrame:
    table = rel.files(spark, d, spread=True)
    return results.fetch_fields(keyword.keyword_search(table, QUERY, k), rel.files(spark, d), fields, few=True)


@register("select_fields", with_parts("SELECT id, name, filePath, extension, score FROM hits JOIN files USING (id)", "hits", "files"))
def _(spark, d):
    return _hits(spark, d, "name", "filePath", "extension")


@register("format_hits", with_parts(r"""
    SELECT CAST(row_number() OVER (ORDER BY score DESC, id) AS INTEGER) AS ordinal,
      concat(CAST(ordinal AS VARCHAR), '. ', name, chr(10), '   Path: ', filePath, chr(10), '   Extension: ', extension, chr(10),
        '   Modified: ', strftime(modifiedDateTime, '%Y-%m-%dT%H:%M:%S'), chr(10), '   Score: ', printf('%.4f', score), chr(10),
        '   Preview: ', replace(left(content, 200), chr(10), ' '), '...') AS block
    FROM hits JOIN files USING (id)""", "hits", "files"))
def _(spark, d):
    return results.format_hits(_hits(spark, d, "name", "filePath", "extension", "modifiedDateTime", "content"))


@register("rag_context", with_parts("""
    SELECT string_agg(concat('From ', name, ':', chr(10), left(content, 500)), concat(chr(10), chr(10)) ORDER BY score DESC, id) AS context
    FROM (SELECT * FROM hits ORDER BY score DESC, id LIMIT 3) JOIN files USING (id)""", "hits", "files"))
def _(spark, d):
    return results.answer_context(_hits(spark, d, "name", "content"), "content")


@register("post_filter_hits", with_parts("""
    SELECT id, extension, score FROM hits JOIN files USING (id) WHERE score > 0.7 AND extension = '.txt'""", "hits", "files"))
def _(spark, d):
    return results.above_score(_hits(spark, d, "extension"), 0.7, ".txt")


@register("hits_by_date", with_parts("""
    SELECT id, modifiedDateTime, score FROM hits JOIN files USING (id) ORDER BY modifiedDateTime DESC, id LIMIT 5""", "hits", "files"))
def _(spark, d):
    return results.newest(_hits(spark, d, "modifiedDateTime"))


@register("recency_boost", with_parts("""
    SELECT id, modifiedDateTime, round(CASE WHEN modifiedDateTime > TIMESTAMP '2024-01-11 00:00:00' THEN score * 1.2 ELSE score END, 6) AS score
    FROM hits JOIN files USING (id)""", "hits", "files"))
def _(spark, d):
    return results.boost_recent(_hits(spark, d, "modifiedDateTime"), F.lit(AS_OF).cast("timestamp_ntz"))


@register("sort_by_field", with_parts("SELECT id, size FROM files ORDER BY size DESC, id", "files"))
def _(spark, d):
    return results.sort_by(rel.files(spark, d), "size", descending=True).select("id", "size")


# ---------------------------------------------------------------- embedding


def _chunks(spark, d) -> DataFrame:
    base = rel.files(spark, d, spread=True).select("doc_id", "filePath", "content")
    return explode_chunks(base, "content", CHUNK_SIZE, CHUNK_OVERLAP).withColumn("id", X.chunk_id("filePath", "chunkNumber"))


@register("embed_chunks", with_parts(f"""
    SELECT md5(concat(filePath, '_chunk_', CAST(chunkNumber AS VARCHAR))) AS id,
      CASE WHEN len({words_sql('chunk')}) > 0 THEN 64 END AS dimensions,
      CASE WHEN len({words_sql('chunk')}) > 0 THEN 1.0::DOUBLE END AS length FROM chunks""", "chunks"))
def _(spark, d):
    # Written once, then read by column: texts to embed, keys to look up.
    chunks = staged(_chunks(spark, d).select("id", "chunk"), "chunks")
    embedded = E.attach_vectors(chunks, E.new_embeddings(chunks, E.HashingEmbedder(64)), min_rows=50)
    length = F.sqrt(F.aggregate("contentVector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return embedded.select("id", F.when(F.col("contentVector").isNotNull(), F.size("contentVector")).alias("dimensions"),
                           F.round(length, 5).alias("length"))


@register("cache_hits", with_parts("""
    SELECT text_hash FROM (SELECT DISTINCT md5(text) AS text_hash FROM documents) SEMI JOIN embedding_cache USING (text_hash)""", "embedding_cache"))
def _(spark, d):
    texts = E.distinct_texts(rel.table(spark, d, "documents"), "text")
    return E.cache_hits(texts, rel.embedding_cache(spark, d)).select("text_hash")


@register("cache_misses", with_parts("""
    SELECT text_hash FROM (SELECT DISTINCT md5(text) AS text_hash FROM documents) ANTI JOIN embedding_cache USING (text_hash)""", "embedding_cache"))
def _(spark, d):
    texts = E.distinct_texts(rel.table(spark, d, "documents"), "text")
    return E.cache_misses(texts, rel.embedding_cache(spark, d)).select("text_hash")


@register("cache_savings", with_parts("""
    SELECT count(*) AS chunks, count(DISTINCT md5(chunk)) AS distinct_texts, count(*) - count(DISTINCT md5(chunk)) AS calls_saved FROM chunks""", "chunks"))
def _(spark, d):
    return stats.cache_savings(_chunks(spark, d), X.text_hash("chunk"))


# ---------------------------------------------------------------- facets and statistics


@register("facet_extension", with_parts("""
    SELECT extension AS value, count(*) AS count FROM scores JOIN files USING (id) GROUP BY extension""", "scores", "files"))
def _(spark, d):
    # Counted over all matching rows, whatever top asks for.
    table = rel.files(spark, d, spread=True)
    return stats.facet(table.filter(C.is_match(table, QUERY)), "extension")


@register("facet_multi", with_parts("""
    SELECT 'extension' AS facet, extension AS value, count(*) AS count FROM scores JOIN files USING (id) GROUP BY extension
    UNION ALL SELECT 'createdBy', createdBy, count(*) FROM scores JOIN files USING (id) GROUP BY createdBy""", "scores", "files"))
def _(spark, d):
    table = rel.files(spark, d, spread=True)
    return stats.facets(table.filter(C.is_match(table, QUERY)), ["extension", "createdBy"])


_COUNTERS = """count(*) AS total_files, count(*) FILTER (status = 'successful') AS successful,
      count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped,
      count(*) FILTER (status = 'oversize') AS oversize,
      round(coalesce(sum(size) FILTER (status = 'successful'), 0) / 1048576.0, 2) AS total_size_mb"""


@register("indexing_summary", with_parts(f"""
    SELECT *, 12.5::DOUBLE AS duration_seconds, round(successful / 12.5, 2) AS files_per_second FROM (SELECT {_COUNTERS} FROM outcomes)""", "outcomes"))
def _(spark, d):
    return stats.run_summary(rel.outcomes(spark, d), 12.5)


@register("vector_indexing_summary", with_parts(f"""
    SELECT source, {_COUNTERS}, CAST(coalesce(sum(chunks), 0) AS BIGINT) AS total_chunks,
      CAST(coalesce(sum(chunks), 0) AS BIGINT) AS total_embeddings,
      CAST(coalesce(sum(CASE WHEN doc_id % 5 <> 0 THEN chunks END), 0) AS BIGINT) AS embedding_calls FROM outcomes GROUP BY source""", "outcomes"))
def _(spark, d):
    rows = rel.outcomes(spark, d).withColumn("embeddings", F.col("chunks")) \
        .withColumn("new_embeddings", F.when(F.col("doc_id") % 5 != 0, F.col("chunks")))
    return stats.vector_run_summary(rows, group=["source"])


@register("extraction_by_type", with_parts("""
    SELECT extension, count(*) FILTER (status <> 'failed') AS extracted, count(*) FILTER (status = 'failed') AS failed
    FROM outcomes GROUP BY extension""", "outcomes"))
def _(spark, d):
    rows = rel.outcomes(spark, d).withColumn("error", F.when(F.col("status") == "failed", "failed"))
    return stats.extraction_by_type(rows)


@register("failure_alert", with_parts("""
    SELECT source AS directory, count(*) FILTER (status = 'failed') AS failed FROM outcomes GROUP BY source HAVING failed > 2""", "outcomes"))
def _(spark, d):
    return stats.failure_alert(rel.outcomes(spark, d), X.top_directory("filePath", 2), 2)


@register("weekly_report", """
    SELECT date_trunc('week', ts)::TIMESTAMP AS week, count(*) FILTER (event_type <> 'error') AS files_indexed,
      count(*) FILTER (event_type = 'error') AS files_failed, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS chunks_created,
      round(sum(round(value, 2)), 2) AS total_size_mb FROM events GROUP BY week""")
def _(spark, d):
    runs = rel.table(spark, d, "events").select(
        "ts", F.when(F.col("event_type") == "error", "failed").otherwise("successful").alias("status"),
        F.get_json_object("props", "$.k").cast("bigint").alias("chunks"), F.round("value", 2).alias("size_mb"))
    return stats.weekly_report(runs).withColumn("week", F.col("week").cast("timestamp_ntz"))


@register("run_report", with_parts("""
    SELECT source AS run, concat('{"validated":', count(*) FILTER (status <> 'oversize'), ',"indexed":', count(*) FILTER (status = 'successful'),
      ',"failed":', count(*) FILTER (status = 'failed'), '}') AS report FROM outcomes GROUP BY source""", "outcomes"))
def _(spark, d):
    return stats.run_report(rel.outcomes(spark, d).withColumnRenamed("source", "run"))


@register("verify_coverage", with_parts("""
    SELECT filePath, 'missing in table' AS problem FROM files WHERE doc_id % 2 = 1
    UNION ALL SELECT concat('/gone', filePath), 'missing in source' FROM files WHERE doc_id % 10 = 0""", "files"))
def _(spark, d):
    source = rel.files(spark, d)
    indexed = source.filter("doc_id % 2 = 0").select("filePath").unionByName(
        source.filter("doc_id % 10 = 0").select(F.concat(F.lit("/gone"), F.col("filePath")).alias("filePath")))
    return stats.verify_coverage(source, indexed)


@register("verify_versions", with_parts("""
    SELECT filePath, CASE WHEN doc_id % 7 = 0 THEN 'missing in table' ELSE 'other version' END AS problem FROM files
      WHERE lang = 'fr' AND (doc_id % 7 = 0 OR doc_id % 11 = 0)
    UNION ALL SELECT concat('/gone', filePath), 'missing in source' FROM files WHERE lang = 'en' AND doc_id % 10 = 0""", "files"))
def _(spark, d):
    source = rel.files(spark, d).select("filePath", "modifiedDateTime", "lang", "doc_id")
    french = F.col("lang") == "fr"
    held = source.filter(~(french & (F.col("doc_id") % 7 == 0))).withColumn("modifiedDateTime", F.when(
        french & (F.col("doc_id") % 11 == 0), F.col("modifiedDateTime") - F.expr("INTERVAL 1 HOUR")).otherwise(F.col("modifiedDateTime")))
    gone = source.filter("lang = 'en' AND doc_id % 10 = 0").withColumn("filePath", F.concat(F.lit("/gone"), F.col("filePath")))
    return stats.verify_versions(source, held.unionByName(gone), version="modifiedDateTime")
