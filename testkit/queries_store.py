"""Tables, upserts, exports, streams and whole indexing runs."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.functions import text as X
from foliospark.functions.chunking import explode_chunks
from foliospark.operators import build as B
from foliospark.operators import embedding as E
from foliospark.operators import keyword, results
from foliospark.plans.indexing import IndexSettings, index_standard, index_vector, recover_table
from foliospark.schemas import CHUNK_DOCUMENT, EMBEDDING_CACHE, INDEX_STATE, STANDARD_DOCUMENT, STORED_DOCUMENT
from foliospark.session import scratch_path
from foliospark.sinks import catalog, export, store
from foliospark.sinks.cache import EmbeddingCache
from foliospark.sinks.folders import write_text_files
from foliospark.sources import files
from foliospark.streaming import ingest
from testkit import relations as rel
from testkit.queries_rows import _tree
from testkit.registry import CHUNK_OVERLAP, CHUNK_SIZE, QUERY, STRIP, register, with_parts

# ---------------------------------------------------------------- upserts


def _documents(spark, d) -> DataFrame:
    return B.build_documents(rel.metadata(spark, d)).join(
        rel.files(spark, d).select("id", "doc_id"), "id")


@register("upsert_documents", with_parts("""
    SELECT id, name, CASE WHEN doc_id % 4 = 2 THEN 'old text' ELSE md5(left(content, 50000)) END AS content FROM files""", "files"))
def _(spark, d):
    table = store.TableStore(spark, scratch_path(spark, "documents"), STANDARD_DOCUMENT)
    rows = _documents(spark, d)
    table.upsert(rows.filter("doc_id % 2 = 0").withColumn("content", F.lit("old text")))
    table.upsert(rows.filter("doc_id % 4 <> 2").withColumn("content", X.text_hash("content")))
    return table.read().select("id", "name", "content")


_CHUNK_PART = T.StructType([f for f in CHUNK_DOCUMENT.fields if f.name in ("id", "filePath", "chunk", "chunkNumber", "totalChunks")])
_WIDE = 200


def _two_chunkings(spark, d, key: str) -> DataFrame:
    """All files, then every third one again in wider windows, which gives fewer chunks."""
    base = rel.files(spark, d, spread=True)

    def rows(source: DataFrame, size: int) -> DataFrame:
        chunks = explode_chunks(source.select("filePath", "content"), "content", size, CHUNK_OVERLAP)
        return chunks.withColumn("id", X.chunk_id("filePath", "chunkNumber")).withColumn("chunk", X.text_hash("chunk"))

    table = store.TableStore(spark, scratch_path(spark, "chunks"), _CHUNK_PART, rows_per_file=100_000)
    table.upsert(rows(base, CHUNK_SIZE))
    table.upsert(rows(base.filter("doc_id % 3 = 0"), _WIDE), key=key)
    return table.read().select("filePath", "chunkNumber", "totalChunks", "chunk")


_WIDE_CHUNKS = f"""
    wide AS (SELECT doc_id, filePath, CAST(t.s // {_WIDE - CHUNK_OVERLAP} AS INTEGER) AS chunkNumber,
      CAST(CASE WHEN len(w) <= {_WIDE} THEN 1 ELSE ceil(len(w) / {_WIDE - CHUNK_OVERLAP}.0) END AS INTEGER) AS totalChunks,
      md5(CASE WHEN len(w) <= {_WIDE} THEN content ELSE array_to_string(w[t.s + 1 : t.s + {_WIDE}], ' ') END) AS chunk
    FROM ws, unnest(CASE WHEN len(w) <= {_WIDE} THEN [0] ELSE range(0, len(w), {_WIDE - CHUNK_OVERLAP}) END) AS t(s)
    WHERE doc_id % 3 = 0)"""


@register("upsert_chunks", with_parts(f""", {_WIDE_CHUNKS}
    SELECT filePath, chunkNumber, totalChunks, chunk FROM wide
    UNION ALL SELECT c.filePath, c.chunkNumber, c.totalChunks, md5(c.chunk) FROM chunks c
      ANTI JOIN wide w ON w.filePath = c.filePath AND w.chunkNumber = c.chunkNumber""", "chunks"))
def _(spark, d):
    return _two_chunkings(spark, d, "id")


@register("replace_file_chunks", with_parts(f""", {_WIDE_CHUNKS}
    SELECT filePath, chunkNumber, totalChunks, chunk FROM wide
    UNION ALL SELECT filePath, chunkNumber, totalChunks, md5(chunk) FROM chunks WHERE doc_id % 3 <> 0""", "chunks"))
def _(spark, d):
    return _two_chunkings(spark, d, "filePath")


_SHORT = 300


@register("erase_owner", with_parts("""
    SELECT 'table' AS kept_in, id AS key FROM files WHERE createdBy <> 'owner3'
    UNION ALL SELECT 'stored files', id FROM files WHERE createdBy <> 'owner3'
    UNION ALL SELECT DISTINCT 'cache', md5(text) FROM files WHERE createdBy <> 'owner3'
    UNION ALL SELECT DISTINCT 'cache files', md5(text) FROM files WHERE createdBy <> 'owner3'
    UNION ALL SELECT 'audit', concat('erase owner3 ', count(*)) FROM files WHERE createdBy = 'owner3'""", "files"))
def _(spark, d):
    # Stored texts are cut, so only the hash of the whole text finds their vectors.
    base = scratch_path(spark, "erased")
    table = store.TableStore(spark, f"{base}/documents", STORED_DOCUMENT)
    cache = store.TableStore(spark, f"{base}/cache", EMBEDDING_CACHE, key="text_hash")
    table.upsert(B.build_documents(rel.metadata(spark, d), content_limit=_SHORT))
    cache.append(E.distinct_texts(rel.table(spark, d, "documents"), "text"))
    store.erase_owner(table, cache, "owner3", F.col("contentHash"), audit=f"{base}/audit")
    audit = spark.read.parquet(f"{base}/audit")

    def found(rows: DataFrame, place: str, key: Column) -> DataFrame:
        return rows.select(F.lit(place).alias("kept_in"), key.alias("key"))

    def stored(name: str) -> DataFrame:
        return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").parquet(f"{base}/{name}/commit-*/rows")
    return found(table.read(), "table", F.col("id")).unionByName(found(stored("documents"), "stored files", F.col("id"))) \
        .unionByName(found(cache.read(), "cache", F.col("text_hash"))).unionByName(found(stored("cache"), "cache files", F.col("text_hash"))) \
        .unionByName(found(audit, "audit", F.concat_ws(" ", "action", "user", F.col("details")["rows"])))


@register("upsert_duplicates", with_parts("""
    SELECT filePath AS id, CAST(max(doc_id) + 1000 AS BIGINT) AS size FROM files GROUP BY filePath""", "files"))
def _(spark, d):
    # Every file comes three times in one batch, in versions an hour apart.
    table = store.TableStore(spark, scratch_path(spark, "twice"), STANDARD_DOCUMENT)
    one = rel.files(spark, d).select("filePath", "doc_id", "modifiedDateTime")
    three = one.select(F.col("filePath").alias("id"), "filePath", "doc_id", "modifiedDateTime", F.explode(F.array(*map(F.lit, (0, 1000, 500)))).alias("n"))
    later = F.col("modifiedDateTime") + F.make_dt_interval(F.lit(0), F.col("n"))
    table.upsert(three.select("id", "filePath", (F.col("doc_id") + F.col("n")).alias("size"), later.alias("modifiedDateTime")))
    return table.read().select("id", "size")


@register("state_update", with_parts("""
    SELECT filePath, CASE WHEN f.doc_id % 3 = 0 THEN f.modifiedDateTime ELSE s.mtime END AS mtime
    FROM files f LEFT JOIN index_state s USING (filePath) WHERE f.doc_id % 3 = 0 OR s.mtime IS NOT NULL""", "files", "index_state"))
def _(spark, d):
    state = store.TableStore(spark, scratch_path(spark, "state"), INDEX_STATE)
    state.upsert(rel.index_state(spark, d))
    state.upsert(rel.files(spark, d).filter("doc_id % 3 = 0").select("filePath", F.col("modifiedDateTime").alias("mtime")))
    state.compact()
    return state.read().withColumn("mtime", F.col("mtime").cast("timestamp_ntz"))


@register("read_state", with_parts("SELECT filePath, mtime FROM index_state", "index_state"))
def _(spark, d):
    state = store.TableStore(spark, scratch_path(spark, "state"), INDEX_STATE)
    state.upsert(rel.index_state(spark, d))
    return state.read().withColumn("mtime", F.col("mtime").cast("timestamp_ntz"))


def _cache_with(spark, d, rows: DataFrame) -> store.TableStore:
    cache = store.TableStore(spark, scratch_path(spark, "cache"), EMBEDDING_CACHE, key="text_hash")
    vectors = rel.table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    known = rows.join(vectors, "doc_id").select(X.text_hash("text").alias("text_hash"), "embedding", "doc_id")
    cache.append(store.latest_version(known, "text_hash", "doc_id"))
    return cache


_CACHE_ROWS = """
    SELECT md5(text) AS text_hash, round(max_by(embedding[1], doc_id), 6)::DOUBLE AS first, 64 AS dimensions
    FROM documents JOIN embeddings ON vec_id = doc_id {where} GROUP BY md5(text)"""


@register("read_cache", _CACHE_ROWS.format(where=""))
def _(spark, d):
    cache = _cache_with(spark, d, rel.table(spark, d, "documents"))
    return cache.read().select("text_hash", F.round(F.col("embedding")[0], 6).cast("double").alias("first"),
                               F.size("embedding").alias("dimensions"))


@register("cache_update", "SELECT DISTINCT md5(text) AS text_hash FROM documents")
def _(spark, d):
    docs = rel.table(spark, d, "documents")
    cache = _cache_with(spark, d, docs)
    cache.append(E.new_embeddings(docs, E.HashingEmbedder(64), cache.read(), text="text"))
    # Texts without any word have no vector and are not cached; they are added for the comparison.
    wordless = docs.filter(F.size(X.word_tokens("text")) == 0).select(X.text_hash("text").alias("text_hash"))
    return cache.read().select("text_hash").unionByName(wordless.join(cache.read().select("text_hash"), "text_hash", "left_anti").distinct())


# ---------------------------------------------------------------- exports, audit, routes


@register("audit_append", """
    SELECT event_type AS action, concat('user', CAST(user_id AS VARCHAR)) AS user, CAST(event_id AS VARCHAR) AS resource,
      CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status, ts AS timestamp, json_extract_string(props, '$.k') AS k
    FROM events""")
def _(spark, d):
    path, events = scratch_path(spark, "audit"), rel.table(spark, d, "events")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        export.audit_append(export.audit_rows(
            events.filter(part), F.col("event_type"), F.concat(F.lit("user"), F.col("user_id").cast("string")),
            F.col("event_id").cast("string"), F.when(F.col("event_type") == "error", "failure").otherwise("success"),
            F.col("ts"), F.from_json("props", "map<string,string>")), path)
    read = export.read_audit(spark, path)
    return read.select("action", "user", "resource", "status", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                       F.col("details")["k"].alias("k"))


def _hits(spark, d) -> DataFrame:
    """Every match of the query with its fields."""
    scores = keyword.keyword_scores(rel.files(spark, d, spread=True), QUERY)
    return rel.files(spark, d).join(scores, "id").select("name", "filePath", "extension", "score")


_ALL_HITS = with_parts("SELECT name, filePath, extension, score FROM scores JOIN files USING (id)", "scores", "files")


@register("export_json", _ALL_HITS)
def _(spark, d):
    path = scratch_path(spark, "json")
    export.export_json(_hits(spark, d), path)
    return spark.read.schema("name string, filePath string, extension string, score double").json(path)


@register("export_csv", _ALL_HITS)
def _(spark, d):
    path = scratch_path(spark, "csv")
    export.export_csv(_hits(spark, d), path)
    return spark.read.schema("name string, filePath string, extension string, score double").option("header", True).csv(path)


@register("route_tables", with_parts("""
    SELECT route, extension, count(*) AS files FROM (
      SELECT 'hr-documents' AS route, extension FROM files WHERE extension IN ('.pdf', '.docx')
      UNION ALL SELECT 'financial-reports', extension FROM files WHERE extension = '.xlsx'
      UNION ALL SELECT 'technical-docs', extension FROM files WHERE extension IN ('.pdf', '.md')) GROUP BY route, extension""", "files"))
def _(spark, d):
    path = scratch_path(spark, "routes")
    export.write_routed(rel.files(spark, d).select("id", "extension"), path)
    return spark.read.parquet(path).groupBy("route", "extension").agg(F.count(F.lit(1)).alias("files"))


@register("export_schema", with_parts("""
    SELECT unnest(['id', 'content', 'title', 'name', 'filePath', 'extension', 'size', 'createdDateTime', 'modifiedDateTime', 'createdBy',
        'lastModifiedBy', 'fileType', 'url', 'author', 'keywords', 'contentHash']) AS field,
      unnest([count(id), count(content), count(title), count(name), count(filePath), count(extension), count(size), 0, count(modifiedDateTime),
        count(createdBy), count(createdBy), count(*), count(filePath), count(lang), 0, count(content)]) AS filled FROM titled""", "titled"))
def _(spark, d):
    # The exported schema must be enough to read the table's files again, column by column.
    path, table = scratch_path(spark, "schema"), B.build_documents(rel.metadata(spark, d))
    export.export_schema(table, f"{path}/schema")
    table.write.parquet(f"{path}/rows")
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()[0]))
    again = spark.read.schema(schema).parquet(f"{path}/rows")
    counts = again.agg(F.array(*[F.struct(F.lit(f.name).alias("field"), F.count(f.name).alias("filled")) for f in schema.fields]).alias("c"))
    return counts.select(F.inline("c"))


# ---------------------------------------------------------------- named tables


def _catalog(spark) -> tuple[catalog.SearchTableCatalog, str]:
    location = scratch_path(spark, "tables")
    database = "d" + location.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    return catalog.SearchTableCatalog(spark, database, location), database


_STATS = with_parts("""
    SELECT count(*) AS documentCount, CAST(sum(length(id) + octet_length(encode(left(content, 50000))) + octet_length(encode(title))
      + octet_length(encode(name)) + 2 * octet_length(encode(filePath)) + length(extension) + 8 + 8 + 2 * length(createdBy) + 4
      + length(concat('author ', lang)) + length(md5(content))) AS BIGINT) AS storageSize FROM titled""", "titled")


@register("create_standard_table", _STATS)
def _(spark, d):
    tables, _ = _catalog(spark)
    tables.create_standard("standard")
    tables.create_standard("standard")
    tables.insert("standard", B.build_documents(rel.metadata(spark, d)))
    return tables.statistics("standard")


@register("create_vector_table", with_parts("""
    SELECT count(*) AS rows, 64 AS dimensions, CAST(sum(totalChunks) AS BIGINT) AS total FROM files JOIN
      (SELECT vec_id AS doc_id, 1 AS totalChunks FROM embeddings) USING (doc_id)""", "files"))
def _(spark, d):
    tables, _ = _catalog(spark)
    tables.create_vector("vectors", 64)
    rows = rel.search_table(spark, d).filter("contentVector IS NOT NULL") \
        .withColumn("chunk", F.col("content")).withColumn("chunkNumber", F.lit(0)).withColumn("totalChunks", F.lit(1))
    tables.insert("vectors", rows)
    return tables.table("vectors").agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("contentVector")).alias("dimensions"),
                                       F.sum("totalChunks").alias("total"))


@register("table_stats", _STATS)
def _(spark, d):
    return catalog.table_stats(B.build_documents(rel.metadata(spark, d)))


def _two_tables(spark, d) -> catalog.SearchTableCatalog:
    tables, _ = _catalog(spark)
    rows = _documents(spark, d)
    for name, part in (("even", "doc_id % 2 = 0"), ("odd", "doc_id % 2 = 1")):
        tables.create_standard(name)
        tables.insert(name, rows.filter(part))
    return tables


@register("all_table_stats", with_parts("""
    SELECT CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS "table", count(*) AS documents,
      round(sum(length(id) + octet_length(encode(left(content, 50000))) + octet_length(encode(title))
      + octet_length(encode(name)) + 2 * octet_length(encode(filePath)) + length(extension) + 8 + 8 + 2 * length(createdBy) + 4
      + length(concat('author ', lang)) + length(md5(content))) / 1048576.0, 2) AS storage_mb FROM titled GROUP BY 1""", "titled"))
def _(spark, d):
    return _two_tables(spark, d).all_statistics()


@register("list_tables", with_parts("""
    SELECT CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS "table", count(*) AS documents FROM files GROUP BY 1""", "files"))
def _(spark, d):
    tables = _two_tables(spark, d)
    listed = [tables.table(n).agg(F.count("id").alias("documents")).select(F.lit(n).alias("table"), "documents") for n in tables.names()]
    return results.union_hits(*listed)


@register("drop_table", with_parts("""
    SELECT 'odd' AS "table", count(*) AS documents, true AS dropped, false AS dropped_again FROM files WHERE doc_id % 2 = 1""", "files"))
def _(spark, d):
    tables = _two_tables(spark, d)
    dropped, again = tables.delete("even"), tables.delete("even")
    listed = [tables.table(n).agg(F.count("id").alias("documents")).select(F.lit(n).alias("table"), "documents") for n in tables.names()]
    return results.union_hits(*listed).withColumn("dropped", F.lit(dropped)).withColumn("dropped_again", F.lit(again))


# ---------------------------------------------------------------- streams


def _arrivals(spark, d, columns: list[str], parts: int = 3) -> tuple[DataFrame, str]:
    """Rows of the files relation, written by Spark as several files that a stream reads one by one."""
    path = scratch_path(spark, "arrivals")
    rows = rel.files(spark, d).select("doc_id", *columns)
    rows.repartition(parts, "doc_id").write.parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return stream, path


@register("stream_upsert", with_parts("SELECT id, name, size FROM files", "files"))
def _(spark, d):
    schema = T.StructType([f for f in STANDARD_DOCUMENT.fields if f.name in ("id", "name", "filePath", "size")])
    table = store.TableStore(spark, scratch_path(spark, "table"), schema)
    stream, _ = _arrivals(spark, d, ["id", "name", "filePath", "size"])
    checkpoint = scratch_path(spark, "checkpoint")
    ingest.upsert_stream(stream, table, checkpoint)
    # A second start finds nothing new.
    ingest.upsert_stream(stream, table, checkpoint)
    return table.read().select("id", "name", "size")


@register("stream_stale_drop", with_parts("""
    SELECT filePath, CASE WHEN doc_id % 4 = 0 THEN 'known' ELSE 'arrived' END AS origin FROM files WHERE doc_id % 2 = 0
    UNION ALL SELECT filePath, 'arrived' FROM files WHERE doc_id % 2 = 1""", "files"))
def _(spark, d):
    schema = T.StructType([T.StructField("filePath", T.StringType()), T.StructField("origin", T.StringType())])
    table = store.TableStore(spark, scratch_path(spark, "table"), schema)
    state = store.TableStore(spark, scratch_path(spark, "state"), INDEX_STATE)
    known = rel.index_state(spark, d)
    state.upsert(known)
    table.upsert(known.withColumn("origin", F.lit("known")))
    stream, _ = _arrivals(spark, d, ["filePath", "modifiedDateTime"])
    stream = stream.withColumn("origin", F.lit("arrived")).withColumn("modifiedDateTime", F.col("modifiedDateTime").cast("timestamp"))
    ingest.upsert_stream(stream, table, scratch_path(spark, "checkpoint"), "modifiedDateTime", state)
    return table.read()


_FILE_TEXTS = rf"""
    SELECT concat('source=', source, '/lang=', lang) AS directory, length({STRIP.format('text')}) >= 10 AS sound,
      len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS n, CAST(octet_length(encode(text)) + 1 AS BIGINT) AS size,
      CAST(length(text) + 1 AS BIGINT) AS chars, text FROM documents"""
_SETTINGS = IndexSettings(chunk_size=CHUNK_SIZE, chunk_overlap=CHUNK_OVERLAP)
_CHUNKED_FILES = f"""
    SELECT directory, size, CAST(CASE WHEN n <= {CHUNK_SIZE} THEN 1 ELSE ceil(n / {CHUNK_SIZE - CHUNK_OVERLAP}.0) END AS BIGINT) AS chunks
    FROM ({_FILE_TEXTS}) WHERE sound"""


# The same with the hash of the stored text, of which there is one for each file.
_CHUNKED_CONTENT = f"""
    SELECT directory, size, CAST(CASE WHEN n <= {CHUNK_SIZE} THEN 1 ELSE ceil(n / {CHUNK_SIZE - CHUNK_OVERLAP}.0) END AS BIGINT) AS chunks,
      1::BIGINT AS contents, md5(left(concat(text, chr(10)), 50000)) AS content FROM ({_FILE_TEXTS}) WHERE sound"""


def _by_directory(table: DataFrame, root: str) -> DataFrame:
    parts = F.split(files.relative_path("filePath", root), "/")
    return table.withColumn("directory", F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/"))


def _chunks_per_file(table: DataFrame, root: str) -> DataFrame:
    """One row for each file with its folder, size and number of chunks."""
    return _by_directory(table, root).groupBy("filePath", "directory").agg(
        F.max("size").alias("size"), F.count(F.lit(1)).alias("chunks")).drop("filePath")


def _chunks_and_content(table: DataFrame, root: str) -> DataFrame:
    """The same with the number of rows that hold the file's content, and its hash."""
    return _by_directory(table, root).groupBy("filePath", "directory").agg(
        F.max("size").alias("size"), F.count(F.lit(1)).alias("chunks"), F.count("content").alias("contents"),
        X.text_hash(F.max("content")).alias("content")).drop("filePath")


@register("stream_ingest", _CHUNKED_CONTENT)
def _(spark, d):
    root, base = _tree(spark, d), scratch_path(spark, "streamed")
    table = store.TableStore(spark, f"{base}/documents", CHUNK_DOCUMENT)
    state = store.TableStore(spark, f"{base}/state", INDEX_STATE)
    cache = EmbeddingCache(spark, f"{base}/embeddings")
    stream = ingest.stream_files(spark, root, files_per_batch=50)
    ingest.ingest_stream(stream, table, state, cache, E.HashingEmbedder(64), f"{base}/checkpoint", _SETTINGS)
    return _chunks_and_content(table.read(), root)


# ---------------------------------------------------------------- whole runs

_RULED = f"""
    SELECT directory, concat(repeat('-- ', {CHUNK_SIZE}), text, chr(10)) AS whole, list_concat(list_resize([]::VARCHAR[], {CHUNK_SIZE}, '--'),
      list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS w FROM ({_FILE_TEXTS})"""
_RULED_CHUNKS = rf"""
    SELECT directory, min(s) AS first_chunk, count(*) AS chunks, 1::BIGINT AS contents, any_value(md5(left(whole, 50000))) AS content FROM (
      SELECT directory, whole, file, CAST(t.s // {CHUNK_SIZE - CHUNK_OVERLAP} AS INTEGER) AS s, array_to_string(CASE WHEN len(w) <= {CHUNK_SIZE} THEN w ELSE w[t.s + 1 : t.s + {CHUNK_SIZE}] END, ' ') AS chunk
      FROM (SELECT *, row_number() OVER () AS file FROM ({_RULED})),
        unnest(CASE WHEN len(w) <= {CHUNK_SIZE} THEN [0] ELSE range(0, len(w), {CHUNK_SIZE - CHUNK_OVERLAP}) END) AS t(s))
    WHERE regexp_matches(chunk, '[\p{{L}}\p{{N}}]') GROUP BY file, directory"""


def _ruled_tree(spark, d) -> str:
    """A tree in which every file begins with a chunk of rule lines, which have no word and so no vector."""
    root = scratch_path(spark, "ruled")
    ruled = F.concat(F.lit("-- " * CHUNK_SIZE), F.col("text"))
    write_text_files(rel.table(spark, d, "documents", "doc_id").withColumn("text", ruled), root, by=("source", "lang"))
    return root


def _kept_content(table: DataFrame, root: str) -> DataFrame:
    """One row per file: which chunk has the content, how many there are, how often the content is stored, its hash."""
    return _by_directory(table, root).groupBy("filePath", "directory").agg(
        F.min(F.when(F.col("content").isNotNull(), F.col("chunkNumber"))).alias("first_chunk"), F.count(F.lit(1)).alias("chunks"),
        F.count("content").alias("contents"), X.text_hash(F.max("content")).alias("content")).drop("filePath")


@register("content_without_first_vector", _RULED_CHUNKS)
def _(spark, d):
    root, base = _ruled_tree(spark, d), scratch_path(spark, "ruledtable")
    index_vector(spark, root, base, _SETTINGS, E.HashingEmbedder(64))
    return _kept_content(store.TableStore(spark, f"{base}/documents", CHUNK_DOCUMENT).read(), root)


@register("index_standard_run", f"""
    SELECT directory, size, least(chars, 50000) AS chars, md5(left(concat(text, chr(10)), 50000)) AS content, '.txt' AS extension,
      count(*) OVER () AS first_successful, count(*) OVER () AS second_skipped FROM ({_FILE_TEXTS})""")
def _(spark, d):
    root, base = _tree(spark, d), scratch_path(spark, "standard")
    first = index_standard(spark, root, base).first()
    second = index_standard(spark, root, base).first()
    table = store.TableStore(spark, f"{base}/documents", STANDARD_DOCUMENT).read()
    return _by_directory(table, root).select(
        "directory", "size", F.length("content").cast("bigint").alias("chars"), X.text_hash("content").alias("content"), "extension",
        F.lit(first["successful"]).cast("bigint").alias("first_successful"), F.lit(second["skipped"]).cast("bigint").alias("second_skipped"))


@register("index_vector_run", _CHUNKED_CONTENT)
def _(spark, d):
    root, base = _tree(spark, d), scratch_path(spark, "vector")
    index_vector(spark, root, base, _SETTINGS, E.HashingEmbedder(64))
    table = store.TableStore(spark, f"{base}/documents", CHUNK_DOCUMENT).read()
    return _chunks_and_content(table.filter(E.valid_dimensions("contentVector", 64)), root)


@register("retry_failed_embeddings", f"""
    SELECT *, CAST(sum(chunks) OVER () AS BIGINT) AS all_chunks, true AS first_run_failed FROM ({_CHUNKED_FILES})""")
def _(spark, d):
    # In the first run the model fails for every third text, in the second one it works again.
    root, base, works = _tree(spark, d), scratch_path(spark, "retried"), E.HashingEmbedder(64)

    def flaky(texts: DataFrame) -> DataFrame:
        fails = F.pmod(F.crc32("text_hash"), F.lit(3)) == 0
        return works(texts).withColumn("embedding", F.when(~fails, F.col("embedding")))

    first = index_vector(spark, root, base, _SETTINGS, flaky).first()
    index_vector(spark, root, base, _SETTINGS, works)
    table = store.TableStore(spark, f"{base}/documents", CHUNK_DOCUMENT).read()
    chunks = _chunks_per_file(table.filter(E.valid_dimensions("contentVector", 64)), root)
    total = store.TableStore(spark, f"{base}/documents", CHUNK_DOCUMENT).read().count()
    return chunks.withColumn("all_chunks", F.lit(total).cast("bigint")).withColumn("first_run_failed", F.lit(first["total_chunks"] < total))


_ADDED = f"{_FILE_TEXTS} WHERE doc_id % 10 = 3"


@register("incremental_vector_run", f"""
    SELECT *, (SELECT count(*) FROM ({_FILE_TEXTS})) AS known, (SELECT count(*) FROM ({_ADDED})) AS new_files,
      (SELECT count(*) FROM ({_ADDED})) AS taken, 0::BIGINT AS folders_beyond FROM ({_CHUNKED_FILES})
    UNION ALL SELECT 'added', size, chunks, (SELECT count(*) FROM ({_FILE_TEXTS})), (SELECT count(*) FROM ({_ADDED})), (SELECT count(*) FROM ({_ADDED})), 0 FROM (
      SELECT size + 2 AS size, CAST(CASE WHEN n + 1 <= {CHUNK_SIZE} THEN 1 ELSE ceil((n + 1) / {CHUNK_SIZE - CHUNK_OVERLAP}.0) END AS BIGINT) AS chunks
      FROM ({_ADDED}))""")
def _(spark, d):
    # All files are indexed; a tenth as many are added, and the second run takes these alone and reads the part of the
    # cache that their texts can lie in.
    root, base = _tree(spark, d), scratch_path(spark, "increment")
    first = index_vector(spark, root, base, _SETTINGS, E.HashingEmbedder(64)).first()
    added = rel.table(spark, d, "documents").filter("doc_id % 10 = 3").select(F.concat(F.lit("z "), F.col("text")).alias("text"))
    write_text_files(added, f"{root}/added")
    second = index_vector(spark, root, base, _SETTINGS, E.HashingEmbedder(64)).first()
    table = store.TableStore(spark, f"{base}/documents", CHUNK_DOCUMENT).read()
    new = _by_directory(table, root).filter("directory = 'added'")
    asked = new.select(E.hash_folder(X.text_hash("chunk"), E.CACHE_DIGITS).alias(E.CACHE_FOLDER)).distinct()
    read = E.needed_part(EmbeddingCache(spark, f"{base}/embeddings").read(), new, E.CACHE_DIGITS)
    beyond = read.select(E.CACHE_FOLDER).distinct().join(asked, E.CACHE_FOLDER, "left_anti").count()
    return _chunks_per_file(table, root).select("*", F.lit(first["total_files"]).cast("bigint").alias("known"),
                                                F.lit(second["total_files"] - first["total_files"]).cast("bigint").alias("new_files"),
                                                F.lit(second["successful"]).cast("bigint").alias("taken"), F.lit(beyond).cast("bigint").alias("folders_beyond"))


@register("run_custom_metadata", f"""
    SELECT directory, upper(split_part(directory, '/', 1)) AS department, CAST(chars AS INTEGER) AS letters FROM ({_FILE_TEXTS})""")
def _(spark, d):
    root, base = _tree(spark, d), scratch_path(spark, "custom")

    def department(metadata: DataFrame) -> DataFrame:
        return metadata.withColumn("department", F.upper(F.split(files.relative_path("file_path", root), "/")[0]))

    def letters(metadata: DataFrame) -> DataFrame:
        return metadata.withColumn("letters", F.length("content"))

    own = (T.StructField("department", T.StringType()), T.StructField("letters", T.IntegerType()))
    index_standard(spark, root, base, IndexSettings(metadata=(department, letters), custom_fields=own))
    table = store.TableStore(spark, f"{base}/documents", T.StructType([*STANDARD_DOCUMENT.fields, *own])).read()
    return _by_directory(table, root).select("directory", "department", "letters")


@register("run_audit", f"""
    SELECT 'audit' AS place, directory, 'index' AS action, CASE WHEN size > 1000 THEN 'oversize' ELSE 'successful' END AS status,
      CAST(size AS VARCHAR) AS size FROM ({_FILE_TEXTS})
    UNION ALL SELECT 'hook', directory, 'index', CASE WHEN size > 1000 THEN 'oversize' ELSE 'successful' END, CAST(size AS VARCHAR) FROM ({_FILE_TEXTS})""")
def _(spark, d):
    root, base = _tree(spark, d), scratch_path(spark, "audited")
    settings = IndexSettings(max_mb=1000 / 2**20, audit=f"{base}/audit", after=(lambda rows: rows.write.parquet(f"{base}/outcomes"),))
    index_standard(spark, root, base, settings)
    audit = export.read_audit(spark, f"{base}/audit").select(F.lit("audit").alias("place"), F.col("resource").alias("filePath"), "action", "status",
                                                             F.col("details")["size"].alias("size"))
    told = spark.read.parquet(f"{base}/outcomes").select(F.lit("hook").alias("place"), F.col("path").alias("filePath"), F.lit("index").alias("action"),
                                                         "status", F.col("size").cast("string").alias("size"))
    return _by_directory(audit.unionByName(told), root).drop("filePath")


@register("recover_table", f"""
    SELECT 'indexed' AS state, directory, size FROM ({_FILE_TEXTS})
    UNION ALL SELECT 'problems', NULL, 0""")
def _(spark, d):
    # The table is built from nothing although the state of a lost one says that all files are known.
    root, base = _tree(spark, d), scratch_path(spark, "recovered")
    state = store.TableStore(spark, f"{base}/state", INDEX_STATE)
    listed = files.scan_directory(spark, root)
    state.append(listed.select(F.col("path").alias("filePath"), F.col("modificationTime").alias("mtime")))
    problems = recover_table(spark, root, base)
    table = store.TableStore(spark, f"{base}/documents", STANDARD_DOCUMENT).read()
    rows = _by_directory(table, root).select(F.lit("indexed").alias("state"), "directory", "size")
    return rows.unionByName(problems.agg(F.count(F.lit(1)).alias("size")).select(F.lit("problems").alias("state"), F.lit(None).cast("string").alias("directory"), "size"))


@register("run_statistics", f"""
    SELECT count(*) AS total_files, count_if(sound) AS successful, count_if(NOT sound) AS failed,
      CAST((SELECT sum(chunks) FROM ({_CHUNKED_FILES})) AS BIGINT) AS total_chunks, round(sum(size) / 1048576.0, 2) AS total_size_mb FROM ({_FILE_TEXTS})""")
def _(spark, d):
    root, base = _tree(spark, d), scratch_path(spark, "vector")
    run = index_vector(spark, root, base, _SETTINGS, E.HashingEmbedder(64))
    return run.select("total_files", "successful", "failed", "total_chunks", "total_size_mb")
