"""Scalars, row construction, chunking, sources and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as X
from foliospark.functions.chunking import PRESETS, explode_chunks
from foliospark.operators import build as B
from foliospark.operators import embedding as E
from foliospark.operators import filters as C
from foliospark.session import scratch_path
from foliospark.sinks.folders import write_text_files
from foliospark.sources import assemble, extract, files, office
from foliospark.sources.html import html_to_text
from foliospark.sources.walk import walk
from testkit import archives, relations as rel
from testkit.registry import CHUNK_OVERLAP, CHUNK_SIZE, QUERY, STRIP, TERM_LIST, register, with_parts, words_sql

# ---------------------------------------------------------------- scalar functions


@register("document_ids", with_parts("SELECT doc_id, md5(filePath) AS id FROM files", "files"))
def _(spark, d):
    return rel.files(spark, d).select("doc_id", X.document_id("filePath").alias("id"))


@register("chunk_ids", with_parts("""
    SELECT doc_id, chunkNumber, md5(concat(filePath, '_chunk_', CAST(chunkNumber AS VARCHAR))) AS id FROM chunks""", "chunks"))
def _(spark, d):
    return _chunked(spark, d).select("doc_id", "chunkNumber", X.chunk_id("filePath", "chunkNumber").alias("id"))


# Names with the edge forms of suffixes are made from each file's own name.
_NAMES = {"plain": "name", "double": "concat('a.tar', name)", "hidden": "concat('.', replace(name, '.', ''))",
          "dots": "concat('..', name)", "upper": "upper(name)"}


@register("path_parts", with_parts(" UNION ALL ".join(rf"""
    SELECT doc_id, '{k}' AS form, base, lower(regexp_extract(base, '^\.*[^.].*?(\.[^.]*)$', 1)) AS extension,
      left(base, length(base) - length(regexp_extract(base, '^\.*[^.].*?(\.[^.]*)$', 1))) AS stem
    FROM (SELECT doc_id, {v} AS base FROM files)""" for k, v in _NAMES.items()), "files"))
def _(spark, d):
    base = rel.files(spark, d)
    forms = F.array(*[F.struct(F.lit(k).alias("form"), F.concat(F.lit("/share/x/"), F.expr(v)).alias("path"))
                      for k, v in _NAMES.items()])
    return base.select("doc_id", F.inline(forms)).select(
        "doc_id", "form", X.file_name("path").alias("base"), X.extension("path").alias("extension"), X.stem("path").alias("stem"))


@register("size_mb", with_parts("""
    SELECT doc_id, round_even(size * 100 / 1048576.0, 2) AS mb, round_even(doc_id / 8.0, 2) AS tie FROM files""", "files"))
def _(spark, d):
    return rel.files(spark, d).select(
        "doc_id", X.size_mb(F.col("size") * 100).alias("mb"), X.size_mb(F.col("doc_id") * 131072).alias("tie"))


@register("title_fallback", with_parts("SELECT doc_id, title FROM titled", "titled"))
def _(spark, d):
    return rel.files(spark, d).select("doc_id", X.title_or_stem("document_title", "filePath").alias("title"))


@register("preview", r"SELECT doc_id, replace(left(text, 200), chr(10), ' ') AS preview FROM documents")
def _(spark, d):
    return rel.table(spark, d, "documents").select("doc_id", X.preview("text").alias("preview"))


_REDACTED = "text"
for _mark, _pattern in X.PII_PATTERNS.items():
    _REDACTED = f"regexp_replace({_REDACTED}, '{_pattern}', '[{_mark}]', 'g')"


@register("redact_pii", f"SELECT doc_id, {_REDACTED} AS redacted FROM documents")
def _(spark, d):
    return rel.table(spark, d, "documents", "doc_id").select("doc_id", X.redact("text").alias("redacted"))


@register("pii_counts", " UNION ALL ".join(
    f"SELECT '{k}' AS category, CAST(sum(len(regexp_extract_all(text, '{p}'))) AS BIGINT) AS found FROM documents"
    for k, p in X.PII_PATTERNS.items()))
def _(spark, d):
    docs = rel.table(spark, d, "documents", "doc_id")
    rows = F.array(*[F.struct(F.lit(k).alias("category"), X.pii_count("text", k).alias("n")) for k in X.PII_PATTERNS])
    return docs.select(F.inline(rows)).groupBy("category").agg(F.sum("n").alias("found"))


@register("tokenize", f"""
    SELECT doc_id, CAST(len(t) AS INTEGER) AS n, md5(array_to_string(t, ' ')) AS joined
    FROM (SELECT doc_id, {words_sql('text')} AS t FROM documents)""")
def _(spark, d):
    return rel.table(spark, d, "documents", "doc_id").select("doc_id", X.word_tokens("text").alias("t")) \
        .select("doc_id", F.size("t").alias("n"), F.md5(F.array_join("t", " ").cast("binary")).alias("joined"))


@register("token_count", with_parts("SELECT doc_id, CAST(len(w) AS INTEGER) AS tokens FROM ws", "ws"))
def _(spark, d):
    return rel.table(spark, d, "documents", "doc_id").select("doc_id", X.token_count("text").alias("tokens"))


@register("truncate_tokens", with_parts("""
    SELECT doc_id, md5(CASE WHEN len(w) <= 200 THEN content ELSE array_to_string(w[1:200], ' ') END) AS short FROM ws""", "ws"))
def _(spark, d):
    return rel.table(spark, d, "documents", "doc_id").select("doc_id", X.text_hash(X.truncate_tokens("text", 200)).alias("short"))


@register("partition_by_department", """
    SELECT source AS directory, count(*) AS files, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes
    FROM documents GROUP BY source""")
def _(spark, d):
    from foliospark.sinks.export import write_by_directory
    path = scratch_path(spark, "departments")
    write_by_directory(rel.files(spark, d).select("filePath", "size"), path, X.top_directory("filePath", 2))
    return spark.read.parquet(path).groupBy(F.col("directory").cast("string").alias("directory")) \
        .agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


@register("audit_details", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, concat('{"k":"', json_extract_string(props, '$.k'), '"}') AS details
    FROM events""")
def _(spark, d):
    details = F.from_json("props", "map<string,string>")
    return rel.table(spark, d, "events").select(
        "event_id", details["k"].cast("bigint").alias("k"), F.to_json(details).alias("details"))


# ---------------------------------------------------------------- chunking and rows


def _chunked(spark, d) -> DataFrame:
    base = rel.files(spark, d, spread=True).select("doc_id", "filePath", "content")
    return explode_chunks(base, "content", CHUNK_SIZE, CHUNK_OVERLAP)


@register("chunk_text", with_parts("SELECT doc_id, chunkNumber, md5(chunk) AS chunk_hash, length(chunk) AS chars FROM chunks", "chunks"))
def _(spark, d):
    return _chunked(spark, d).select(
        "doc_id", "chunkNumber", X.text_hash("chunk").alias("chunk_hash"), F.length("chunk").cast("bigint").alias("chars"))


@register("chunk_presets", with_parts(" UNION ALL ".join(f"""
    SELECT '{k}' AS preset, CAST(sum(CASE WHEN len(w) <= {s} THEN 1 ELSE ceil(len(w) / {s - o}.0) END) AS BIGINT) AS chunks
    FROM ws""" for k, (s, o) in PRESETS.items()), "ws"))
def _(spark, d):
    base = rel.files(spark, d, spread=True).select("doc_id", "content")
    parts = [explode_chunks(base, "content", s, o).agg(F.count(F.lit(1)).alias("chunks")).select(F.lit(k).alias("preset"), "chunks")
             for k, (s, o) in PRESETS.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("chunk_numbering", with_parts("""
    SELECT doc_id, chunkNumber, totalChunks, count(*) OVER (PARTITION BY doc_id) = totalChunks AS complete FROM chunks""", "chunks"))
def _(spark, d):
    whole = _chunked(spark, d).select("doc_id", "chunkNumber", "totalChunks")
    seen = whole.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return whole.join(seen, "doc_id").select("doc_id", "chunkNumber", "totalChunks", (F.col("n") == F.col("totalChunks")).alias("complete"))


@register("build_documents", with_parts("""
    SELECT id, md5(left(content, 50000)) AS content, title, name, filePath, extension, size, modifiedDateTime, createdBy,
      createdBy AS lastModifiedBy, 'File' AS fileType, filePath AS url, concat('author ', lang) AS author FROM titled""", "titled"))
def _(spark, d):
    rows = B.build_documents(rel.metadata(spark, d))
    return rows.select("id", X.text_hash("content").alias("content"), "title", "name", "filePath", "extension", "size",
                       F.col("modifiedDateTime").cast("timestamp_ntz").alias("modifiedDateTime"), "createdBy",
                       "lastModifiedBy", "fileType", "url", "author")


_CHUNK_ROWS = """
    SELECT md5(concat(filePath, '_chunk_', CAST(chunkNumber AS VARCHAR))) AS id, {content} AS content,
      md5(chunk) AS chunk, chunkNumber, totalChunks, coalesce(document_title, concat('doc', CAST(doc_id AS VARCHAR))) AS title,
      name, filePath, extension, size, createdBy, 'File' AS fileType, concat('author ', lang) AS author
    FROM long_chunks"""


def _chunk_rows(spark, d, first_only: bool) -> DataFrame:
    meta = rel.metadata(spark, d, spread=True)
    chunks = B.build_chunk_rows(meta, CHUNK_SIZE, CHUNK_OVERLAP)
    rows = B.attach_content(chunks, meta.select(F.col("file_path").alias("filePath"), "content"), first_only)
    return rows.select("id", X.text_hash("content").alias("content"), X.text_hash("chunk").alias("chunk"), "chunkNumber",
                       "totalChunks", "title", "name", "filePath", "extension", "size", "createdBy", "fileType", "author")


@register("build_chunks", with_parts(_CHUNK_ROWS.format(content="CASE WHEN chunkNumber = 0 THEN md5(left(content, 50000)) END"), "long_chunks"))
def _(spark, d):
    return _chunk_rows(spark, d, first_only=True)


@register("build_chunks_full_content", with_parts(_CHUNK_ROWS.format(content="md5(left(content, 50000))"), "long_chunks"))
def _(spark, d):
    return _chunk_rows(spark, d, first_only=False)


@register("truncate_content", """
    SELECT doc_id, md5(left(text, 50000)) AS stored, length(text) > 50000 AS truncated, md5(left(text, 1000)) AS short,
      length(text) > 1000 AS short_truncated FROM documents""")
def _(spark, d):
    return rel.table(spark, d, "documents").select(
        "doc_id", X.text_hash(B.capped("text")).alias("stored"), B.is_truncated("text").alias("truncated"),
        X.text_hash(B.capped("text", 1000)).alias("short"), B.is_truncated("text", 1000).alias("short_truncated"))


# ---------------------------------------------------------------- sources


def _tree(spark, d) -> str:
    """One text file for each document, below source=…/lang=… folders, written by the tasks."""
    path = scratch_path(spark, "tree")
    write_text_files(rel.table(spark, d, "documents", "doc_id"), path, by=("source", "lang"))
    return path


_DIRS = """
    SELECT concat('source=', source, '/lang=', lang) AS directory, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes
    FROM documents {where} GROUP BY source, lang"""


def _by_directory(found: DataFrame, root: str) -> DataFrame:
    parts = F.split(files.relative_path("path", root), "/")
    return found.groupBy(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/").alias("directory")) \
        .agg(F.sum("length").alias("bytes"))


@register("scan_recursive", _DIRS.format(where=""))
def _(spark, d):
    root = _tree(spark, d)
    return _by_directory(files.scan_directory(spark, root), root)


@register("scan_flat", """
    SELECT source, lang, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes FROM documents
    WHERE source = 'src1' AND lang = 'en' GROUP BY source, lang
    UNION ALL SELECT 'root', 'none', 0""")
def _(spark, d):
    root = _tree(spark, d)
    leaf = files.scan_directory(spark, f"{root}/source=src1/lang=en", recursive=False)
    top = files.scan_directory(spark, root, recursive=False)
    return leaf.agg(F.sum("length").alias("bytes")).select(F.lit("src1").alias("source"), F.lit("en").alias("lang"), "bytes") \
        .unionByName(top.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
                     .select(F.lit("root").alias("source"), F.lit("none").alias("lang"), "bytes"))


@register("scan_exclude_dirs", _DIRS.format(where="WHERE lang <> 'fr' AND source NOT IN ('src1', 'src2')"))
def _(spark, d):
    root = _tree(spark, d)
    return _by_directory(files.scan_directory(spark, root, exclude=["lang=fr", "source=src1", "source=src2", "LANG=de"]), root)


@register("walk_levels", _DIRS.format(where="WHERE lang <> 'fr' AND source NOT IN ('src1', 'src2')"))
def _(spark, d):
    # The excluded names are those of whole subtrees; they are not listed at all.
    root = _tree(spark, d)
    return _by_directory(walk(spark, root, exclude=["lang=fr", "source=src1", "source=src2", "LANG=de"]), root)


@register("walk_flat", """
    SELECT lang, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes FROM documents
    WHERE source = 'src1' AND lang = 'en' GROUP BY lang""")
def _(spark, d):
    # The root and the first folder hold folders only; the files of the second are listed, those of its neighbours are not.
    root = _tree(spark, d)
    flat = [root, f"{root}/source=src1", f"{root}/source=src1/lang=en"]
    found = walk(spark, flat, recursive=False)
    return found.groupBy(F.regexp_extract("path", "/lang=([^/]*)/", 1).alias("lang")).agg(F.sum("length").alias("bytes"))


@register("filter_extension_allowlist", with_parts("SELECT doc_id, filePath FROM files WHERE extension IN ('.txt', '.pdf')", "files"))
def _(spark, d):
    # Names in upper case must pass as well.
    listed = rel.listing(spark, d)
    upper = F.when(F.col("doc_id") % 2 == 0, F.upper("path")).otherwise(F.col("path"))
    return listed.filter(files.has_extension(upper, [".txt", ".PDF"])).select("doc_id", F.col("path").alias("filePath"))


@register("scan_file_list", with_parts("""
    SELECT doc_id, filePath FROM files WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""", "files"))
def _(spark, d):
    listed = rel.listing(spark, d)
    wanted = listed.join(rel.table(spark, d, "labels").filter("quality = 1"), "doc_id").select("path")
    return files.listed_in(listed, wanted).select("doc_id", F.col("path").alias("filePath"))


@register("scan_multi_root", """
    SELECT lang, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes FROM documents
    WHERE source IN ('src3', 'src4', 'src5') GROUP BY lang""")
def _(spark, d):
    root = _tree(spark, d)
    found = files.scan_roots(spark, [f"{root}/source=src{i}" for i in (3, 4, 5)])
    return found.groupBy(F.regexp_extract("path", "/lang=([^/]*)/", 1).alias("lang")).agg(F.sum("length").alias("bytes"))


@register("decode_text", "SELECT doc_id, md5(text) AS decoded FROM documents")
def _(spark, d):
    # UTF-8 with Windows line ends, UTF-16 with mark in both byte orders, and Latin-1 bytes.
    way, text = F.col("doc_id") % 4, F.col("text")
    content = F.when(way == 0, F.encode(F.replace(text, F.lit("\n"), F.lit("\r\n")), "UTF-8")) \
        .when(way == 1, F.encode(text, "UTF-16")) \
        .when(way == 2, F.concat(F.unhex(F.lit("FFFE")), F.encode(text, "UTF-16LE"))) \
        .otherwise(F.encode(text, "ISO-8859-1"))
    return rel.table(spark, d, "documents", "doc_id").select("doc_id", content.alias("content")) \
        .select("doc_id", X.text_hash(files.decode_text("content")).alias("decoded"))


_LINES = "list_filter(str_split(text, chr(10)), lambda s: length(" + STRIP.format("s") + ") > 0)"


@register("extract_docx", with_parts(f"""
    SELECT filePath, md5(concat(array_to_string({_LINES}, chr(10)), CASE WHEN len({_LINES}) > 0 THEN chr(10) ELSE '' END,
      source, ' | ', lang, chr(10), 'size | ', CAST(size AS VARCHAR))) AS content FROM files""", "files"))
def _(spark, d):
    made = archives.docx_files(rel.files(spark, d, spread=True))
    return office.extract_docx(made).select(F.col("path").alias("filePath"), X.text_hash("content").alias("content"))


@register("docx_metadata", with_parts("""
    SELECT filePath, document_title, concat('author ', lang) AS document_author, '2024-01-02T03:04:05' AS document_created,
      CAST(len(str_split(text, chr(10))) AS INTEGER) AS paragraph_count, 1 AS table_count FROM files""", "files"))
def _(spark, d):
    made = archives.docx_files(rel.files(spark, d, spread=True))
    return office.extract_docx(made).select(F.col("path").alias("filePath"), "document_title", "document_author",
                                            "document_created", "paragraph_count", "table_count")


@register("extract_xlsx", with_parts("""
    SELECT filePath, md5(concat('[Sheet: Lines]', chr(10), lines, chr(10), '[Sheet: Info]', chr(10), source, ' | ', lang, chr(10),
      'True | ', CAST(size AS VARCHAR))) AS content
    FROM (SELECT filePath, source, lang, size, array_to_string(list_transform(str_split(text, chr(10)),
            lambda s, i: concat(CAST(i - 1 AS VARCHAR), ' | ', s)), chr(10)) AS lines FROM files)""", "files"))
def _(spark, d):
    made = archives.xlsx_files(rel.files(spark, d, spread=True))
    return office.extract_xlsx(made).select(F.col("path").alias("filePath"), X.text_hash("content").alias("content"))


@register("xlsx_metadata", with_parts("""
    SELECT filePath, document_title, concat('author ', lang) AS document_author, '2024-01-02T03:04:05' AS document_created,
      2 AS sheet_count, 'Lines,Info' AS sheet_names FROM files""", "files"))
def _(spark, d):
    made = archives.xlsx_files(rel.files(spark, d, spread=True))
    return office.extract_xlsx(made).select(
        F.col("path").alias("filePath"), "document_title", "document_author", "document_created", "sheet_count",
        F.array_join("sheet_names", ",").alias("sheet_names"))


@register("assemble_pages", rf"""
    SELECT conv_id, md5(string_agg(concat('[Page ', CAST(turn AS VARCHAR), ']', chr(10), text), concat(chr(10), chr(10)) ORDER BY turn)) AS content
    FROM conversations WHERE length({STRIP.format('text')}) > 0 GROUP BY conv_id""")
def _(spark, d):
    pages = rel.table(spark, d, "conversations")
    return assemble.assemble_pages(pages, "conv_id", "turn", "text").select("conv_id", X.text_hash("content").alias("content"))


@register("assemble_sheets", """
    WITH cells AS (SELECT l_suppkey AS doc, l_orderkey AS sheet, l_linenumber AS row, [CAST(l_partkey AS VARCHAR),
        CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, l_linestatus] AS v FROM lineitem),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY doc, sheet, row ORDER BY v[1]) AS n FROM cells),
    lines AS (SELECT doc, sheet, row, array_to_string(list_filter(v, lambda x: x IS NOT NULL), ' | ') AS line FROM ranked WHERE n = 1),
    sheets AS (SELECT doc, sheet, concat('[Sheet: order ', CAST(sheet AS VARCHAR), ']', chr(10), string_agg(line, chr(10) ORDER BY row)) AS t
        FROM lines GROUP BY doc, sheet)
    SELECT doc, md5(string_agg(t, chr(10) ORDER BY sheet)) AS content FROM sheets GROUP BY doc""")
def _(spark, d):
    # An order is a sheet of the supplier's book, a line item is a row.
    items = rel.table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("doc"), F.col("l_orderkey").alias("sheet"), F.col("l_linenumber").alias("row"),
        F.col("l_partkey").cast("string").alias("part"), "l_returnflag", "l_linestatus")
    items = items.groupBy("doc", "sheet", "row").agg(F.min(F.struct("part", "l_returnflag", "l_linestatus")).alias("i"))
    cells = items.select(
        "doc", "sheet", F.concat(F.lit("order "), F.col("sheet")).alias("title"), "row",
        F.posexplode(F.array("i.part", F.when(F.col("i.l_returnflag") != "N", F.col("i.l_returnflag")), "i.l_linestatus"))
        .alias("column", "value"))
    return assemble.assemble_sheets(cells).select("doc", X.text_hash("content").alias("content"))


@register("assemble_paragraphs", rf"""
    SELECT conv_id, md5(string_agg(text, chr(10) ORDER BY CASE role WHEN 'user' THEN 0 ELSE 1 END, turn)) AS content
    FROM conversations WHERE role <> 'user' OR length({STRIP.format('text')}) > 0 GROUP BY conv_id""")
def _(spark, d):
    parts = rel.table(spark, d, "conversations")
    return assemble.assemble_paragraphs(parts, "conv_id", "role", "turn", "text", paragraph="user") \
        .select("conv_id", X.text_hash("content").alias("content"))


@register("part_counts", """
    SELECT conv_id, CAST(count(*) FILTER (role = 'user') AS INTEGER) AS paragraph_count,
      CAST(count(*) FILTER (role = 'assistant') AS INTEGER) AS table_count,
      array_to_string(list_sort(list(DISTINCT role)), ',') AS names FROM conversations GROUP BY conv_id""")
def _(spark, d):
    counted = {"paragraph_count": F.col("role") == "user", "table_count": F.col("role") == "assistant"}
    return assemble.part_counts(rel.table(spark, d, "conversations"), "conv_id", counted, "role") \
        .withColumn("names", F.array_join("names", ","))


@register("extract_dispatch", with_parts("""
    SELECT extension, error, count(*) AS files, CAST(sum(length(content)) AS BIGINT) AS chars FROM (
      SELECT CASE WHEN doc_id % 10 = 0 THEN '.pptx' WHEN doc_id % 10 = 1 THEN '.md' ELSE '.txt' END AS extension,
        CASE WHEN doc_id % 10 = 0 THEN 'Unsupported file type: .pptx' END AS error,
        CASE WHEN doc_id % 10 <> 0 THEN text END AS content FROM documents)
    GROUP BY extension, error"""))
def _(spark, d):
    suffix = F.when(F.col("doc_id") % 10 == 0, ".pptx").when(F.col("doc_id") % 10 == 1, ".MD").otherwise(".txt")
    made = rel.table(spark, d, "documents").select(
        F.concat(F.lit("/share/f"), F.col("doc_id"), suffix).alias("path"), F.encode("text", "UTF-8").alias("content"))
    return extract.extract(made).groupBy(X.extension("path").alias("extension"), "error") \
        .agg(F.count(F.lit(1)).alias("files"), F.sum(F.length("content")).alias("chars"))


@register("file_metadata", with_parts("""
    SELECT name AS file_name, filePath AS file_path, extension AS file_extension, size AS file_size_bytes,
      round_even(size / 1048576.0, 2) AS file_size_mb, strftime(modifiedDateTime, '%Y-%m-%dT%H:%M:%S') AS modified,
      CASE WHEN doc_id % 2 = 0 THEN createdBy ELSE 'Unknown' END AS owner FROM files""", "files"))
def _(spark, d):
    manifest = rel.files(spark, d).filter("doc_id % 2 = 0").select(
        F.col("filePath").alias("path"), F.lit(None).cast("timestamp").alias("created_time"),
        F.lit(None).cast("timestamp").alias("accessed_time"), F.col("createdBy").alias("owner"))
    return extract.file_metadata(rel.listing(spark, d), manifest).select(
        "file_name", "file_path", "file_extension", "file_size_bytes", "file_size_mb", X.iso_time("modified_time").alias("modified"), "owner")


@register("metadata_merge", with_parts("""
    SELECT filePath AS file_path, name AS file_name, CASE WHEN quality = 1 THEN 'document' ELSE createdBy END AS owner,
      CASE WHEN quality IS NOT NULL THEN document_title END AS document_title
    FROM files LEFT JOIN labels USING (doc_id)""", "files"))
def _(spark, d):
    base = rel.files(spark, d)
    properties = base.join(rel.table(spark, d, "labels"), "doc_id").select(
        F.col("filePath").alias("file_path"), "document_title", F.when(F.col("quality") == 1, "document").alias("owner"))
    filesystem = base.select(F.col("filePath").alias("file_path"), F.col("name").alias("file_name"), F.col("createdBy").alias("owner"))
    return extract.merge_metadata(filesystem, properties)


_PAGE_TEXT = r"""
    SELECT page_id, replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g'),
      '(?s)<[/!?a-zA-Z][^>]*>', '{between}', 'g'), '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&') AS text FROM pages"""


@register("html_to_text", _PAGE_TEXT.format(between=""))
def _(spark, d):
    return rel.table(spark, d, "pages", "page_id").select("page_id", html_to_text("html").alias("text"))


@register("extract_html", _PAGE_TEXT.format(between=" "))
def _(spark, d):
    # Pages as files of both extensions, through the dispatcher.
    suffix = F.when(F.col("page_id") % 2 == 0, ".html").otherwise(".HTM")
    pages = rel.table(spark, d, "pages", "page_id").select(
        F.concat(F.lit("/site/"), F.col("page_id").cast("string"), suffix).alias("path"), F.encode("html", "UTF-8").alias("content"))
    number = F.regexp_extract("path", r"([0-9]+)\.", 1).cast("bigint")
    return extract.extract(pages).select(number.alias("page_id"), F.col("content").alias("text"))


# ---------------------------------------------------------------- gates and filters


@register("filter_max_size", with_parts("SELECT doc_id, size FROM files WHERE size <= 10485", "files"))
def _(spark, d):
    return rel.listing(spark, d).filter(files.within_size("length", 0.01)).select("doc_id", F.col("length").alias("size"))


@register("incremental_filter", with_parts("""
    SELECT f.doc_id FROM files f LEFT JOIN index_state s USING (filePath) WHERE s.mtime IS NULL OR f.modifiedDateTime > s.mtime""",
    "files", "index_state"))
def _(spark, d):
    return files.changed_files(rel.listing(spark, d), rel.index_state(spark, d)).select("doc_id")


@register("filter_min_content", f"SELECT doc_id FROM documents WHERE length({STRIP.format('text')}) >= 10")
def _(spark, d):
    return rel.table(spark, d, "documents").filter(B.has_meaning("text")).select("doc_id")


@register("drop_failed_embeddings", """
    SELECT doc_id FROM documents JOIN embeddings ON vec_id = doc_id WHERE label <> 3 AND label <> 4""")
def _(spark, d):
    # Label 3 stands for a failed call, label 4 for an empty answer.
    vector = F.when(F.col("label") == 4, F.array().cast("array<float>")).when(F.col("label") != 3, F.col("embedding"))
    found = rel.table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), vector.alias("contentVector"))
    return B.with_vectors(rel.table(spark, d, "documents").join(found, "doc_id", "left")).select("doc_id")


@register("validate_dimensions", "SELECT vec_id FROM embeddings WHERE label % 2 = 0")
def _(spark, d):
    # Odd labels lose their last component.
    table = rel.table(spark, d, "embeddings")
    vector = F.when(F.col("label") % 2 == 0, F.col("embedding")).otherwise(F.slice("embedding", 1, 63))
    return table.withColumn("v", vector).filter(E.valid_dimensions("v", 64)).select("vec_id")


@register("plugin_predicate", with_parts("""
    SELECT doc_id FROM files WHERE source <> 'src3' AND size > 100 AND name NOT LIKE '%7.txt'""", "files"))
def _(spark, d):
    hooks = [~F.contains("path", F.lit("/src3/")), F.col("length") > 100, ~F.endswith("path", F.lit("7.txt"))]
    return B.admitted(rel.listing(spark, d), hooks).select("doc_id")


@register("custom_metadata", with_parts("""
    SELECT filePath AS file_path, upper(lang) AS custom_field, length(name) > 10 AS long_name FROM files""", "files"))
def _(spark, d):
    base = rel.files(spark, d).select(F.col("filePath").alias("file_path"), F.col("name").alias("file_name"), "lang")
    return B.with_custom_fields(
        base, lambda m: m.withColumn("custom_field", F.upper("lang")),
        lambda m: m.withColumn("long_name", F.length("file_name") > 10)).select("file_path", "custom_field", "long_name")


def _filtered(name: str, sql: str, condition):
    @register(name, with_parts(f"SELECT doc_id FROM titled WHERE {sql}", "titled"))
    def _(spark, d):
        table = rel.files(spark, d).withColumn("title", X.title_or_stem("document_title", "filePath"))
        return table.filter(condition(table)).select("doc_id")


_filtered("filtered_extension", "extension = '.pdf'", lambda t: C.metadata_filter(extension=".pdf"))
_filtered("filtered_date_range",
          "modifiedDateTime >= TIMESTAMP '2024-01-05 00:00:00' AND modifiedDateTime <= TIMESTAMP '2024-01-20 12:00:00'",
          lambda t: C.metadata_filter(date_from="2024-01-05T00:00:00", date_to="2024-01-20T12:00:00"))
_filtered("filtered_author", "createdBy IN ('owner1', 'owner4')", lambda t: C.metadata_filter(author="owner1,owner4"))
_filtered("filtered_conjunction", """extension = '.txt' AND modifiedDateTime >= TIMESTAMP '2024-01-03 00:00:00'
          AND createdBy IN ('owner2', 'owner3')""",
          lambda t: C.metadata_filter(extension=".txt", date_from="2024-01-03T00:00:00", author="owner2,owner3"))
_filtered("filter_comparisons", """title <> 'Title 3' AND extension IS DISTINCT FROM '.pdf' AND size > 500 AND size < 9000
          AND doc_id >= 0 AND modifiedDateTime >= TIMESTAMP '2024-01-02 00:00:00'
          AND modifiedDateTime <= TIMESTAMP '2024-02-01 00:00:00' AND createdBy = 'owner1'""",
          lambda t: C.differs("title", "Title 3") & C.differs("extension", ".pdf") & C.above("size", 500)
          & C.below("size", 9000) & C.at_least("modifiedDateTime", "2024-01-02 00:00:00")
          & C.at_most("modifiedDateTime", "2024-02-01 00:00:00") & C.equals("createdBy", "owner1"))
_filtered("filter_boolean", "(extension = '.pdf' OR extension = '.docx') AND size < 5000 AND NOT (createdBy = 'owner0')",
          lambda t: (C.equals("extension", ".pdf") | C.equals("extension", ".docx")) & C.below("size", 5000)
          & ~C.equals("createdBy", "owner0"))
_filtered("filter_ismatch", f"len(list_intersect({TERM_LIST}, {words_sql('content')})) > 0", lambda t: C.is_match(t, QUERY))


@register("filter_in_list", with_parts("""
    SELECT doc_id, 'list' AS way FROM files WHERE name IN ('doc1.txt', 'doc2.txt', 'doc5.txt', 'doc9.pdf')
    UNION ALL SELECT doc_id, 'table' FROM files WHERE name IN (SELECT name FROM files JOIN labels USING (doc_id) WHERE toxic = 1)""", "files"))
def _(spark, d):
    table = rel.files(spark, d)
    names = table.join(rel.table(spark, d, "labels").filter("toxic = 1"), "doc_id").select("name")
    few = table.filter(C.in_list("name", "doc1.txt|doc2.txt|doc5.txt|doc9.pdf", "|"))
    return few.select("doc_id", F.lit("list").alias("way")).unionByName(
        C.in_table(table, "name", names).select("doc_id", F.lit("table").alias("way")))
