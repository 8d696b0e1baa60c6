"""The queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import exact, language, layout, lexical, mixing, omh, packing, pii, quality, repair, tokens, vectors, warc
from foliospark.llm.common import remainder
from foliospark.session import scratch_path, ship_packages, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_PAIRS = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def add(function):
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_packages(spark)
            return function(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return function
    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_exact_dedup", r"""
    WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
      doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY body)""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(documents(spark, sf_dir)).drop("keep_locator")


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder("doc_id", 4) != 2)
    labelled = docs.select("doc_id", "text").join(labels.select("doc_id", "quality"), "doc_id").select(
        F.col("doc_id").alias("id"), "text", F.col("quality").alias("label"))
    scored = quality.score(docs, quality.train(labelled))
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query("op3_html_layout")
def op3_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.rendered_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op4_personal_data")
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(documents(spark, sf_dir))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of(*pii.BASE)
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.BASE],
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
                        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS if k not in pii.BASE],
                        F.size("spans").cast("long").alias("n_spans"))


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf_dir), BYTE_PAIRS)
    return packed.withColumn("length", F.col("length").cast("long"))


@query("op6_mixing", r"""
    WITH sized AS (SELECT doc_id, source,
        CAST(coalesce(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')), 0) AS BIGINT) AS size,
        md5(concat('mix', coalesce(CAST(doc_id AS VARCHAR), ''))) AS place FROM documents),
    totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    weighed AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
        [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM totals),
    levels AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
          - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
    chosen AS (SELECT arg_min(level, cap / w) AS level FROM levels WHERE level * w < cap),
    targets AS (SELECT source, source_size, least(cap, coalesce(chosen.level * w, cap)) AS target FROM levels, chosen),
    queued AS (SELECT doc_id, place, size, source_size, target,
        CAST(sum(size) OVER (PARTITION BY sized.source ORDER BY place, doc_id, size) - size AS BIGINT) AS before
      FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
    copies AS (SELECT *, turn, before + turn * source_size AS start, (before + turn * source_size + size) / target AS done,
        greatest(0, least(size, CAST(floor(target) AS BIGINT) - (before + turn * source_size))) AS early
      FROM queued, (VALUES (0), (1)) AS turns(turn) WHERE size > 0),
    parts AS (SELECT doc_id, place, turn, 0 AS part, early AS words, least(done, 1.0) AS finish FROM copies WHERE early > 0
      UNION ALL SELECT doc_id, place, turn, 1, size - early, done FROM copies WHERE size > early),
    ordered AS (SELECT *, sum(words) OVER (ORDER BY finish, place, doc_id, turn, part) - words AS ahead FROM parts),
    takes AS (SELECT doc_id, CAST(sum(greatest(0, least(words, (SELECT floor(sum(target)) FROM targets) - ahead))) AS BIGINT) AS taken
      FROM ordered GROUP BY doc_id)
    SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM queued LEFT JOIN takes USING (doc_id)""")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.queue_documents(documents(spark, sf_dir))


@query("op8_order_minhash")
def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = omh.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "component", (F.col("doc_id") == F.col("component")).alias("kept"))


@query("op9_language")
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", remainder("doc_id", 3) == 1)
    profiles = language.learn_profiles(docs.where("NOT held_out"))
    found = language.identify(docs, profiles)
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(documents(spark, sf_dir), PIECES)


@query("op10_vectors")
def op10_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op11_lexical_search", r"""
    WITH numbered AS (SELECT doc_id, text, row_number() OVER () AS row FROM documents),
    words AS (SELECT doc_id, row, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM numbered),
    tfs AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM words GROUP BY row, term),
    sizes AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY row),
    total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM sizes),
    weights AS (SELECT term, CAST(floor(1000 * ln(((2 * docs + 2) / (2 * df + 1))::DOUBLE)) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), total),
    asked AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
    scores AS (SELECT item_id, row, any_value(doc_id) AS doc_id,
        CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // len)))) AS BIGINT) AS score
      FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (row), total GROUP BY item_id, row)
    SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
    WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 10""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of ``conversations`` after the damage that `op13_conversation_repair` mends; nulls count as one space."""
    def text_of(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    marked = turns.withColumn("damage", kind).where("damage <> 0")
    text = F.when(F.col("damage") == 1, F.lit("")).when(F.col("damage") == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text"))
    role = F.when(F.col("damage") == 4, F.lit("user")).otherwise(text_of("role"))
    copies = F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


@query("op13_conversation_repair", r"""
    WITH RECURSIVE given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        list_transform(string_split(concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')), ''),
          lambda c: CAST(ord(c) AS BIGINT)) AS bytes FROM conversations),
    kinds AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda crc, b:
        list_reduce(list_prepend(xor(crc, b), range(8)), lambda c, i:
          CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)), 4294967295::BIGINT) % 20 AS kind FROM given),
    rows AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
      FROM kinds, (VALUES (0), (1)) AS copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
        regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last FROM rows),
    faults AS (SELECT *, CASE WHEN last = '' THEN 1
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 2
        WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault, left(role, 1) AS initial FROM placed),
    pairs AS (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair FROM faults),
    counts AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
        count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM pairs GROUP BY conv_id),
    inserts(a, b, cost, edits, said) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
      (0, 2, 5, 'I', E'
user:'), (1, 2, 5, 'I', E'
user:'), (3, 2, 5, 'I', E'
user:'), (2, 3, 5, 'I', E'
assistant:'),
      (0, 3, 10, 'II', E'
user:
assistant:'), (1, 3, 10, 'II', E'
user:
assistant:')),
    edits AS (SELECT conv_id, place, a, a AS b, 2 AS cost, 'D' AS edit, '' AS said FROM faults, range(4) AS states(a)
      UNION ALL SELECT conv_id, place, a, b, CASE WHEN initial = name THEN 0 ELSE 1 END + CASE fault WHEN 3 THEN 5 ELSE 0 END,
        CASE WHEN initial = name THEN 'K' ELSE 'R' END, concat(E'
', CASE WHEN initial = name THEN role ELSE full_name END, ':', text)
      FROM faults, (VALUES (0, 1, 's', ''), (0, 2, 'u', 'user'), (1, 2, 'u', 'user'), (3, 2, 'u', 'user'), (2, 3, 'a', 'assistant')) AS moves(a, b, name, full_name)
      WHERE fault IN (0, 3) AND (initial = name OR name <> 's')),
    moves AS (SELECT conv_id, place, inserts.a, edits.b, CAST(inserts.cost + edits.cost AS BIGINT) AS cost, inserts.edits || edit AS edits,
        inserts.said || edits.said AS said FROM edits JOIN inserts ON inserts.b = edits.a),
    walks AS (SELECT conv_id, 1::BIGINT AS place, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS said FROM (SELECT DISTINCT conv_id FROM conversations)
      UNION ALL SELECT conv_id, place, state, best.cost, best.audit, best.said FROM (
        SELECT walks.conv_id, walks.place + 1 AS place, moves.b AS state,
          min({'cost': walks.cost + moves.cost, 'audit': walks.audit || moves.edits, 'said': walks.said || moves.said}) AS best
        FROM walks JOIN moves ON walks.conv_id IS NOT DISTINCT FROM moves.conv_id AND walks.place = moves.place AND walks.state = moves.a
        GROUP BY ALL)),
    ends AS (SELECT walks.conv_id, min({'cost': walks.cost + inserts.cost, 'audit': audit || inserts.edits, 'said': walks.said || inserts.said}) AS best
      FROM walks LEFT JOIN counts ON walks.conv_id IS NOT DISTINCT FROM counts.conv_id
      JOIN inserts ON inserts.a = walks.state AND inserts.b IN (0, 3) WHERE walks.place = coalesce(n, 0) + 1 GROUP BY walks.conv_id)
    SELECT ends.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
      sha256(substr(best.said, 2)) AS repaired_sha256
    FROM ends LEFT JOIN counts ON ends.conv_id IS NOT DISTINCT FROM counts.conv_id""")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns = damaged(given)
    return repair.repaired_digests(turns, repair.repair_plans(turns, ids=given))


@query("op12_warc_index", r"""
    WITH given AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
    heads AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS head, row_number() OVER (PARTITION BY html ORDER BY page_id DESC, url DESC) AS turn,
        sha1(html) AS hex, regexp_extract(url, '^(?:([A-Za-z][A-Za-z0-9+.-]*):)?//(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^#]*)', ['scheme', 'host', 'port', 'path']) AS u,
        '2000-01-01'::TIMESTAMP + to_seconds(page_id) AS captured FROM given),
    keyed AS (SELECT *, CASE WHEN NOT contains(url, '//') THEN url ELSE concat(
        array_to_string(list_reverse(string_split(regexp_replace(lower(u.host), '^www[0-9]*\.', ''), '.')), ','),
        CASE WHEN u.port = '' OR (lower(u.scheme), u.port) IN (('http', '80'), ('https', '443')) THEN '' ELSE ':' || u.port END, ')',
        CASE WHEN u.path LIKE '/%' THEN '' ELSE '/' END, u.path) END AS url_key FROM heads)
    SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
      array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS INTEGER)) % 32 + 1 AS BIGINT), 1)), '') AS payload_digest,
      CASE WHEN turn = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN turn > 1 THEN head END AS refers_to,
      url_key, row_number() OVER (ORDER BY url_key, captured, page_id) AS place,
      row_number() OVER (PARTITION BY url_key ORDER BY captured, page_id) AS capture
    FROM keyed""")
def op12_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    captures = warc.capture_index(staged(warc.read_archives(spark, path), "runs"))
    return captures.select(
        warc.page_id(F.col("record_id")).cast("long").alias("page_id"), "payload_bytes",
        F.coalesce("computed_digest", "payload_digest").alias("payload_digest"), F.col("type").alias("record_type"),
        warc.page_id(F.col("refers_to")).cast("long").alias("refers_to"), "url_key", "place", "capture")
