"""Exact deduplication by a stream with keyed state, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import SPACE, salt_of
from foliospark.session import in_few_files, scratch_path, staged

_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # Without reserving megabytes of disk for each state partition, of which small inputs fill little.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def normalised(text: Column) -> Column:
    """Text with each run of blanks, tabs and line ends as one blank; null as empty text."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def first_seen(keyed: DataFrame, path: str, files_per_batch: int) -> DataFrame:
    """Run the stored rows of ``path`` through a stream that keeps one state row per digest and salt, for ever.

    State is on disk (RocksDB), has no expiry and retains the digest, the smallest id, where that row's text lies
    and the number of rows. Every batch writes the state rows it changed to a folder of its own, which a repeated
    batch overwrites; the count of a key only grows, so its last row is the one with the largest count.
    """
    spark = keyed.sparkSession
    out = scratch_path(spark, "first-seen")
    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        def state_of(rows: DataFrame) -> DataFrame:
            return rows.groupBy("digest", "salt").agg(F.min(F.struct("id", "locator")).alias("first"), F.count("*").alias("n"))

        state_of(keyed.limit(0)).write.parquet(f"{out}/batch=none")  # so that an input without rows can be read too
        state = state_of(spark.readStream.schema(keyed.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path))
        query = (state.writeStream.outputMode("update").trigger(availableNow=True)
                 .option("checkpointLocation", scratch_path(spark, "dedup-state"))
                 .foreachBatch(lambda rows, batch: in_few_files(rows).write.mode("overwrite").parquet(f"{out}/batch={batch}"))
                 .start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    changed = spark.read.schema(state.schema).parquet(out)
    return changed.groupBy("digest", "salt").agg(F.min("first").alias("first"), F.max("n").alias("n"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256,
                     files_per_batch: int = 2000) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``keep_locator``.

    Texts are equal when they are the same bytes after each run of white space became one blank. Their digests go
    through a stream with keyed state; rows whose digest was seen more than once are hits, and the full bytes of all
    hits are then compared, copies within a task first, so that a text held by a third of all rows is one row per
    task. Digests that different texts share are taken apart by the bytes.

    Null texts count as empty, and empty texts are copies of each other. Of several rows with the smallest id and the
    same text one is kept. A null id never wins against another one; rows that are all null in a group keep one row
    with a null ``keep_id``. An empty table gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("id"), normalised(docs[text_col]).alias("bytes"), F.input_file_name().alias("locator"))
    keyed = rows.withColumn("digest", digest(F.col("bytes"))).withColumn("salt", salt_of(spark, "id"))
    path = scratch_path(spark, "digests")
    keyed.select("id", "locator", "digest", "salt").write.parquet(path)
    stored = spark.read.parquet(path)
    seen = first_seen(stored, path, files_per_batch)
    whole = _class_of(seen)
    # Each row's text is needed only where its digest was a hit; the others drop it here.
    marked = keyed.drop("locator").join(whole.hint("shuffle_hash"), ["digest", "salt"]).select(
        "id", "digest", "salt", "keep_id", "locator", "size", F.when(F.col("size") > 1, F.col("bytes")).alias("bytes"))
    marked = staged(marked, "marked")
    texts = marked.where("size > 1").groupBy("digest", "bytes").agg(F.min("id").alias("true_id"), F.count("*").alias("true_size"))
    shared = staged(texts.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1"), "shared-digests")
    if not shared.isEmpty():
        true = texts.join(shared, "digest").select("digest", "bytes", "true_id", "true_size")
        marked = marked.join(true, ["digest", "bytes"], "left").withColumn(
            "keep_id", F.when(F.col("true_size").isNotNull(), F.col("true_id")).otherwise(F.col("keep_id"))).withColumn(
            "size", F.coalesce("true_size", "size")).withColumn(
            "locator", F.when(F.col("true_size").isNull(), F.col("locator")))
        text_of = F.coalesce("bytes", F.lit(""))
    else:
        text_of = F.lit("")
    turn = F.row_number().over(Window.partitionBy("digest", "salt", text_of, "id").orderBy(F.lit(1)))
    return marked.withColumn("turn", turn).select(
        F.col("id").alias(id_col), "keep_id", F.col("size").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), F.col("locator").alias("keep_locator"))


def _class_of(seen: DataFrame) -> DataFrame:
    """Join the salts of a digest: at most one row per salt meets in a window, whatever the number of copies."""
    all_salts = Window.partitionBy("digest")
    known = F.when(F.col("first.id").isNotNull(), F.col("first"))
    best = F.coalesce(F.min(known).over(all_salts), F.col("first"))
    return seen.select("digest", "salt", F.sum("n").over(all_salts).alias("size"), best.alias("best")).select(
        "digest", "salt", "size", F.col("best.id").alias("keep_id"), F.col("best.locator").alias("locator"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rules for nulls and ties as in `exact_duplicates`."""
    def id_text(column: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))

    kept = exact_duplicates(docs, id_col, text_col).where("kept").select(
        F.unhex("text_sha256").alias("digest"), id_text(F.col(id_col)).alias("of"))
    whole = docs.select(F.struct("*").alias("doc"), sha256(normalised(docs[text_col])).alias("digest"),
                        id_text(docs[id_col]).alias("of"))
    # Repeated rows of one id and text are left side by side by this join; one of them stays.
    joined = whole.join(kept.hint("shuffle_hash"), ["digest", "of"], "left_semi")
    return joined.dropDuplicates(["digest", "of"]).select("doc.*")
