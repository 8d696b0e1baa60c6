import hashlib
import os

import pytest
from pyspark.sql import functions as F

from foliospark.functions.text import text_hash
from foliospark.operators.build import attach_content
from foliospark.operators.embedding import HashingEmbedder, needed_part
from foliospark.operators.stats import extraction_statistics
from foliospark.plans.indexing import IndexSettings, index_files, index_standard, index_vector, run_statistics
from foliospark.schemas import CHUNK_DOCUMENT, EMBEDDING_CACHE, INDEX_STATE, STANDARD_DOCUMENT
from foliospark.session import local_rows, read_table, scratch_path, setting, shared_folder, staged
from foliospark.sinks.cache import EmbeddingCache, fill, look_up
from foliospark.sinks.store import TableStore, erase_owner
from foliospark.sources.files import plain_path
from foliospark.streaming.ingest import ingest_stream, land_files, stream_files
from testkit import archives

EMBED = HashingEmbedder(32)
SMALL = IndexSettings(chunk_size=5, chunk_overlap=1, max_mb=1)


def write(path, text, mtime=1_700_000_000):
    path.write_text(text)
    os.utime(path, (mtime, mtime))


@pytest.fixture
def share(tmp_path):
    write(tmp_path / "a.txt", "one two three four five six seven")
    write(tmp_path / "b.txt", "short text here")
    write(tmp_path / "tiny.txt", " tiny  ")
    write(tmp_path / "big.txt", "x" * (2 * 2**20))
    (tmp_path / "d.docx").write_bytes(archives.docx_bytes(["alpha beta gamma delta"], [], "The Title", "Au Thor"))
    (tmp_path / "p.pptx").write_bytes(b"slides")
    return tmp_path


def stats(row):
    return {k: row[k] for k in ("total_files", "successful", "failed", "skipped", "oversize")}


def test_standard_run_counts_and_rows(spark, share):
    base = scratch_path(spark, "std")
    first = index_standard(spark, str(share), base, SMALL).first()
    assert stats(first) == {"total_files": 6, "successful": 4, "failed": 1, "skipped": 0, "oversize": 1}
    rows = {r["name"]: r for r in TableStore(spark, f"{base}/documents", STANDARD_DOCUMENT).read().collect()}
    assert set(rows) == {"a.txt", "b.txt", "tiny.txt", "d.docx"}
    assert (rows["d.docx"]["title"], rows["d.docx"]["author"], rows["a.txt"]["title"]) == ("The Title", "Au Thor", "a")
    assert rows["a.txt"]["createdBy"] == "Unknown" and rows["a.txt"]["url"] == str(share / "a.txt")


def test_incremental_runs_take_only_newer_files(spark, share):
    base = scratch_path(spark, "inc")
    index_standard(spark, str(share), base, SMALL)
    write(share / "a.txt", "changed but same time")
    write(share / "b.txt", "changed and older", 1_600_000_000)
    write(share / "tiny.txt", "changed and newer", 1_800_000_000)
    second = index_standard(spark, str(share), base, SMALL).first()
    # The failed file is tried again.
    assert stats(second) == {"total_files": 6, "successful": 1, "failed": 1, "skipped": 3, "oversize": 1}
    rows = {r["name"]: r["content"] for r in TableStore(spark, f"{base}/documents", STANDARD_DOCUMENT).read().collect()}
    assert rows["tiny.txt"] == "changed and newer" and rows["b.txt"] == "short text here"
    assert run_statistics(spark, f"{base}/statistics").first()["skipped"] == 3


def test_vector_run_chunks_cache_and_shrinking_file(spark, share):
    base = scratch_path(spark, "vec")
    first = index_vector(spark, str(share), base, SMALL, EMBED).first()
    assert stats(first) == {"total_files": 6, "successful": 3, "failed": 2, "skipped": 0, "oversize": 1}
    assert (first["total_chunks"], first["embedding_calls"]) == (4, 4)
    table = TableStore(spark, f"{base}/documents", CHUNK_DOCUMENT)
    chunks = [r["chunk"] for r in table.read().filter("name = 'a.txt'").orderBy("chunkNumber").collect()]
    assert chunks == ["one two three four five", "five six seven"]
    # The file shrinks and repeats a known text: no stale chunk stays, no new call is made.
    write(share / "a.txt", "short text here", 1_800_000_000)
    second = index_vector(spark, str(share), base, SMALL, EMBED).first()
    assert (second["successful"], second["embedding_calls"], second["total_chunks"]) == (1, 0, 1)
    assert [r["chunk"] for r in table.read().filter("name = 'a.txt'").collect()] == ["short text here"]
    assert table.read().count() == 3


def test_settings_hooks_manifest_and_first_chunk_content(spark, share):
    base = scratch_path(spark, "opt")
    settings = IndexSettings(chunk_size=5, chunk_overlap=1, content_in_first_chunk_only=True, extensions=(".txt",),
                             hooks=(~F.endswith("path", F.lit("b.txt")), F.col("length") < 1000))
    manifest = spark.createDataFrame([(str(share / "a.txt"), "dom\\ann")], "path string, owner string") \
        .withColumn("created_time", F.lit(None).cast("timestamp")).withColumn("accessed_time", F.lit(None).cast("timestamp"))
    row = index_vector(spark, [str(share)], base, settings, EMBED, manifest).first()
    assert (row["total_files"], row["successful"]) == (2, 1)
    rows = TableStore(spark, f"{base}/documents", CHUNK_DOCUMENT).read().orderBy("chunkNumber").collect()
    assert [r["content"] is None for r in rows] == [False, True] and rows[0]["createdBy"] == "dom\\ann"


def test_content_stays_when_the_first_chunk_has_no_vector(spark, share):
    base, ruled = scratch_path(spark, "ruled"), "-- -- -- -- -- one two three four five six seven eight"
    write(share / "ruled.txt", ruled)
    index_files(spark, [str(share / "ruled.txt")], base, vectors=True, settings=SMALL, embedder=EMBED)
    rows = TableStore(spark, f"{base}/documents", CHUNK_DOCUMENT).read().orderBy("chunkNumber").collect()
    assert [(r["chunkNumber"], r["content"]) for r in rows] == [(1, ruled), (2, None), (3, None)]


def scratch_folders(spark):
    return {n for n in os.listdir(shared_folder(spark)) if n.startswith("stage-")}


def test_runs_and_streams_leave_no_copies_behind(spark, share):
    before, base = scratch_folders(spark), scratch_path(spark, "clean")
    table = TableStore(spark, f"{base}/documents", CHUNK_DOCUMENT)
    state = TableStore(spark, f"{base}/state", INDEX_STATE)
    cache = EmbeddingCache(spark, f"{base}/embeddings")
    index_vector(spark, str(share), base, SMALL, EMBED)
    index_standard(spark, str(share), scratch_path(spark, "clean"), SMALL)
    ingest_stream(stream_files(spark, str(share), (".txt",), files_per_batch=2), table, state, cache, EMBED, f"{base}/checkpoint", SMALL)
    erase_owner(table, cache, "Unknown", text_hash("chunk"))
    assert table.read().count() == 0 and scratch_folders(spark) == before

    def failing(texts):
        raise RuntimeError("no model")
    with pytest.raises(RuntimeError):
        index_vector(spark, str(share), scratch_path(spark, "broken"), SMALL, failing)
    assert scratch_folders(spark) == before


def test_a_run_reads_the_folders_of_its_hashes(spark):
    cache = EmbeddingCache(spark, scratch_path(spark, "cache"), digits=1)
    known = local_rows(spark, [(f"text number {i}",) for i in range(300)], "chunk string")
    assert fill(cache, known, EMBED, None) == 300 and fill(cache, known, EMBED, None) == 0
    few = staged(local_rows(spark, [("a", "text number 7"), ("b", "new words"), ("c", None)], "id string, chunk string"), "few")
    part = needed_part(cache.read(), few, 1)
    assert "dynamicpruning" in part._jdf.queryExecution().executedPlan().toString()
    def folders(rows):
        return {r["folder"] for r in rows.select("folder").distinct().collect()}
    assert len(folders(cache.read())) == 16
    assert folders(part) == {text_hash_of("text number 7")[0], text_hash_of("new words")[0]}
    found = {r["id"]: r["contentVector"] is not None for r in look_up(cache, few).collect()}
    assert found == {"a": True, "b": False, "c": False}
    assert fill(cache, few.filter("chunk IS NOT NULL"), EMBED, None) == 1
    assert all(r["contentVector"] for r in look_up(cache, few.filter("id <> 'c'")).collect())
    # Erasure and compaction keep the layout, other digits lay it out anew.
    cache.erase(local_rows(spark, [(text_hash_of("new words"),)], "text_hash string"))
    other = EmbeddingCache(spark, cache.path, digits=2)
    other.compact()
    assert other.read().filter(F.length("folder") == 2).count() == 300
    assert [r["contentVector"] is not None for r in look_up(other, few).orderBy("id").collect()] == [True, False, False]


def text_hash_of(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_single_files(spark, share):
    base = scratch_path(spark, "one")
    write(share / "_hidden.txt", "taken when it is named")
    paths = [str(share / n) for n in ("b.txt", "_hidden.txt", "gone.txt")]
    row = index_files(spark, paths, base).first()
    assert stats(row) == {"total_files": 3, "successful": 2, "failed": 1, "skipped": 0, "oversize": 0}


def test_extraction_statistics(spark):
    rows = spark.createDataFrame([(".txt", None), (".txt", None), (".pdf", "bad"), (".docx", None)], "extension string, error string")
    row = extraction_statistics(rows).first()
    assert (row["total_extracted"], row["failed"], row["by_type"]) == (3, 1, {".txt": 2, ".docx": 1})


def test_stream_takes_each_file_once(spark, share):
    base = scratch_path(spark, "stream")
    table = TableStore(spark, f"{base}/documents", CHUNK_DOCUMENT)
    state = TableStore(spark, f"{base}/state", INDEX_STATE)
    cache = TableStore(spark, f"{base}/cache", EMBEDDING_CACHE, key="text_hash")

    def run():
        ingest_stream(stream_files(spark, str(share), (".txt",)), table, state, cache, EMBED, f"{base}/checkpoint", SMALL)

    run()
    assert table.read().count() == 3
    write(share / "new.txt", "a newly arrived file")
    run()
    assert table.read().count() == 4 and cache.read().count() == 4
    assert {r["name"] for r in table.read().collect()} == {"a.txt", "b.txt", "new.txt"}


def stream_tables(spark):
    base = scratch_path(spark, "stream")
    return base, TableStore(spark, f"{base}/documents", CHUNK_DOCUMENT), TableStore(spark, f"{base}/state", INDEX_STATE), \
        EmbeddingCache(spark, f"{base}/embeddings")


def test_batches_of_a_stream_are_indexed_together(spark, share):
    for group_bytes, commits in ((1 << 20, [1]), (1, [2, 3])):
        base, table, state, cache = stream_tables(spark)
        stream = stream_files(spark, str(share), (".txt",), files_per_batch=1)
        ingest_stream(stream, table, state, cache, EMBED, f"{base}/checkpoint", SMALL, group_bytes=group_bytes)
        assert sorted(os.path.basename(r["filePath"]) for r in state.read().collect()) == ["a.txt", "b.txt"]
        assert table.read().count() == 3 and len(state.commits()) in commits
        assert not os.path.exists(f"{base}/checkpoint-inbox")


def test_a_stream_goes_on_where_it_was_interrupted(spark, share):
    base, table, state, cache = stream_tables(spark)

    def run(embedder):
        ingest_stream(stream_files(spark, str(share), (".txt",), files_per_batch=1), table, state, cache, embedder, f"{base}/checkpoint", SMALL)

    def failing(texts):
        raise RuntimeError("no model")
    with pytest.raises(RuntimeError):
        run(failing)
    assert table.read().count() == 0
    run(EMBED)  # the stream has nothing new
    assert table.read().count() == 3 and state.read().count() == 2
    run(failing)  # and now there is nothing to index
    assert table.read().count() == 3


def test_a_batch_lands_whole_and_a_repeated_one_takes_its_place(spark, share, tmp_path):
    """Without the marks and checksums of Spark's writer, each of which is a file and a started program."""
    batch = spark.read.format("binaryFile").load(str(share)).withColumn("path", plain_path("path"))
    inbox = tmp_path / "inbox"
    for rows in (batch, batch.filter("length < 100"), batch.filter("length < 0")):
        size = land_files(rows, f"file://{inbox}/batch=7")
        found = [os.path.join(base, f) for base, _, names in os.walk(inbox) for f in names]
        assert all(f.endswith(".parquet") for f in found) and sum(map(os.path.getsize, found)) == size
        landed = spark.read.schema(rows.schema).parquet(*found).collect() if found else []
        assert sorted(landed) == sorted(rows.collect())


def test_a_setting_ends_with_its_block(spark):
    key = "spark.sql.sources.parallelPartitionDiscovery.threshold"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), setting(spark, key, "7"):
        assert spark.conf.get(key) == "7"
        raise RuntimeError
    assert spark.conf.get(key) == before


def test_long_texts_are_shuffled_once(spark):
    chunks = staged(local_rows(spark, [("a", 3), ("a", 1), ("a", 2), ("b", 0), ("c", 5)], "filePath string, chunkNumber int"), "chunks")
    contents = staged(local_rows(spark, [("a", "text a"), ("b", "text b"), ("d", "text d")], "filePath string, content string"), "contents")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        found = attach_content(chunks, contents)
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = {(r["filePath"], r["chunkNumber"], r["content"]) for r in found.collect()}
    assert rows == {("a", 1, "text a"), ("a", 2, None), ("a", 3, None), ("b", 0, "text b"), ("c", 5, None)}
    assert plan.count("Exchange hashpartitioning") == 3  # chunks, their numbers, contents


def test_chunks_are_deleted_before_the_table_is_written(spark, share, monkeypatch):
    upsert, seen = TableStore.upsert, []

    def look(self, *args, **options):
        seen.append([f for f in os.listdir(shared_folder(spark)) if f.startswith("stage-chunks") and f not in before])
        return upsert(self, *args, **options)

    before = set(os.listdir(shared_folder(spark)))
    monkeypatch.setattr(TableStore, "upsert", look)
    index_vector(spark, str(share), scratch_path(spark, "cut"), SMALL, EMBED)
    assert len(seen) == 2 and not any(seen)


def test_a_table_of_many_files_is_not_copied(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    for files, name in ((cores, "many"), (1, "one")):
        spark.range(200).repartition(files).write.parquet(str(tmp_path / name))
        read = read_table(spark, str(tmp_path / name), "id")
        assert read.count() == 200 and ("stage-spread" in read.inputFiles()[0]) == (name == "one")
