import random
import re
import time
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.operators import keyword
from foliospark.operators.term_index import StaleIndex, TermIndex
from foliospark.plans.search import SearchTable
from foliospark.session import local_rows, scratch_path, staged
from foliospark.sinks.store import TableStore

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "filePath", "content", "extension")])


@pytest.fixture
def table(spark):
    return TableStore(spark, scratch_path(spark, "table"), SCHEMA, compact_after=1000)


def rows(spark, *items):
    return local_rows(spark, [(i, f, text, ".txt") for i, f, text in items], SCHEMA)


def agrees(table, index, query="w1 w3 w9"):
    now = index.snapshot(table)
    live = table.read()
    assert sorted(map(tuple, now.scores(query).collect())) == sorted(map(tuple, keyword.keyword_scores(live, query).collect()))
    texts = [re.findall(r"\w+", r["content"] or "") for r in live.collect()]
    assert (now.documents, now.tokens) == (len(texts), sum(map(len, texts)))
    df = Counter(w for t in texts for w in set(t))
    terms = ["w1", "w3", "w9", "absent"]
    assert {r["term"]: r["doc_freq"] for r in now.document_frequencies(terms).collect()} == {t: df[t] for t in terms if df[t]}


def test_the_index_follows_random_commits(spark, table):
    dice = random.Random(4)
    index = TermIndex(spark, scratch_path(spark, "index"), per_file=30, fan_in=2)
    for step in range(8):
        files = dice.sample(range(12), dice.randint(1, 5))
        if step in (3, 7):
            table.erase(local_rows(spark, [(f"f{f}",) for f in files], "filePath string"))
        else:
            table.upsert(rows(spark, *[(f"f{f}-{c}", f"f{f}", " ".join(f"w{dice.randint(0, 9)}" for _ in range(dice.randint(0, 12))) or None)
                                       for f in files for c in range(dice.randint(1, 3))]), key="id" if step == 5 else None)
        if step == 4:
            table.compact()  # the index has not seen the last commit
        if step in (2, 3, 6):
            assert index.refresh(table) >= 1
            agrees(table, index)
    index.refresh(table)
    table.compact()  # it has seen everything
    assert index.refresh(table) == 1 and index.refresh(table) == 0
    agrees(table, index)
    assert len(index.snapshot(table).segments) <= 4


def test_an_index_behind_its_table_is_not_used(spark, table):
    index = TermIndex(spark, scratch_path(spark, "index"))
    assert index.version == -1 and index.snapshot(table).search("w1").count() == 0
    table.upsert(rows(spark, ("1", "a", "w1 w2"), ("2", "b", None)))
    with pytest.raises(StaleIndex):
        index.snapshot(table)
    with pytest.raises(StaleIndex):
        SearchTable.of_store(table, index, refresh=False)
    asked = SearchTable.of_store(table, index)
    table.upsert(rows(spark, ("1", "a", "other")))
    # A search table goes on with the rows and the index of its time; a new one sees the commit.
    assert [r["id"] for r in asked.keyword("w1").collect()] == ["1"]
    assert SearchTable.of_store(table, index).keyword("w1").count() == 0
    with pytest.raises(ValueError, match="replaced by"):
        table.upsert(rows(spark, ("3", "c", "w1")), key="extension")
        index.refresh(table)


def test_small_segments_are_merged_and_superseded_folders_deleted(spark, table):
    index = TermIndex(spark, scratch_path(spark, "index"), fan_in=3)
    for i in range(7):
        table.upsert(rows(spark, (f"{i}", f"f{i}", f"w1 w{i}")))
        index.refresh(table)
    segments = index.snapshot(table).segments
    assert [s.tier for s in segments] == [1, 1, 0] and sum(s.postings for s in segments) == 13
    folders = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(index.path).select("path")
    found = {re.search(r"segment-\w+", r["path"])[0] for r in folders.collect() if "segment-" in r["path"]}
    assert {s.folder for s in segments} == found
    agrees(table, index)


def test_a_search_reads_the_buckets_of_its_words_and_no_text(spark, table):
    index = TermIndex(spark, scratch_path(spark, "index"), per_file=20)
    table.upsert(rows(spark, *[(str(i), f"f{i}", f"w{i % 7} hot w{i}") for i in range(60)]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would put so few rows into one file
    try:
        asked = SearchTable.of_store(table, index)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    [segment] = asked.postings.segments
    assert segment.buckets > 3
    hot = spark.read.parquet(f"{index.path}/{segment.folder}/postings").filter("term = 'hot'")
    assert hot.select(F.input_file_name()).distinct().count() > 1  # 60 postings, 20 per file
    plan = asked.postings.scores("w3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "content" not in plan
    filtered = asked.keyword("hot", where=F.col("extension") == ".txt")._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in filtered.split("LeftSemi")[-1].split("Relation")[0]


def test_a_filtered_search_reads_only_the_columns_of_its_filter(spark, table):
    index = TermIndex(spark, scratch_path(spark, "index"))
    table.upsert(rows(spark, *[(str(i), f"f{i}", f"w{i % 3} text") for i in range(9)]))
    asked = SearchTable.of_store(table, index)
    where = F.col("extension") == ".txt"
    for found in (asked._keyword_scores("w1", where), asked.facets("w1", ["extension"], where)):
        scans = re.findall(r"FileScan parquet [^\n]*", found._jdf.queryExecution().executedPlan().toString())
        of_table = [s for s in scans if "extension#" in s]
        assert of_table and all("content" not in s for s in scans)
        assert any("EqualTo(extension,.txt)" in s for s in of_table)


def test_rows_have_dense_numbers_and_postings_hold_no_ids(spark, table):
    index = TermIndex(spark, scratch_path(spark, "index"), fan_in=2)
    for first in (0, 30):
        table.upsert(rows(spark, *[(str(i), f"f{i}", f"w{i % 3} w{i}") for i in range(first, first + 40)]).repartition(3))
        index.refresh(table)
    [segment] = index.snapshot(table).segments  # merged; the ten files that came twice have their later rows
    docs = {r["number"]: r["id"] for r in index._docs(segment.folder).collect()}
    assert len(docs) == 70 == len(set(docs.values())) and max(docs) == 79
    written = spark.read.parquet(f"{index.path}/{segment.folder}/postings")
    assert set(written.columns) == {"term", "number", "tf", "bucket"}
    assert {(docs[r["number"]], r["term"]) for r in written.collect()} >= {(str(i), f"w{i}") for i in range(70)}
    agrees(table, index)


def test_rows_that_are_gone_are_looked_up_in_bitmaps(spark, table):
    """Across the edges of bytes and bitmaps, and without a shuffle of postings however many rows are gone."""
    gone = [0, 7, 8, 32_767, 32_768, 39_999]
    table.upsert(spark.range(40_000).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("f"), "id").alias("filePath"),
                                            F.lit("w1").alias("content"), F.lit(".txt").alias("extension")).repartition(1, "id"))
    index = TermIndex(spark, scratch_path(spark, "index"), fan_in=9)
    index.refresh(table)
    numbers = {r["number"]: r["id"] for r in index._all_docs(index.snapshot(table).segments).collect()}
    table.erase(local_rows(spark, [(f"f{numbers[n]}",) for n in gone], "filePath string"))
    index.refresh(table)
    now = index.snapshot(table)
    assert (now.documents, now.tokens) == (39_994, 39_994)
    assert {r["id"] for r in now.hits(["w1"]).collect()} == set(numbers.values()) - {numbers[n] for n in gone}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = now._found(["w1"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def shuffle_files(spark):
    """Data files of shuffles in the folders of the block manager."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles())
            if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}


def test_a_written_step_leaves_no_shuffle_files(spark):
    """They stayed until the driver collected its garbage."""
    before = shuffle_files(spark)
    staged(spark.range(1000).repartition(3, "id"), "some")
    for _ in range(50):  # the executors are told to delete them and nobody waits for it
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before


def test_numbers_are_written_as_differences(spark, table):
    index = TermIndex(spark, scratch_path(spark, "index"))
    table.upsert(rows(spark, *[(str(i), f"f{i}", "w1 w2") for i in range(500)]))
    index.refresh(table)
    [segment] = index.snapshot(table).segments
    path = spark.read.parquet(f"{index.path}/{segment.folder}/postings").inputFiles()[0]
    group = pq.ParquetFile(path.removeprefix("file://")).metadata.row_group(0)
    encodings = {group.column(i).path_in_schema: group.column(i).encodings for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in encodings["number"] and "RLE_DICTIONARY" in encodings["term"]
    agrees(table, index)
