import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.operators import stats
from foliospark.schemas import CHUNK_DOCUMENT
from foliospark.session import scratch_path, shared_folder
from foliospark.sinks import clustered, export
from foliospark.sinks.catalog import SearchTableCatalog
from foliospark.sinks.store import TableStore, latest_version

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("filePath", T.StringType()), T.StructField("n", T.IntegerType())])


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def content(store):
    return sorted(tuple(r) for r in store.read().collect())


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_path(spark, "t"), SCHEMA)


def test_empty_table_reads_as_no_rows(store):
    assert content(store) == []


def test_replacing_a_file_drops_its_surplus_rows(spark, store):
    assert store.upsert(rows(spark, ("a0", "a", 1), ("a1", "a", 1), ("b0", "b", 1))) == 3
    store.upsert(rows(spark, ("a0", "a", 2)))
    assert content(store) == [("a0", "a", 2), ("b0", "b", 1)]


def test_upsert_by_id_keeps_surplus_rows(spark, store):
    store.upsert(rows(spark, ("a0", "a", 1), ("a1", "a", 1)))
    store.upsert(rows(spark, ("a0", "a", 2)), key="id")
    assert content(store) == [("a0", "a", 2), ("a1", "a", 1)]
    # Both kinds of commits in one table, then a clean folder.
    store.upsert(rows(spark, ("a0", "a", 3)))
    store.compact()
    assert content(store) == [("a0", "a", 3)]
    assert len(store.commits()) == 1


def test_erase_append_and_rewrite(spark, store):
    store.append(rows(spark, ("a0", "a", 1), ("b0", "b", 1)))
    store.erase(rows(spark, ("x", "a", 0)))
    assert content(store) == [("b0", "b", 1)]
    store.append(rows(spark, ("a9", "a", 9)))
    assert content(store) == [("a9", "a", 9), ("b0", "b", 1)]


def test_a_tagged_commit_happens_once(spark, store):
    assert store.append(rows(spark, ("a0", "a", 1)), tag="batch-1") == 1
    assert store.append(rows(spark, ("a0", "a", 1)), tag="batch-1") == 0
    assert content(store) == [("a0", "a", 1)]


def test_unfinished_commit_is_invisible(spark, store):
    store.append(rows(spark, ("a0", "a", 1)))
    rows(spark, ("zz", "z", 0)).write.parquet(f"{store.path}/commit-lost/rows")
    assert content(store) == [("a0", "a", 1)]


def test_many_commits_are_compacted(spark):
    store = TableStore(spark, scratch_path(spark, "t"), SCHEMA, compact_after=2)
    for n in range(4):
        store.upsert(rows(spark, ("a0", "a", n)))
    assert content(store) == [("a0", "a", 3)] and len(store.commits()) <= 2


def test_latest_version(spark):
    old = rows(spark, ("a0", "a", 1), ("a0", "a", 5), ("b0", "b", 2))
    assert sorted(tuple(r) for r in latest_version(old, "id", "n").collect()) == [("a0", "a", 5), ("b0", "b", 2)]


def test_catalog_lifecycle(spark):
    place = scratch_path(spark, "tables")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lifecycle LOCATION '{place}'")
    tables = SearchTableCatalog(spark, "lifecycle", place)
    assert tables.create_standard("plain") and tables.create_standard("plain")
    assert tables.create_vector("vectors", 3)
    assert tables.names() == ["plain", "vectors"] and tables.dimensions("vectors") == 3
    assert tables.table("vectors").columns == CHUNK_DOCUMENT.fieldNames()
    good = spark.createDataFrame([("i", [1.0, 0.0, 0.0])], "id string, contentVector array<float>")
    tables.insert("vectors", good)
    assert tables.statistics("vectors").first()["documentCount"] == 1
    with pytest.raises(Exception, match="must have 3 dimensions"):
        tables.insert("vectors", good.withColumn("contentVector", F.slice("contentVector", 1, 2)))
    assert {r["table"]: r["documents"] for r in tables.all_statistics().collect()} == {"plain": 0, "vectors": 1}
    assert tables.delete("plain") is True and tables.delete("plain") is False


def test_audit_rows_round_trip(spark):
    path = scratch_path(spark, "audit")
    events = spark.createDataFrame([("a.txt", "ok")], "r string, s string")
    entries = export.audit_rows(events, F.lit("INDEX_DOCUMENT"), F.lit("system"), F.col("r"), F.col("s"), F.current_timestamp(),
                                F.create_map(F.lit("chunks"), F.lit("5")))
    export.audit_append(entries, path)
    export.audit_append(export.audit_rows(events, F.lit("X"), F.lit("u"), F.col("r"), F.col("s"), F.current_timestamp()), path)
    read = {r["action"]: r["details"] for r in export.read_audit(spark, path).collect()}
    assert read == {"INDEX_DOCUMENT": {"chunks": "5"}, "X": {}}


def test_shared_folder_is_read_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_rows_of_near_values_share_files(spark, tmp_path):
    rows = [(i, f"owner{i % 50:02d}", i * 7919 % 5000, None if i % 9 == 0 else f"k{i % 3}") for i in range(6000)]
    rows += [(10_000 + i, "owner07", 1, "k1") for i in range(3000)]  # a third of all rows in one place
    df = spark.createDataFrame(rows, "id long, owner string, day int, kind string")
    path = str(tmp_path / "clustered")
    clustered.write_clustered(df, path, ["owner", "day"], files=32)
    table = spark.read.parquet(path)
    assert sorted(table.collect(), key=lambda r: r.id) == sorted(df.collect(), key=lambda r: r.id)
    ends = clustered.value_ranges(table, ["owner", "day"]).collect()
    one = [r for r in ends if r.low_owner <= "owner30" <= r.high_owner]
    both = [r for r in one if r.low_day <= 2500 <= r.high_day]
    assert len(ends) >= 24 and len(one) <= len(ends) // 2 and len(both) <= len(ends) // 4
    held = [r["n"] for r in table.groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n")).collect()]
    assert max(held) <= 3000  # the hot place is dealt over several files


def test_clustering_of_awkward_values(spark, tmp_path):
    schema = "id long, a string, b timestamp, c date, d double"
    for n, rows in enumerate(([], [(1, None, None, None, None)] * 3, [(i, "same", None, None, float("nan")) for i in range(5)])):
        df = spark.createDataFrame(rows, schema)
        clustered.write_clustered(df, str(tmp_path / str(n)), ["a", "b", "c", "d"], files=4)
        assert spark.read.schema(schema).parquet(str(tmp_path / str(n))).count() == len(rows)


def test_versions_are_compared_in_differing_ranges_only(spark):
    one = spark.range(5000).select(F.concat(F.lit("f"), "id").alias("filePath"), (F.col("id") % 17).alias("v"))
    other = one.filter("filePath <> 'f7'").withColumn("v", F.when(F.col("filePath") == "f9", None).otherwise(F.col("v"))) \
        .unionByName(one.limit(1).withColumn("filePath", F.lit("new")))
    got = {tuple(r) for r in stats.verify_versions(one, other, version="v", ranges=64).collect()}
    assert got == {("f7", "missing in table"), ("f9", "other version"), ("new", "missing in source")}
    assert {tuple(r) for r in stats.verify_versions(one, other, ranges=1).collect()} == {("f7", "missing in table"), ("new", "missing in source")}
    assert stats.differing_ranges(one, other, "filePath", F.col("v"), 512).count() <= 3
    assert stats.verify_versions(one, one.repartition(3), version="v").count() == 0
    assert stats.verify_versions(one.limit(0), one.limit(0), version="v").count() == 0
