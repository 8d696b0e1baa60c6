import os

from pyspark.sql import functions as F

from foliospark.session import local_rows
from foliospark.sinks.folders import write_text_files
from foliospark.sources.walk import walk

ROWS = [("a", "x", "plain"), ("b\nc", "x", "with/slash=é"), (None, None, ""), ("", "y", "plain"), ("a", "x", "plain")]


def tree(root):
    return sorted((os.path.relpath(base, root), open(os.path.join(base, f), "rb").read()) for base, _, files in os.walk(root)
                  for f in files if f.endswith(".txt"))


def test_files_and_folders_equal_those_of_sparks_writer(spark, tmp_path):
    rows = local_rows(spark, ROWS, "text string, one string, two string")
    assert write_text_files(rows, str(tmp_path / "ours"), by=("one", "two")) == 5
    rows.write.partitionBy("one", "two").option("maxRecordsPerFile", 1).text(str(tmp_path / "sparks"))
    assert tree(tmp_path / "ours") == tree(tmp_path / "sparks") and len(tree(tmp_path / "ours")) == 5


def test_one_file_for_each_row_and_nothing_else(spark, tmp_path):
    """Spark's writer leaves a checksum file beside each file and renames it twice."""
    rows = spark.range(300).select(F.concat(F.lit("t"), "id").alias("text"), (F.col("id") % 3).alias("k"))
    assert write_text_files(rows, f"file://{tmp_path}/many", by=["k"]) == 300
    found = [f for _, _, files in os.walk(tmp_path / "many") for f in files]
    assert len(found) == 300 and all(f.endswith(".txt") for f in found)
    assert walk(spark, str(tmp_path / "many")).count() == 300


def test_no_rows_give_an_empty_folder(spark, tmp_path):
    assert write_text_files(local_rows(spark, [], "text string"), str(tmp_path / "none")) == 0
    assert walk(spark, str(tmp_path / "none")).count() == 0
