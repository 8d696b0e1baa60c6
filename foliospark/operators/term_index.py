"""A term index that follows its table: posting segments, one per commit, merged as they grow in number.

Every row that a commit brings gets a number of its own, by its place in the commit's files. A segment is a folder of plain
Parquet: ``postings`` (term, number, tf) in folders by a hash bucket of the term, sorted by term and number, ``docs`` (number, id,
key, length), and ``removed`` (number), the rows of earlier segments that its commit replaced or erased. The number of
buckets follows the size of the segment, and a word that is common in it is dealt over as many files as its measured
count asks for. Numbers are dense, so those removed are bitmaps of a bit per row, which are broadcast: postings are looked up
in them and never shuffled to be told from those that are gone. Ids are joined to the hits of a query. Number of documents
and of tokens are kept up to date by each refresh, which adds what a commit brought and subtracts what it removed.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.functions.scoring import bm25, rounded
from foliospark.functions.text import query_terms
from foliospark.operators.keyword import field_tokens
from foliospark.operators.postings import postings
from foliospark.operators.topk import top
from foliospark.session import freeing_shuffles, local_rows, remove_folder
from foliospark.sinks.store import TableStore, read_or_empty

POSTINGS_PER_FILE = 2_000_000
MOST_BUCKETS = 4096
#: So many segments of one size tier are merged into one of the next; a tier is so many times larger than the one before.
FAN_IN = 4

#: Sorted numbers are written as differences, which take a byte or two.
ENCODING = {"compression": "zstd", "parquet.writer.version": "v2", "parquet.enable.dictionary#number": "false"}

SEGMENT = T.StructType([T.StructField("folder", T.StringType()), T.StructField("version", T.LongType()),
                        T.StructField("postings", T.LongType()), T.StructField("tier", T.IntegerType()), T.StructField("buckets", T.IntegerType())])
STATE = T.StructType([
    T.StructField("number", T.LongType()), T.StructField("table_version", T.LongType()), T.StructField("documents", T.LongType()),
    T.StructField("tokens", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("segments", T.ArrayType(SEGMENT)), T.StructField("obsolete", T.ArrayType(T.StringType()))])


#: Rows of one bitmap, as Spark's bitmap functions make them.
BITMAP_ROWS = 32_768


class StaleIndex(ValueError):
    """The index has not seen all commits of its table, or has seen more than a reader."""


@dataclass(frozen=True)
class Segment:
    folder: str
    version: int
    postings: int
    tier: int
    buckets: int


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _numbered(rows: DataFrame, first: int) -> tuple[DataFrame, int]:
    """The rows of stored files with ``number``, counted from ``first`` in the order of the files; returns the next number as well.

    A row's number is that of its file's first row, for which the driver gets one count per file, and its place in the file,
    so it is the same in every job that reads the files.
    """
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    begins = []
    for count in sorted(placed.groupBy("_file").count().collect()):
        begins.append((count["_file"], first))
        first += count["count"]
    begin = local_rows(rows.sparkSession, begins, "_file string, _begin long")
    return placed.join(F.broadcast(begin), "_file").withColumn("number", F.col("_begin") + F.col("_row")).drop("_file", "_row", "_begin"), first


def _written(docs: DataFrame, path: str, words: Column | None = None) -> tuple[int, int, int]:
    """Write (number, ..., length) and return how many rows, tokens and, by ``words``, postings there were, observed by the same job."""
    seen = Observation()
    with freeing_shuffles(docs.sparkSession):
        docs.withColumn("_words", F.lit(0) if words is None else words).observe(
            seen, F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"),
            F.coalesce(F.sum("_words"), F.lit(0)).alias("postings")).drop("_words", "_tokens").write.option("compression", "zstd").parquet(path)
    return seen.get["documents"], seen.get["tokens"], seen.get["postings"]


class TermIndex:
    """The term index of one `TableStore`, in the folder ``path``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, fields: Sequence[str] = ("content",), id_col: str = "id", key: str = "filePath",
                 per_file: int = POSTINGS_PER_FILE, fan_in: int = FAN_IN):
        self.spark, self.path, self.fields, self.id_col, self.key = spark, path.rstrip("/"), tuple(fields), id_col, key
        self.per_file, self.fan_in = per_file, fan_in
        self._made: list[str] = []  # folders that this refresh has written

    # ---- state

    def _state(self) -> Row | None:
        # An index of ids, from before rows had numbers, counts as none and is built anew.
        rows = read_or_empty(self.spark, f"{self.path}/state", STATE).filter(F.col("rows").isNotNull())
        return rows.orderBy(F.desc("number")).first()  # one row per refresh, the newest one counts

    def _save(self, before: Row | None, version: int, documents: int, tokens: int, rows: int, segments: list[Segment]) -> None:
        kept = {s.folder for s in segments}
        # Folders that are superseded now stay until the next refresh, for searches that have begun.
        old = sorted({s["folder"] for s in before["segments"]} - kept) if before else []
        row = ((before["number"] + 1) if before else 0, version, documents, tokens, rows,
               [(s.folder, s.version, s.postings, s.tier, s.buckets) for s in segments], old)
        local_rows(self.spark, [row], STATE).coalesce(1).write.mode("append").parquet(f"{self.path}/state")
        for folder in (before["obsolete"] if before else []):
            remove_folder(self.spark, f"{self.path}/{folder}")

    @property
    def version(self) -> int:
        """The table's version that the index has seen; -1 before the first refresh."""
        state = self._state()
        return state["table_version"] if state else -1

    # ---- writing

    def refresh(self, table: TableStore) -> int:
        """Take in the commits since the last refresh; returns how many there were.

        The work is that of the new rows and of the removed ones. If the table was compacted and the commits in between
        are gone, the index is built anew from the clean folder.
        """
        state, commits = self._state(), table.commits()
        seen = state["table_version"] if state else -1
        new = [c for c in commits if c["version"] > seen]
        if not new:
            return 0
        self._made = []
        segments = [Segment(**s.asDict()) for s in state["segments"]] if state else []
        documents, tokens, rows = (state["documents"], state["tokens"], state["rows"]) if state else (0, 0, 0)
        for commit in new:
            if commit["kind"] == "base":
                if commit["version"] == seen + 1 and state:
                    seen += 1  # the same rows in a clean folder
                    continue
                segments, documents, tokens = [], 0, 0
            seen = commit["version"]
            gained, lost, segment, rows = self._segment(table, commit, segments, rows)
            documents, tokens = documents + gained[0] - lost[0], tokens + gained[1] - lost[1]
            segments = self._merged([*segments, segment])
        self._save(state, seen, documents, tokens, rows, segments)
        for folder in set(self._made) - {s.folder for s in segments}:  # merged before anybody could read them
            remove_folder(self.spark, f"{self.path}/{folder}")
        return len(new)

    def _folder(self) -> str:
        self._made.append(f"segment-{uuid.uuid4().hex}")
        return self._made[-1]

    def _segment(self, table: TableStore, commit: Row, earlier: list[Segment],
                 first: int) -> tuple[tuple[int, int], tuple[int, int], Segment, int]:
        """Write the segment of one commit, whose rows are numbered from ``first``: what it adds and removes as (documents,
        tokens), the segment, and the next number."""
        folder = self._folder()
        lost = (0, 0, 0)
        if commit["key"] and earlier:
            if commit["key"] not in (self.id_col, self.key):
                raise ValueError(f"rows were replaced by {commit['key']}, the index knows {self.id_col} and {self.key}")
            name = "id" if commit["key"] == self.id_col else "key"
            keys = table.replaced_keys(commit).select(F.col(commit["key"]).alias(name))
            gone = self._live_docs(earlier).join(keys, name, "left_semi").select("number", "length")
            lost = _written(gone, f"{self.path}/{folder}/removed")
        if commit["kind"] == "erase":
            return (0, 0), lost[:2], Segment(folder, commit["version"], 0, 0, 0), first
        rows, following = _numbered(table.rows_of(commit), first)
        key = F.col(self.key) if self.key in rows.columns else F.lit(None)
        tokens = rows.select("number", F.col(self.id_col).cast("string").alias("id"), key.cast("string").alias("key"),
                             field_tokens(self.fields).alias("_tokens"))
        docs, words, size = _written(tokens.select("number", "id", "key", F.size("_tokens").alias("length"), "_tokens"),
                                     f"{self.path}/{folder}/docs", F.size(F.array_distinct("_tokens")))
        terms = tokens.select(F.explode(F.array_distinct("_tokens")).alias("term"))
        found = postings(rows, self.fields, "number").select("term", F.col("id").alias("number"), "tf")
        # Rows of one word that lie together take about half the place in the shuffle.
        size, buckets = self._write(found.sortWithinPartitions("term", "number"), terms, size, folder, "number")
        return (docs, words), lost[:2], Segment(folder, commit["version"], size, self._tier(size), buckets), following

    def _write(self, found: DataFrame, terms: DataFrame, most: int, folder: str, row: str = "id") -> tuple[int, int]:
        """Write postings by bucket and sorted by term and ``row``; returns their number and that of the buckets.

        There are at most ``most`` postings, and ``terms`` has at least one row for each of them, its word. Both are known
        before the postings are made, which so are shuffled and written once and never kept beside.
        """
        buckets, shares, seen = min(MOST_BUCKETS, max(1, math.ceil(most / self.per_file))), [], Observation()
        found = found.observe(seen, F.count(F.lit(1)).alias("size"))
        if buckets > 1:  # else no word can be that common; there are fewer than most / per_file such words
            common = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > self.per_file)
            share = F.pmod(F.xxhash64(row), F.ceil(F.coalesce("n", F.lit(1)) / self.per_file))
            found, shares = found.join(F.broadcast(common), "term", "left").withColumn("share", share).drop("n"), ["share"]
        bucket = _bucket(F.col("term"), buckets)  # made from the term on both sides of the shuffle, so that it does not travel
        dealt = found.repartition(bucket, *shares).drop(*shares)
        with freeing_shuffles(self.spark):
            dealt.withColumn("bucket", bucket).sortWithinPartitions("bucket", "term", row).write.options(**ENCODING) \
                .partitionBy("bucket").parquet(f"{self.path}/{folder}/postings")
        return seen.get["size"], buckets

    def _tier(self, size: int) -> int:
        return max(0, math.floor(math.log(max(1, size) / self.per_file, self.fan_in)) + 1) if size > self.per_file else 0

    def _merged(self, segments: list[Segment]) -> list[Segment]:
        """Merge the newest segments, up to one of a higher tier, when ``fan_in`` of them are of one tier.

        Only neighbours in time are merged, so that what a segment removes stays later than what it removes it from.
        """
        tier = 0
        while tier <= max((s.tier for s in segments), default=-1):
            first = len(segments)
            while first and segments[first - 1].tier <= tier:
                first -= 1
            run = segments[first:]
            if sum(s.tier == tier for s in run) >= self.fan_in:
                segments = [*segments[:first], self._merge(run, first == 0, tier + 1)]
            tier += 1
        return segments

    def _merge(self, run: list[Segment], oldest: bool, tier: int) -> Segment:
        folder = self._folder()
        with freeing_shuffles(self.spark):
            self._live_docs(run).write.option("compression", "zstd").parquet(f"{self.path}/{folder}/docs")
            if not oldest:  # there are earlier rows that these removals hide
                _union([self._removed(s.folder) for s in run]).write.option("compression", "zstd").parquet(f"{self.path}/{folder}/removed")
        every = self._postings(run)
        size, buckets = self._write(self._live(run, every), every.select("term"), sum(s.postings for s in run), folder, "number")
        for s in run:  # made by this refresh and read by nobody else
            if s.folder in self._made:
                remove_folder(self.spark, f"{self.path}/{s.folder}")
        return Segment(folder, run[-1].version, size, max(tier, self._tier(size)), buckets)

    # ---- reading

    def _docs(self, folder: str) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/{folder}/docs", T.StructType.fromDDL("number long, id string, key string, length int"))

    def _removed(self, folder: str) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/{folder}/removed", T.StructType.fromDDL("number long, length int"))

    def _postings(self, segments: list[Segment], terms: list[str] | None = None) -> DataFrame:
        """Postings of all segments, of the given words only if there are any."""
        parts = [self._segment_postings(s, terms) for s in segments if s.postings]
        return _union(parts) if parts else local_rows(self.spark, [], "term string, number long, tf int")

    def _segment_postings(self, segment: Segment, terms: list[str] | None) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.path}/{segment.folder}/postings")
        if terms is not None:  # constants, for the pruning of folders and row groups
            words = local_rows(self.spark, [(t,) for t in terms], "term string").select(_bucket(F.col("term"), segment.buckets).alias("b"))
            rows = rows.filter(F.col("bucket").isin([r["b"] for r in words.distinct().collect()]) & F.col("term").isin(terms))
        return rows.select("term", "number", "tf")

    def _live(self, segments: list[Segment], rows: DataFrame) -> DataFrame:
        """Rows (number, ...) that none of the segments removed.

        Broadcast are bitmaps with one bit for each row of their block, so at most a bit for every row that the table ever got.
        """
        if len(segments) < 2:
            return rows
        gone = _union([self._removed(s.folder) for s in segments[1:]]).select((F.col("number") + 1).alias("n"))
        bitmaps = gone.groupBy((F.bitmap_bucket_number("n") - 1).alias("_block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("_bits"))
        byte = F.expr(f"CAST(conv(hex(substring(_bits, CAST(number % {BITMAP_ROWS} DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)")
        removed = F.getbit(byte, (F.col("number") % 8).cast("int")) == 1
        block = F.floor(F.col("number") / BITMAP_ROWS).cast("long")
        found = rows.withColumn("_block", block).join(F.broadcast(bitmaps), "_block", "left")
        return found.filter(F.col("_bits").isNull() | ~removed).drop("_block", "_bits")

    def _all_docs(self, segments: list[Segment]) -> DataFrame:
        return _union([self._docs(s.folder) for s in segments])

    def _live_docs(self, segments: list[Segment]) -> DataFrame:
        return self._live(segments, self._all_docs(segments))

    def snapshot(self, table: TableStore | None = None) -> TermSnapshot:
        """The index as it is now, unchanged by later refreshes.

        With ``table`` it must have seen exactly the table's commits, else `StaleIndex` is raised.
        """
        state = self._state()
        seen = state["table_version"] if state else -1
        if table is not None:
            commits = table.commits()
            newest = commits[-1]["version"] if commits else -1
            if seen != newest:
                raise StaleIndex(f"the index has seen version {seen}, the table is at {newest}; call refresh")
        segments = [Segment(**s.asDict()) for s in state["segments"]] if state else []
        return TermSnapshot(self, segments, state["documents"] if state else 0, state["tokens"] if state else 0)


class TermSnapshot:
    """Searches and statistics over a fixed list of segments."""

    def __init__(self, index: TermIndex, segments: list[Segment], documents: int, tokens: int):
        self.index, self.segments, self.documents, self.tokens = index, segments, documents, tokens

    @property
    def mean_length(self) -> float:
        return self.tokens / self.documents if self.documents else 0.0

    def _found(self, terms: list[str]) -> DataFrame:
        """(term, number, tf) of the live rows that hold one of the words."""
        return self.index._live(self.segments, self.index._postings(self.segments, terms))

    def hits(self, terms: list[str]) -> DataFrame:
        """(term, id, tf, length) of the live rows that hold one of the words."""
        if not self.segments:
            return local_rows(self.index.spark, [], "term string, id string, tf int, length int")
        return self._found(terms).join(self.index._all_docs(self.segments), "number").select("term", "id", "tf", "length")

    def document_frequencies(self, terms: list[str]) -> DataFrame:
        """(term, doc_freq) over the live rows, counted from the postings of these words."""
        return self._found(terms).groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))

    def scores(self, query: str, allowed: DataFrame | None = None) -> DataFrame:
        """(id, score) of every live row that holds a query word, with statistics over the whole table; no text is read.

        ``allowed``, a table of ids, keeps some of the rows without a change of their scores. The postings of the
        query's words are read twice, first for the frequencies, of which there is one per word.
        """
        terms = query_terms(self.index.spark, query)
        if not terms or not self.segments:
            return local_rows(self.index.spark, [], "id string, score double")
        docs = self.index._all_docs(self.segments).select("number", "id", "length")
        if allowed is not None:
            docs = docs.join(allowed.select("id"), "id", "left_semi")
        found = self._found(terms).join(F.broadcast(self.document_frequencies(terms)), "term").join(docs, "number")
        weight = bm25(F.col("tf"), F.col("length"), F.lit(self.mean_length), F.lit(self.documents), F.col("doc_freq"))
        return found.groupBy("number", "id").agg(rounded(F.sum(weight)).alias("score")).drop("number")

    def search(self, query: str, k: int = 5, allowed: DataFrame | None = None) -> DataFrame:
        return top(self.scores(query, allowed), k)
