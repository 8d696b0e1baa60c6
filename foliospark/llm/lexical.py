"""Ranked lexical search over term owners, with accumulators that travel from one owner to the next."""

from __future__ import annotations

import itertools
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from foliospark.llm.common import bounded_batches
from foliospark.session import local_rows, staged

#: Bytes of item text that one pass over the documents serves; more items take more passes.
PASS_BYTES = 8 << 20
#: Items of one bundle, documents and word occurrences of one shard: an accumulator table has at most BUNDLE x SHARD cells.
BUNDLE, SHARD, SHARD_HITS = 256, 4096, 4_000_000
#: Term owners, that is stages that a bundle goes through.
OWNERS = 3
#: Bytes of text that are cut into terms at a time.
BLOCK = 1 << 20

_SIGNS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytearray(range(256))
_TABLE[0x41:0x5B] = range(0x61, 0x7B)
for _sign in _SIGNS:
    _TABLE[_sign] = 0x20
_TABLE = bytes(_TABLE)


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, block by block: runs of letters, digits and non-ASCII characters; A-Z in lower case."""
    plain = (text or b"").translate(_TABLE)
    at = 0
    while at < len(plain):
        end = len(plain)
        if at + BLOCK < end:
            end = plain.rfind(b" ", at, at + BLOCK)
            if end < 0:
                end = plain.find(b" ", at + BLOCK)
                end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end + 1


def weight(documents: int, holding: int) -> int:
    """A term's weight from the number of documents and of those that hold it."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def saturation(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What an occurrence count adds per unit of weight, in millionths, for documents of relative length ``length``."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * length)


def _index_schema(id_type) -> StructType:
    return StructType([StructField("shard", LongType()), StructField("term", IntegerType()),
                       StructField("docs", ArrayType(IntegerType())), StructField("counts", ArrayType(IntegerType())),
                       StructField("ids", ArrayType(id_type)), StructField("sizes", ArrayType(LongType())),
                       StructField("documents", LongType()), StructField("words", LongType())])


def term_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Postings of the terms in ``vocabulary`` by shard and term, from ``docs(id, text)``, without a shuffle.

    A shard is up to SHARD consecutive documents of one task. Its row with term 0 has the ids in ascending order, null
    last, the numbers of terms and, for the statistics, how many documents have a term and how many terms there are;
    the other rows have a term's places in that list and its counts.
    """
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = _index_schema(docs.schema["id"].dataType)
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)
        ids, sizes, hits, state = [], [], [], Counter()

        def shard() -> pa.RecordBatch:
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            doc = np.repeat(place, [h.size for h in hits]) if hits else np.zeros(0, np.int64)
            term = np.concatenate(hits) if hits else np.zeros(0, np.int64)
            width = max(1, len(ids))
            cells, counts = np.unique(term * width + doc, return_counts=True)
            term, doc = cells // width, cells % width
            starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if term.size else np.zeros(0, np.int64)
            n = starts.size
            edges = np.concatenate([[0], starts, [term.size]]).astype(np.int32)  # the first list is that of term 0, empty
            first = [i == 0 for i in range(n + 1)]

            def once(values, kind):
                return pa.array([values if f else None for f in first], kind)
            rows = [pa.array([next(number)] * (n + 1), pa.int64()), pa.array([0, *term[starts].tolist()], pa.int32()),
                    pa.ListArray.from_arrays(edges, pa.array(doc, pa.int32())), pa.ListArray.from_arrays(edges, pa.array(counts, pa.int32())),
                    once([ids[i] for i in order], target.field("ids").type), once([sizes[i] for i in order], target.field("sizes").type),
                    once(state["documents"], pa.int64()), once(state["words"], pa.int64())]
            return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(rows, target, strict=True)], schema=target)

        held = 0
        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                size, found = 0, []
                for words in terms(text):
                    size += len(words)
                    found.append(np.fromiter(filter(None, map(vocabulary.get, words)), np.int64))
                state["documents"] += size > 0
                state["words"] += size
                found = np.concatenate(found) if found else np.zeros(0, np.int64)
                if found.size:
                    ids.append(key)
                    sizes.append(size)
                    hits.append(found)
                    held += found.size
                if len(ids) >= SHARD or held >= SHARD_HITS:
                    yield shard()
                    ids, sizes, hits, held = [], [], [], 0
                    state.clear()
        if ids or state["documents"]:
            yield shard()
    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def _items(items: DataFrame) -> DataFrame:
    """Terms of ``items(id, text)`` as one row per item: id, terms, counts."""
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = StructType([items.schema["id"], *StructType.fromDDL("terms array<binary>, counts array<int>").fields])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = []
            for text in batch.column("text").to_pylist():
                counts: Counter = Counter()
                for words in terms(text):
                    counts.update(words)
                counted.append(counts)
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(target.field(0).type), pa.array([list(c) for c in counted], target.field(1).type),
                                              pa.array([list(c.values()) for c in counted], target.field(2).type)], schema=target)
    return items.mapInArrow(run, schema)


def ranked(docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The ``top`` documents with the highest scores for each item: item id, ``rank``, id, ``score``.

    Terms are runs of letters, digits and non-ASCII characters with A-Z in lower case. All documents and whole texts
    are searched and counted. A document's score adds up over the item's terms, repeats included, in whole numbers; a
    common length, term frequency and rarity enter as in `saturation` and `weight`.

    Items come in passes of about ``pass_bytes`` of text, and in bundles of at most BUNDLE items within a pass. A pass
    writes the postings of its terms by shard of documents. Each term belongs to one owner, rare terms to the first
    ones. A bundle has one sparse accumulator table per shard, which meets the postings of one owner after the other
    by cogroup on bundle and shard, so that neither a common word nor a popular item gathers anywhere. A document
    whose score cannot reach the shard's current ``top`` any more, whatever the later owners add, is not carried on.

    Null texts and texts without terms have none: such documents do not count in the statistics, such items have no
    rows. Only scores above 0 are returned, equal ones by ascending id, null last. Very long texts are cut into terms
    block by block and are one document. Repeated rows, also repeated items, are rows of their own with ranks of their
    own. Empty tables give no rows; further columns are ignored. Ids may be of any type that can be sorted.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").cast("binary").alias("text"))
    asked = items.select(items[item_col].alias("id"), items[item_text].cast("string").cast("binary").alias("text"))
    schema = StructType([StructField(item_col, asked.schema["id"].dataType), StructField("rank", IntegerType()),
                         StructField(id_col, rows.schema["id"].dataType), StructField("score", LongType())])
    amount = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(amount / pass_bytes))
    out = None
    for turn in range(passes):
        part = _items(asked.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == turn))
        found = _search(rows, [tuple(r) for r in part.collect()], top, schema)  # the terms of about pass_bytes of text
        out = found if out is None else out.unionByName(found)
    return out


def _search(rows: DataFrame, asked: list[tuple], top: int, schema: StructType) -> DataFrame:
    spark = rows.sparkSession
    asked = sorted((a for a in asked if a[1]), key=lambda a: (a[0] is None, a[0] if a[0] is not None else 0))
    vocabulary = {t: i for i, t in enumerate(sorted({t for a in asked for t in a[1]}), 1)}
    index = staged(term_index(rows, vocabulary), "postings")
    total = index.where("term = 0").agg(F.sum("documents"), F.sum("words")).first()
    documents, words = total[0] or 0, total[1] or 0
    # At most one row per term of the pass.
    known = {r[0]: (r[1], r[2]) for r in index.where("term > 0").groupBy("term").agg(F.sum(F.size("docs")), F.max(F.array_max("counts"))).collect()}
    if not known:
        return spark.createDataFrame([], schema)
    weights = {t: weight(documents, n) for t, (n, _) in known.items()}
    reach = {t: weights[t] * int(saturation(np.int64(most), np.int64(25))) for t, (_, most) in known.items()}
    owner = _owners(known, weights)
    # Per bundle: term -> [(place of the item in the bundle, repeats)], and what the owners after each stage can still add.
    bundles = [asked[i:i + BUNDLE] for i in range(0, len(asked), BUNDLE)]
    wants, rest = [], []
    for bundle in bundles:
        want, later = defaultdict(list), np.zeros((OWNERS, len(bundle)), np.int64)
        for place, (_, its, counts) in enumerate(bundle):
            for name, n in zip(its, counts, strict=True):
                t = vocabulary[bytes(name)]
                if t in known:
                    want[t].append((place, n))
                    later[:owner[t], place] += n * reach[t]
        wants.append(dict(want))
        rest.append(later)
    route = local_rows(spark, [(t, b, owner[t]) for b, want in enumerate(wants) for t in want], "term int, bundle int, owner int")
    id_list = index.schema["ids"].dataType
    table = StructType([StructField("bundle", IntegerType()), StructField("shard", LongType()), StructField("ids", id_list),
                        StructField("sizes", ArrayType(LongType())), *StructType.fromDDL("cells binary, scores binary").fields])
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(table)
    shards = index.where("term = 0 AND size(ids) > 0").select("shard", "ids", "sizes")
    held = shards.withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(len(bundles) - 1)))).select(
        "bundle", "shard", "ids", "sizes", F.lit(b"").alias("cells"), F.lit(b"").alias("scores"))

    def stage(number: int):
        def add(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            b = key[0].as_py()
            sizes = np.asarray(left.column("sizes").combine_chunks().flatten())
            length = 25 + (75 * sizes * documents) // words
            want, later, n = wants[b], rest[b][number], sizes.size
            scores = np.zeros(len(bundles[b]) * n, np.int64)
            scores[np.frombuffer(left.column("cells")[0].as_py(), np.uint32)] = np.frombuffer(left.column("scores")[0].as_py(), np.int64)
            scores = scores.reshape(len(bundles[b]), n)
            for t, at, tf in zip(right.column("term").to_pylist(), right.column("docs"), right.column("counts"), strict=True):
                at, tf = np.asarray(at.values), np.asarray(tf.values).astype(np.int64)
                adds = weights[t] * saturation(tf, length[at])
                for place, repeats in want[t]:
                    scores[place, at] += adds * repeats
            keep = scores > 0
            if n > top:
                least = np.partition(scores, n - top, axis=1)[:, n - top]
                keep &= scores + later[:, None] >= least[:, None]
            cells = np.flatnonzero(keep).astype(np.uint32)
            return pa.Table.from_arrays([left.column("bundle"), left.column("shard"), left.column("ids").cast(target.field("ids").type),
                                         left.column("sizes").cast(target.field("sizes").type), pa.array([cells.tobytes()], pa.binary()),
                                         pa.array([scores.ravel()[cells].tobytes()], pa.binary())], schema=target)
        return add

    for number in range(OWNERS):
        of_owner = index.where("term > 0").join(F.broadcast(route.where(F.col("owner") == number).drop("owner")), "term").select(
            F.col("bundle").alias("for"), F.col("shard").alias("of"), "term", "docs", "counts")
        held = held.groupBy("bundle", "shard").cogroup(of_owner.groupBy("for", "of")).applyInArrow(stage(number), table)
    best = _best(held, bundles, top, schema)
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    chosen = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return chosen.select(F.col("item").alias(schema[0].name), "rank", F.col("id").alias(schema[2].name), "score")


def _owners(known: dict[int, tuple[int, int]], weights: dict[int, int]) -> dict[int, int]:
    """Terms dealt over the owners by falling weight, with about the same number of postings for each owner."""
    share, before, out = sum(n for n, _ in known.values()) / OWNERS, 0, {}
    for t in sorted(known, key=lambda t: (-weights[t], t)):
        out[t] = min(OWNERS - 1, int(before / share))
        before += known[t][0]
    return out


def _best(held: DataFrame, bundles: list[list[tuple]], top: int, schema: StructType) -> DataFrame:
    """The best documents of every shard for every item, from the accumulators that left the last owner."""
    from pyspark.sql.pandas.types import to_arrow_schema
    out = StructType([StructField("place", LongType()), StructField("item", schema[0].dataType),
                      StructField("id", schema[2].dataType), StructField("score", LongType())])
    target = to_arrow_schema(out)
    names = [[a[0] for a in bundle] for bundle in bundles]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                cells, scores = np.frombuffer(row["cells"], np.uint32).astype(np.int64), np.frombuffer(row["scores"], np.int64)
                item, doc = cells // len(row["ids"]), cells % len(row["ids"])
                edges = np.searchsorted(item, np.arange(len(names[row["bundle"]]) + 1))
                for place, (start, end) in enumerate(itertools.pairwise(edges)):
                    for i in start + np.lexsort((doc[start:end], -scores[start:end]))[:top]:
                        rows.append((row["bundle"] * BUNDLE + place, names[row["bundle"]][place], row["ids"][doc[i]], int(scores[i])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)
    return held.mapInArrow(run, out)
