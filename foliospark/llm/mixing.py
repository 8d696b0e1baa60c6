"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import SPACE, WORD
from foliospark.session import staged

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
REPEATS = 2
#: Ranges of finish times per unit of time, and the number of the last one; time 1 is where the targets are met.
SLOTS = 4096
LAST_SLOT = 4 * SLOTS


def words_in(text: Column) -> Column:
    """Number of words, that is runs of characters other than blanks, tabs and line ends; null has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Sources in the order of their names, null last, take the weights in turn. They divide ``share`` of all words by
    weight; a source never gets more than ``repeats`` times its own size, and what it cannot take is divided again by
    weight among the others. In the order of size for weight, the sources at their limit come first, so the level at
    which the rest stands follows from running sums. The table has one row per source and not per document.
    """
    names = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(names) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    limited = sizes.withColumn("w", weight).withColumn("cap", F.col("source_size") * float(repeats))
    by_limit = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    upto, rest = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * share
    levels = limited.withColumn("level", (budget - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / F.sum("w").over(rest))
    # The first source in this order that stays below its limit sets the level of all that follow.
    free = F.when(F.col("level") * F.col("w") < F.col("cap"), F.col("level"))
    level = F.first(free, ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.withColumn("level", level).select(
        "source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def queue_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: str = "mix") -> DataFrame:
    """How many words of each document the mix takes: id, ``size``, ``source_size``, ``target``, ``taken``.

    The documents of a source are shuffled by a hash of their id and queued as often as repeats are allowed. A
    document's virtual finish time is the number of the source's words up to its end divided by the source's target,
    so every source stands at its target at time 1. All documents are put in the order of that time, and the mix is
    cut where its words reach the sum of the targets; the document at the cut gives only its first words. A document
    that is running at time 1 is queued in two parts, before and after it, so that a very long document of a small
    source neither blocks its source nor overshoots the target.

    Null text and text without words have size 0 and nothing is taken of them; a null source is a source of its own.
    Repeated rows are separate documents. An empty table gives no rows; further columns are ignored.
    """
    taken = _taken(docs.select(docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"),
                               words_in(docs[text_col]).alias("size")), weights, share, repeats, seed)
    return taken.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def _pieces(repeats: int) -> Column:
    """The queued parts of a document: (turn, part, words, finish)."""
    parts = []
    for turn in range(repeats):
        start = F.col("before") + turn * F.col("source_size")
        end = (start + F.col("size")) / F.col("target")
        early = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - start)).cast("long")
        for part, (words, finish) in enumerate(((early, F.least(end, F.lit(1.0))), (F.col("size") - early, end))):
            parts.append(F.struct(F.lit(turn).alias("turn"), F.lit(part).alias("part"), words.alias("words"), finish.alias("finish")))
    return F.filter(F.array(*parts), lambda x: x["words"] > 0)


def _slot(finish: Column) -> Column:
    """The range of finish times that a part lies in; the last one holds all late parts."""
    return F.least(F.ceil(finish * SLOTS) - 1, F.lit(LAST_SLOT)).cast("long")


def _taken(rows: DataFrame, weights, share: float, repeats: int, seed: str) -> DataFrame:
    """``rows(id, source, size)`` with source size, target, words taken and the row's place in its source's shuffle."""
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    place = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"))
    rows = staged(rows.withColumns({"key": key, "place": place, "row": F.monotonically_increasing_id()}), "sizes")
    targets = staged(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats)
                     .withColumn("key", key).drop("source"), "targets")
    # Three digits of the hash make 4096 buckets of a source: sums per bucket first, then rows inside their bucket,
    # so that no task holds a whole source.
    rows = rows.withColumn("bucket", F.substring("place", 1, 3))
    ahead = F.sum("size").over(Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    sums = rows.groupBy("key", "bucket").agg(F.sum("size").alias("size")).withColumn("ahead", F.coalesce(ahead, F.lit(0))).drop("size")
    inside = F.sum("size").over(Window.partitionBy("key", "bucket").orderBy("place", "id", "size").rowsBetween(Window.unboundedPreceding, -1))
    queued = rows.withColumn("inside", F.coalesce(inside, F.lit(0))).join(sums.join(targets, "key"), ["key", "bucket"])
    queued = staged(queued.withColumn("before", F.col("ahead") + F.col("inside")).drop("inside", "ahead", "bucket"), "queue", short=True)

    queue = queued.where("size > 0").select("row", "id", "place", F.inline(_pieces(repeats))).withColumn("slot", _slot(F.col("finish")))
    budget = int(targets.agg(F.floor(F.coalesce(F.sum("target"), F.lit(0.0)))).first()[0])
    cut, left = LAST_SLOT + 1, budget
    for slot, words in sorted(map(tuple, queue.groupBy("slot").agg(F.sum("words")).collect())):  # at most LAST_SLOT + 1 rows
        if words > left:
            cut = slot
            break
        left -= words
    order = Window.partitionBy("slot").orderBy("finish", "place", "id", "turn", "part").rowsBetween(Window.unboundedPreceding, -1)
    at_cut = queue.where(F.col("slot") == cut).withColumn("ahead", F.coalesce(F.sum("words").over(order), F.lit(0)))
    at_cut = at_cut.where(F.col("ahead") < left).groupBy("row").agg(F.sum(F.least("words", F.lit(left) - F.col("ahead"))).alias("more"))
    whole = F.aggregate(F.filter(_pieces(repeats), lambda x: _slot(x["finish"]) < cut), F.lit(0).cast("long"), lambda n, x: n + x["words"])
    return queued.join(at_cut, "row", "left").withColumn(
        "taken", F.when(F.col("size") > 0, whole).otherwise(F.lit(0)) + F.coalesce("more", F.lit(0))).drop("more", "key")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document taken twice is two rows, one taken in part is cut.

    A cut document keeps its first words, one blank between them; very long ones are cut in the same way. Documents of
    which nothing is taken are not in the result. What is taken of repeated rows, that is of rows with one id and size,
    is dealt evenly over them, the remainder to the first ones, so that the mix has every word of the plan; such rows
    meet in one task, one after the other. The other rules are those of `queue_documents`.
    """
    def key(column: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))

    spread = docs.select(F.struct("*").alias("doc"), key(docs[id_col]).alias("key"), words_in(docs[text_col]).alias("words"))
    plan = queue_documents(docs, id_col, text_col, source_col, **how)
    plan = plan.groupBy(key(F.col(id_col)).alias("key"), F.col("size").alias("words")).agg(
        F.sum("taken").alias("total"), F.count("*").alias("rows")).where("total > 0")
    turn = F.row_number().over(Window.partitionBy("key", "words").orderBy(F.lit(1)))
    share = F.floor(F.col("total") / F.col("rows")) + F.when(F.col("turn") <= F.col("total") % F.col("rows"), 1).otherwise(0)
    joined = spread.join(plan, ["key", "words"]).withColumn("turn", turn).withColumn("taken", share)
    parts = F.transform(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("words")).cast("int") - 1),
                        lambda i: F.least(F.col("words"), F.col("taken") - i * F.col("words")))
    rows = joined.where("taken > 0").select("doc", "words", F.explode(parts).alias("keep"))
    words = F.split(F.trim(F.regexp_replace(F.col("doc")[text_col], SPACE, " ")), " ")
    first = F.array_join(F.slice(words, 1, F.col("keep").cast("int")), " ")
    text = F.when(F.col("keep") < F.col("words"), first).otherwise(F.col("doc")[text_col])
    return rows.select(F.col("doc").withField(text_col, text).alias("doc")).select("doc.*")
