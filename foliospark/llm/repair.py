"""Repair of conversation structure by a shortest path over a grammar of role and fault sequences."""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from foliospark.llm.common import bounded_batches
from foliospark.session import staged

NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: Rows of one conversation that are gathered in a group at first.
SEGMENT = 256
#: Rounds of pair replacement and rules a round; both only bound how much work conversations share.
ROUNDS, RULES = 10, 64

# ---- ropes and transfer matrices


class Rope:
    """Text as a tree of shared parts."""

    __slots__ = ("left", "right", "text", "size")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        self.size = len(text) if left is None else left.size + right.size

    def __add__(self, other: Rope) -> Rope:
        return other if not self.size else self if not other.size else Rope(left=self, right=other)

    def parts(self) -> Iterator[str]:
        stack = [self]
        while stack:
            node = stack.pop()
            if node.left is None:
                yield node.text
            else:
                stack += (node.right, node.left)

    def __str__(self) -> str:
        return "".join(self.parts())


def before(a: Rope, b: Rope) -> bool:
    """Whether the text of ``a`` is less than that of ``b``; parts that both share are not opened."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if x.left is not None and (x.size >= y.size or y.left is None):
            left += (x.right, x.left)
            right.append(y)
        elif y.left is not None:
            right += (y.right, y.left)
            left.append(x)
        else:
            n = min(len(x.text), len(y.text))
            if x.text[:n] != y.text[:n]:
                return x.text < y.text
            if len(x.text) > n:
                left.append(Rope(x.text[n:]))
            if len(y.text) > n:
                right.append(Rope(y.text[n:]))
    return any(n.size for n in right) and not any(n.size for n in left)


def better(a: tuple[int, Rope] | None, b: tuple[int, Rope] | None) -> tuple[int, Rope] | None:
    """The cheaper of two edits; of equally cheap ones the one whose text is less."""
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if before(b[1], a[1]) else a


def then(left: list, right: list) -> list:
    """Min-plus product of two transfer matrices, or of a row of states and a matrix.

    Of the same rows, two edits of equal cost are never one the beginning of the other, as more inserts cost more; so
    the best edit of a whole consists of best edits of its parts.
    """
    out = [[None] * 4 for _ in left]
    for i, row in enumerate(left):
        for k, first in enumerate(row):
            if first is not None:
                for j, second in enumerate(right[k]):
                    if second is not None:
                        held = out[i][j]
                        cost = first[0] + second[0]
                        if held is None or cost <= held[0]:
                            out[i][j] = better(held, (cost, first[1] + second[1]))
    return out


# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
_USER_FROM = (START, SYSTEM, ASSISTANT)


def _inserts() -> list:
    matrix = [[None] * 4 for _ in range(4)]
    for i in range(4):
        matrix[i][i] = (0, Rope())
    for i in _USER_FROM:
        matrix[i][USER] = (INSERT, Rope("I"))
        if i != ASSISTANT:
            matrix[i][ASSISTANT] = (2 * INSERT, Rope("II"))
    matrix[USER][ASSISTANT] = (INSERT, Rope("I"))
    return matrix


def _edits(role: str, fault: int) -> list:
    """What can be done with one row, as a transfer matrix without inserts."""
    matrix = [[None] * 4 for _ in range(4)]
    extra = CUT if fault == TRUNCATED else 0
    for i in range(4):
        matrix[i][i] = (DELETE, Rope("D"))
        if fault in (BLANK, DUPLICATE):
            continue
        if role == "s" and i == START:
            matrix[i][SYSTEM] = (KEEP + extra, Rope("K"))
        for name, j, allowed in (("u", USER, _USER_FROM), ("a", ASSISTANT, (USER,))):
            if i in allowed:
                matrix[i][j] = better(matrix[i][j], (KEEP + extra, Rope("K")) if role == name else (REROLE + extra, Rope("R")))
    return matrix


INSERTS = _inserts()
ROLES = "suax"
#: One character for each role initial (x: any other one) and fault.
SYMBOLS = {(r, f): chr(65 + 4 * i + f) for i, r in enumerate(ROLES) for f in range(4)}
_ROLE_OF = {c: r for (r, _), c in SYMBOLS.items()}
_FAULT_OF = {c: f for (_, f), c in SYMBOLS.items()}
TERMINALS = {c: then(INSERTS, _edits(r, f)) for (r, f), c in SYMBOLS.items()}
FIRST_RULE = 0x4E00


def replace_pairs(symbols: str, rules: dict[str, str]) -> str:
    """Replace pairs from left to right by the symbols of their rules."""
    out, i, n = [], 0, len(symbols)
    while i < n:
        rule = rules.get(symbols[i:i + 2]) if i + 1 < n else None
        out.append(rule or symbols[i])
        i += 2 if rule else 1
    return "".join(out)


def count_pairs(symbols: str) -> Counter:
    """Adjacent pairs; in a run of one symbol only those that do not overlap."""
    counts: Counter = Counter()
    for symbol, run in itertools.groupby(symbols):
        n = sum(1 for _ in run)
        if n > 1:
            counts[symbol * 2] += n // 2
    counts.update(a + b for a, b in itertools.pairwise(symbols) if a != b)
    return counts


def choose_rules(counts: list[tuple[str, int]], first: int) -> dict[str, str]:
    """Rules for the most frequent pairs that cannot overlap: no symbol is the left of one and the right of another."""
    left, right, rules = set(), set(), {}
    for pair, _ in sorted(counts, key=lambda c: (-c[1], c[0])):
        a, b = pair
        if a in right or b in left or (a == b and a in left):
            continue
        left.add(a)
        right.add(b)
        rules[pair] = chr(first + len(rules))
    return rules


def grammar(forms: DataFrame, rounds: int = ROUNDS, rules: int = RULES) -> list[dict[str, str]]:
    """Rounds of rules by Re-Pair over ``forms(symbols)``, the distinct sequences of all conversations.

    Each round counts the adjacent pairs of all sequences, partial counts first, and gives the most frequent ones a
    symbol. At most ``rounds`` times ``rules`` rules come to the driver; sequences that they do not cover are longer.
    """
    made: list[dict[str, str]] = []
    for _ in range(rounds):
        def count(batches: Iterator[pa.RecordBatch], made=tuple(made)) -> Iterator[pa.RecordBatch]:
            counts: Counter = Counter()
            for batch in batches:
                for symbols in batch.column(0).to_pylist():
                    for pairs in made:
                        symbols = replace_pairs(symbols, pairs)
                    counts.update(count_pairs(symbols))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["pair", "n"])
        top = forms.mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1").orderBy(
            F.desc("n"), "pair").limit(rules).collect()
        if not top:
            break
        made.append(choose_rules([tuple(r) for r in top], FIRST_RULE + sum(map(len, made))))
    return made


def matrices(rounds: list[dict[str, str]]) -> dict[str, list]:
    """The transfer matrix of every symbol, rules bottom-up from their two parts; ropes are shared."""
    known = dict(TERMINALS)
    for rules in rounds:
        for pair, symbol in rules.items():
            known[symbol] = then(known[pair[0]], known[pair[1]])
    return known


def cheapest(symbols: str, rounds: list[dict[str, str]], known: dict[str, list]) -> tuple[int, str]:
    """Cost and audit of the cheapest edit of a sequence, least text first."""
    for rules in rounds:
        symbols = replace_pairs(symbols, rules)
    states = [[(0, Rope()), None, None, None]]
    for symbol in symbols:
        states = then(states, known[symbol])
    states = then(states, INSERTS)[0]
    cost, rope = better(states[START], states[ASSISTANT])
    return cost, str(rope)


def steps(symbols: str, audit: str) -> str:
    """The audit with roles: K kept, D deleted, U and A turned into user and assistant, u and a inserted ones."""
    out, rows, state = [], iter(symbols), START
    for edit in audit:
        if edit == "D":
            next(rows)
            out.append("D")
            continue
        role = _ROLE_OF[next(rows)] if edit in "KR" else None
        if edit == "K" and role == "s":
            state = SYSTEM
        else:
            state = ASSISTANT if state == USER else USER
        name = "a" if state == ASSISTANT else "u"
        out.append("K" if edit == "K" else name.upper() if edit == "R" else name)
    return "".join(out)


# ---- rows and their faults

def _small(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Each row as (conv, turn, tie, role number, fault without duplicates); nulls of role and text as one space."""
    who, said = (F.coalesce(rows[c].cast("string"), F.lit(" ")) for c in (role, text))
    first = F.substring(who, 1, 1)
    last = F.substring(F.rtrim(said, F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    return rows.select(
        rows[conv].alias("conv"), rows[turn].alias("turn"), _tie(who, said).alias("tie"),
        F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3).alias("role"),
        F.when(last == "", BLANK).when(last.isin(".", "!", "?"), NONE).otherwise(TRUNCATED).alias("fault"))


def _tie(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def _sequences(rows: DataFrame, conv: str, turn: str, role: str, text: str, ids: DataFrame | None) -> DataFrame:
    """One row per conversation: conv, its symbols in order, gaps.

    Rows are sorted over all conversations by range, so a conversation of any length is spread over tasks; numbers in
    that order take the place of turns. The first row of each role and text is found by the least number of its
    digest. Symbols, one character per row, are gathered in segments of at most SEGMENT rows and then joined.
    """
    keyed = _small(rows, conv, turn, role, text).withColumn("copy", F.monotonically_increasing_id())
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "tie", "copy"]
    numbered = staged(keyed.repartitionByRange(*order).sortWithinPartitions(*order)
                      .withColumn("at", F.monotonically_increasing_id()).drop("copy"), "turns")
    first = numbered.groupBy("conv", "tie").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = F.when(F.col("fault") == BLANK, BLANK).when(F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    symbol = F.char(65 + F.col("role") * 4 + fault)
    coded = numbered.join(first, "at", "left").select("conv", "at", F.floor(F.col("at") / SEGMENT).alias("segment"), symbol.alias("symbol"))
    in_order = F.array_sort(F.collect_list(F.struct("at", "symbol")))
    segments = coded.groupBy("conv", "segment").agg(F.array_join(F.transform(in_order, lambda s: s["symbol"]), "").alias("symbols"))
    turns = numbered.where("turn IS NOT NULL").select("conv", "turn").distinct().groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))
    nothing = F.lit(None)
    parts = segments.select("conv", F.struct("segment", "symbols").alias("part"), nothing.cast("long").alias("gaps")).unionByName(
        turns.select("conv", nothing.cast("struct<segment:bigint,symbols:string>").alias("part"), "gaps"))
    if ids is not None:
        parts = parts.unionByName(ids.select(F.col(conv).alias("conv"), nothing.cast("struct<segment:bigint,symbols:string>").alias("part"),
                                             nothing.cast("long").alias("gaps")))
    return parts.groupBy("conv").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["symbols"]), "").alias("symbols"),
        F.coalesce(F.max("gaps"), F.lit(0)).cast("long").alias("gaps"))


def repair_plans(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 ids: DataFrame | None = None) -> DataFrame:
    """The cheapest repair of every conversation: conv, counts of faults, ``cost``, ``audit``, ``symbols``, ``steps``.

    A conversation's rows are taken by turn, nulls first; rows of one turn by the SHA-256 of role and text. A row is
    blank, a duplicate of an earlier row's role and text, truncated (its last character is none of ``.!?``) or sound.
    Edits give roles that begin with ``s?(ua)+`` or nothing at all; the cheapest one is chosen, ties by the least audit.

    Conversations become strings of one character per row for role and fault. Re-Pair over the distinct strings gives
    a grammar, each rule has one min-plus transfer matrix over four states with the audit as a rope, evaluated
    bottom-up once and used by all conversations; a conversation multiplies the matrices of its compressed string.

    Nulls of role and text are one space; a null conversation id is a conversation of its own. ``ids`` adds
    conversations without rows, which need no repair. Repeated rows are duplicates. Long texts only count by digest
    and last character, long conversations by one byte per row, like their audit. Empty tables give no rows.
    """
    forms = staged(_sequences(rows, conv_col, turn_col, role_col, text_col, ids), "sequences")
    rounds = grammar(forms.select("symbols").distinct())
    known = matrices(rounds)
    schema = StructType([forms.schema["conv"], *StructType.fromDDL(
        "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, symbols string, steps string").fields])
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(schema)
    legal = {"su", "ua", "au"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple] = {}
        for batch in batches:
            made = []
            for symbols in batch.column("symbols").to_pylist():
                if symbols not in memo:
                    if len(memo) > 20_000:
                        memo.clear()
                    faults = Counter(_FAULT_OF[c] for c in symbols)
                    bad = sum(n for pair, n in Counter(itertools.pairwise(symbols)).items()
                              if _ROLE_OF[pair[0]] + _ROLE_OF[pair[1]] not in legal)
                    cost, audit = cheapest(symbols, rounds, known)
                    memo[symbols] = (faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], bad, cost, audit, symbols, steps(symbols, audit))
                made.append(memo[symbols])
            if made:
                columns = [batch.column("conv"), batch.column("gaps"), *map(list, zip(*made, strict=True))]
                yield pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c)).cast(f.type)
                                                  for c, f in zip(columns, target, strict=True)], schema=target)
    bounded_batches(rows.sparkSession)
    return forms.select("conv", "gaps", "symbols").mapInArrow(run, schema).withColumnRenamed("conv", conv_col)


def _in_order(rows: DataFrame, plans: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Plans and rows of a conversation one after the other in one partition, sorted by Spark, which may spill."""
    who, said = (F.coalesce(rows[c].cast("string"), F.lit(" ")) for c in (role, text))
    given = rows.select(rows[conv].alias("conv"), F.lit(1).alias("kind"), rows[turn].alias("turn"), _tie(who, said).alias("tie"),
                        who.alias("role"), said.alias("text"), F.lit(None).cast(StructType(plans.schema.fields)).alias("plan"))
    nothing = F.lit(None)
    heads = plans.select(F.col(conv).alias("conv"), F.lit(0).alias("kind"), nothing.cast(rows.schema[turn].dataType).alias("turn"),
                         nothing.cast("binary").alias("tie"), nothing.cast("string").alias("role"), nothing.cast("string").alias("text"),
                         F.struct(*plans.columns).alias("plan"))
    both = heads.unionByName(given).repartition("conv")
    return both.sortWithinPartitions("conv", "kind", F.col("turn").asc_nulls_first(), "tie").drop("turn", "tie")


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Sorted plans and rows as ("begin", plan), ("turn", role, text) for each repaired turn, and ("end", plan)."""
    plan, left = None, iter(())

    def until_row() -> Iterator[tuple]:
        """Inserted turns; returns the step of the next row, if there is one."""
        for step in left:
            if step not in "ua":
                return step
            yield "turn", "user" if step == "u" else "assistant", ""
        return None

    def finish() -> Iterator[tuple]:
        if plan is not None:
            yield from until_row()
            yield "end", plan, None
    for batch in batches:
        for kind, role, text, head in zip(*(batch.column(c).to_pylist() for c in ("kind", "role", "text", "plan")), strict=True):
            if kind == 0:
                yield from finish()
                plan, left = head, iter(head["steps"])
                yield "begin", plan, None
                continue
            step = yield from until_row()
            if step != "D":
                yield "turn", role if step == "K" else "user" if step == "U" else "assistant", text
    yield from finish()


def _streamed(rows: DataFrame, plans: DataFrame, columns: tuple[str, str, str, str], schema: StructType, made: Callable) -> DataFrame:
    """Rows that ``made`` yields from the events of each partition, in batches of up to 2000."""
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in itertools.batched(made(_events(batches)), 2000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), target, strict=True)], schema=target)
    bounded_batches(rows.sparkSession)
    return _in_order(rows, plans, *columns).mapInArrow(run, schema)


def repaired_turns(rows: DataFrame, plans: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """The repaired conversations as rows: conv, ``place`` from 0, ``role``, ``text``; rules as in `repair_plans`.

    ``plans`` is what `repair_plans` returned for ``rows``. Inserted turns have an empty text. A conversation of which
    nothing stays has no rows. The rows of a conversation follow each other in one partition, sorted by Spark with
    spilling, so nothing but a batch and the steps of one conversation is held in memory.
    """
    schema = StructType([StructField(conv_col, rows.schema[conv_col].dataType), *StructType.fromDDL("place long, role string, text string").fields])

    def made(events):
        conv = place = None
        for kind, first, second in events:
            if kind == "begin":
                conv, place = first[conv_col], 0
            elif kind == "turn":
                yield conv, place, first, second
                place += 1
    return _streamed(rows, plans, (conv_col, turn_col, role_col, text_col), schema, made)


def repaired_digests(rows: DataFrame, plans: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                     text_col: str = "text") -> DataFrame:
    """``plans`` with ``repaired_sha256``, the digest of the repaired ``role:text``, joined by line feeds.

    The digest is fed turn by turn; a conversation that stays empty has the digest of the empty text.
    """
    kept = [f for f in plans.schema.fields if f.name not in ("symbols", "steps")]
    schema = StructType([*kept, *StructType.fromDDL("repaired_sha256 string").fields])

    def made(events):
        digest, between = None, b""
        for kind, first, second in events:
            if kind == "begin":
                digest, between = hashlib.sha256(), b""
            elif kind == "turn":
                digest.update(between + first.encode() + b":" + second.encode())
                between = b"\n"
            else:
                yield *(first[f.name] for f in kept), digest.hexdigest()
    return _streamed(rows, plans, (conv_col, turn_col, role_col, text_col), schema, made)
