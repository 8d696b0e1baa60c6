"""Conversation repair against a search over all edits, and the parts of its grammar."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from foliospark.llm import repair
from foliospark.llm.queries import damaged
from foliospark.session import local_rows

GOOD = re.compile(r"(s?(ua)+)?$")
SCHEMA = "conv_id long, turn long, role string, text string, tie string, symbols string, plan int"


def plain_faults(rows):
    seen, faults = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def plain_repair(rows):
    """Cost, audit and turns by a recursion over rows and the roles given so far, without states or grammar."""
    faults = plain_faults(rows)

    def open_end(roles):
        return re.match(r"(s?(ua)*u?)$", roles)

    @functools.cache
    def best(i, roles):
        # Only the last two roles and whether anything stands before them matter, but whole strings are followed here.
        found = []
        if i == len(rows):
            if GOOD.match(roles):
                found.append((0, "", ()))
        else:
            role, text = rows[i]
            rest = best(i + 1, roles)
            found += [(rest[0] + 2, "D" + rest[1], rest[2])] if rest else []
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] == "truncated" else 0
                for edit, name in (("K", role), ("R", "user"), ("R", "assistant")):
                    if name[:1] and open_end(roles + name[0]):
                        rest = best(i + 1, roles + name[0])
                        found += [(rest[0] + extra + (edit == "R"), edit + rest[1], ((name, text), *rest[2]))] if rest else []
        if len(roles) < 2 * len(rows) + 3:
            for name in ("user", "assistant"):
                if open_end(roles + name[0]):
                    rest = best(i, roles + name[0])
                    found += [(rest[0] + 5, "I" + rest[1], ((name, ""), *rest[2]))] if rest else []
        return min(found, default=None)
    return best(0, "")


def talk(dice, n):
    roles = ["user", "assistant", "system", "tool", " ", "s", "assistant", "user"]
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?", "More. ", "odd "]
    return [(dice.choice(roles), dice.choice(texts) if dice.random() < 0.6 else f"{dice.random()}.") for _ in range(n)]


@pytest.fixture(scope="module")
def talks():
    dice = random.Random(5)
    return {i: talk(dice, dice.randint(0, 6)) for i in range(150)}


def test_repairs_equal_a_search_over_all_edits(spark, talks):
    rows = local_rows(spark, [(c, t, role, text, "x", "y", 1) for c, said in talks.items() for t, (role, text) in enumerate(said)], SCHEMA)
    ids = local_rows(spark, [(c,) for c in talks], "conv_id long")
    plans = repair.repair_plans(rows, ids=ids)
    found = {r["conv_id"]: r for r in plans.collect()}
    turns = {}
    for r in repair.repaired_turns(rows, plans).orderBy("conv_id", "place").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.repaired_digests(rows, plans).collect()}
    assert set(found) == set(talks) == set(digests)
    for conv, said in talks.items():
        cost, audit, kept = plain_repair(tuple(said))
        assert (found[conv]["cost"], found[conv]["audit"]) == (cost, audit), said
        assert turns.get(conv, []) == list(kept)
        assert digests[conv] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        faults = plain_faults(said)
        assert [found[conv][f] for f in ("blank", "duplicate", "truncated")] == [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        assert found[conv]["illegal"] == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:], strict=False))


def test_nulls_ties_gaps_and_repeated_rows(spark):
    rows = [(1, None, "user", "a."), (1, 5, "assistant", "b."), (1, 9, None, None), (1, 9, "user", "c."), (1, 9, "user", "c."),
            (None, 1, "user", "x."), (None, 2, "assistant", "y."), (2, None, "user", "z.")]
    table = local_rows(spark, [(*r, None, None, None) for r in rows], SCHEMA)
    found = {r["conv_id"]: r for r in repair.repair_plans(table).collect()}
    assert (found[1]["gaps"], found[1]["blank"], found[1]["duplicate"]) == (3, 1, 1)
    assert (found[None]["cost"], found[None]["audit"], found[None]["gaps"]) == (0, "KK", 0)
    assert (found[2]["cost"], found[2]["audit"], found[2]["gaps"]) == (2, "D", 0)
    assert repair.repair_plans(table.limit(0)).count() == 0
    assert repair.repaired_turns(table.limit(0), repair.repair_plans(table.limit(0))).count() == 0


def test_a_long_conversation_is_gathered_in_segments(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 8)
    dice = random.Random(2)
    said = [(("user", "assistant")[dice.random() < 0.55], f"{i}" + dice.choice([".", ".", "", "?"])) for i in range(3000)]
    rows = local_rows(spark, [(7, t, role, text, None, None, None) for t, (role, text) in enumerate(said)], SCHEMA)
    plan = repair.repair_plans(rows).first()
    known = repair.matrices([])
    codes = [repair.SYMBOLS[role[0], 0 if text[-1] in ".?" else 3] for role, text in said]
    assert plan["symbols"] == "".join(codes)
    assert (plan["cost"], plan["audit"]) == repair.cheapest("".join(codes), [], known)  # without any rule


def test_the_grammar_changes_no_result(spark):
    dice = random.Random(9)
    forms = ["".join(dice.choices(list(repair.SYMBOLS.values()), [6, 1, 1, 1] * 4, k=dice.randint(0, 60))) for _ in range(200)]
    rounds = repair.grammar(local_rows(spark, [(f,) for f in forms], "symbols string"), rounds=6, rules=8)
    known, bare = repair.matrices(rounds), repair.matrices([])
    assert len(known) > len(bare) + 10
    for form in forms:
        assert repair.cheapest(form, rounds, known) == repair.cheapest(form, [], bare)
        short = form
        for rules in rounds:
            short = repair.replace_pairs(short, rules)
        back = {s: p for rules in rounds for p, s in rules.items()}
        while any(c in back for c in short):
            short = "".join(back.get(c, c) for c in short)
        assert short == form


def test_rules_do_not_overlap():
    rules = repair.choose_rules([("AB", 9), ("BC", 8), ("AA", 7), ("CD", 6), ("EE", 5), ("EF", 4)], 0x4E00)
    assert list(rules) == ["AB", "CD", "EE"]
    assert repair.count_pairs("AAAAAB") == {"AA": 2, "AB": 1}
    assert repair.replace_pairs("AAA", {"AA": "x"}) == "xA"


def test_ropes_compare_like_their_texts():
    dice = random.Random(3)

    def rope(depth):
        return repair.Rope("".join(dice.choices("DIK", k=dice.randint(0, 3)))) if not depth else rope(depth - 1) + rope(depth - 1)
    ropes = [rope(dice.randint(0, 4)) for _ in range(40)]
    ropes += [a + b for a in ropes[:6] for b in ropes[:6]]
    for a in ropes:
        for b in ropes[::3]:
            assert repair.before(a, b) == (str(a) < str(b))


def test_damage_follows_its_rule(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(30) for t in range(5)] + [(None, None, None, None)]
    out = damaged(local_rows(spark, rows, "conv_id long, turn long, role string, text string")).collect()
    expected = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            said = "" if kind == 1 else re.sub("[.!?]", "", text or " ") if kind == 2 else text or " "
            expected += [(conv, turn, "user" if kind == 4 else role or " ", said)] * (2 if kind == 3 else 1)
    assert sorted(map(tuple, out), key=str) == sorted(expected, key=str)
