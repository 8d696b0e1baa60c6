"""Ranked search against a plain search over every document, with small shards, bundles and passes."""

import math
import random
import re
from collections import Counter

import pytest

from foliospark.llm import lexical
from foliospark.session import local_rows
from tests.llm.helpers import TEXTS, awkward

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or ""))


def plain(docs, items, top=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 25 + 75 * c.total() * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda s: s[:3])[:top], 1)]
    return out


def result(rows):
    key = lambda r: tuple((v is None, v or 0) for v in r)
    return sorted((tuple(r) for r in rows), key=key)


def corpus(n, seed):
    dice = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    common = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(dice.choices(vocabulary, common, k=dice.randint(1, 40)))) for i in range(n)]
    items = [(i, " ".join(dice.choices(vocabulary, common, k=dice.randint(1, 12)))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("top,shard,bundle,pass_bytes", [(10, 4096, 256, 1 << 20), (3, 16, 4, 300), (1, 7, 25, 1 << 20)])
def test_equal_to_a_search_over_every_document(spark, monkeypatch, top, shard, bundle, pass_bytes):
    monkeypatch.setattr(lexical, "SHARD", shard)
    monkeypatch.setattr(lexical, "BUNDLE", bundle)
    docs, items = corpus(300, top)
    found = lexical.ranked(local_rows(spark, docs, "doc_id long, text string"), local_rows(spark, items, "item_id long, text string"),
                           top, pass_bytes=pass_bytes).collect()
    assert result(found) == result(plain(docs, items, top))


def test_awkward_rows_on_both_sides(spark):
    items = [(1, "alpha BETA gamma"), (1, "solo"), (None, "SOLO here"), (2, None), (3, "!!! ..."), (4, "ñandú é 漢字 12345"), (5, "w3x3 nowhere")]
    both = local_rows(spark, [(i, t, "x", 7) for i, t in items], "item_id long, text string, doc_id string, score long")
    found = lexical.ranked(awkward(spark, TEXTS), both).collect()
    assert result(found) == result(plain(TEXTS, items))
    assert [r["rank"] for r in found if r["item_id"] == 2] == []


def test_empty_tables(spark):
    docs, items = local_rows(spark, [(1, "a b")], "doc_id long, text string"), local_rows(spark, [(1, "a")], "item_id long, text string")
    for left, right in ((docs.limit(0), items), (docs, items.limit(0)), (docs, local_rows(spark, [(1, "?!")], "item_id long, text string"))):
        out = lexical.ranked(left, right)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_string_ids(spark):
    docs = local_rows(spark, [("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    found = lexical.ranked(docs, local_rows(spark, [("q", "x")], "item_id string, text string"))
    assert [tuple(r)[:3] for r in found.orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None)]


def test_long_texts_are_cut_only_between_terms(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 16)
    text = " ".join("ab" * (i % 17) + "É" for i in range(200)) + " " + "q" * 100
    assert [t for block in lexical.terms(text.encode()) for t in block] == [t.encode() for t in terms(text)]


def test_postings_need_no_shuffle_and_no_cross_join(spark):
    docs, items = corpus(50, 4)
    plan = lexical.ranked(local_rows(spark, docs, "doc_id long, text string"), local_rows(spark, items, "item_id long, text string"))
    text = plan._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert text.count("FlatMapCoGroupsInArrow") >= lexical.OWNERS and "WindowGroupLimit" in text
