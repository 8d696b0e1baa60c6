import random
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from foliospark.llm import omh
from foliospark.llm.components import components
from foliospark.session import local_rows
from tests.llm.helpers import LONG, TEXTS, awkward


def shingle_list(text, k=5):
    w = text.lower().split()
    return [tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []


def common_in_order(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, best[j] = best[j], max(best[j], best[j - 1], before + (x == y))
    return best[-1]


def similarity(a, b):
    a, b = shingle_list(a), shingle_list(b)
    if not a or not b:
        return 0.0
    c = common_in_order(a, b)
    return c / (len(a) + len(b) - c)


def classes(rows, linked):
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in rows:
        for j, b in rows:
            if i < j and find(i) != find(j) and linked(a, b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i, _ in rows}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(0, 3), max_size=30), st.sampled_from([0.1, 0.3, 0.5, 0.8]))
def test_alignment_equals_plain_dynamic_programming(a, b, least):
    c = common_in_order(a, b)
    true = c / (len(a) + len(b) - c) if a and b else 0.0
    got = omh.aligned_similarity(np.array(a, np.uint64), np.array(b, np.uint64), least)
    assert abs(got - (true if true >= least - 1e-12 else 0.0)) < 1e-9


def test_alignment_of_long_texts():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 60, 40_000).astype(np.uint64)
    b = np.delete(a, rng.integers(0, a.size, 500))
    assert abs(omh.aligned_similarity(a, b) - b.size / a.size) < 1e-9
    assert omh.aligned_similarity(a, rng.permutation(a)) == 0.0


def test_occurrences_and_order_count():
    items = np.array([5, 7, 5, 5, 7], np.uint64)
    assert len(set(omh.labelled(items).tolist())) == 5
    many = omh.labelled(np.arange(300, dtype=np.uint64))
    assert (omh.order_sketch(many) == omh.order_sketch(many.copy())).all()
    assert (omh.order_sketch(many) == omh.order_sketch(many[::-1].copy())).sum() == 0


def mutated(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_classes_equal_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows, i = [], 0
    for family in range(12):
        text = " ".join(rng.choice(vocabulary) for _ in range(150))
        for k in range(6):
            rows.append((i := i + 1, mutated(rng, text, k * 2)))
    for _ in range(25):  # a shared passage alone does not make texts similar
        rows.append((i := i + 1, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(90))))
    for n in (3, 3, 5, 1):
        rows.append((i := i + 1, " ".join(["short"] * n)))
    rng.shuffle(rows)
    want = classes(rows, lambda a, b: similarity(a, b) >= 0.8)
    got = {r.doc_id: r.component for r in omh.near_duplicates(awkward(spark, rows)).collect()}
    assert got == want


def test_many_copies_of_one_text(spark):
    rng = random.Random(6)
    text = " ".join(f"v{rng.randrange(5000)}" for _ in range(200))
    rows = [(i, text if i % 2 else mutated(rng, text, 2)) for i in range(1, 300)]
    got = {r.component for r in omh.near_duplicates(awkward(spark, rows)).collect()}
    assert got == {1}


def test_awkward_rows(spark):
    docs = awkward(spark, TEXTS)
    got = defaultdict(set)
    for r in omh.near_duplicates(docs).collect():
        got[r.doc_id].add(r.component)
    assert got[1] == got[2] == got[6] == {1} and got[7] == got[8] == {7} and got[11] == got[12] == {11}
    assert got[3] == {3} and got[4] == {4} and got[5] == {5} and got[None] == {None}
    kept = omh.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([1, 3, 4, 5, 7, 9, 10, 11, 11, 13, None, None], key=str)
    assert omh.near_duplicates(docs.limit(0)).count() == 0 and omh.without_near_copies(docs.limit(0)).count() == 0
    assert LONG


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 60)] + [(70, 70), (200, 100)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    found = {r.id: r.component for r in components(local_rows(spark, edges, "a long, b long")).collect()}
    nodes = [(n, None) for n in sorted({x for e in edges for x in e})]
    links = set(edges)
    parent = {n: n for n, _ in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert found == {n: find(n) for n in parent}


def keys_of(text):
    return omh.order_sketch(omh.labelled(omh.shingles_of(text)))


def test_pairs_that_agree_in_few_sketches_are_compared(spark):
    """Two texts at 0.8 that share one or two keys, in all of which a text that is similar to neither has the smallest id."""
    rng = random.Random(8)

    def changed(text, places):
        return " ".join(f"new{rng.randrange(10**9)}" if i in places else w for i, w in enumerate(text.split()))
    while True:
        one = " ".join(f"v{rng.randrange(10**6)}" for _ in range(94))
        two = changed(one, {rng.randrange(5, 40), rng.randrange(50, 88)})
        same = keys_of(one) == keys_of(two)
        if not 1 <= same.sum() <= 2:
            continue
        heads = (changed(one, {rng.randrange(5, 25), rng.randrange(35, 55), rng.randrange(65, 88)}) for _ in range(500))
        head = next((h for h in heads if (keys_of(h) == keys_of(one))[same].all() and max(similarity(h, one), similarity(h, two)) < 0.8), None)
        if head:
            break
    assert similarity(one, two) >= 0.8
    got = {r.doc_id: r.component for r in omh.near_duplicates(awkward(spark, [(1, head), (2, one), (3, two)])).collect()}
    assert got == {1: 1, 2: 2, 3: 2}


def test_profiles_leave_out_no_similar_pair():
    rng = np.random.default_rng(9)
    for n in (4, 5, 9, 60, 700, 4000):
        for gone in range(1 + n // 9):
            a = rng.integers(0, 1 << 60, n).astype(np.uint64)
            b = np.concatenate([np.delete(a, rng.choice(n, gone, replace=False)), rng.integers(0, 1 << 60, int(rng.integers(0, gone + 1))).astype(np.uint64)])
            similar = omh.compare(a, b)[0] > 0
            sizes = tuple(np.array([x.size]) for x in (a, b))
            profiles = tuple(np.frombuffer(omh.profile(omh.labelled(x)), np.uint64)[None] for x in (a, b))
            assert not similar or omh._alike(np.array([0]), np.array([0]), sizes, profiles, 0.8).all()


def test_short_texts_that_differ_by_one_word_at_an_end(spark):
    rng = random.Random(10)
    rows = []
    for words in (7, 8, 9, 10, 11, 13):  # 3 and 4 shingles are 0.75, all others 0.8 or more
        for k in range(20):
            text = [f"s{rng.randrange(10**6)}" for _ in range(words + 1)]
            rows += [(len(rows) + 1, " ".join(text)), (len(rows) + 2, " ".join(text[1:] if k % 2 else text[:-1]))]
    want = classes(rows, lambda a, b: similarity(a, b) >= 0.8)
    assert sum(i == c for i, c in want.items()) == 140
    assert {r.doc_id: r.component for r in omh.near_duplicates(awkward(spark, rows)).collect()} == want


def test_short_texts_of_any_length_share_a_key():
    rng = np.random.default_rng(11)
    for more in range(5, omh.SHORT + 1):
        fewer = -(-4 * more // 5)
        for _ in range(20):
            a = rng.integers(0, 1 << 60, more).astype(np.uint64)
            b = np.delete(a, rng.choice(more, more - fewer, replace=False))
            one, two = (omh.text_keys(omh.labelled(x)) for x in (a, b))
            assert (one == two).any()
