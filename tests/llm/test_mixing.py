from collections import defaultdict

from foliospark.llm import mixing
from tests.llm.helpers import LONG, TEXTS, awkward, words


def level_targets(sizes):
    """Water filling, step by step."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = 2 * sizes[s]
        left -= sum(target[s] for s in over)
        free -= set(over)
    return target


def check(rows, got):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += len(words(r.text))
    target = level_targets(sizes)
    source = {r.doc_id: r.source for r in rows}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s]
        assert abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= len(sizes) + 1
    assert sum(taken.values()) == int(1.5 * sum(sizes.values()))


def test_sources_reach_their_targets(spark):
    rows = [(i, " ".join(["w"] * (i * 37 % 101))) for i in range(1, 400)]
    docs = awkward(spark, rows)
    check(docs.collect(), mixing.queue_documents(docs).collect())


def test_awkward_rows(spark):
    docs = awkward(spark, [r for r in TEXTS if r[0] is not None])
    got = mixing.queue_documents(docs).collect()
    check(docs.collect(), got)
    assert all(r.size == 0 and r.taken == 0 for r in got if r.doc_id in (3, 4, 5))


def test_reruns_agree(spark):
    docs = awkward(spark, [(i, "a b c d " * (i % 7)) for i in range(200)])
    one, two = (sorted(map(tuple, mixing.queue_documents(d).collect())) for d in (docs, docs.repartition(5)))
    assert one == two


def test_rows_of_the_mix(spark):
    docs = awkward(spark, [*[(i, "a b  c " * (i % 9)) for i in range(1, 60)], (70, LONG)])
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    plan = {r.doc_id: r.taken for r in mixing.queue_documents(docs).collect()}
    held = defaultdict(int)
    for r in mixed.collect():
        held[r.doc_id] += len(words(r.text))
    assert {k: v for k, v in plan.items() if v} == dict(held)


def test_repeated_rows_lose_no_word(spark):
    docs = awkward(spark, [*[(1, "a b c d e")] * 7, *[(2, "f g h")] * 5, (3, "i"), (None, "j k"), (None, "j k")])
    plan, held = defaultdict(int), defaultdict(int)
    for r in mixing.queue_documents(docs).collect():
        plan[r.doc_id] += r.taken
    for r in mixing.mixed_documents(docs).collect():
        held[r.doc_id] += len(words(r.text))
        assert len(words(r.text)) <= {1: 5, 2: 3, 3: 1, None: 2}[r.doc_id]
    assert {k: v for k, v in plan.items() if v} == dict(held)


def test_empty_table(spark):
    assert mixing.queue_documents(awkward(spark, [])).count() == 0
    assert mixing.mixed_documents(awkward(spark, [])).count() == 0
