import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from foliospark.llm import vectors
from foliospark.session import local_rows

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, home long"


def brute(rows, least=0.9):
    good = {i: np.array(v, np.float64) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids = sorted(good)
    near = {i: set() for i, _ in rows}
    for i in ids:
        for j in ids:
            if i != j and good[i].size == good[j].size:
                a, b = good[i] / np.linalg.norm(good[i]), good[j] / np.linalg.norm(good[j])
                if a @ b >= least:
                    near[i].add(j)
    label = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for i in near:
            for j in near[i]:
                if label[j] < label[i]:
                    label[i], changed = label[j], True
    return {i: (len(near[i]), label[i]) for i, _ in rows}


def frame(spark, rows):
    return local_rows(spark, [(i, v, None, "c", 1) for i, v in rows], SCHEMA)


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    points = np.float32(np.repeat(centres, 30, 0) + rng.normal(scale=0.28, size=(1200, 16)))
    rows = [(int(i), [float(x) for x in p]) for i, p in zip(rng.permutation(1200), points)]
    rows += [(2000 + i, rows[0][1]) for i in range(50)] + [(3000, [2 * x for x in rows[1][1]])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(frame(spark, rows)).collect()}
    want = brute(rows)
    found, true = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert found >= 0.98 * true
    assert np.mean([got[i][1] == want[i][1] for i in want]) >= 0.98


def test_blocks_of_a_cell_add_up(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in (np.eye(8)[i % 3] + rng.normal(scale=0.05, size=8))]) for i in range(200)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_traversal_goes_from_near_to_far():
    rng = np.random.default_rng(1)
    index = vectors.MultiIndex(rng.normal(size=(7, 4)), rng.normal(size=(5, 4)))
    one, two = (d[0] for d in index.distances(rng.normal(size=(1, 8))))
    cells = list(index.traverse(one, two))
    every = sorted((float(one[i] + two[j]) - float(one.min() + two.min()), i * 5 + j) for i in range(7) for j in range(5))
    assert len({c for c, _ in cells}) == 35
    assert np.allclose([a for _, a in cells], [a for a, _ in every])


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, None]),
            (9, [1.0, 0.0, 0.0]), (10, [1e-30, 0.0]), (11, [3e38, 3e38]), (12, [0.0, -1.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(frame(spark, rows)).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in brute(rows).items()}
    assert got[10] == (2, 1, False) and got[9] == (0, 9, True)
    assert vectors.near_vectors(frame(spark, rows).limit(0)).count() == 0
    assert vectors.near_vectors(frame(spark, rows[2:8])).where(F.col("n_links") > 0).count() == 0


def test_recall_on_the_given_table_with_links(spark):
    """The given vectors have no link at the limit, so each has a partner that is turned a little."""
    given = [(r.vec_id, np.array(r.embedding, np.float64)) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist()) for i, v in given]
    rows += [(i + 10_000, (v + 0.05 * rng.normal(size=v.size) * np.linalg.norm(v)).tolist()) for i, v in given]
    want, got = brute(rows), {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(frame(spark, rows)).collect()}
    assert sum(n for n, _ in want.values()) >= 900
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())


def test_recall_where_links_are_rare(spark):
    """One vector in a hundred has a link; the queries of the sample have to be those with links."""
    for seed in (1, 2):
        rng = np.random.default_rng(seed)
        points = rng.normal(size=(4000, 64))
        points[1:40:2] = points[:40:2] + rng.normal(scale=0.45, size=(20, 64))
        rows = [(int(i), [float(np.float32(x)) for x in p]) for i, p in zip(rng.permutation(4000), points, strict=True)]
        units = np.array([p for _, p in rows])
        units /= np.linalg.norm(units, axis=1)[:, None]
        true = int((units @ units.T >= 0.9).sum()) - 4000
        assert 20 <= true <= 40
        assert sum(r.n_links for r in vectors.near_vectors(frame(spark, rows)).collect()) >= 0.98 * true


def test_all_cells_that_can_hold_a_link(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = vectors.MultiIndex(x[:9, :4], x[:9, 4:], None, 0.2)
    cells = [index.visits(a, b) for a, b in zip(*index.distances(x), strict=True)]
    assert all(cells[j][0] in cells[i] for i, j in np.argwhere(x @ x.T >= 0.9))
    rows = [(i, [float(np.float32(v)) for v in p]) for i, p in enumerate(x)]
    assert {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(frame(spark, rows), all_cells=True).collect()} == brute(rows)


def linked(seed, n, pairs, dims=64):
    """Random vectors of which ``pairs`` have a partner at a cosine of just over 0.9, and their true number of links."""
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, dims))
    points /= np.linalg.norm(points, axis=1)[:, None]
    away = rng.normal(size=(pairs, dims))
    first = points[:2 * pairs:2]
    away -= (away * first).sum(1)[:, None] * first
    points[1:2 * pairs:2] = 0.905 * first + (1 - 0.905 ** 2) ** 0.5 * away / np.linalg.norm(away, axis=1)[:, None]
    return rng.permutation(n), points, 2 * pairs


def test_recall_and_visits_where_no_sample_query_has_a_link(spark, monkeypatch):
    """One vector in a hundred and in a thousand has a link and 8 queries are compared: the turned vectors set the depth."""
    monkeypatch.setattr(vectors, "FIT_QUERIES", 8)
    for pairs in (100, 10):
        ids, points, true = linked(pairs, 20_000, pairs)
        table = spark.createDataFrame(pa.table({"vec_id": pa.array(ids), "embedding": pa.array(list(points), pa.list_(pa.float64()))}))
        assert sum(r.n_links for r in vectors.near_vectors(table).where("n_links > 0").collect()) >= 0.95 * true
    index = vectors.MultiIndex(vectors._fit(points[:, :32], 10), vectors._fit(points[:, 32:], 10))
    index.depth = vectors.turned_depth(index, points[:4000], 0.9)
    one, two = index.distances(points[4000:5000])
    assert np.mean([len(index.visits(a, b)) for a, b in zip(one, two, strict=True)]) < 10  # of 100 cells
    large = vectors.MultiIndex(vectors._fit(points[:, :32], 50, 4), vectors._fit(points[:, 32:], 50, 4))
    large.depth = vectors.turned_depth(large, points[:4000], 0.9)
    one, two = large.distances(points[4000:5000])
    assert np.mean([len(large.visits(a, b)) for a, b in zip(one, two, strict=True)]) < 50  # of 2500 cells


def test_rows_of_one_id_are_one_vector(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 2.0]), (3, [0.0, 2.0]), (4, [-1.0, 0.0]), (4, [-1.0, 0.1]), (5, [-1.0, 0.05])]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(frame(spark, rows)).collect())
    assert got == [(1, 0, 1), (1, 0, 1), (2, 1, 2), (3, 1, 2), (3, 1, 2), (4, 1, 4), (4, 1, 4), (5, 1, 4)]
