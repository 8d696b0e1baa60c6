"""Near-duplicate vectors by an inverted multi-index."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import bounded_batches, spread_lookup
from foliospark.llm.components import components
from foliospark.session import staged

COSINE = 0.9
#: Share of the true links of the sample queries, and of sample vectors turned by the angle of the limit, that the traversal
#: has to reach.
RECALL, TURNED_RECALL = 0.995, 0.99
#: Bounds of the samples: vectors that the codebooks are fitted on and that are turned, and queries that are compared with
#: every vector.
FIT_ROWS, TURNED_ROWS, FIT_QUERIES = 20_000, 8192, 256
#: Queries that are compared at once.
QUERY_ROWS = 256
#: Vectors that a cell should hold on average, and rows of a block of a cell.
CELL_ROWS, BLOCK_ROWS = 200, 2048
BINS, WIDEST = 2048, 8.0


@dataclass
class MultiIndex:
    """Two codebooks, one for each half of a vector; a cell is a pair of their entries.

    Cells are searched down to ``depth``, or with None all that a vector within the squared distance ``reach`` can lie in.
    """

    first: np.ndarray
    second: np.ndarray
    depth: float | None = 0.0
    reach: float = 0.0

    def distances(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of both halves to the entries of their codebooks."""
        half = self.first.shape[1]
        return tuple(np.maximum((x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1), 0)
                     for x, book in ((units[:, :half], self.first), (units[:, half:], self.second)))

    def traverse(self, one: np.ndarray, two: np.ndarray) -> Iterator[tuple[int, float]]:
        """Cells from the nearest on, by the sum of both halves' distances, with how much farther than the nearest.

        Both codebooks are sorted by distance; a cell is queued when its left and its lower neighbour were visited.
        """
        by_one, by_two = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
        a, b = one[by_one], two[by_two]
        least = a[0] + b[0]
        queue, seen = [(0.0, 0, 0)], {(0, 0)}
        while queue:
            away, i, j = heapq.heappop(queue)
            yield int(by_one[i]) * two.size + int(by_two[j]), away
            for i2, j2 in ((i + 1, j), (i, j + 1)):
                if i2 < a.size and j2 < b.size and (i2, j2) not in seen:
                    seen.add((i2, j2))
                    heapq.heappush(queue, (float(a[i2] + b[j2] - least), i2, j2))

    def visits(self, one: np.ndarray, two: np.ndarray) -> list[int]:
        """The cells to search for a vector; the first one is its own."""
        if self.depth is None:
            return self._possible(one, two)
        out = []
        for cell, away in self.traverse(one, two):
            if away > self.depth and out:
                break
            out.append(cell)
        return out

    def _possible(self, one: np.ndarray, two: np.ndarray) -> list[int]:
        """All cells that can hold a link: half a vector is at least as far from a cell as from the plane before it."""
        away = []
        for book, d in ((self.first, one), (self.second, two)):
            apart = 2 * np.sqrt(((book - book[d.argmin()]) ** 2).sum(1))
            away.append(np.divide(d - d.min(), apart, out=np.zeros_like(d), where=apart > 0) ** 2)
        i, j = np.nonzero(away[0][:, None] + away[1] <= self.reach + 1e-9)
        home = int(one.argmin()) * two.size + int(two.argmin())
        cells = i * two.size + j
        return [home, *cells[cells != home].tolist()]


def _fit(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Codebook of at most ``k`` entries by Lloyd's rounds, started from points spread over the sample."""
    book = np.unique(points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)], axis=0)
    for _ in range(rounds):
        near = np.argmin((book * book).sum(1) - 2 * points @ book.T, axis=1)
        n = np.bincount(near, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, near, points)
        book = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], book)
    return book


def _units(df: DataFrame, id_col: str, vec_col: str, width: int) -> DataFrame:
    """``(id, dims, digest, unit)`` of the vectors that can be compared, in double precision, padded to ``width``."""
    bounded_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            ids, dims, digests, units = [], [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i is None or not v or any(x is None for x in v):
                    continue
                x = np.array(v, np.float64) + 0.0
                if not np.isfinite(x).all():
                    continue
                largest = np.abs(x).max()
                if largest == 0:
                    continue
                scaled = x / largest
                ids.append(i)
                dims.append(x.size)
                digests.append(hashlib.md5(x.tobytes(), usedforsecurity=False).digest())
                units.append(np.pad(scaled / np.sqrt(scaled @ scaled), (0, width - x.size)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()),
                                              pa.array(units, pa.list_(pa.float64()))], names=["id", "dims", "digest", "unit"])
    rows = df.select(df[id_col].cast("long").alias("id"), df[vec_col].cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "id long, dims int, digest binary, unit array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py():column.offsets[-1].as_py()].reshape(len(column), -1) \
        if len(column) else np.zeros((0, 0))


def fit_index(rows: DataFrame, count: int, least: float = COSINE, recall: float = RECALL, all_cells: bool = False) -> MultiIndex:
    """Codebooks from at most ``FIT_ROWS`` vectors, and the depth that the traversal has to reach for links.

    A link at the limit is a vector turned by the angle of the limit, so sample vectors are turned so far in random
    directions: the depth at which ``TURNED_RECALL`` of the pairs meet needs no links in the table, however rare they
    are. Real links may lie in worse directions; ``FIT_QUERIES`` sample queries are therefore compared with every
    vector, and if they have links the larger depth counts. The same is done at every size. ``all_cells`` sets no
    depth: all cells that a link can lie in are searched, which is exact and visits most of them.
    """
    sample = rows.orderBy(F.xxhash64("id"), "id").select("unit").limit(FIT_ROWS).toPandas()["unit"]
    points = np.array([np.asarray(x) for x in sample])
    half, k = (points.shape[1] + 1) // 2, max(1, round((count / CELL_ROWS) ** 0.5))
    index = MultiIndex(_fit(points[:, :half], k), _fit(points[:, half:], k) if points.shape[1] > half else np.zeros((1, 0)),
                       reach=2 - 2 * least)
    if all_cells:
        index.depth = None
        return index
    index.depth = turned_depth(index, points[:TURNED_ROWS], least)
    table = _link_depths(rows, index, 0, FIT_QUERIES, least)
    if len(table):
        reached = np.minimum(np.cumsum(table.sum(0)) / table.sum(), (np.cumsum(table, 1) / table.sum(1, keepdims=True)).mean(0))
        index.depth = max(index.depth, float(np.argmax(reached >= recall) * WIDEST / BINS))
    return index


def turned_depth(index: MultiIndex, units: np.ndarray, least: float) -> float:
    """The depth at which one of a unit vector and its copy, turned to the cosine ``least``, searches the other's cell."""
    away = np.random.default_rng(0).normal(size=units.shape) * (units != 0).any(0)  # not into the padding
    away -= (away * units).sum(1, keepdims=True) * units
    turned = least * units + (1 - least * least) ** 0.5 * away / np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    row, depths = np.arange(len(units)), []
    both = index.distances(units), index.distances(turned)
    for (a1, a2), (b1, b2) in (both, both[::-1]):
        depths.append(a1[row, b1.argmin(1)] + a2[row, b2.argmin(1)] - a1.min(1) - a2.min(1))
    return float(np.quantile(np.minimum(*depths), TURNED_RECALL, method="higher"))


def _link_depths(rows: DataFrame, index: MultiIndex, skip: int, many: int, least: float) -> np.ndarray:
    """Histograms of how deep the links of ``many`` sample queries lie, after the first ``skip``; one per query with links."""
    asked = rows.orderBy(F.xxhash64("id", F.lit(1)), "id").select("id", "dims", "unit").limit(skip + many).offset(skip).toPandas()
    if asked.empty:
        return np.zeros((0, BINS))
    queries = (asked["id"].to_numpy(), asked["dims"].to_numpy(), np.array([np.asarray(x) for x in asked["unit"]]))
    held = rows.sparkSession.sparkContext.broadcast((index, queries))

    def run(batches):
        index, (ids, dims, units) = held.value
        q1, q2 = index.distances(units)
        q_best, q_home = q1.min(1) + q2.min(1), (q1.argmin(1), q2.argmin(1))
        for batch in batches:
            x = _matrix(batch.column("unit"))
            if not len(x):
                continue
            x1, x2 = index.distances(x)
            x_ids, x_dims, x_best, x_home = batch.column("id").to_numpy(), batch.column("dims").to_numpy(), x1.min(1) + x2.min(1), (x1.argmin(1), x2.argmin(1))
            found = []
            for at in range(0, ids.size, QUERY_ROWS):
                part = slice(at, at + QUERY_ROWS)
                q, r = np.nonzero(units[part] @ x.T >= least)
                q += at
                real = (ids[q] != x_ids[r]) & (dims[q] == x_dims[r])
                q, r = q[real], r[real]
                there = q1[q, x_home[0][r]] + q2[q, x_home[1][r]] - q_best[q]
                back = x1[r, q_home[0][q]] + x2[r, q_home[1][q]] - x_best[r]
                bins = np.minimum(np.ceil(np.minimum(there, back) * (BINS / WIDEST)).astype(np.int64), BINS - 1)
                found.append(q * BINS + bins)
            places, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(places // BINS), pa.array(places % BINS), pa.array(n)], names=["q", "bin", "n"])
    seen = rows.select("id", "dims", "unit").mapInArrow(run, "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n")).collect()
    place = {q: i for i, q in enumerate(sorted({r["q"] for r in seen}))}
    table = np.zeros((len(place), BINS))
    for q, b, n in seen:
        table[place[q], b] = n
    return table


def _placed(rows: DataFrame, index: MultiIndex) -> DataFrame:
    """Each vector once in its own cell and once in each cell that it searches: ``(cell, asks, id, n, home, visits, unit)``."""
    held = rows.sparkSession.sparkContext.broadcast(index)
    names = ["cell", "asks", "id", "n", "home", "visits", "unit"]

    def run(batches):
        index = held.value
        for batch in batches:
            x = _matrix(batch.column("unit"))
            if not len(x):
                continue
            one, two = index.distances(x)
            visits = [index.visits(a, b) for a, b in zip(one, two, strict=True)]
            dims = batch.column("dims").to_numpy().astype(np.int64)
            wide = np.int64(len(index.first) * len(index.second))
            visits = [np.array(v, np.int64) + d * wide for v, d in zip(visits, dims, strict=True)]
            take = np.concatenate([np.arange(len(x)), np.repeat(np.arange(len(x)), [v.size for v in visits])])
            cells = np.concatenate([[v[0] for v in visits], *visits])
            home = np.array([v[0] for v in visits])[take]
            none = np.zeros(0, np.int64)
            lists = [*visits, *[none] * (take.size - len(x))]
            for at in range(0, take.size, 4000):
                part = slice(at, at + 4000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells[part]), pa.array(np.arange(take.size)[part] >= len(x)), batch.column("id").take(pa.array(take[part])),
                     batch.column("n").take(pa.array(take[part])), pa.array(home[part]), pa.array(lists[part], pa.list_(pa.int64())),
                     batch.column("unit").take(pa.array(take[part]))], names=names)
    return rows.select("id", "dims", "n", "unit").mapInArrow(
        run, "cell long, asks boolean, id long, n long, home long, visits array<long>, unit array<double>")


def _compare(table: pa.Table, least: float) -> pa.Table:
    """Links between the askers and the members of one block of a cell: ``(id, links, label)``.

    A link that the member finds as well, when it asks, is counted there; else both sides are counted here. Labels
    join what is linked inside the block, so that a block gives one edge per vector and not one per pair.
    """
    table = table.combine_chunks()
    asks = table.column("asks").to_numpy(zero_copy_only=False)
    members, askers = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
    empty = pa.table({"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "label": pa.array([], pa.int64())})
    if not len(members) or not len(askers):
        return empty
    x, q = (_matrix(t.column("unit").combine_chunks()) for t in (members, askers))
    xid, qid, xn, qn = (t.column(c).to_numpy() for c in ("id", "n") for t in (members, askers))
    near = (q @ x.T >= least) & (qid[:, None] != xid)
    if not near.any():
        return empty
    visits = members.column("visits").combine_chunks()
    flat, owner = visits.flatten().to_numpy(), np.repeat(np.arange(len(xid)), np.diff(visits.offsets.to_numpy()))
    home, links_x = askers.column("home").to_numpy(), np.zeros(xid.size, np.int64)
    for cell in np.unique(home[near.any(1)]):
        finds = np.zeros(xid.size, bool)
        finds[owner[flat == cell]] = True
        rows = home == cell
        links_x += np.where(finds, 0, qn[rows] @ near[rows])
    links_q = near @ xn
    label_q, label_x = qid.copy(), xid.copy()
    most = np.iinfo(np.int64).max
    while True:
        new_x = np.minimum(label_x, np.where(near, label_q[:, None], most).min(0))
        new_q = np.minimum(label_q, np.where(near, new_x, most).min(1))
        if (new_x == label_x).all() and (new_q == label_q).all():
            break
        label_x, label_q = new_x, new_q
    some_x, some_q = near.any(0), near.any(1)
    return pa.table({"id": pa.array(np.concatenate([qid[some_q], xid[some_x]])),
                     "links": pa.array(np.concatenate([links_q[some_q], links_x[some_x]])),
                     "label": pa.array(np.concatenate([label_q[some_q], label_x[some_x]]))})


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = COSINE,
                 recall: float = RECALL, all_cells: bool = False) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    Equal vectors are one entry of the index and count as links of each other. Every entry lies in the cell of its
    nearest codebook entries and asks the members of the nearest cells, as deep as `fit_index` says; what it finds is
    compared in double precision. A cell is compared in blocks of bounded size. With ``all_cells`` each cell that can
    hold a link is asked, for a result without misses at the cost of most pairs.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
    different lengths. Rows of one id are one vector: repeated rows count once, and of different vectors under one id the
    one with the smallest MD5 is compared; each row is returned with the result of its id. Rows with a null id link with
    nothing. Ids are cast to long; a text that is no number is an error. Very long vectors are compared whole. An empty
    table gives no rows; further columns are ignored.
    """
    width = vectors.agg(F.max(F.size(vectors[vec_col]))).first()[0] or 0
    every = vectors.select(vectors[id_col].cast("long").alias("id"))
    alone = every.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    if width <= 0:
        return alone
    rows = staged(_units(vectors, id_col, vec_col, width), "units")
    single = staged(rows.groupBy("id").agg(F.min("digest").alias("digest")), "single")
    groups = staged(single.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("n")), "groups")
    entries = staged(rows.join(groups, ["digest", "id"]).dropDuplicates(["id"]).select("id", "dims", "n", "unit"), "entries")
    count = entries.count()
    if count == 0:
        return alone
    index = fit_index(entries, count, least, recall, all_cells)
    placed = staged(_placed(entries, index), "placed")
    parts = placed.groupBy("cell").agg(*[F.ceil(F.count_if(c) / BLOCK_ROWS).cast("int").alias(n) for n, c in
                                         (("member_blocks", ~F.col("asks")), ("asker_blocks", F.col("asks")))])
    parts = parts.where("member_blocks > 0 AND asker_blocks > 0")
    sized = spread_lookup(placed, parts, ["cell"], ["id"])
    own = F.pmod(F.xxhash64("id"), F.when(F.col("asks"), F.col("asker_blocks")).otherwise(F.col("member_blocks"))).cast("int")
    others = F.when(F.col("asks"), F.col("member_blocks")).otherwise(F.col("asker_blocks"))
    dealt = sized.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    dealt = dealt.withColumn("member_block", F.when(F.col("asks"), F.col("other")).otherwise(F.col("own"))).withColumn(
        "asker_block", F.when(F.col("asks"), F.col("own")).otherwise(F.col("other")))
    found = dealt.select("cell", "member_block", "asker_block", "asks", "id", "n", "home", "visits", "unit").groupBy(
        "cell", "member_block", "asker_block").applyInArrow(lambda t: _compare(t, least), "id long, links long, label long")
    found = staged(found, "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = components(found.select(F.col("id").alias("a"), F.col("label").alias("b")))
    entry = entries.select("id", "n").join(links, "id", "left").join(named, "id", "left").select(
        "id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    by_digest = groups.select("digest", "id").join(entry, "id").drop("id")
    known = spread_lookup(single, by_digest, ["digest"], ["id"]).select("id", "n_links", "component_id")
    return every.join(known, "id", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"))
