"""Near-duplicates by order MinHash and banded alignment."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import bounded_batches, mix, shingle_hashes, spread_lookup, word_hashes
from foliospark.llm.components import components
from foliospark.session import staged

SHINGLE = 5
SIMILARITY = 0.8
#: Each of SKETCHES hash functions keeps the ORDERED smallest shingles of a text, in text order, as one key.
#: Two long texts at the limit of 0.8 agree in a key with a chance of about 0.8^6, so they miss all 40 with 5 in a million.
#: Short ones do so less often: 24 common shingles of 30 miss with 3 in a hundred thousand, 8 of 10 with 3 in a thousand,
#: and texts of fewer than ORDERED shingles only agree if they have the same number. So texts of up to SHORT shingles have
#: SKETCHES further keys of the ORDERED_SHORT smallest; 4 common shingles of 5 miss these with 2 in a thousand million.
SKETCHES = 40
ORDERED = 6
SHORT, ORDERED_SHORT = 60, 3
#: In keys that hold several components after every member was compared with the smallest one, each member of a smaller
#: component first asks for its BEST most similar ones. That only sets the order: all pairs still open are compared then.
BEST = 3
#: Bits of a text's profile: how many of its shingles fall on a bit, odd or even.
PROFILE = 1024
#: Members of a key that are compared with each other at once.
BLOCK_ROWS = 512
_SEEDS = mix(np.arange(1, 1 + 2 * SKETCHES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS, _SHIFTS = _SEEDS[:SKETCHES] | np.uint64(1), _SEEDS[SKETCHES:]


def shingles_of(text: str, k: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of ``k`` words in text order; words are split at white space, capitals A to Z are lowered."""
    return shingle_hashes(word_hashes(text, lower=True), k)


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Shingles with the number of their occurrence, so that a repeated one counts as often as it occurs."""
    if shingles.size < 2:
        return mix(shingles)
    order = np.argsort(shingles, kind="stable")
    held = shingles[order]
    starts = np.concatenate([[True], held[1:] != held[:-1]])
    at = np.arange(held.size)
    turn = np.empty(held.size, np.uint64)
    turn[order] = (at - np.maximum.accumulate(np.where(starts, at, 0))).astype(np.uint64)
    return mix(shingles + turn * np.uint64(0xD6E8FEB86659FD93))


def order_sketch(items: np.ndarray, ordered: int = ORDERED) -> np.ndarray:
    """One key per hash function: the ``ordered`` smallest items under it, in the order of the text."""
    n, least = items.size, min(ordered, items.size)
    limit = np.uint64(min(2**64 - 1, int(2**64 * min(1.0, (ordered + 14) / n))))
    keys = np.arange(1, SKETCHES + 1, dtype=np.uint64)
    step = max(1, (1 << 20) // n)
    for at in range(0, SKETCHES, step):
        values = items * _FACTORS[at:at + step, None] + _SHIFTS[at:at + step, None]
        function, place = np.nonzero(values <= limit)
        many = np.bincount(function, minlength=len(values))
        if many.min() < least:  # rare: too few items below the limit, so all are ranked
            function, place = np.divmod(np.arange(values.size), n)
            many = np.full(len(values), n)
        order = np.lexsort((values[function, place], function))
        rank = np.arange(order.size) - np.repeat(np.cumsum(many) - many, many)
        chosen = np.sort(place[order[rank < least]].reshape(len(values), least), axis=1)
        for column in chosen.T:
            keys[at:at + step] = keys[at:at + step] * np.uint64(0x9E3779B97F4A7C15) + items[column]
    return mix(keys)


def text_keys(items: np.ndarray) -> np.ndarray:
    """All keys of a text; those of short texts come last."""
    keys = order_sketch(items)
    return keys if items.size > SHORT else np.concatenate([keys, mix(order_sketch(items, ORDERED_SHORT) + np.uint64(SHORT))])


def profile(items: np.ndarray) -> bytes:
    """For each of ``PROFILE`` bits whether an odd number of items falls on it.

    Two texts differ in at least as many items as their profiles do in bits.
    """
    many = np.bincount((items % np.uint64(PROFILE)).astype(np.int64), minlength=PROFILE)
    return np.packbits((many & 1).astype(np.uint8)).tobytes()


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, digest, keys, size, profile)``: digest of the word sequence, order sketch, number and profile of the shingles.

    Texts without words have no keys.
    """
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            digests, keys, sizes, profiles = [], [], [], []
            for text in batch.column(1):
                words = word_hashes(text.as_py() or "", lower=True)
                places = np.arange(1, words.size + 1, dtype=np.uint64)
                # Two sums over words and places: a 128-bit digest of the sequence.
                digests.append((np.array([np.sum(mix(words + places * _FACTORS[k]), dtype=np.uint64) for k in (0, 1)])).tobytes())
                items = labelled(shingle_hashes(words, SHINGLE))
                keys.append(text_keys(items).view(np.int64) if words.size else np.zeros(0, np.int64))
                sizes.append(items.size)
                profiles.append(profile(items))
            offsets = np.concatenate([[0], np.cumsum([k.size for k in keys])]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(offsets, flat),
                                              pa.array(sizes, pa.int64()), pa.array(profiles, pa.binary())],
                                             names=["id", "digest", "keys", "size", "profile"])
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return texts.mapInArrow(run, "id long, digest binary, keys array<long>, size long, profile binary")


def compare(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> tuple[float, float]:
    """How similar two texts' shingles are in text order, 0 if below ``least``; and in any order.

    Both are common shingles by all shingles of both texts. The second one bounds the first from above and spares
    most hopeless pairs the alignment. For the first, the longest common sequence is sought by diagonals, and only in
    the band that a result of at least ``least`` can lie in: with c common ones of n + m, c / (n + m - c) >= least
    allows few insertions and deletions.
    """
    n, m = a.size, b.size
    if n == 0 or m == 0:
        return 0.0, 0.0
    both, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    common = int(np.minimum(np.bincount(inverse[:n], minlength=both.size), np.bincount(inverse[n:], minlength=both.size)).sum())
    need = int(_needed(n + m, least))
    edits = _edits(inverse[:n], inverse[n:], n + m - 2 * need) if common >= need else None
    found = 0 if edits is None else (n + m - edits) // 2
    return found / (n + m - found), common / (n + m - common)


def _needed(total, least: float):
    """Common shingles that two texts of ``total`` shingles together need for a similarity of ``least``."""
    return np.ceil(least / (1 + least) * total - 1e-9)


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    return compare(a, b, least)[0]


def _edits(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Insertions and deletions that turn ``a`` into ``b``, None if more than ``most``.

    Furthest-reaching points on each diagonal of the band -most .. most; runs of equal items are crossed in strides.
    """
    n, m = a.size, b.size
    reach = np.full(2 * most + 3, -1, np.int64)
    middle = most + 1
    reach[middle + 1] = 0
    for edits in range(most + 1):
        ks = np.arange(-edits, edits + 1, 2)
        ks = ks[(ks >= -m) & (ks <= n)]
        down, right = reach[middle + ks + 1], reach[middle + ks - 1] + 1
        x = np.maximum(np.where(ks == -edits, down, np.where(ks == edits, right, np.maximum(down, right))), 0)
        x = np.minimum(x, n)
        live = np.arange(ks.size)
        while live.size:
            ok = (x[live] < n) & (x[live] - ks[live] < m) & (x[live] - ks[live] >= 0)
            live = live[ok]
            if live.size == 0:
                break
            if live.size <= 4:
                for i in live.tolist():
                    x[i] = _slide(a, b, int(x[i]), int(x[i] - ks[i]))
                break
            live = live[a[x[live]] == b[x[live] - ks[live]]]
            x[live] += 1
        reach[middle + ks] = x
        if np.any((x >= n) & (x - ks >= m)):
            return edits
    return None


def _slide(a: np.ndarray, b: np.ndarray, x: int, y: int) -> int:
    """The end of the run of equal items that starts at ``x`` and ``y``."""
    step = 64
    while x < a.size and y < b.size:
        k = min(step, a.size - x, b.size - y)
        odd = np.flatnonzero(a[x:x + k] != b[y:y + k])
        if odd.size:
            return x + int(odd[0])
        x, y, step = x + k, y + k, step * 2
    return x


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """``(a, b, linked, away)`` for the rows of ``pairs``: whether the texts are similar, and their distance in any order.

    ``texts(id, text)`` holds the candidates only. ``a`` may be the same in a third of all pairs, so its text is sent
    to each task once and not to one task.
    """
    bounded_batches(pairs.sparkSession)
    near = spread_lookup(pairs, texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), ["a"], ["b"])
    both = near.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches):
        known = functools.lru_cache(64)(shingles_of)
        for batch in batches:
            found = [compare(known(a.as_py()), known(b.as_py()), least) for a, b in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x >= least for x, _ in found], pa.bool_()),
                 pa.array([1 - y for _, y in found], pa.float64())], names=["a", "b", "linked", "away"])
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, linked boolean, away double")


def _alike(i: np.ndarray, j: np.ndarray, sizes: tuple, profiles: tuple, least: float) -> np.ndarray:
    """Which pairs of places can be similar by the numbers and the profiles of their shingles."""
    total = sizes[0][i] + sizes[1][j]
    most = total - 2 * _needed(total, least)
    keep = np.abs(sizes[0][i] - sizes[1][j]) <= most
    at = np.flatnonzero(keep)
    for part in np.split(at, range(1 << 15, at.size, 1 << 15)):
        keep[part] = np.bitwise_count(profiles[0][i[part]] ^ profiles[1][j[part]]).sum(1, dtype=np.int64) <= most[part]
    return keep


def _candidates(table: pa.Table, least: float, best: int) -> pa.Table:
    """Pairs ``(a, b)`` of one block of a key's members that may be linked although they are in different components.

    A pair that agrees in an earlier key as well is left to that key. Both distances to the key's smallest id may differ
    by at most ``1 - least``: distances in any order obey the triangle inequality and are no larger than those in text
    order. Nor may the texts differ in more shingles than a link allows, by their numbers and profiles. Nothing that
    could be linked is left out by these rules. With ``best`` each member outside the block's most frequent component
    asks for those that agree with it in most keys.
    """
    table = table.combine_chunks()
    left, right = (table.filter(pc.equal(table.column("side"), side)) for side in (0, 1))
    none = pa.table({n: pa.array([], pa.int64()) for n in ("a", "b", "asker", "agree")})
    if not len(left) or not len(right):
        return none
    place = table.column("place")[0].as_py()
    # In a further key of short texts all members have further keys; in others some may have none.
    width = 4 * SKETCHES * (1 if place < SKETCHES else 2)
    (a, ca, da, na, sa, fa), (b, cb, db, nb, sb, fb) = (
        (*(t.column(c).to_numpy() for c in ("id", "component", "away", "size")),
         *(np.frombuffer(b"".join(x[:wide] for x in t.column(c).to_pylist()), kind).reshape(len(t), -1)
           for c, kind, wide in (("signs", np.uint32, width), ("profile", np.uint64, None))))
        for t in (left, right))
    open_pairs = (ca[:, None] != cb) & (np.abs(da[:, None] - db) <= 1 - least + 1e-9) & (a[:, None] < b)
    i, j = np.nonzero(open_pairs)
    keep = _alike(i, j, (na, nb), (fa, fb), least)
    for k in range(place):
        keep &= sa[i, k] != sb[j, k]
    i, j = i[keep], j[keep]
    agree = np.zeros(i.size, np.int64)
    for k in range(sa.shape[1]):
        agree += sa[i, k] == sb[j, k]
    if not best or not i.size:
        return pa.table({"a": a[i], "b": b[j], "asker": a[i], "agree": agree})
    names, many = np.unique(np.concatenate([ca, cb]), return_counts=True)
    frequent, found = names[many.argmax()], []
    for side, (one, component, name) in enumerate(((i, ca, a), (j, cb, b))):
        order = np.lexsort((a[i] if side else b[j], -agree, one))
        asker = one[order]
        turn = np.arange(order.size) - np.searchsorted(asker, asker)
        order = order[(turn < best) & (component[asker] != frequent)]
        found.append((a[i[order]], b[j[order]], name[one[order]], agree[order]))
    return pa.table(dict(zip(("a", "b", "asker", "agree"), (np.concatenate(x) for x in zip(*found, strict=True)), strict=True)))


def _open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the keys that still hold several components, with their component."""
    named = staged(members.drop("component").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")), "named")
    sizes = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    return named.join(sizes.where("low < high").select("key", "n"), "key")


def _further_pairs(members: DataFrame, least: float, best: int) -> DataFrame:
    """Pairs to compare among open members, key by key in blocks of bounded size."""
    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    dealt = members.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    others = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    columns = ["key", "place", "id", "component", "away", "signs", "size", "profile", "own"]
    left = dealt.select(*columns, others, F.lit(0).alias("side")).withColumnsRenamed({"own": "left", "other": "right"})
    right = dealt.select(*columns, others, F.lit(1).alias("side")).withColumnsRenamed({"own": "right", "other": "left"})
    both = left.unionByName(right)
    pairs = both.groupBy("key", "left", "right").applyInArrow(
        lambda t: _candidates(t, least, best), "a long, b long, asker long, agree long")
    if best:
        order = Window.partitionBy("asker").orderBy(F.desc("agree"), "a", "b")
        pairs = pairs.distinct().withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= best)
    return pairs.select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``(id, component)`` for each row of ``docs``: texts linked directly or through others share the smallest id.

    Two texts are linked if their five-word shingles, aligned in text order, agree to ``least`` or more. Candidates
    share an order sketch. Rows of the same words are first brought to one representative. In each key the smallest
    id is compared with all members, which joins large groups of copies without pairing them. Where a key still
    holds several components, members of the smaller ones are compared with those most like them in all sketches, and then all
    pairs of different components are that are not too far apart for a link by their distances to the smallest id and
    by the numbers and profiles of their shingles. Copies of one component are not compared with each other again.

    Texts of fewer than five words are linked if they have the same words. Null texts and texts without words are
    linked with nothing. Repeated rows get equal results. Rows with a null id stand alone. An empty table gives no
    rows; further columns are ignored.
    """
    held = staged(sketches(docs, id_col, text_col), "sketches")
    known = held.where("id IS NOT NULL AND size(keys) > 0")
    heads = staged(known.groupBy("digest").agg(F.min("id").alias("head"), F.count("*").alias("n")), "heads", short=True)
    copies = spread_lookup(known.select("id", "digest"), heads.where("n > 1"), ["digest"], ["id"]).select("id", "head").where("id <> head")
    rows = known.join(heads.select("digest", F.col("head").alias("id")), ["digest", "id"], "left_semi").dropDuplicates(["id"])
    keys = rows.select("id", F.posexplode("keys").alias("place", "key"))
    shared = keys.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1")
    # A key with a large share of the rows is split by adaptive execution, as both sides are plain shuffles.
    members = staged(keys.join(shared.select("key", "a"), "key"), "members", short=True)

    text_of = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    candidates = members.select("id").distinct()
    texts = staged(text_of.join(candidates.hint("shuffle_hash"), "id", "left_semi").dropDuplicates(["id"]), "texts")
    first = members.where("a <> id").select("a", F.col("id").alias("b")).distinct()
    tested = staged(verified(staged(first, "pairs", short=True), texts, least), "tested", short=True)
    links = tested.where("linked").select("a", "b")

    # Four bytes of each key tell whether two texts agree in it.
    signs = F.unhex(F.array_join(F.transform("keys", lambda k: F.lpad(F.hex(k.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))
    open_members = _open_members(members, staged(components(links), "labels", short=True))
    distance = tested.select("a", F.col("b").alias("id"), "away")
    open_members = open_members.join(distance, ["a", "id"], "left").withColumn("away", F.coalesce("away", F.lit(0.0)))
    open_members = staged(open_members.join(rows.select("id", signs.alias("signs"), "size", "profile"), "id"), "open")
    for best in (BEST, 0):
        pairs = staged(_further_pairs(open_members, least, best).join(tested.select("a", "b"), ["a", "b"], "left_anti"), "pairs", short=True)
        tested = tested.unionByName(staged(verified(pairs, texts, least), "tested", short=True))
        links = tested.where("linked").select("a", "b")
        if best:
            open_members = staged(_open_members(open_members.drop("n"), staged(components(links), "labels", short=True)), "open")
    linked = links.union(copies.select(F.col("head").alias("a"), F.col("id").alias("b")))
    classes = staged(components(linked), "classes", short=True)
    return held.select("id").join(classes, "id", "left").select(
        F.col("id").alias(id_col), F.coalesce("component", "id").alias("component"))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their class; rules for nulls and ties as in `near_duplicates`."""
    kept = near_duplicates(docs, id_col, text_col, least).where(F.col(id_col) != F.col("component")).select(F.col(id_col).alias("_gone")).distinct()
    whole = docs.select(F.struct("*").alias("doc"), docs[id_col].cast("long").alias("_id"))
    return whole.join(kept.hint("shuffle_hash"), whole["_id"] == kept["_gone"], "left_anti").select("doc.*")
