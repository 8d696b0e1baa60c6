"""Packing tokenised documents into windows by best-fit decreasing."""

from __future__ import annotations

import json
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import bounded_batches, once, shuffle_width
from foliospark.session import staged

WINDOW = 1024
PIECES = "id long, start long, length int, ids_crc32 long, doc_tokens long"


class OpenWindows:
    """Open windows counted by remaining capacity, in a segment tree that finds the tightest one that fits.

    Leaf ``r`` holds runs of windows ``(first window, number of windows)`` with ``r`` places left; a node tells
    whether any leaf below it holds some. Because windows with the same room are interchangeable, a run stands for
    any number of them, and the tree has as many leaves as a window has places, whatever the number of documents.
    """

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.any = [0] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def _count(self, room: int, change: int) -> None:
        node = self.leaves + room
        while node:
            self.any[node] += change
            node //= 2

    def add(self, room: int, first: int, count: int) -> None:
        if room > 0 and count > 0:
            self.runs[room].append((first, count))
            self._count(room, 1)

    def tightest(self, size: int) -> int | None:
        """The smallest room of at least ``size``; climbs from the leaf to the next node with windows, then down."""
        node = self.leaves + size
        if self.any[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.leaves

    def take(self, room: int) -> tuple[int, int]:
        self._count(room, -1)
        return self.runs[room].pop()


def best_fit(counts: dict[int, int], window: int = WINDOW) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Place ``counts[length]`` pieces of each length, longest first, each in the tightest open window.

    Returns steps ``(length, first piece, pieces, first window, pieces per window, offset)`` and the number of
    windows. Piece ``first + i`` of a length lies in window ``first window + i // per``. A step serves a whole run of
    windows, so their number depends on the window's size and not on the number of pieces.
    """
    free, steps, opened = OpenWindows(window), [], 0
    for length in sorted(counts, reverse=True):
        done, todo = 0, counts[length]
        while todo:
            room = free.tightest(length)
            if room is None:
                room, first, count = window, opened, -(-todo // (window // length))
                opened += count
            else:
                first, count = free.take(room)
            per = room // length
            full = min(count, todo // per)
            if full:
                steps.append((length, done, full * per, first, per, window - room))
                free.add(room - per * length, first, full)
                done, todo, first, count = done + full * per, todo - full * per, first + full, count - full
            if todo and count:  # fewer pieces are left than one more window holds
                steps.append((length, done, todo, first, todo, window - room))
                free.add(room - todo * length, first, 1)
                done, todo, first, count = done + todo, 0, first + 1, count - 1
            free.add(room, first, count)
    return steps, opened


class Encoder:
    """Token ids of a text as little-endian 32-bit numbers, by a byte-level vocabulary.

    Where a blank stands between two characters that are no white space, a text's ids before and after it do not
    depend on each other. The parts between such blanks are looked up in a table of those seen first; the others are
    encoded together, and a token that starts with a blank is then the first one of its part. A text with other white
    space beside a blank, or with a special token in it, is encoded as a whole. Both ways give the same ids.
    """

    def __init__(self, vocabulary: str, special: str = "<|endoftext|>", held: int = 300_000):
        """``vocabulary`` is the content of the tokenizer's JSON file."""
        table, vocab = byte_of_letter(), json.loads(vocabulary)["model"]["vocab"]
        ranks = {bytes(table[c] for c in token): i for token, i in vocab.items() if token != special}
        self.special, self.held, self.seen = special, held, {}
        self.codec = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks,
                                       special_tokens={special: vocab.get(special, len(ranks))})
        self.spaced = np.zeros(max(ranks.values()) + 1, bool)
        self.spaced[[i for token, i in ranks.items() if token.startswith(b" ")]] = True

    def _whole(self, text: str) -> bytes:
        return self.codec.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()

    def _parts(self, parts: list[str]) -> list[bytes]:
        ids = np.array(self.codec.encode_ordinary(" " + " ".join(parts)), "<u4")
        starts = [*(4 * np.flatnonzero(self.spaced[ids])).tolist(), 4 * ids.size]
        data = ids.tobytes()
        return [data[i:j] for i, j in zip(starts[:-1], starts[1:], strict=True)]

    def __call__(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if not rest or not first or first[-1].isspace() or self.special in text:
            return self._whole(text)
        found = list(map(self.seen.get, rest))
        if None in found:
            new = list(dict.fromkeys([w for w, ids in zip(rest, found, strict=True) if ids is None]))
            if any(not w or w[0].isspace() or w[-1].isspace() for w in new):
                return self._whole(text)
            made = dict(zip(new, self._parts(new), strict=True))
            found = [made[w] if ids is None else ids for w, ids in zip(rest, found, strict=True)]
            if len(self.seen) < self.held:
                self.seen.update(made)
        return self._whole(first) + b"".join(found)


#: Fixed value: the split of a text before byte pairs are merged, as the vocabulary's own documentation gives it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in such a vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def token_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Cut each document's ids, with ``end_id`` after them, into full windows and a rest.

    Columns: id, start, length, ids_crc32, doc_tokens and, if asked for, the ids as 32-bit little-endian bytes.
    """
    bounded_batches(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary file, a few megabytes
    end = end_id.to_bytes(4, "little")
    kinds = [("id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    kinds += [("ids", pa.binary())] * with_ids

    def run(batches):
        encode = once(("encoder", vocabulary), lambda: Encoder(content.value))
        for batch in batches:
            out = [[] for _ in kinds]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py()) + end
                n = len(ids) // 4
                for start in range(0, n, window):
                    piece = ids[4 * start:4 * (start + window)]
                    for column, value in zip(out, (doc, start, len(piece) // 4, zlib.crc32(piece), n, piece), strict=False):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(out, kinds, strict=True)], names=[n for n, _ in kinds])
    texts = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, PIECES + ", ids binary" * with_ids)


def _numbered(pieces: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0: by shard first, then inside a shard, so that no length is one task."""
    shards = shuffle_width(pieces.sparkSession)
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("id", "start"), F.lit(shards)).cast("int"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sums = pieces.groupBy("length", "shard").agg(F.count("*").alias("n"))
    sums = sums.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy("length", "shard").orderBy("id", "start", "ids_crc32")) - 1
    return pieces.withColumn("inside", inside).join(sums, ["length", "shard"]).withColumn(
        "number", (F.col("ahead") + F.col("inside")).cast("long")).drop("inside", "ahead", "shard")


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Give each piece a ``sequence_id`` and an ``offset``; ``pieces`` is a stored table with a ``length`` of 1 to ``window``.

    Pieces of one length are interchangeable, so the best fit is found on the number of pieces per length, which is at
    most ``window`` numbers, and covers the whole table at once. Each piece then finds its step by length and number.
    """
    counts = dict(map(tuple, pieces.groupBy("length").count().collect()))  # at most one row per length up to the window
    steps, _ = best_fit(counts, window)
    table = np.array(sorted(steps), np.int64).reshape(-1, 6)
    held = pieces.sparkSession.sparkContext.broadcast(table)
    numbered = _numbered(pieces)

    def run(batches):
        steps = held.value
        keys = steps[:, 0] << 44 | steps[:, 1]
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            step = steps[np.searchsorted(keys, length.astype(np.int64) << 44 | number, "right") - 1]
            turn = number - step[:, 1]
            sequence = step[:, 3] + turn // step[:, 4]
            offset = step[:, 5] + turn % step[:, 4] * length
            rest = [c for c in batch.schema.names if c != "number"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(sequence), pa.array(offset)],
                                             names=[*rest, "sequence_id", "offset"])
    schema = numbered.drop("number").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    return numbered.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Tokenise ``docs`` and pack the pieces: one row per piece with its place in a sequence.

    Overlong documents are cut into full windows first; the rests go, longest first, into the tightest open window.
    Null and empty texts are one piece that holds the end id alone. Repeated rows are separate documents. Pieces of one
    length are numbered by id and start, so reruns agree. An empty table gives no rows; further columns are ignored.
    """
    pieces = staged(token_pieces(docs, vocabulary, id_col, text_col, window, end_id, with_ids), "pieces")
    return pack(pieces, window).withColumnRenamed("id", id_col)


def windows(packed: DataFrame) -> DataFrame:
    """The sequences themselves, ``(sequence_id, ids)``, from packed pieces with ids; at most one window's pieces meet."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
