"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import bounded_batches, once

LONGEST = 3
PROFILE = 400
BLOCK = 1 << 18
#: The share of documents that may score lower than the score the threshold is taken from, the part of that score which is
#: the threshold, and the steps that scores are counted in.
THRESHOLD_SHARE, THRESHOLD_PART, THRESHOLD_STEPS = 0.01, 0.5, 10_000


def letter_table() -> np.ndarray:
    """Whether a code point is a letter."""
    table = np.zeros(sys.maxunicode + 2, bool)
    table[[i for i in range(sys.maxunicode + 1) if chr(i).isalpha()]] = True
    return table


class Grams:
    """Counts of n-grams of one to three characters inside words, in lower case, a word's ends as a blank.

    A gram is one number: up to three code points of 21 bits. Whole texts are counted, long ones block by block.
    """

    def __init__(self):
        self.letters = letter_table()

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        text = text.lower()
        found = [self._block(text[max(0, at - 2):at + BLOCK], at == 0, at + BLOCK >= len(text)) for at in range(0, len(text), BLOCK)]
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(found) == 1:
            return found[0]
        grams, place = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
        return grams, np.bincount(place, np.concatenate([n for _, n in found]), grams.size).astype(np.int64)

    def _block(self, text: str, first: bool, last: bool) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the grams that end in this block; a later block starts with two characters of the one before."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(self.letters[points], points, 32).astype(np.uint64)
        blank = np.array([32], np.uint64)
        points = np.concatenate([blank] * first + [points] + [blank] * last)
        letter = points != 32
        seen = 1 if first else 2
        two = (points[:-1] << np.uint64(21) | points[1:])[seen - 1:]
        three = points[:-2] << np.uint64(42) | points[1:-1] << np.uint64(21) | points[2:]
        grams = np.concatenate([points[seen:][letter[seen:]], two[(letter[:-1] | letter[1:])[seen - 1:]], three[letter[1:-1]]])
        grams.sort()
        if grams.size == 0:
            return grams, np.zeros(0, np.int64)
        starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        return grams[starts], np.diff(np.append(starts, grams.size))


def ranked(grams: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent grams, most frequent first, ties by number."""
    if grams.size > 4 * most:
        least = np.partition(counts, -most)[-most]
        held = counts >= least
        grams, counts = grams[held], counts[held]
    return grams[np.lexsort((grams, -counts))][:most]


@dataclass
class Profiles:
    """Ranks of grams for each language; one row per language, at most ``size`` ranks each."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray  # languages x grams, ``size`` where a gram is not in the profile
    size: int

    def distances(self, top: np.ndarray) -> np.ndarray:
        """Out-of-place distance to each language: how far each gram's rank is from that in the profile."""
        at = np.searchsorted(self.grams, top)
        at[at == self.grams.size] = 0
        known = self.grams[at] == top
        ranks = np.where(known, self.ranks[:, at], self.size)
        away = np.abs(ranks - np.arange(top.size))
        away[ranks == self.size] = self.size
        return away.sum(axis=1)

    def best(self, top: np.ndarray) -> tuple[str, float]:
        """The nearest language, ties by name, and how near it is: 1 for equal ranks, 0 if no gram is known."""
        away = self.distances(top)
        i = int(np.argmin(away))
        return self.languages[i], float(1 - away[i] / (self.size * top.size))


def count_grams(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(lang, gram, n)`` over all rows with a language; each task adds up what it has read before it passes it on."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        grams_of = once(("grams",), Grams)
        held: dict[str, list] = {}

        def flush():
            for lang, parts in held.items():
                grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(place, np.concatenate([c for _, c in parts]), grams.size).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * grams.size, pa.string()), pa.array(grams.astype(np.int64)), pa.array(n)],
                                                 names=["lang", "gram", "n"])
            held.clear()
        waiting = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = grams_of(text.as_py())
                held.setdefault(lang, []).append(part)
                waiting += part[0].size
                if waiting > 4_000_000:
                    for made in flush():
                        yield made
                    waiting = 0
        yield from flush()
    rows = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("string").alias("text"))
    parts = rows.where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(run, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE) -> Profiles:
    """The ``size`` most frequent n-grams of each language over all of its rows.

    Only the profiles come to the driver: ``size`` numbers for each language.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = count_grams(docs, lang_col, text_col).withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size)
    rows = top.select("lang", "gram", "rank").collect()
    languages = sorted({r["lang"] for r in rows})
    grams = np.array(sorted({r["gram"] for r in rows}), np.uint64)
    ranks = np.full((len(languages), grams.size), size, np.int64)
    row_of = {lang: i for i, lang in enumerate(languages)}
    for r in rows:
        ranks[row_of[r["lang"]], np.searchsorted(grams, np.uint64(r["gram"]))] = r["rank"]
    return Profiles(languages, grams, ranks, size)


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``lang_pred`` and ``score`` for each row of ``docs``: id and these two columns.

    A document's most frequent n-grams are compared with each profile by out-of-place distance; the score is 1 for
    equal ranks and 0 if no n-gram is known. Null texts and texts without letters are ``und`` with score 0, as all
    texts are when no language was learnt. Equal distances go to the first language by name; repeated rows get equal
    results; an empty table gives no rows; further columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(profiles)  # some hundred numbers for each language

    def run(batches):
        grams_of, known = once(("grams",), Grams), held.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(1):
                grams, counts = grams_of(text.as_py() or "")
                lang, score = known.best(ranked(grams, counts, known.size)) if grams.size and known.languages else ("und", 0.0)
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[id_col, "lang_pred", "score"])
    rows = docs.select(docs[id_col], docs[text_col].cast("string").alias("text"))
    schema = rows.select(rows[0]).schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema)


def least_score(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text",
                share: float = THRESHOLD_SHARE, part: float = THRESHOLD_PART, steps: int = THRESHOLD_STEPS) -> float:
    """The score below which a text counts as being in no learnt language, from the scores of texts that are in one.

    All of ``docs`` are scored and counted by score, rounded down to one of ``steps``; the highest step is taken that at
    most ``share`` of them score lower than. The threshold is ``part`` of it, so that texts of the learnt languages, also
    odd ones, stay well above it. Texts without letters do not count; without any text the threshold is 0. The driver gets
    one count for each step.
    """
    scored = identify(docs, profiles, id_col, text_col).where("lang_pred <> 'und'")
    counts = {r["step"]: r["count"] for r in scored.groupBy(F.floor(F.col("score") * steps).alias("step")).count().collect()}
    lower, most = 0, share * sum(counts.values())
    for step in sorted(counts):
        lower += counts[step]
        if lower > most:
            return part * step / steps
    return 0.0


def in_known_language(docs: DataFrame, profiles: Profiles, text_col: str = "text", least: float = 0.0,
                      lang_col: str | None = None) -> DataFrame:
    """The rows of ``docs``, with their columns, whose text is in a learnt language with a score of at least ``least``.

    Null texts, texts without letters and all texts when no language was learnt are dropped. With ``lang_col`` a null
    language becomes the one found. Long texts count whole; repeated rows are judged alike and all stay or go; further
    columns stay as they are.
    """
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(profiles)
    place = docs.columns.index(lang_col) if lang_col else None

    def run(batches):
        grams_of, known = once(("grams",), Grams), held.value
        for batch in batches:
            keep, langs = [], []
            for text in batch.column(text_col):
                grams, counts = grams_of(text.as_py() or "")
                lang, score = known.best(ranked(grams, counts, known.size)) if grams.size and known.languages else (None, -1.0)
                keep.append(lang is not None and score >= least)
                langs.append(lang)
            if place is not None:
                filled = pc.coalesce(batch.column(place), pa.array(langs, batch.schema.field(place).type))
                batch = batch.set_column(place, batch.schema.field(place), filled)
            yield batch.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
