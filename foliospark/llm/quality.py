"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import WORDS_AND_SIGNS, bounded_batches, mix, word_hashes

BITS = 20
#: Most labelled rows that the model is fitted on, those with the smallest hash of their id, and parts trained apart.
FIT_ROWS, SHARDS = 24_000, 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-4
SCALE = 16.0
_REPEAT = np.uint64(0x2545F4914F6CDD1D)


def features(text: str) -> np.ndarray:
    """Hashed slots of a text's words and word pairs; a word that repeats the one before is a pair of its own kind."""
    words = word_hashes(text, lower=False, classes=WORDS_AND_SIGNS)
    if words.size == 0:
        return np.zeros(0, np.int64)
    pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    pairs[words[:-1] == words[1:]] = _REPEAT
    return (np.concatenate([words, pairs]) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Ftrl:
    """Per-coordinate follow-the-regularised-leader; a document's values are its slots' shares of all its features."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def new(cls) -> Ftrl:
        return cls(np.zeros(1 << BITS | 1), np.zeros(1 << BITS | 1))  # the last slot is the bias

    def weights(self, slots) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, slots: np.ndarray, values: np.ndarray, label: float) -> None:
        w = self.weights(slots)
        g = (1 / (1 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
        n = self.n[slots]
        self.z[slots] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[slots] = n + g * g


def _sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    slots, counts = np.unique(features(text), return_counts=True)
    return np.append(slots, 1 << BITS), np.append(SCALE * counts / max(1, counts.sum()), 1.0)


def train(labelled: DataFrame, fit_rows: int = FIT_ROWS, shards: int = SHARDS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights from ``labelled(id, text, label)``; only that many rows are used, whatever the table's size.

    Each shard of the sample is learnt in its own task; the weights are averaged, so their size does not depend on
    the data. Rows without a label are not used. With no labelled rows all weights are 0 and all scores one half.
    """
    spark = labelled.sparkSession
    bounded_batches(spark)
    known = labelled.where("label IS NOT NULL AND id IS NOT NULL")
    chosen = known.select("id").orderBy(F.xxhash64("id"), "id").limit(fit_rows)  # ids only
    rows = known.join(chosen.distinct(), "id", "left_semi").select(
        F.pmod(F.xxhash64("id", F.lit(7)), F.lit(shards)).alias("shard"), "id", F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.col("label").cast("double").alias("label"))

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("label", "ascending")])
        made = [(*_sparse(t.as_py()), y) for t, y in zip(table.column("text"), table.column("label").to_pylist(), strict=True)]
        model, order = Ftrl.new(), np.random.default_rng(1)
        for _ in range(epochs):
            for i in order.permutation(len(made)):
                model.learn(*made[i])
        return pa.table({"weights": [model.weights(slice(None)).astype(np.float32).tobytes()], "n": [len(made)]})
    parts = rows.groupBy("shard").applyInArrow(learn, "weights binary, n long").collect()  # one model for each shard
    total = np.zeros(1 << BITS | 1)
    for part in parts:
        total += np.frombuffer(part["weights"], np.float32).astype(np.float64) * part["n"]
    return (total / max(1, sum(p["n"] for p in parts))).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score`` for each row of ``docs``, 0 to 1: the logistic function of the sparse product of weights and features.

    Null and empty texts have no features and get the score of the bias. Repeated rows get equal scores; an empty
    table gives no rows; further columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(weights)  # a fixed number of weights

    def run(batches):
        w = held.value
        for batch in batches:
            total = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(1)):
                slots = features(text.as_py() or "")
                total[i] = w[-1] + (SCALE * float(w[slots].sum(dtype=np.float64)) / slots.size if slots.size else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], names=[id_col, "score"])
    rows = docs.select(docs[id_col], docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, rows.select(rows[0]).schema.add("score", "double"))
