import numpy as np
from pyspark.sql import functions as F

from foliospark.llm import quality
from foliospark.llm.queries import QUERIES
from tests.llm.helpers import TEXTS, awkward

SF = "/root/testdata/sf0.1"


def test_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op2_quality"](spark, SF).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.97
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.97


def test_updates_follow_the_leader():
    """One coordinate against the closed form of the sums of gradients and squared gradients."""
    model, slots, values = quality.Ftrl.new(), np.array([3]), np.array([1.0])
    z = n = 0.0
    for label in (1.0, 1.0, 0.0, 1.0):
        w = 0.0 if abs(z) <= quality.L1 else -(z - np.sign(z) * quality.L1) / ((quality.BETA + n ** 0.5) / quality.ALPHA + quality.L2)
        assert abs(model.weights(slots)[0] - w) < 1e-12
        g = 1 / (1 + np.exp(-w)) - label
        z += g - ((n + g * g) ** 0.5 - n ** 0.5) / quality.ALPHA * w
        n += g * g
        model.learn(slots, values, label)
    assert abs(model.z[3] - z) < 1e-12 and abs(model.n[3] - n) < 1e-12


def test_repeats_and_signs_are_features():
    one, two = quality.features("Aa Aa Aa"), quality.features("Bb Bb Bb")
    assert set(one) & set(two)
    assert set(quality.features("word###")) >= set(quality.features("word")) | set(quality.features("###"))


def test_awkward_rows(spark):
    docs = awkward(spark, TEXTS)
    labelled = docs.select(F.col("doc_id").alias("id"), "text", F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 2).alias("label"))
    weights = quality.train(labelled, fit_rows=6)
    got = quality.score(docs, weights).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1
    none = quality.train(labelled.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), none).count() == 0


def test_training_equals_a_plain_loop(spark):
    """All shards, epochs and updates with dictionaries, one coordinate after the other."""
    texts = {i: " ".join(("good" if i % 2 else "bad") + str(j * i % 5) for j in range(1 + i % 4)) for i in range(1, 25)}
    rows = [(i, t, i % 2) for i, t in texts.items()]
    df = spark.createDataFrame(rows, "id long, text string, label int")
    shard = {r.id: r.s for r in df.select("id", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(quality.SHARDS)).alias("s")).collect()}
    total = {}
    for s in set(shard.values()):
        mine, z, n = [i for i in sorted(texts) if shard[i] == s], {}, {}

        def weight(k):
            a = z.get(k, 0.0)
            return 0.0 if abs(a) <= quality.L1 else -(a - np.sign(a) * quality.L1) / ((quality.BETA + n.get(k, 0.0) ** 0.5) / quality.ALPHA + quality.L2)
        order = np.random.default_rng(1)
        for _ in range(quality.EPOCHS):
            for at in order.permutation(len(mine)):
                slots = quality.features(texts[mine[at]]).tolist()
                values = {k: quality.SCALE * slots.count(k) / len(slots) for k in slots} | {"bias": 1.0}
                w = {k: weight(k) for k in values}
                error = 1 / (1 + np.exp(-sum(w[k] * v for k, v in values.items()))) - mine[at] % 2
                for k, v in values.items():
                    g = error * v
                    before = n.get(k, 0.0)
                    z[k] = z.get(k, 0.0) + g - ((before + g * g) ** 0.5 - before ** 0.5) / quality.ALPHA * w[k]
                    n[k] = before + g * g
        for k in z:
            total[k] = total.get(k, 0.0) + weight(k) * len(mine) / len(texts)
    weights = quality.train(df)
    assert set(np.flatnonzero(weights).tolist()) == {1 << quality.BITS if k == "bias" else k for k, w in total.items() if abs(w) > 1e-9}
    for r in quality.score(df, weights, "id").collect():
        slots = quality.features(texts[r.id]).tolist()
        margin = total["bias"] + quality.SCALE * sum(total.get(k, 0.0) for k in slots) / len(slots)
        assert abs(r.score - 1 / (1 + np.exp(-margin))) < 1e-5
