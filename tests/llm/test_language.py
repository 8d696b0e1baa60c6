import numpy as np
import public_tokenizers  # noqa: F401 - the queries need it
from pyspark.sql import functions as F

from foliospark.llm import language
from foliospark.llm.common import remainder
from foliospark.llm.queries import QUERIES
from tests.llm.helpers import LONG, TEXTS, awkward

SF = "/root/testdata/sf0.01"


def simple_grams(text):
    out = {}
    points = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    for i in range(len(points)):
        for n in (1, 2, 3):
            gram = points[max(0, i - n + 1):i + 1]
            if len(gram) < n or (n == 1 and gram == " ") or (n == 2 and gram == "  ") or (n == 3 and gram[1] == " "):
                continue
            key = 0
            for c in gram:
                key = key << 21 | ord(c)
            out[key] = out.get(key, 0) + 1
    return out


def test_grams_equal_a_plain_count(monkeypatch):
    count = language.Grams()
    for text in ("", "a", "A b, c!", "éèê ñandú 漢字 İx", "the the", "x" * 50, "..."):
        assert dict(zip(*(x.tolist() for x in count(text)))) == simple_grams(text)
    text = LONG[:4000] + " éa 漢字漢 " + LONG[:777]
    whole = simple_grams(text)
    for block in (3, 64, 1000):
        monkeypatch.setattr(language, "BLOCK", block)
        assert dict(zip(*(x.tolist() for x in count(text)))) == whole


def test_ranks_and_ties():
    grams, counts = np.arange(50, dtype=np.uint64), np.array([5] * 10 + [9] * 5 + [1] * 35)
    assert language.ranked(grams, counts, 8).tolist() == [10, 11, 12, 13, 14, 0, 1, 2]


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = QUERIES["op9_language"](spark, SF).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.97


def test_awkward_rows(spark):
    docs = awkward(spark, [*TEXTS, (50, "the quick brown fox"), (51, "zzz")]).withColumn("lang", F.when(F.col("doc_id") == 50, "en").when(F.col("doc_id") == 10, "xx"))
    profiles = language.learn_profiles(docs.where(remainder("doc_id", 3) != 99))
    assert profiles.languages == ["en", "xx"]
    got = language.identify(docs, profiles).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.lang_pred == "und" for r in got if r.doc_id in (3, 4, 5, 9))
    kept = language.in_known_language(docs, profiles)
    assert kept.columns == docs.columns and kept.where("doc_id in (3, 4, 5, 9)").count() == 0
    assert kept.count() == docs.count() - 4


def test_nothing_learnt_and_empty_table(spark):
    docs = awkward(spark, TEXTS)
    none = language.learn_profiles(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.limit(0), none).count() == 0


def test_predictions_equal_plain_ranking(spark):
    """Profiles, ranks, out-of-place distances and scores by sorted lists, for every document of the small table."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = {r[0] for r in docs.where(remainder("doc_id", 3) == 1).select("doc_id").collect()}
    rows, counts = docs.select("doc_id", "text", "lang").collect(), {}
    for r in rows:
        if r.doc_id not in held and r.lang is not None and r.text is not None:
            mine = counts.setdefault(r.lang, {})
            for gram, n in simple_grams(r.text).items():
                mine[gram] = mine.get(gram, 0) + n

    def order(grams):
        return sorted(grams, key=lambda g: (-grams[g], g))[:language.PROFILE]
    profiles = {lang: {g: i for i, g in enumerate(order(grams))} for lang, grams in counts.items()}
    expected = {}
    for r in rows:
        top = order(simple_grams(r.text or ""))
        if not top:
            expected[r.doc_id] = (r.doc_id in held, "und", 0.0)
            continue
        away = {lang: sum(abs(ranks[g] - i) if g in ranks else language.PROFILE for i, g in enumerate(top)) for lang, ranks in profiles.items()}
        best = min(away, key=lambda lang: (away[lang], lang))
        expected[r.doc_id] = (r.doc_id in held, best, 1 - away[best] / (language.PROFILE * len(top)))
    got = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in QUERIES["op9_language"](spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == expected.keys()
    for i, (out, lang, score) in expected.items():
        assert got[i][:2] == (out, lang) and abs(got[i][2] - score) < 1e-12


def test_threshold_counts_every_document(spark):
    """The lowest scores decide; a sample of 10,000 rows by a hash of the id missed most of them."""
    good = "the quick brown fox jumps over the lazy dog and then the dog sleeps"
    texts = spark.range(30_000).selectExpr("id AS doc_id", f"CASE WHEN id < 29600 THEN '{good}' ELSE 'жщ' END AS text", "'en' AS lang")
    docs = texts.repartition(8)
    profiles = language.learn_profiles(docs.where("doc_id < 29600"))
    scores = sorted(r.score for r in language.identify(docs, profiles).select("score").collect())
    for share in (0.01, 0.0133, 0.014, 0.5):
        lowest = scores[int(share * len(scores))]
        assert abs(language.least_score(docs, profiles, share=share) - 0.5 * int(lowest * 10_000) / 10_000) < 1e-9
    assert language.least_score(docs.limit(0), profiles) == 0.0
