import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from foliospark.operators import hybrid, keyword, postings, topk, vector
from foliospark.operators.embedding import HashingEmbedder, ModelEmbedder, attach_vectors, new_embeddings
from foliospark.operators.results import fall_back, sort_by
from foliospark.operators.skew import hot_keys, lookup_join
from foliospark.session import scratch_path
from foliospark.plans.search import SearchTable, render_results
from testkit import relations

WORDS = [f"w{i}" for i in range(30)]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(1, 40))) for _ in range(300)]
    # A third of the documents are exact copies, so that scores tie.
    texts += ["w1 w2 w3 w1"] * 150
    return [(f"id{i:04d}", t, [rng.gauss(0, 1) for _ in range(8)] if i % 3 else [1.0] * 8) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def table(spark, corpus):
    return spark.createDataFrame(corpus, "id string, content string, contentVector array<float>").repartition(5, "id").cache()


def bm25(corpus, terms):
    docs = [(i, t.split()) for i, t, _ in corpus]
    mean = sum(len(t) for _, t in docs) / len(docs)
    df = {w: sum(w in t for _, t in docs) for w in terms}
    out = {}
    for i, t in docs:
        score = sum(math.log(1 + (len(docs) - df[w] + .5) / (df[w] + .5)) * t.count(w) * 2.2 / (t.count(w) + 1.2 * (.25 + .75 * len(t) / mean))
                    for w in terms if w in t)
        if any(w in t for w in terms):
            out[i] = round(score, 6)
    return sorted(out.items(), key=lambda p: (-p[1], p[0]))


def cosines(corpus, v):
    v = np.array(v)
    scores = {i: round(float(np.float32(x).astype(float) @ v / np.linalg.norm(np.float32(x).astype(float)) / np.linalg.norm(v)), 6) for i, _, x in corpus}
    return sorted(scores.items(), key=lambda p: (-p[1], p[0]))


def pairs(df):
    return [(r["id"], r["score"]) for r in df.collect()]


def fused(corpus, terms, v, k):
    score = {}
    for rank, (i, _) in enumerate(bm25(corpus, terms), 1):
        score[i] = score.get(i, 0) + 1 / (60 + rank)
    for rank, (i, _) in enumerate(cosines(corpus, v)[:50], 1):
        score[i] = score.get(i, 0) + 1 / (60 + rank)
    return sorted(score.items(), key=lambda p: (-p[1], p[0]))[:k]


def test_keyword_search_equals_brute_force(table, corpus):
    assert pairs(keyword.keyword_search(table, "W1, w7 w1", 40)) == bm25(corpus, ["w1", "w7"])[:40]
    assert pairs(keyword.keyword_search(table, "nothing here", 5)) == []
    assert pairs(keyword.keyword_search(table, " ... ", 5)) == []


def test_a_keyword_query_shuffles_nothing_and_keeps_only_hits(table, corpus):
    hits, stats = keyword.term_hits(table, ["w1", "w7"], ["content"], "id")
    assert "Exchange" not in hits._jdf.queryExecution().executedPlan().toString()
    assert hits.count() == len(bm25(corpus, ["w1", "w7"])) and stats["documents"] == len(corpus)
    restricted, all_rows = keyword.term_hits(table, ["w1", "w7"], ["content"], "id", F.col("id") < "id0100")
    assert all_rows == stats and restricted.count() < hits.count()


def test_batch_keyword_search_over_several_passes(spark, table, corpus, monkeypatch):
    monkeypatch.setattr(keyword, "TERMS_PER_PASS", 3)
    queries = {1: "w1 w7", 2: "w2", 3: "w1 w7", 4: "absent", 5: "w3 w4 w5"}
    df = spark.createDataFrame(list(queries.items()), "query_id int, text string")
    got = {}
    for r in keyword.batch_keyword_search(table, df, 7).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    assert got == {q: bm25(corpus, t.split())[:7] for q, t in queries.items() if q != 4}


def test_vector_search_equals_brute_force(spark, table, corpus):
    v = [0.5, -1, 2, 0, 0, 1, 1, -0.25]
    assert pairs(vector.vector_search(table, v, 200)) == cosines(corpus, v)[:200]
    short = table.limit(3).select("id", F.slice("contentVector", 1, 3).alias("contentVector"))
    both = table.select("id", "contentVector").unionByName(short.withColumn("id", F.concat(F.lit("s"), "id")))
    assert pairs(vector.vector_search(both, v, 200)) == cosines(corpus, v)[:200]


def test_vector_queries_of_several_dimensions_and_passes(spark, table, corpus, monkeypatch):
    monkeypatch.setattr(vector, "BYTES_PER_PASS", 64)
    queries = spark.createDataFrame([(1, [1.0] * 8), (2, [0.0, 1.0] * 4), (3, [1.0, 0.0]), (4, [0.0] * 8)], "query_id int, vector array<double>")
    got = {}
    for r in vector.batch_vector_search(table, queries, 4).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    assert got == {1: cosines(corpus, [1.0] * 8)[:4], 2: cosines(corpus, [0.0, 1.0] * 4)[:4]}


def test_ties_at_the_cut_are_decided_by_id():
    scores, ids = np.array([1.0, 2.0, 1.0, 1.0]), np.array(["d", "c", "b", "a"])
    assert sorted(ids[topk.best_rows(scores, ids, 3)]) == ["a", "b", "c"]
    leaders = topk.Leaders(2, ["q"])
    leaders.offer(0, np.array([1.0, 1.0]), np.array(["x", "y"]))
    leaders.offer(0, np.array([1.0, 0.5]), np.array(["a", "b"]))
    assert sorted(leaders.kept[0][1]) == ["a", "x"]


def test_hybrid_search_equals_brute_force(spark, table, corpus):
    v = [1.0, -1.0, 2.0, 0.0, 0.0, 1.0, 1.0, -0.25]
    assert pairs(hybrid.hybrid_search(table, "w1 w9", v, 30)) == fused(corpus, ["w1", "w9"], v, 30)
    queries = spark.createDataFrame([("a", "w1 w9", v), ("b", "w2", [1.0] * 8), ("c", "absent", v)], "query_id string, text string, vector array<double>")
    got = {}
    for r in hybrid.batch_hybrid_search(table, queries, 9).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    assert got == {"a": fused(corpus, ["w1", "w9"], v, 9), "b": fused(corpus, ["w2"], [1.0] * 8, 9), "c": fused(corpus, ["absent"], v, 9)}


def test_batch_hybrid_search_over_several_passes(spark, table, corpus, monkeypatch):
    monkeypatch.setattr(keyword, "TERMS_PER_PASS", 2)
    v = [1.0, -1.0, 2.0, 0.0, 0.0, 1.0, 1.0, -0.25]
    asked = {"a": "w1 w9", "b": "w2", "c": "absent", "d": "w3 w4 w5"}
    queries = spark.createDataFrame([(q, t, v) for q, t in asked.items()], "query_id string, text string, vector array<double>")
    got = {}
    for r in hybrid.batch_hybrid_search(table, queries, 9).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    assert got == {q: fused(corpus, t.split(), v, 9) for q, t in asked.items()}


def test_ranks_of_chosen_rows(table, corpus):
    order = [i for i, _ in bm25(corpus, ["w1"])]
    wanted = order[3:300:25] + ["missing"]
    got = {r["id"]: r["rank"] for r in hybrid.ranks_of(keyword.keyword_scores(table, "w1"), wanted).collect()}
    assert got == {i: order.index(i) + 1 for i in wanted if i in order}


def test_cells_find_most_neighbours(spark, table):
    queries = table.limit(10).select(F.col("id").alias("query_id"), F.col("contentVector").alias("vector"))
    centroids = vector.train_cells(table, 6)
    celled = vector.assign_cells(table.select("id", "contentVector"), centroids)
    exact = vector.batch_vector_search(table, queries, 5)
    assert vector.recall(vector.ann_search(celled, centroids, queries, 5, 6), exact).first()[0] == 1.0
    assert vector.recall(vector.ann_search(celled, centroids, queries, 5, 4), exact).first()[0] > 0.5


@pytest.fixture
def documents(spark):
    rows = [("1", "benefits of work", "alpha text", "a.txt", "/s/a.txt", ".txt", "2024-01-05 00:00:00", "Ann"),
            ("2", "travel", "benefits. health benefits plan\nother", "b.pdf", "/s/b.pdf", ".pdf", "2024-02-05 00:00:00", "Bob"),
            ("3", "food", "nothing", "c.pdf", "/s/c.pdf", ".pdf", "2024-03-05 00:00:00", "Cy")]
    df = spark.createDataFrame(rows, "id string, title string, content string, name string, filePath string, extension string, m string, createdBy string")
    return df.withColumn("modifiedDateTime", F.to_timestamp("m")).drop("m")


def with_vectors(docs, embedder):
    texts = docs.withColumn("chunk", F.col("content"))
    return attach_vectors(texts, new_embeddings(texts, embedder)).withColumn("chunkNumber", F.lit(0)).withColumn("totalChunks", F.lit(1))


def test_without_vectors_searches_fall_back(documents):
    table = SearchTable(documents)
    with pytest.raises(ValueError):
        table.vector("benefits")
    for kind in (table.keyword, table.hybrid, table.semantic):
        assert [r["id"] for r in kind("benefits").collect()] == [r["id"] for r in table.keyword("benefits").collect()]
    assert {r["id"] for r in table.keyword("benefits").collect()} == {"1", "2"}
    assert table.keyword("benefits", top=0).count() == 0
    assert "content" in table.keyword("benefits").columns


def test_search_types_with_vectors(documents):
    embedder = HashingEmbedder(64)
    table = SearchTable(with_vectors(documents, embedder), embedder)
    assert table.vector("health benefits plan", top=1).first()["id"] == "2"
    best = table.semantic("health benefits", top=2).collect()
    assert best[0]["caption"] == "health benefits plan" and best[0]["reranker_score"] >= best[1]["reranker_score"]
    assert table.answer("health benefits").first()["answer"] == "health benefits plan"
    plain = SearchTable(table.table, embedder, reranking=False)
    assert pairs(plain.semantic("benefits")) == pairs(plain.hybrid("benefits"))
    assert pairs(table.filtered("benefits", search_type="unheard")) == pairs(table.hybrid("benefits"))


def test_term_index_gives_the_same_results(spark, documents):
    embedder, path = HashingEmbedder(64), scratch_path(spark, "postings")
    plain = SearchTable(with_vectors(documents, embedder), embedder)
    postings.write_postings(plain.table, path, plain.fields, buckets=4)
    indexed = SearchTable(plain.table, embedder, postings=path)
    pdf = F.col("extension") == ".pdf"
    for kind in ("keyword", "hybrid", "semantic"):
        for where in (None, pdf):
            expected = getattr(plain, kind)("health benefits absent", where=where).collect()
            assert getattr(indexed, kind)("health benefits absent", where=where).collect() == expected
    assert pairs(indexed.keyword("*")) == pairs(plain.keyword("*"))
    assert indexed.keyword("absent").count() == 0
    read = plan(postings.posting_scores(spark, path, "health"))
    assert "PartitionFilters: [isnotnull(bucket" in read and "In(term" in read.replace("EqualTo(term", "In(term")


def test_filters_apply_before_ranking(documents):
    table = SearchTable(documents)
    def ids(**kw):
        return {r["id"] for r in table.filtered("*", top=10, **kw).collect()}
    assert ids() == {"1", "2", "3"}
    assert ids(extension=".pdf") == {"2", "3"} and ids(extension=".PDF") == set()
    assert ids(date_from="2024-01-05T00:00:00", date_to="2024-02-05T00:00:00") == {"1", "2"}
    assert ids(author="Ann,Cy") == {"1", "3"} and ids(author="Ann,Cy", extension=".pdf") == {"3"}


def test_rendering(documents):
    table = SearchTable(documents)
    assert render_results(table.keyword("absent")) == "No results found."
    text = render_results(table.keyword("health"))
    assert "1. b.pdf" in text and "   Preview: benefits. health benefits plan other..." in text and "   Score: " in text
    assert "Score" not in render_results(table.keyword("health"), show_scores=False)


def test_sorting_by_a_sortable_field(documents):
    def order(field, **kw):
        return [r["id"] for r in sort_by(documents, field, **kw).collect()]
    assert order("title") == ["1", "3", "2"] and order("modifiedDateTime", descending=True) == ["3", "2", "1"]
    with pytest.raises(ValueError):
        sort_by(documents, "name")


def test_low_scores_switch_to_the_other_list(spark):
    low = spark.createDataFrame([("a", 0.2)], "id string, score double")
    other = spark.createDataFrame([("b", 3.0)], "id string, score double")
    assert pairs(fall_back(low, other)) == [("b", 3.0)]
    assert pairs(fall_back(low.withColumn("score", F.lit(0.7)), other)) == [("a", 0.7)]
    assert pairs(fall_back(low.limit(0), other)) == [("b", 3.0)]


def test_model_embedder_calls_once_per_distinct_text(spark):
    chunks = spark.createDataFrame([(str(i), f"text {i % 3}") for i in range(30)], "id string, chunk string").coalesce(1)
    calls = spark.sparkContext.accumulator(0)

    def load():
        def model(texts):
            calls.add(len(texts))
            return [None if t.endswith("2") else [float(len(t)), 1.0] for t in texts]
        return model

    embedded = new_embeddings(chunks, ModelEmbedder(load, batch_size=2)).collect()
    # A failed call leaves no row that could enter the cache.
    assert len(embedded) == 2 and calls.value == 3
    cache = spark.createDataFrame(embedded, "text_hash string, embedding array<float>")
    assert new_embeddings(chunks, HashingEmbedder(4), cache).count() == 1
    assert attach_vectors(chunks, cache).filter("contentVector IS NOT NULL").count() == 20


def test_hashing_embedder_is_order_free_and_unit_length(spark):
    df = spark.createDataFrame([("h1", "red blue"), ("h2", "Blue, red!"), ("h3", "...")], "text_hash string, text string")
    got = {r["text_hash"]: r["embedding"] for r in HashingEmbedder(128)(df).collect()}
    assert got["h1"] == got["h2"] and "h3" not in got
    assert math.isclose(sum(x * x for x in got["h1"]), 1.0, rel_tol=1e-5)


def test_lookup_with_a_hot_key_equals_a_plain_join(spark):
    facts = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key"))
    lookup = facts.select("key").distinct().filter("key <> 'k1'").withColumn("v", F.length("key"))
    assert [r[0] for r in hot_keys(facts, "key", 10, 100).collect()] == ["hot"]
    got = lookup_join(facts, lookup, "key", F.col("id"), salts=8, share=10, min_rows=100)
    expected = facts.join(lookup, "key", "left")
    assert got.select("id", "key", "v").exceptAll(expected.select("id", "key", "v")).isEmpty() and got.count() == 9000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cross_join_and_limit_before_the_shuffle(spark, table):
    queries = spark.createDataFrame([(1, "w1")], "query_id int, text string")
    batch = plan(keyword.batch_keyword_search(table, queries, 3))
    assert "WindowGroupLimit" in batch
    single = plan(keyword.keyword_search(table, "w1 w2", 3))
    assert "Exchange" not in single[single.index("TakeOrderedAndProject"):]  # hits are ranked where they were found
    for text in (batch, single, plan(hybrid.hybrid_search(table, "w1", [1.0] * 8, 3))):
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_hashed_vectors_equal_a_plain_loop(spark):
    texts = ["one two two", "Füße 漢字 one", "a", "x y z " * 50]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "text_hash string, text string")
    for row in HashingEmbedder(64)(df).collect():
        expected = np.zeros(64)
        for word in re.findall(r"[^\W_]+", texts[int(row.text_hash)].lower()):
            code = xxhash.xxh64_intdigest(word.encode(), seed=42) % 2 ** 64
            code = (code - 2 ** 64 if code >= 2 ** 63 else code) % 128
            expected[code // 2] += 1 - 2 * (code % 2)
        assert np.allclose(row.embedding, expected / np.linalg.norm(expected), atol=1e-6)


def test_salts_follow_the_count_of_a_hot_key(spark):
    facts = spark.range(3000).select("id", F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2600, "warm").otherwise(
        F.concat(F.lit("k"), F.col("id"))).alias("key"))
    lookup = facts.select("key", F.xxhash64("key").alias("v")).distinct().filter("key <> 'k2999'")
    assert dict(map(tuple, hot_keys(facts, "key", 10, 100).collect())) == {"hot": 2000, "warm": 600}
    for how in ({"rows_per_salt": 150}, {"rows_per_salt": 10**6}, {"salts": 1}):
        got = lookup_join(facts, lookup, "key", F.col("id"), share=10, min_rows=100, **how)
        assert got.columns == ["key", "id", "v"] and got.count() == 3000 and got.select("id").distinct().count() == 3000
        assert got.filter("v IS NULL OR v <> xxhash64(key)").select("key", "v").collect() == [("k2999", None)]


def test_search_table_is_stored_once(spark):
    # A search reads its table several times: no join behind it, and the same files for every query of a session.
    first, again = (relations.search_table(spark, "/root/testdata/sf0.001") for _ in range(2))
    assert "Join" not in first._jdf.queryExecution().optimizedPlan().toString()
    assert first.inputFiles() == again.inputFiles() and first.count() == 200
    assert first.where("contentVector is not null").count() > 0
