"""Each stage of the pipeline against brute force over what the stage before has kept."""

import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from foliospark.session import local_rows, scratch_path, shared_folder
from tests.llm.helpers import words
from tests.llm.test_omh import classes, mutated, similarity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    rng = random.Random(11)
    syllables = {"en": ["the", "th", "er", "ing"], "fr": ["é", "oux", "ment", "que"], "de": ["sch", "ung", "ein", "zu"]}
    rows = []
    for i in range(1, 121):
        lang = rng.choice(sorted(syllables))
        text = " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(20, 160)))
        rows.append([i, text, lang, rng.choice(["a", "a", "a", "b", "c", None])])
    rows += [[200 + i, rows[i % 9][1], "en", "a"] for i in range(40)]
    rows += [[300 + i, re.sub(" ", "  ", rows[i][1]), None, "b"] for i in range(9)]
    rows += [[400 + i, mutated(rng, rows[20 + i % 5][1], 1), "de", "c"] for i in range(25)]
    rows += [[500, None, "en", "a"], [501, "", None, None], [502, "123 456 ...", "fr", "a"], [503, "漢字", "en", "a"],
             [505, "кошка сидит на окне", None, "a"]]  # held out, in a language that nothing was learnt of
    return [(*r, len(r[1] or "")) for r in rows]


def test_stages(spark):
    rows = documents()
    docs, held = local_rows(spark, rows, SCHEMA), []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
        held.append(docs.collect())
        if name != "pack_sequences":
            assert sorted(docs.columns) == sorted(n.split()[0] for n in SCHEMA.split(", "))
    language, exact, near, mixed, packed = held
    by_id = {r[0]: r for r in rows}
    # Null, empty and letterless texts, and the one in no known language.
    assert {r.doc_id for r in language} == set(by_id) - {500, 501, 502, 505}
    assert all(r.lang == (by_id[r.doc_id][2] or r.lang) and r.lang in ("de", "en", "fr") for r in language)
    assert any(by_id[r.doc_id][2] is None for r in language)

    def body(text):
        return re.sub(r"[\x20\x09-\x0D]+", " ", text)
    first = {}
    for r in sorted(language, key=lambda r: r.doc_id):
        first.setdefault(body(r.text), r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(first.values())
    assert all(r.text == by_id[r.doc_id][1] and r.source == by_id[r.doc_id][3] for r in exact)
    kept = classes([(r.doc_id, r.text) for r in exact], lambda a, b: similarity(a, b) >= 0.8)
    assert sorted(r.doc_id for r in near) == sorted({*kept.values()})
    assert len(near) < len(exact) < len(language)

    sizes, taken = defaultdict(int), defaultdict(int)
    for r in near:
        sizes[r.source] += len(words(r.text))
    copies = Counter(r.doc_id for r in mixed)
    assert max(copies.values()) <= 2
    text = {r.doc_id: words(r.text) for r in near}
    for r in mixed:
        taken[r.source] += len(words(r.text))
        assert words(r.text) == text[r.doc_id][:len(words(r.text))]
    assert sum(taken.values()) == int(1.5 * sum(sizes.values()))
    assert all(taken[s] <= 2 * sizes[s] for s in sizes)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r.doc_id, len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in mixed)
    got = Counter((r.doc_id, r.doc_tokens) for r in packed if r.start == 0)
    assert got == want
    assert sum(r.length for r in packed) == sum(n * k for (_, n), k in want.items())
    fill = Counter()
    for r in packed:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 1024 and len(fill) == max(fill) + 1


def test_empty_documents(spark):
    docs = local_rows(spark, [], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.count() == 0


def test_awkward_documents_go_through_all_stages(spark):
    """Repeated rows, nulls in every column, a very long text and extra columns with names used inside the stages."""
    rows = documents()[:60]
    long = " ".join(rows[i % 60][1] for i in range(400))
    rows += [rows[3], rows[3], (None, rows[4][1] + " more", None, None, None), (900, long, None, "a", 7), (901, long + " the end", "en", "a", 7)]
    docs = local_rows(spark, [(*r, "k", 5, "r") for r in rows], SCHEMA + ", key string, words long, digest string")
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "pack_sequences":
            assert {"key", "words", "digest"} <= set(docs.columns)
            assert docs.where("key <> 'k' OR words <> 5 OR digest <> 'r'").count() == 0
        if name == "near_dedup":  # of the long texts one stays, and one row of the repeated ones
            assert docs.where("doc_id >= 900").count() == 1
            assert docs.groupBy("doc_id").count().where("count > 1").count() == 0
    assert docs.agg({"length": "sum"}).first()[0] > 0


def test_tables_of_short_rows_are_written_in_few_files(spark):
    """With many shuffle partitions, which are not put together, a table of short rows is no file per partition."""
    docs = local_rows(spark, [r for r in documents() if r[1]], SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    names = ("exact_dedup", "near_dedup", "mix_sources")
    want = [sorted(map(str, stages[n](spark, docs, "").collect())) for n in names]
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    shared = Path(shared_folder(spark))
    old = {*shared.iterdir()}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = [sorted(map(str, stages[n](spark, docs, "").collect())) for n in names]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want
    most = spark.sparkContext.defaultParallelism
    for name in ("first-seen", "stage-heads", "stage-members", "stage-pairs", "stage-tested", "stage-edges", "stage-labels",
                 "stage-classes", "stage-queue"):
        folders = [f for f in shared.glob(f"{name}-*") if f not in old]
        folders = [b for f in folders for b in f.glob("batch=[0-9]*")] if name == "first-seen" else folders
        assert folders and all(1 <= len([*f.glob("*.parquet")]) <= most for f in folders), name
