import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from foliospark.llm import exact
from tests.llm.helpers import TEXTS, awkward


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for i, t in rows:
        body = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        known = [x for x in groups[body] if x is not None]
        out.append((i, min(known) if known else None, len(groups[body]), hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


def test_classes_equal_brute_force(spark):
    got = exact.exact_duplicates(awkward(spark, TEXTS)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(TEXTS)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})


def test_state_is_kept_between_batches(spark):
    rows = [(i, f"text {i % 7}") for i in range(60)]
    docs = awkward(spark, rows).repartition(12)
    got = exact.exact_duplicates(docs, files_per_batch=1).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(rows)
    assert sum(r.kept for r in got) == 7


def test_texts_that_share_a_digest_are_told_apart_by_their_bytes(spark):
    rows = [(i, f"text {i % 9}") for i in range(40)]
    got = exact.exact_duplicates(awkward(spark, rows), digest=lambda text: F.lit(b"x")).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(i, k, n) for i, k, n, _ in brute(rows)}
    assert sum(r.kept for r in got) == 9


def test_empty_table(spark):
    assert exact.exact_duplicates(awkward(spark, [])).count() == 0
    assert exact.without_copies(awkward(spark, [])).count() == 0


def test_rows_that_stay_have_their_columns(spark):
    docs = awkward(spark, TEXTS)
    kept = exact.without_copies(docs)
    assert kept.columns == docs.columns
    got = sorted([(r.doc_id, r.text) for r in kept.collect()], key=str)
    bodies = {re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in TEXTS}
    assert len(got) == len(bodies)
    assert (11, "solo") in got and (12, "solo") not in got and (1, "alpha  beta\tgamma") in got
