import math

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliospark.llm import tokens
from tests.llm.helpers import LONG, TEXTS, awkward, words

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return tokens.Unigram.load(PATH)


def best_score(model, word):
    text = tokens.MARK + word
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            if text[start:end] in model.scores:
                best[end] = max(best[end], best[start] + model.scores[text[start:end]])
        if text[end - 1] not in model.scores:
            best[end] = max(best[end], best[end - 1] + len(text[end - 1].encode()) * model.byte_score)
    return best[-1]


def paths(model, text):
    """Every split into pieces and bytes: (score, tokens)."""
    if not text:
        yield 0.0, 0
    for n in range(1, len(text) + 1):
        head = text[:n]
        if head in model.scores:
            yield from ((s + model.scores[head], k + 1) for s, k in paths(model, text[n:]))
        elif n == 1:
            size = len(head.encode())
            yield from ((s + size * model.byte_score, k + size) for s, k in paths(model, text[1:]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abtheonéñ漢\U0001f600.1"), min_size=1, max_size=7), min_size=1, max_size=8))
def test_counts_belong_to_a_best_split(model, batch):
    trie = tokens.Trie(model)
    trie.insert(set(batch))
    for word in batch:
        every = list(paths(model, tokens.MARK + word))
        top = max(s for s, _ in every)
        assert abs(top - best_score(model, word)) < 1e-9
        assert trie.known[word] in {k for s, k in every if s > top - 1e-9}


def test_counts_do_not_depend_on_the_batch(model):
    batch = {"the", "then", "thence", "a", "ab", "abc", "zürich", "漢字", LONG[:5000].replace(" ", "")}
    together = tokens.Trie(model)
    together.insert(batch)
    for word in batch:
        alone = tokens.Trie(model, held=1)
        assert alone.count([f"{word} {word}", ""]) == [(2, 2 * together.known[word]), (0, 0)]


def test_awkward_rows(spark):
    docs = awkward(spark, TEXTS)
    got = tokens.token_counts(docs, PATH).collect()
    text = dict(TEXTS)
    assert len(got) == docs.count()
    assert all(r.n_words == len(words(text[r.doc_id])) and r.n_tokens >= r.n_words for r in got)
    assert all(r.n_tokens == 0 for r in got if r.doc_id in (3, 4, 5))
    assert tokens.token_counts(docs.limit(0), PATH).count() == 0
