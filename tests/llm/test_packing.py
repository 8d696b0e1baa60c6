import random
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from foliospark.llm import packing
from tests.llm.helpers import TEXTS, awkward

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as file:
        return packing.Encoder(file.read(), held=50)


def ids_of(tokenizer, text):
    return b"".join(i.to_bytes(4, "little") for i in tokenizer.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t's.,!12aé漢  "), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_ids_equal_the_tokenizer(tokenizer, encoder, text):
    assert encoder(text) == ids_of(tokenizer, text)


def test_special_tokens_and_white_space(tokenizer, encoder):
    for text in ("a <|endoftext|> b", "<|endoftext|>", " x", "x ", "a  b", "a \n b", "it's 'tis", "  a", "a" * 3000, "", "a" + " " * 5000 + "b"):
        assert encoder(text) == ids_of(tokenizer, text)


def simple_best_fit(lengths, window):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(window - n)
    return sorted(rooms)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_plan_equals_best_fit_piece_by_piece(lengths):
    counts = defaultdict(int)
    for n in lengths:
        counts[n] += 1
    steps, opened = packing.best_fit(dict(counts), 32)
    used = [0] * opened
    for length, _, count, first, per, offset in sorted(steps, key=lambda s: -s[0]):
        for i in range(count):
            assert used[first + i // per] == offset + i % per * length
            used[first + i // per] += length
    assert sorted(32 - u for u in used) == simple_best_fit(lengths, 32)


def test_pieces_are_whole_and_windows_gapless(spark, tokenizer):
    texts = [*TEXTS, *[(100 + i, "word " * random.Random(i).randint(0, 900)) for i in range(150)]]
    docs = awkward(spark, texts)
    packed = packing.pack_documents(docs, PATH, with_ids=True).cache()
    rows = packed.collect()
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        assert 1 <= r.length <= 1024 and zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
    for i, text in texts:
        if i not in (None, 11):  # these ids are in several rows
            own = sorted(by_doc[i], key=lambda r: r.start)
            ids = ids_of(tokenizer, text or "") + bytes(4)
            assert b"".join(bytes(r.ids) for r in own) == ids and all(r.doc_tokens == len(ids) // 4 for r in own)
    for window in by_window.values():
        at = 0
        for r in sorted(window, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    total = sum(r.length for r in rows)
    assert sorted(by_window) == list(range(len(by_window)))
    assert len(by_window) <= -(-total // 1024) + 1
    made = {r.sequence_id: bytes(r.ids) for r in packing.windows(packed).collect()}
    assert all(made[k] == b"".join(bytes(r.ids) for r in sorted(v, key=lambda r: r.offset)) for k, v in by_window.items())


def test_empty_table(spark):
    assert packing.pack_documents(awkward(spark, []), PATH).count() == 0
