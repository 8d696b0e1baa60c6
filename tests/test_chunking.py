import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliospark.functions.chunking import explode_chunks, explode_chunks_with_codec
from foliospark.functions.text import truncate_tokens


def chunks(spark, texts, *args, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc int, content string").coalesce(1)
    out = [[] for _ in texts]
    for r in explode_chunks(df, "content", *args, **kw).orderBy("doc", "chunkNumber").collect():
        assert r["chunkNumber"] == len(out[r["doc"]])
        out[r["doc"]].append(r)
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=8), st.integers(1, 12), st.data())
def test_windows_cover_the_text(spark, counts, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    texts = [" \t".join(f"w{i}" for i in range(n)) for n in counts]
    step = size - overlap
    for n, text, rows in zip(counts, texts, chunks(spark, texts, size, overlap)):
        assert len(rows) == (1 if n <= size else -(-n // step)) == rows[0]["totalChunks"]
        if n <= size:
            assert rows[0]["chunk"] == text
            continue
        words = text.split()
        assert [r["chunk"] for r in rows] == [" ".join(words[s:s + size]) for s in range(0, n, step)]


def test_lossless_tokens_rebuild_the_text(spark):
    text = "  lead  and\n\nlines\ttabs   end  \n"
    rows = chunks(spark, [text], 2, 0, tokenizer="lossless")[0]
    assert len(rows) > 1 and "".join(r["chunk"] for r in rows) == text


def test_bad_windows_are_refused(spark):
    for size, overlap in ((10, 10), (10, 11), (0, 0), (5, -1)):
        with pytest.raises(ValueError):
            chunks(spark, ["a"], size, overlap)


def test_codec_windows(spark):
    def byte_codec():
        return tiktoken.Encoding("bytes", pat_str=r".+", mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})

    df = spark.createDataFrame([(1, "abcdefghij"), (2, "abc")], "doc int, content string")
    rows = explode_chunks_with_codec(df, byte_codec, "content", 4, 1).orderBy("doc", "chunkNumber").collect()
    assert [(r["doc"], r["chunkNumber"], r["totalChunks"], r["chunk"]) for r in rows] == [
        (1, 0, 4, "abcd"), (1, 1, 4, "defg"), (1, 2, 4, "ghij"), (1, 3, 4, "j"), (2, 0, 1, "abc")]


def test_truncation_leaves_short_texts_untouched(spark):
    df = spark.createDataFrame([("a  b",), ("a b\n c d",)], "t string")
    assert [r[0] for r in df.select(truncate_tokens(F.col("t"), 3)).collect()] == ["a  b", "a b c"]
