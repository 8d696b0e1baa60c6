"""Fixtures with the awkward cases that every operator has to take."""

import re

from foliospark.session import local_rows

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, digest string, salt string, key string"


def awkward(spark, texts):
    """Documents with nulls in every column and with extra columns that clash with names used inside operators."""
    rows = [(i, t, "en" if i is None or i % 2 else None, None if i is None or i % 5 == 0 else f"src{i % 3}", None, "d", "s", None)
            for i, t in texts]
    return local_rows(spark, rows, COLUMNS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
TEXTS = [
    (1, "alpha  beta\tgamma"), (2, "alpha beta gamma"), (3, None), (4, ""), (5, "   "), (6, "alpha beta gamma\n"),
    (7, LONG), (8, LONG + " end"), (9, "12345 67890 !!!"), (10, "éèê ñandú 漢字 \U0001f600 ok"), (11, "solo"), (11, "solo"), (12, "solo"),
    (None, "no id here at all"), (None, "no id here at all"), (13, "<|endoftext|> special <|endoftext|>"),
]
