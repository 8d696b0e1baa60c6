"""Scalar text functions as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The sanitising patterns with their replacement marks, applied in this order.
# (?U) gives \w, \d, \b and \s their Unicode meaning.
PII_PATTERNS = {
    "EMAIL": r"\b[\w\.-]+@[\w\.-]+\.\w+\b",
    "PHONE": r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b",
    "SSN": r"\b\d{3}-\d{2}-\d{4}\b",
    "CARD": r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b",
}
# Also finds "(743) 555-3824" and spaces between groups; an option, not the default.
WIDE_PHONE = r"(?:\(\d{3}\)\s*|\b\d{3}[-.\s]?)\d{3}[-.\s]?\d{4}\b"

WORD_SEPARATOR = r"[^\p{L}\p{N}]+"
SENTENCE_END = r"[.!?\n]+"
EDGE_SPACE = r"^\s+|\s+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_tokens(text: Column | str) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(_col(text)), WORD_SEPARATOR), lambda t: t != "")


def space_tokens(text: Column | str) -> Column:
    """Whitespace-separated tokens, in order."""
    return F.filter(F.split(_col(text), r"\s+"), lambda t: t != "")


def spaced_pieces(text: Column | str) -> Column:
    """Tokens that keep the whitespace after them, so that their concatenation is the text."""
    return F.regexp_extract_all(_col(text), F.lit(r"\s*\S+\s*|\s+"), F.lit(0))


def query_terms(spark: SparkSession, query: str) -> list[str]:
    """Distinct word tokens of one query string, by the same rule as the table side."""
    row = spark.sql("SELECT :q AS q", args={"q": query}).select(
        F.array_distinct(word_tokens("q")).alias("t")).first()
    return list(row["t"])


def token_count(text: Column | str) -> Column:
    return F.size(space_tokens(text))


def truncate_tokens(text: Column | str, limit: int = 8000) -> Column:
    """The first ``limit`` whitespace tokens; a text within the limit is returned untouched."""
    tokens = space_tokens(text)
    return F.when(F.size(tokens) <= limit, _col(text)).otherwise(
        F.array_join(F.slice(tokens, 1, limit), " "))


def strip(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), EDGE_SPACE, "")


def file_name(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def _suffix(name: Column) -> Column:
    # The last dot starts the suffix unless only dots come before it.
    return F.regexp_extract(name, r"^\.*[^.].*?(\.[^.]*)$", 1)


def extension(path: Column | str) -> Column:
    """Lower-cased last suffix with its dot, empty when there is none."""
    return F.lower(_suffix(file_name(path)))


def stem(path: Column | str) -> Column:
    name = file_name(path)
    return F.left(name, F.length(name) - F.length(_suffix(name)))


def document_id(path: Column | str) -> Column:
    return F.md5(_col(path).cast("binary"))


def chunk_id(path: Column | str, number: Column | str) -> Column:
    return F.md5(F.concat(_col(path), F.lit("_chunk_"), _col(number).cast("string")).cast("binary"))


def text_hash(text: Column | str) -> Column:
    return F.md5(_col(text).cast("binary"))


def size_mb(size_bytes: Column | str) -> Column:
    """Mebibytes to two decimals; ties go to the even digit."""
    return F.bround(_col(size_bytes) / F.lit(1048576.0), 2)


def title_or_stem(title: Column | str, path: Column | str) -> Column:
    return F.coalesce(F.nullif(_col(title), F.lit("")), stem(path))


def preview(text: Column | str, length: int = 200) -> Column:
    return F.translate(F.left(_col(text), F.lit(length)), "\n", " ")


def iso_time(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss")


def redact(text: Column | str, patterns: dict[str, str] | None = None) -> Column:
    """Replace every match by its mark, pattern after pattern."""
    out = _col(text)
    for mark, pattern in (patterns or PII_PATTERNS).items():
        out = F.regexp_replace(out, f"(?U){pattern}", f"[{mark}]")
    return out


def pii_count(text: Column | str, category: str, patterns: dict[str, str] | None = None) -> Column:
    return F.regexp_count(_col(text), F.lit("(?U)" + (patterns or PII_PATTERNS)[category]))


def top_directory(path: Column | str, depth: int = 1) -> Column:
    """The ``depth``-th path component below the leading slash."""
    return F.split(_col(path), "/").getItem(depth)
