"""Metadata predicates that a search applies before it ranks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import query_terms, word_tokens
from foliospark.operators.build import all_of
from foliospark.schemas import FILTERABLE


def field(name: str) -> Column:
    if name not in FILTERABLE:
        raise ValueError(f"{name} is not filterable")
    return F.col(name)


def equals(name: str, value) -> Column:
    return field(name) == F.lit(value)


def differs(name: str, value) -> Column:
    """Also true for a missing value."""
    return ~field(name).eqNullSafe(F.lit(value))


def above(name: str, value) -> Column:
    return field(name) > F.lit(value)


def below(name: str, value) -> Column:
    return field(name) < F.lit(value)


def at_least(name: str, value) -> Column:
    return field(name) >= F.lit(value)


def at_most(name: str, value) -> Column:
    return field(name) <= F.lit(value)


def in_list(name: str, values: str, delimiter: str = ",") -> Column:
    """Membership in a delimited list."""
    return field(name).isin(values.split(delimiter))


def in_table(df: DataFrame, name: str, values: DataFrame) -> DataFrame:
    """Membership in a one-column table of any size."""
    field(name)
    return df.join(values.toDF(name).distinct(), name, "left_semi")


def is_match(df: DataFrame, text: str, name: str = "content") -> Column:
    """Full-text condition: the field holds any word of ``text``."""
    terms = query_terms(df.sparkSession, text)
    return F.arrays_overlap(word_tokens(name), F.array(*[F.lit(t) for t in terms]).cast("array<string>"))


def _bound(moment: str | datetime) -> str:
    # As text, so that Spark casts the constant to the column's type and can push the filter down.
    return moment.isoformat() if isinstance(moment, datetime) else moment


def metadata_filter(extension: str | None = None, date_from: str | datetime | None = None,
                    date_to: str | datetime | None = None, author: str | None = None) -> Column:
    """Conjunction of the given conditions; dates are inclusive on both sides, a comma in
    ``author`` separates several authors, and nothing given means no condition."""
    given = []
    if extension:
        given.append(equals("extension", extension))
    if date_from:
        given.append(at_least("modifiedDateTime", _bound(date_from)))
    if date_to:
        given.append(at_most("modifiedDateTime", _bound(date_to)))
    if author:
        given.append(in_list("createdBy", author))
    return all_of(given)
