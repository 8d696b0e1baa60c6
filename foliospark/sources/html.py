"""HTML pages to text."""

from __future__ import annotations

import html
import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# Content that is not text: scripts, styles, comments and declarations.
NON_TEXT = (
    r"(?is)<script[^>]*>.*?</script>",
    r"(?is)<style[^>]*>.*?</style>",
    r"(?s)<!--.*?-->",
)
TAG = r"(?s)<[/!?a-zA-Z][^>]*>"
ENTITY = r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
#: All named entities of the HTML standard and their characters, as a constant map.
NAMED = json.dumps({name[:-1]: text for name, text in html.entities.html5.items() if name.endswith(";")})
#: What the numbers 128 to 159 stand for: by the standard those of Windows-1252, not control characters.
C1 = [html.unescape(f"&#{code};") for code in range(128, 160)]
LARGEST = 0x10FFFF


def _character(code: Column) -> Column:
    """The character of a code point; the replacement character for a number that is none."""
    sound = (code > 0) & (code <= LARGEST) & ~code.between(0xD800, 0xDFFF)
    other = F.decode(F.unhex(F.lpad(F.hex(F.when(sound, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    return F.when(code.between(128, 159), F.get(F.array(*map(F.lit, C1)), (code - 128).cast("int"))).otherwise(other)


def _number(digits: Column, longest: int, base: int) -> Column:
    return F.coalesce(F.when(F.length(digits) <= longest, F.conv(digits, base, 10).cast("bigint")), F.lit(0))


def _meaning(entity: Column) -> Column:
    """The characters of one entity, written without ``&`` and ``;``; an unknown name stays as it is written."""
    named = F.try_element_at(F.from_json(F.lit(NAMED), "map<string,string>"), entity)
    return F.when(entity.startswith("#x") | entity.startswith("#X"), _character(_number(F.substring(entity, 3, 1 << 20), 8, 16))) \
        .when(entity.startswith("#"), _character(_number(F.substring(entity, 2, 1 << 20), 9, 10))) \
        .otherwise(F.coalesce(named, F.concat(F.lit("&"), entity, F.lit(";"))))


def unescape_entities(text: Column) -> Column:
    """Entities as characters, named and numeric ones in one pass, so that nothing is replaced twice."""
    found = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(1)), _meaning)
    # One part more than entities, so the last part has none.
    whole = F.array_join(F.zip_with(F.split(text, ENTITY, -1), found, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(F.regexp_like(text, F.lit(ENTITY)), whole).otherwise(text)


def html_to_text(page: Column | str, separator: str = "", decode_entities: bool = True) -> Column:
    """The text nodes of a page joined by ``separator``; entities become characters."""
    out = F.col(page) if isinstance(page, str) else page
    for pattern in NON_TEXT:
        out = F.regexp_replace(out, pattern, "")
    out = F.regexp_replace(out, TAG, separator)
    return unescape_entities(out) if decode_entities else out
