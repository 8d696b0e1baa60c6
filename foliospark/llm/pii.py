"""Personal data: anchors by Aho-Corasick, expanded and checked by local parsers."""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import bounded_batches

KINDS = ("email", "ip", "card", "phone", "url", "account", "passport", "secret")
BASE = KINDS[:4]
# Cues that stand before an identifier, by the kind of their values, in lower case, and schemes of addresses.
CUES = {
    "account": ("iban", "account", "acct", "konto", "kontonummer", "compte", "cuenta", "ssn", "customer id", "routing", "user id"),
    "passport": ("passport", "reisepass", "passeport", "pasaporte"),
    "secret": ("token", "api key", "api_key", "api-key", "apikey", "access key", "access_key", "secret", "secret key", "secret_key",
               "password", "passwd", "pwd", "passphrase", "bearer"),
}
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "sftp://", "mailto:")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[^\s<>\"'`|\\^{}]+")
_AFTER_CUE = re.compile(r"(?:\s*(?:number|no\.?|nr\.?|num\.?|#))?\s*[:=#]?\s*", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{1,4}){3,8}")
_ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){5,17}")
_PASSPORT = re.compile(r"[A-Za-z0-9]{6,12}(?![A-Za-z0-9])")
_ASSIGNED = re.compile(r"(?:[\"']?\s*(?::=|=>|[:=])\s*)([\"'`]?)")
_BLANKS = re.compile(r"\s+")
_VALUE = re.compile(r"[^\s\"'`<>,;|]+")
#: A secret is at least that long; without quotes it holds letters and digits.
SECRET_LENGTH = 8
_CAPITALS = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def anchors() -> ahocorasick.Automaton:
    """At-signs, digits, plus signs, schemes and cues; every occurrence in a text in lower case is found in one pass."""
    machine = ahocorasick.Automaton()
    for digit in "0123456789":
        machine.add_word(digit, ("digit", 1))
    machine.add_word("@", ("at", 1))
    machine.add_word("+", ("plus", 1))
    for scheme in SCHEMES:
        machine.add_word(scheme, ("scheme", len(scheme)))
    for kind, cues in CUES.items():
        for cue in cues:
            machine.add_word(cue, (kind, len(cue)))
    machine.make_automaton()
    return machine


def lowered(text: str) -> str:
    """The text in lower case, each character in its place: where a capital becomes two characters, only A to Z change."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_CAPITALS)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def parse_email(text: str, at: int, least: int) -> tuple[int, int] | None:
    """Grow an address around the at-sign at ``at``; it does not reach back before ``least``."""
    start = at
    while start > least and text[start - 1] in _LOCAL:
        start -= 1
    label = _LABEL.match(text, at + 1)
    if start == at or label is None:
        return None
    end, labels = label.end(), 1
    while end < len(text) and text[end] == "." and (label := _LABEL.match(text, end + 1)):
        end, labels = label.end(), labels + 1
    return (start, end) if labels > 1 else None


def parse_ip(text: str, at: int) -> tuple[int, int, bool]:
    """Four numbers with points between them from ``at``: start, end and whether all are at most 255.

    Without four numbers the end is that of the first one, and the span is not valid.
    """
    first = part = _DIGITS.match(text, at)
    parts = [part.group()]
    while len(parts) < 4:
        if part.end() >= len(text) or text[part.end()] != "." or not (part := _DIGITS.match(text, part.end() + 1)):
            return at, first.end(), False
        parts.append(part.group())
    return at, part.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def parse_url(text: str, at: int, after: int) -> tuple[int, int] | None:
    """An address from its scheme at ``at`` to white space or a sign that cannot be in one, without closing marks."""
    body = _URL.match(text, after)
    if not body:
        return None
    end = after + len(body.group().rstrip(".,;:!?)]"))
    return (at, end) if end > after else None


def iban_ok(text: str) -> bool:
    moved = text.replace(" ", "")
    return 15 <= len(moved) <= 34 and int("".join(str(int(c, 36)) for c in moved[4:] + moved[:4])) % 97 == 1


def parse_account(text: str, after: int) -> tuple[int, int] | None:
    """An account number right after a cue: an IBAN with a valid check number, or 6 to 18 digits."""
    start = _AFTER_CUE.match(text, after).end()
    iban = _IBAN.match(text, start)
    while iban:
        if iban_ok(iban.group()):
            return iban.span()
        shorter = iban.group().rpartition(" ")[0]  # words after the number may look like a part of it
        iban = _IBAN.fullmatch(text, start, start + len(shorter)) if shorter else None
    number = _ACCOUNT.match(text, start)
    if number and not (number.end() < len(text) and text[number.end()].isdigit()):
        return number.span()
    return None


def parse_passport(text: str, after: int) -> tuple[int, int] | None:
    """A passport number right after a cue: 6 to 12 letters and digits, at least four of them digits."""
    number = _PASSPORT.match(text, _AFTER_CUE.match(text, after).end())
    return number.span() if number and sum(c.isdigit() for c in number.group()) >= 4 else None


def parse_secret(text: str, after: int, bearer: bool = False) -> tuple[int, int] | None:
    """The value that a cue is given by an equals sign or colon, or that follows the word bearer after blanks.

    In quotes it reaches to the same quote, else to white space or a sign that ends a value; then it must hold a letter
    and a digit, so that words of a sentence are none.
    """
    sign = _ASSIGNED.match(text, after) or (_BLANKS.match(text, after) if bearer else None)
    if not sign:
        return None
    quote, start = sign.group(1) if sign.re is _ASSIGNED else "", sign.end()
    value = _VALUE.match(text, start)
    if not value:
        return None
    end = value.end()
    if not quote:
        end = start + len(value.group().rstrip(".:!?)]}"))
    elif text[end:end + 1] != quote:
        return None
    held = text[start:end]
    mixed = any(map(str.isdigit, held)) and any(map(str.isalpha, held))
    return (start, end) if len(held) >= SECRET_LENGTH and (quote or mixed) else None


def find_spans(text: str, machine: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """All spans ``(start, end, kind)`` in code points, by start and then kind.

    For each kind, spans are the leftmost ones that do not overlap. A run of digits that is no valid number of a kind
    still takes its place for that kind, so a later part of it is not tried again.
    """
    found: list[tuple[int, int, str]] = []
    upto = dict.fromkeys(KINDS, 0)
    for last, (sort, length) in machine.iter(lowered(text)):
        at = last + 1 - length
        if sort == "digit":
            if at >= upto["ip"]:
                start, upto["ip"], good = parse_ip(text, at)
                if good:
                    found.append((start, upto["ip"], "ip"))
            if at >= upto["card"]:
                card = _CARD.match(text, at)
                upto["card"] = card.end() if card else at + 1
                if card and 14 <= len(digits := _only_digits(card.group())) <= 19 and luhn(digits):
                    found.append((at, card.end(), "card"))
        elif sort == "at":
            if span := parse_email(text, at, upto["email"]):
                upto["email"] = span[1]
                found.append((*span, "email"))
        elif sort == "plus":
            phone = _PHONE.match(text, at)
            if phone and 10 <= len(_only_digits(phone.group())) <= 15:
                found.append((at, phone.end(), "phone"))
        elif sort == "scheme":
            if at >= upto["url"] and (at == 0 or not text[at - 1].isalnum()) and (span := parse_url(text, at, last + 1)):
                upto["url"] = span[1]
                found.append((*span, "url"))
        elif at >= upto[sort] and (at == 0 or not text[at - 1].isalnum()):
            if sort == "account":
                span = parse_account(text, last + 1)
            elif sort == "passport":
                span = parse_passport(text, last + 1)
            else:
                span = parse_secret(text, last + 1, text[at:last + 1].lower() == "bearer")
            if span and span[0] >= upto[sort]:
                upto[sort] = span[1]
                found.append((*span, sort))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``spans``, an array of (kind, start, end) by start and kind, for each row of ``docs``: id and this column.

    Positions count code points and ends are exclusive. Null texts count as empty and, as all texts without personal
    data, have no spans. Texts of any length are searched whole, in one pass. Spans of one kind do not overlap; of two
    at one place that of the kind listed first comes first. Repeated rows get equal results; an empty table gives no
    rows; further columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        machine = anchors()
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for a, b, k in find_spans(t.as_py() or "", machine)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=[id_col, "spans"])
    rows = docs.select(docs[id_col], docs[text_col].cast("string").alias("text"))
    schema = rows.select(rows[0], F.array(F.struct(F.lit("").alias("kind"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))).alias("spans")).schema
    return rows.mapInArrow(run, schema)


