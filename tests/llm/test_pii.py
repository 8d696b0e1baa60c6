import re

from hypothesis import given, settings
from hypothesis import strategies as st

from foliospark.llm import pii
from tests.llm.helpers import TEXTS, awkward

MACHINE = pii.anchors()
# The patterns of the base kinds.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def valid(kind, text):
    digits = re.sub(r"[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = 0
        for i, d in enumerate(reversed(digits)):
            x = int(d) * (1 + i % 2)
            total += x - 9 if x > 9 else x
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def brute(text):
    return sorted((m.start(), m.end(), k) for k, p in PATTERNS.items() for m in p.finditer(text) if valid(k, m.group()))


def base(text):
    return sorted(s for s in pii.find_spans(text, MACHINE) if s[2] in pii.BASE)


@settings(max_examples=3000, deadline=None)
@given(st.text(st.sampled_from("@@..ab-+ 0123456789()%_é@.\n"), max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert base(text) == brute(text)


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "1.2.3.4", "256.1.1.1", "+1 (555) 010-9999", "a@b.co", "a@b.co@c.de", "@", ".", " ", "-", "x", "0", "+", "12.34.5", "é"]), max_size=12))
def test_base_spans_of_joined_parts(parts):
    assert base("".join(parts)) == brute("".join(parts))


def test_extra_kinds():
    def spans(text):
        return [(text[a:b], k) for a, b, k in pii.find_spans(text, MACHINE) if k not in pii.BASE]
    assert spans("see https://a.b/c?d=1). and http://x") == [("https://a.b/c?d=1", "url"), ("http://x", "url")]
    assert spans("IBAN: DE89 3704 0044 0532 0130 00 thanks") == [("DE89 3704 0044 0532 0130 00", "account")]
    assert spans("Account number: 123-456-789.") == [("123-456-789", "account")]
    assert spans("accounting 123456789") == [] and spans("myaccount 123456789") == []


def extra(text):
    return [(text[a:b], k) for a, b, k in pii.find_spans(text, MACHINE) if k not in pii.BASE]


def test_cues_in_any_case_and_their_values():
    assert extra("Customer ID: 12345678 and CusTomer iD 87654321") == [("12345678", "account"), ("87654321", "account")]
    assert extra("HTTPS://a.b/c Http://d.e") == [("HTTPS://a.b/c", "url"), ("Http://d.e", "url")]
    assert extra("Passport No. C01X00T47.") == [("C01X00T47", "passport")]
    assert extra("İİ PASSWORD = 'p w d' password: hunter2x, İ") == [("hunter2x", "secret")]
    assert extra('token = "04dbebab91ab85687d33" thha') == [("04dbebab91ab85687d33", "secret")]
    assert extra('{"api_key": "abcdefgh", "pwd":"short"}') == [("abcdefgh", "secret")]
    assert extra("Authorization: Bearer eyJhbGci.0iJIUz.") == [("eyJhbGci.0iJIUz", "secret")]
    assert extra("Account number:" + " " * 200 + "123-456-789") == [("123-456-789", "account")]


def test_plain_sentences_hold_no_values():
    for text in ("the token: something odd", "a secret password is better", "tokens = 4x8a9b7c6d5e", "passport control office",
                 "bearer of the ring", "password: unknown-to-me", "passport for 2 people", "token", "token =", "token = '", "secret: 1234"):
        assert extra(text) == [], text


def plain_secrets(text):
    """Every cue by a search from each position on, one pattern after the other."""
    found, upto = [], 0
    for at in range(len(text)):
        if at < upto or (at and text[at - 1].isalnum()):
            continue
        for cue in sorted(pii.CUES["secret"], key=len):
            if text[at:at + len(cue)].lower() == cue:
                m = re.match(r"""["']?\s*(?::=|=>|[:=])\s*(["'`]?)([^\s"'`<>,;|]+)""", text[at + len(cue):])
                if not m or (m[1] and text[at + len(cue) + m.end():][:1] != m[1]):
                    continue
                value = m[2] if m[1] else m[2].rstrip(".:!?)]}")
                start = at + len(cue) + m.start(2)
                if len(value) >= 8 and start >= upto and (m[1] or (re.search(r"\d", value) and re.search(r"[^\W\d_]", value))):
                    found.append((start, start + len(value), "secret"))
                    upto = start + len(value)
    return found


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.sampled_from(["token", "Secret", "secret key", "pwd", " ", "=", ":", ":=", '"', "'", "a1b2c3d4", "abcdefgh", ".", ",", "x", "é", "İ"]), max_size=14))
def test_secrets_equal_a_plain_search(parts):
    text = "".join(parts)
    assert [s for s in pii.find_spans(text, MACHINE) if s[2] == "secret"] == plain_secrets(text)


def test_tokens_of_the_given_documents_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id for r in pii.personal_data(docs).collect() if any(s.kind == "secret" for s in r.spans)}
    lines = {r.doc_id for r in docs.collect() if re.search(r'\btoken = "[0-9a-f]{40}"', r.text or "")}
    assert lines and found == lines


def test_awkward_rows(spark):
    docs = awkward(spark, [*TEXTS, (60, "é a@b.co"), (61, "1" * 100_000), (62, "a@" * 50_000), (63, "+1" * 50_000)])
    got = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    assert [tuple(s) for s in got[60]] == [("email", 2, 8)]
    assert got[3] == [] and got[4] == [] and pii.personal_data(docs).count() == docs.count()
    assert pii.personal_data(docs.limit(0)).count() == 0
