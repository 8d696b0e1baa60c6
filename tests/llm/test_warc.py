"""Archives by exact round trips, the index against a plain sort."""

import base64
import gzip
import hashlib
import itertools
import random
from collections import Counter

import pytest

from foliospark.llm import warc
from foliospark.session import local_rows, scratch_path, staged

SCHEMA = "page_id long, url string, html string, id string, sha string, digest string, copy int"
PAGES = [
    (1, "http://www.Example.com:80/a?b=1#part", "plain"), (2, "https://example.com/a?b=1", "plain"), (3, "http://example.com:8080", "gap\r\n\r\ngap\r\n\r\n"),
    (4, "http://example.com/a", "\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"), (5, None, None), (6, "http://user@b.example.org/x", ""),
    (7, "odd\nurl with\tbreaks", "é漢\U0001f600\x00"), (8, "http://example.com/a", "plain"), (8, "http://example.com/a", "plain"), (8, "http://other.example/", "plain"),
    (None, "http://n.example/", "plain"), (None, None, "only null"), (9, "http://example.com/a", "x" * 300_000), (10, "ftp:nothing", "\r\n"), (11, "", "HTTP/1.1 200 OK\r\n\r\n"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def written(spark, rows, **how):
    path = scratch_path(spark, "archives")
    warc.write_archives(local_rows(spark, [(*r, "x", "y", "z", 1) for r in rows], SCHEMA).repartition(3), path, **how)
    found = staged(warc.read_archives(spark, path), "runs")
    return found, [(r, r["page"], r["refers"]) for r in found.withColumn("page", warc.page_id(found.record_id)).withColumn(
        "refers", warc.page_id(found.refers_to)).collect()]


@pytest.mark.parametrize("least", [0, 1, 6])
def test_what_is_written_is_read(spark, least):
    _, found = written(spark, PAGES, least_bytes=least)
    text = lambda i: None if i is None else str(i)
    assert Counter((p, r["payload_bytes"], r["computed_digest"] or r["payload_digest"]) for r, p, _ in found) == Counter(
        (text(i), len((h or "").encode()), digest(h)) for i, _, h in PAGES)
    for html, group in itertools.groupby(sorted(PAGES, key=lambda r: r[2] or ""), key=lambda r: r[2] or ""):
        group = list(group)
        here = [(r, p, to) for r, p, to in found if (r["computed_digest"] or r["payload_digest"]) == digest(html)]
        top = max((i for i, _, _ in group if i is not None), default=None)
        if len(html.encode()) < least:
            assert {r["type"] for r, _, _ in here} == {"response"} and len(here) == len(group)
            continue
        assert [(p, to) for r, p, to in here if r["type"] == "response"] == [(text(top), None)]
        assert sum(r["type"] == "revisit" and to == text(top) for r, _, to in here) == len(group) - 1
    for r, _, _ in found:
        assert r["computed_digest"] in (None, r["payload_digest"])
    assert len({r["record_id"] + (r["url"] or "") for r, _, _ in found}) == len(found)


def test_urls_stay_on_their_line(spark):
    _, found = written(spark, PAGES)
    assert {r["url"] for r, p, _ in found if p == "7"} == {"odd%0Aurl%20with%09breaks"}
    assert {r["url_key"] for r, p, _ in found if p in ("1", "2")} == {"com,example)/a?b=1"}
    assert [warc.url_key(u) for u in ("http://EXAMPLE.com", "https://x.y:443?q", "//h:81/p", "mailto:a", None, "http://www2.a.b//c")] == [
        "com,example)/", "y,x)/?q", "h:81)/p", "mailto:a", "", "b,a)//c"]


@pytest.mark.parametrize("range_rows", [1000, 7])
def test_the_index_is_one_sorted_list(spark, range_rows, monkeypatch):
    monkeypatch.setattr(warc, "RUN_ROWS", 5)
    dice = random.Random(range_rows)
    rows = [(i, "http://hot.example/" if dice.random() < 0.5 else f"http://h{dice.randint(0, 9)}.example/{dice.randint(0, 3)}", f"p{i}") for i in range(120)]
    runs, _ = written(spark, rows)
    for _, run in itertools.groupby(sorted(runs.collect(), key=lambda r: r["run"]), key=lambda r: r["run"]):
        assert 1 <= len(list(run)) <= 5
    index = sorted(warc.capture_index(runs, range_rows).collect(), key=lambda r: r["place"])
    expected = sorted((warc.url_key(u), i) for i, u, _ in rows)
    assert [r["place"] for r in index] == list(range(1, 121))
    assert [(r["url_key"], r["payload_digest"]) for r in index] == [(k, digest(f"p{i}")) for k, i in expected]
    seen = Counter()
    for r in index:
        seen[r["url_key"]] += 1
        assert r["capture"] == seen[r["url_key"]]


def test_archives_of_others_and_broken_ones(spark, tmp_path):
    block = bytes(range(256)) * 3
    records = [b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://a.b/\r\n c\r\nContent-Type: image/gif\r\n"
               b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n",
               b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
               b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: 12\r\n\r\nHTTP/1.1 204\r\n\r\n"]
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "one.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    found = warc.read_archives(spark, str(tmp_path / "good")).orderBy("number").collect()
    assert [(r["type"], r["payload_bytes"]) for r in found] == [("resource", 768), ("warcinfo", 0), ("response", 0)]
    assert found[0]["computed_digest"] == base64.b32encode(hashlib.sha1(block).digest()).decode() and found[0]["url"] == "http://a.b/ c"
    for name, data in (("cut", records[0][:-400]), ("noise", b"hello\r\n\r\n" + records[1])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.warc.gz").write_bytes(gzip.compress(data))
        with pytest.raises(Exception, match="WARC record|ends within"):
            warc.read_archives(spark, str(tmp_path / name)).collect()


def test_an_empty_table(spark):
    runs, found = written(spark, [])
    assert found == [] and warc.capture_index(runs).count() == 0


def test_records_do_not_depend_on_where_the_bytes_were_split():
    payload = b"a\r\n\r\n\r\nb\r\n\r\n"
    head = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload)
    one = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % len(head + payload) + head + payload
    stream = (one + b"\r\n\r\n") * 3
    rows = list(warc.records(iter(stream.split(b"\r\n\r\n"))))
    assert [(r[0], r[6]) for r in rows] == [("response", len(payload))] * 3
    assert {r[7] for r in rows} == {base64.b32encode(hashlib.sha1(payload).digest()).decode()}


def test_the_tree_of_losers_merges_like_a_sort():
    dice = random.Random(1)
    for k in range(0, 12):
        runs = [sorted(dice.choices(range(20), k=dice.randint(0, 9))) for _ in range(k)]
        assert list(warc.merged(runs, lambda x: x)) == sorted(itertools.chain(*runs))
