"""Web archives: records written and read by Spark, and an ordered index of their captures."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliospark.llm.common import bounded_batches, spread_lookup
from foliospark.session import staged

VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: What separates header and block, and ends a record.
GAP = "\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Captures of one range of the index; a range is merged in memory.
RANGE_ROWS = 100_000

# ---- writing


def base32_sha1(text: Column) -> Column:
    """SHA-1 in upper-case base32 without a prefix: five hexadecimal digits make four characters."""
    digits = F.sha1(text.cast("binary"))
    letters = []
    for group in range(8):
        value = F.conv(F.substring(digits, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(_BASE32), F.shiftright(value, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def _line(name: str, value: Column) -> Column:
    """A header line; none for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _one_line(url: Column) -> Column:
    """A url in which blanks and control characters, which would break a header line, are percent codes."""
    code = F.transform(F.regexp_extract_all(url, F.lit("(?s)."), F.lit(0)),
                       lambda c: F.when(c.rlike(r"[\x00-\x20\x7F]"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c))
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), F.array_join(code, "")).otherwise(url)


def _uri(key: Column, copy: Column) -> Column:
    """The record's name: the page's id, in hexadecimal so that any id may stand there, and the number of the copy."""
    return F.concat(F.lit("<urn:x-page:"), F.hex(F.encode(key, "UTF-8")), F.lit(":"), copy.cast("string"), F.lit(">"))


def _key(column: Column) -> Column:
    """A value as text that is never null: ``=`` and the value, or nothing."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   time_col: str | None = None, least_bytes: int = 0, codec: str = "gzip") -> None:
    """Write one WARC record per row of ``pages`` to files in the folder ``path``.

    Of rows with equal payloads of at least ``least_bytes`` bytes, the one with the largest id is a response and the
    others are revisits that refer to it and carry its headers, but not its payload; shorter payloads are responses.
    Equal means equal SHA-256 and length. Spark's text writer puts the records one after the other, so that archives
    go to any file system that Spark writes to, and a lost task is repeated without a trace.

    Only small columns are grouped; payloads are shuffled once and only copies of one row meet, one per task. Null
    payloads are empty, null urls have no target line, null ids count as smaller than any other. Rows that are equal in
    id, url and payload are copies 0, 1, ... of one record; of rows with one id and payload the largest url wins. Long
    payloads go through whole. ``time_col`` gives the capture time, by default seconds since 2000 by a number id, else
    2000-01-01. Further columns are ignored. An empty table writes no record.
    """
    payload = F.coalesce(pages[payload_col].cast("string"), F.lit(""))
    number = pages.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long")
    since = F.coalesce(pages[id_col].cast("long"), F.lit(0)) if number else F.lit(0)
    when = pages[time_col].cast("timestamp") if time_col else F.timestamp_seconds(F.lit(946_684_800) + F.pmod(since, F.lit(10**10)))
    rows = pages.select(
        pages[id_col].alias("id"), _one_line(pages[url_col].cast("string")).alias("url"), _key(pages[id_col]).alias("id_key"), _key(pages[url_col]).alias("url_key"),
        F.date_format(F.coalesce(when, F.timestamp_seconds(F.lit(946_684_800))), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        F.sha2(payload.cast("binary"), 256).alias("sha"), F.octet_length(payload).cast("long").alias("bytes"), base32_sha1(payload).alias("digest"),
        payload.alias("payload"))
    unit = ["id_key", "url_key", "date", "sha", "bytes"]
    units = staged(rows.groupBy(*unit).agg(F.count("*").alias("n"), F.first("id").alias("id"), F.first("url").alias("url"), F.first("digest").alias("digest")), "units")
    long_enough = F.col("bytes") >= least_bytes
    heads = units.where(long_enough).groupBy("sha", "bytes").agg(F.max(F.struct("id", "url_key", "date", "id_key", "url")).alias("head"))
    marked = spread_lookup(units, heads, ["sha", "bytes"], ["id_key", "url_key", "date"], "inner").select(*units.columns, "head")
    same = (F.col("head.id_key") == F.col("id_key")) & (F.col("head.url_key") == F.col("url_key")) & (F.col("head.date") == F.col("date"))
    decided = staged(marked.withColumn("is_head", same).unionByName(
        units.where(~long_enough).withColumn("head", F.lit(None).cast(marked.schema["head"].dataType)).withColumn("is_head", F.lit(True))), "decided")

    def header(kind: str, copy: Column, block: Column, *more: Column) -> Column:
        return F.concat(F.lit(f"{VERSION}\r\nWARC-Type: {kind}\r\n"), _line("WARC-Record-ID", _uri(F.col("id_key"), copy)),
                        _line("WARC-Target-URI", F.col("url")), _line("WARC-Date", F.col("date")),
                        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), *more,
                        F.lit("Content-Type: application/http; msgtype=response\r\n"),
                        _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(GAP))
    # Equal rows are one row per task after the partial aggregation.
    bodies = rows.groupBy(*unit).agg(F.first("payload").alias("payload"))
    first = bodies.join(decided.where("is_head"), unit)
    block = F.concat(http, F.col("payload"))
    # Short payloads: all copies are responses. Others: one copy is, the rest are revisits.
    copies = F.when(F.col("bytes") < least_bytes, F.sequence(F.lit(0), F.col("n").cast("int") - 1)).otherwise(F.array(F.lit(0)))
    responses = first.withColumn("copy", F.explode(copies)).select(F.concat(header("response", F.col("copy"), block), block).alias("record"))
    again = decided.where("bytes >= %d" % least_bytes).where("n > 1 OR NOT is_head").withColumn(
        "copy", F.explode(F.sequence(F.when(F.col("is_head"), 1).otherwise(0), F.col("n").cast("int") - 1)))
    refers = (F.lit(f"WARC-Profile: {REVISIT}\r\n"), _line("WARC-Refers-To", _uri(F.col("head.id_key"), F.lit(0))),
              _line("WARC-Refers-To-Target-URI", F.col("head.url")), _line("WARC-Refers-To-Date", F.col("head.date")))
    revisits = again.select(F.concat(header("revisit", F.col("copy"), http, *refers), http).alias("record"))
    responses.unionByName(revisits).write.option("lineSep", GAP).option("compression", codec).text(path)


# ---- reading

#: Captures of one sorted run.
RUN_ROWS = 50_000
RECORD = ("file string, run string, number long, type string, record_id string, url string, date string, payload_digest string, refers_to string, "
          "payload_bytes long, computed_digest string, url_key string")
_COLUMNS = [f.split()[0] for f in RECORD.split(", ")]
_RUN, _KEY, _DATE, _NAME = (_COLUMNS.index(c) for c in ("run", "url_key", "date", "record_id"))


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Header lines as a dictionary with lower-case names; a line that begins with a blank goes on with the one before."""
    out, name = {}, None
    for line in lines:
        if line[:1] in (b" ", b"\t") and name:
            out[name] += " " + line.strip().decode("utf-8", "replace")
        elif b":" in line:
            name, value = line.split(b":", 1)
            name = name.strip().lower().decode("latin-1")
            out[name] = value.strip().decode("utf-8", "replace")
    return out


class _Record:
    """A record that is being read: its header, and how much of its block is still to come."""

    def __init__(self, head: bytes):
        lines = head.split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"not the beginning of a WARC record: {lines[0][:60]!r}")
        self.fields = _fields(lines[1:])
        self.left = int(self.fields["content-length"])
        self.http: dict[str, str] | None = None
        self.has_http = self.fields.get("content-type", "").startswith("application/http")
        self.payload, self.digest, self.open = 0, hashlib.sha1(), b""

    def feed(self, data: bytes) -> bytes:
        """Take what belongs to the block and return the rest."""
        data, rest = data[:self.left], data[self.left:]
        self.left -= len(data)
        if self.has_http and self.http is None:
            head, gap, data = (self.open + data).partition(GAP.encode())
            if not gap and self.left:
                self.open = head
                return rest
            self.http, self.open = _fields(head.split(b"\r\n")[1:]), b""
        self.payload += len(data)
        self.digest.update(data)
        return rest

    def row(self) -> tuple:
        get, kind = self.fields.get, self.fields.get("warc-type")
        stated = get("warc-payload-digest", "").removeprefix("sha1:") or None
        n, made = self.payload, base64.b32encode(self.digest.digest()).decode()
        if kind == "revisit":  # its headers tell the length of the payload that it stands for
            n, made = int((self.http or {}).get("content-length", 0)), None
        return kind, get("warc-record-id"), get("warc-target-uri"), get("warc-date"), stated, get("warc-refers-to"), n, made


def records(pieces: Iterator[bytes]) -> Iterator[tuple]:
    """Records of one archive, whose bytes were split at every empty line; of a block only one piece is held."""
    record, held = None, b""
    for data in itertools.islice(itertools.chain.from_iterable((GAP.encode(), piece) for piece in pieces), 1, None):
        data = held + data
        held = b""
        while data or (record and not record.left):
            if record is None:
                data = data.lstrip(b"\r\n")
                head, gap, rest = data.partition(GAP.encode())
                if not gap:
                    break
                record, data = _Record(head), rest
            if record.left:
                data = record.feed(data)
            if record.left:
                break
            yield record.row()
            record = None
        held = data
    if record is not None or held.strip(b"\r\n"):
        raise ValueError("an archive ends within a record")


_URL = re.compile(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?//(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^#]*)")
_PORTS = {"http": "80", "https": "443"}


def url_key(url: str | None) -> str:
    """The key by which captures are sorted: host labels from the right, then path and query, e.g. ``org,example)/a?b``.

    Scheme, user, fragment, default port and a leading ``www.`` do not count; other texts are their own key, null is
    the empty key.
    """
    found = _URL.match(url or "")
    if not found:
        return url or ""
    scheme, host, port, path = found.groups()
    host = re.sub(r"^www[0-9]*\.", "", host.lower())
    port = "" if not port or port == _PORTS.get((scheme or "").lower()) else f":{port}"
    return f"{','.join(reversed(host.split('.')))}{port}){path if path[:1] == '/' else '/' + path}"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all gzip archives in the folder ``path``, as sorted capture runs.

    A task reads its archives from the beginning to the end, computes the length and SHA-1 of each payload and gives
    its captures in runs of at most RUN_ROWS, each sorted by (url key, date, record name); ``run`` names the run. Files may
    come from elsewhere: blocks of any bytes, several gzip members, records without HTTP headers. An archive that ends
    too early or has no record where one should begin is an error.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = StructType.fromDDL(RECORD)
    target = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            yield from zip(batch.column("file").to_pylist(), batch.column("value").to_pylist(), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, pieces in itertools.groupby(rows(batches), key=lambda r: r[0]):
            found = ((*r, url_key(r[2])) for r in records(piece for _, piece in pieces))
            for number, captures in enumerate(itertools.batched(found, RUN_ROWS)):
                captures = [(file, f"{file}#{number}", number * RUN_ROWS + i, *r) for i, r in enumerate(captures)]
                captures.sort(key=capture_order)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*captures, strict=True), target, strict=True)], schema=target)
    bounded_batches(spark)
    text = spark.read.option("lineSep", GAP).text(path)
    return text.select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("value")).mapInArrow(run, schema)


def capture_order(capture: tuple) -> tuple[str, str, str]:
    """What captures are sorted by: url key, date, record name; missing ones are empty."""
    return capture[_KEY], capture[_DATE] or "", capture[_NAME] or ""


# ---- the index


def merged(runs: list[list], order: Callable) -> Iterator:
    """The items of several sorted lists in order, by a tree of losers; of equal items those of earlier lists first.

    Each inner node keeps the list that lost there, so that the next item takes one comparison per level.
    """
    k, at = len(runs), [0] * len(runs)
    keys = [order(r[0]) if r else None for r in runs]

    def first(a: int, b: int) -> bool:
        if keys[a] is None or keys[b] is None:
            return keys[b] is None and (keys[a] is not None or a < b)
        return (keys[a], a) < (keys[b], b)

    losers = [-1] * max(1, k)
    for leaf in range(k):
        node, winner = (leaf + k) // 2, leaf
        while node and winner >= 0:
            if losers[node] < 0:
                losers[node], winner = winner, -1
            elif first(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
        if winner >= 0:
            losers[0] = winner
    while k and keys[losers[0]] is not None:
        winner = losers[0]
        yield runs[winner][at[winner]]
        at[winner] += 1
        keys[winner] = order(runs[winner][at[winner]]) if at[winner] < len(runs[winner]) else None
        node = (winner + k) // 2
        while node:
            if first(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
        losers[0] = winner


def capture_index(runs: DataFrame, range_rows: int | None = None) -> DataFrame:
    """All captures in the order of url key, date and record name: the columns of ``runs``, ``place``, ``capture``.

    ``runs`` are sorted runs as `read_archives` gives them. Every run is cut at the same bounds, which Spark samples so
    that a range has about ``range_rows`` captures however many one url has, and each task merges its range's slices by
    a tree of losers. ``place`` is the number in the whole order, ``capture`` that in the history of its url, both from
    1; what earlier ranges hold is added from one row per range. The result is written by range, so that its files
    follow each other in order. Runs that come out of order are sorted again; an empty table has no captures.
    """
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema
    count = runs.count()
    ranges = max(1, -(-count // (range_rows or RANGE_ROWS)))
    dealt = runs.repartitionByRange(ranges, F.col("url_key"), F.coalesce("date", F.lit("")), F.coalesce("record_id", F.lit("")), "run", "number")
    schema = StructType([*runs.schema.fields, *StructType.fromDDL("range int, at long, nth long").fields])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                slices.setdefault(row[_RUN], []).append(row)
        for rows in slices.values():
            if any(capture_order(a) > capture_order(b) for a, b in itertools.pairwise(rows)):
                rows.sort(key=capture_order)
        number = TaskContext.get().partitionId()

        def counted() -> Iterator[tuple]:
            of, nth = None, 0
            for at, row in enumerate(merged([slices[name] for name in sorted(slices)], capture_order)):
                of, nth = row[_KEY], nth + 1 if row[_KEY] == of else 0
                yield *row, number, at, nth
        for held in itertools.batched(counted(), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), target, strict=True)], schema=target)
    bounded_batches(runs.sparkSession)
    index = staged(dealt.mapInArrow(run, schema), "captures")
    # One row per range: how many captures are before it, and how many of its first url's.
    edges = index.groupBy("range").agg(F.count("*").alias("n"), F.min("url_key").alias("first_url"), F.max("url_key").alias("last_url"),
                                       (F.max_by("nth", "at") + 1).alias("last_n"))
    before = Window.orderBy("range")
    so_far = edges.withColumn("base", F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        "of_last", F.sum("last_n").over(Window.partitionBy("last_url").orderBy("range"))).withColumn(
        "carried", F.when(F.lag("last_url").over(before) == F.col("first_url"), F.lag("of_last").over(before)))
    bases = so_far.select("range", "first_url", F.coalesce("base", F.lit(0)).alias("base"), F.coalesce("carried", F.lit(0)).alias("carried"))
    more = F.when(F.col("url_key") == F.col("first_url"), F.col("carried")).otherwise(F.lit(0))
    return index.join(bases, "range").select(*runs.columns, (F.col("base") + F.col("at") + 1).alias("place"), (F.col("nth") + more + 1).alias("capture"))


def page_id(name: Column) -> Column:
    """The page's id, as text, from a record name that `write_archives` gave; null for a null id."""
    key = F.decode(F.unhex(F.regexp_extract(name, "^<urn:x-page:([0-9A-F]*):[0-9]+>$", 1)), "UTF-8")
    return F.when(key.startswith("="), F.substring(key, 2, 1 << 30))
