"""Minimal word-processing and spreadsheet archives built from rows, as extraction inputs."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame

from foliospark.session import bounded_batches

W_NS = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
S_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
R_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def core_xml(title: str | None, author: str | None, created: str = "2024-01-02T03:04:05Z") -> str:
    fields = "".join(f"<dc:{t}>{escape(v)}</dc:{t}>" for t, v in (("title", title), ("creator", author)) if v)
    return ('<cp:coreProperties xmlns:cp="http://schemas.openxmlformats.org/package/2006/metadata/core-properties" '
            'xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:dcterms="http://purl.org/dc/terms/">'
            f"{fields}<dcterms:created>{created}</dcterms:created></cp:coreProperties>")


def _packed(members: dict[str, str]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
        for name, text in members.items():
            out.writestr(name, text)
    return buffer.getvalue()


def docx_bytes(paragraphs: list[str], rows: list[list[str]], title: str | None, author: str | None) -> bytes:
    def paragraph(text: str) -> str:
        return f'<w:p><w:r><w:t xml:space="preserve">{escape(text)}</w:t></w:r></w:p>'
    table = "".join("<w:tr>" + "".join(f"<w:tc>{paragraph(c)}</w:tc>" for c in row) + "</w:tr>" for row in rows)
    # The table stands before the paragraphs; extraction must still give paragraphs first.
    body = f"<w:tbl>{table}</w:tbl>" + "".join(map(paragraph, paragraphs))
    return _packed({"word/document.xml": f'<w:document xmlns:w="{W_NS}"><w:body>{body}</w:body></w:document>',
                    "docProps/core.xml": core_xml(title, author)})


def xlsx_bytes(sheets: list[tuple[str, list[list]]], title: str | None, author: str | None) -> bytes:
    strings: dict[str, int] = {}

    def cell(value) -> str:
        if value is None:
            return "<c/>"
        if isinstance(value, bool):
            return f'<c t="b"><v>{int(value)}</v></c>'
        if isinstance(value, (int, float)):
            return f"<c><v>{value}</v></c>"
        return f'<c t="s"><v>{strings.setdefault(value, len(strings))}</v></c>'

    members, book, links = {}, "", ""
    for number, (name, rows) in enumerate(sheets, 1):
        data = "".join("<row>" + "".join(map(cell, row)) + "</row>" for row in rows)
        members[f"xl/worksheets/sheet{number}.xml"] = f'<worksheet xmlns="{S_NS}"><sheetData>{data}</sheetData></worksheet>'
        book += f'<sheet name="{escape(name)}" sheetId="{number}" r:id="rId{number}"/>'
        links += f'<Relationship Id="rId{number}" Type="{R_NS}/worksheet" Target="worksheets/sheet{number}.xml"/>'
    members["xl/workbook.xml"] = f'<workbook xmlns="{S_NS}" xmlns:r="{R_NS}"><sheets>{book}</sheets></workbook>'
    members["xl/_rels/workbook.xml.rels"] = f"<Relationships>{links}</Relationships>"
    shared = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings)
    members["xl/sharedStrings.xml"] = f'<sst xmlns="{S_NS}">{shared}</sst>'
    members["docProps/core.xml"] = core_xml(title, author)
    return _packed(members)


def docx_files(rows: DataFrame) -> DataFrame:
    """(path, content): one paragraph per line of ``text`` and a two-row table."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["filePath"], "content": [
                docx_bytes(t.split("\n"), [[f" {s} ", lang], ["size", str(n)]], title, f"author {lang}")
                for t, s, lang, n, title in zip(b["text"], b["source"], b["lang"], b["size"], b["document_title"])]})
    bounded_batches(rows.sparkSession)
    return rows.select("filePath", "text", "source", "lang", "size", "document_title") \
        .mapInPandas(build, "path string, content binary")


def xlsx_files(rows: DataFrame) -> DataFrame:
    """(path, content): a sheet with one row per line of ``text``, and a sheet with gaps."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["filePath"], "content": [
                xlsx_bytes([("Lines", [[i, line] for i, line in enumerate(t.split("\n"))]),
                            ("Info", [[s, None, lang], [None, None], [True, n]])], title, f"author {lang}")
                for t, s, lang, n, title in zip(b["text"], b["source"], b["lang"], b["size"], b["document_title"])]})
    bounded_batches(rows.sparkSession)
    return rows.select("filePath", "text", "source", "lang", "size", "document_title") \
        .mapInPandas(build, "path string, content binary")
