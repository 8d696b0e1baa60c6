"""Text and properties of word-processing and spreadsheet files.

Each file is one row; Spark distributes the rows, the helpers below parse one archive.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, time, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

from foliospark.schemas import EXTRACTED
from foliospark.session import bounded_batches

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
CORE = "{http://schemas.openxmlformats.org/package/2006/metadata/core-properties}"
DC = "{http://purl.org/dc/elements/1.1/}"
TERMS = "{http://purl.org/dc/terms/}"

#: So many extracted files are passed on at once.
FILES_PER_BATCH = 100

# Built-in spreadsheet number formats that mean a date or a time.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _core_properties(archive: zipfile.ZipFile, description_field: str) -> dict:
    if "docProps/core.xml" not in archive.namelist():
        return {}
    root = ElementTree.fromstring(archive.read("docProps/core.xml"))
    tags = {
        "document_title": DC + "title", "document_author": DC + "creator", "document_subject": DC + "subject",
        "document_keywords": CORE + "keywords", "document_category": CORE + "category",
        description_field: DC + "description",
        "document_created": TERMS + "created", "document_modified": TERMS + "modified",
    }
    found = {field: root.findtext(tag) for field, tag in tags.items()}
    return {f: (v.rstrip("Z") if f in ("document_created", "document_modified") else v)
            for f, v in found.items() if v}


def _paragraph_text(paragraph: ElementTree.Element) -> str:
    marks = {W + "tab": "\t", W + "cr": "\n", W + "noBreakHyphen": "-"}
    out = []
    for run in paragraph.iter(W + "r"):
        for node in run:
            if node.tag == W + "t":
                out.append(node.text or "")
            elif node.tag == W + "br" and node.get(W + "type", "textWrapping") == "textWrapping":
                out.append("\n")
            else:
                out.append(marks.get(node.tag, ""))
    return "".join(out)


def _table_rows(table: ElementTree.Element) -> Iterator[list[str]]:
    """Cell texts by grid column; a merged cell shows its text in every column and row it covers."""
    above: list[str] = []
    for row in table.findall(W + "tr"):
        cells: list[str] = []
        for cell in row.findall(W + "tc"):
            span, merge = cell.find(f"{W}tcPr/{W}gridSpan"), cell.find(f"{W}tcPr/{W}vMerge")
            text = "\n".join(_paragraph_text(p) for p in cell.findall(W + "p"))
            if merge is not None and merge.get(W + "val", "continue") == "continue" and len(cells) < len(above):
                text = above[len(cells)]
            cells += [text] * int(span.get(W + "val") if span is not None else 1)
        above = cells
        yield cells


def docx_body(archive: zipfile.ZipFile) -> tuple[list[str], list[list[list[str]]]]:
    body = ElementTree.fromstring(archive.read("word/document.xml")).find(W + "body")
    return ([_paragraph_text(p) for p in body.findall(W + "p")],
            [list(_table_rows(t)) for t in body.findall(W + "tbl")])


def docx_text(archive: zipfile.ZipFile) -> str:
    paragraphs, tables = docx_body(archive)
    lines = [p for p in paragraphs if p.strip()]
    lines += [" | ".join(cell.strip() for cell in row) for table in tables for row in table]
    return "\n".join(lines)


def docx_properties(archive: zipfile.ZipFile) -> dict:
    paragraphs, tables = docx_body(archive)
    return {**_core_properties(archive, "document_comments"),
            "paragraph_count": len(paragraphs), "table_count": len(tables)}


def _sheets(archive: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(title, archive member) in workbook order; chart sheets are left out."""
    links = ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in links if r.get("Type", "").endswith("/worksheet")}
    book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
    return [(s.get("name"), "xl/" + targets[s.get(R + "id")].removeprefix("/xl/"))
            for s in book.iter(S + "sheet") if s.get(R + "id") in targets]


def _shared_strings(archive: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in archive.namelist():
        return []
    root = ElementTree.fromstring(archive.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in [*item.findall(S + "t"), *item.findall(f"{S}r/{S}t")])
            for item in root.findall(S + "si")]


def _date_styles(archive: zipfile.ZipFile) -> set[int]:
    """Indexes of the cell styles that show a number as a date."""
    if "xl/styles.xml" not in archive.namelist():
        return set()
    root = ElementTree.fromstring(archive.read("xl/styles.xml"))
    custom = {int(n.get("numFmtId")): n.get("formatCode", "") for n in root.iter(S + "numFmt")}
    plain = {i: re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", code) for i, code in custom.items()}
    dated = DATE_FORMATS | {i for i, code in plain.items() if re.search("[dmyhs]", code, re.IGNORECASE)}
    formats = root.find(S + "cellXfs")
    return {i for i, xf in enumerate(formats if formats is not None else ())
            if int(xf.get("numFmtId", 0)) in dated}


def _cell_value(cell: ElementTree.Element, strings: list[str], dated: set[int], epoch: datetime) -> str | None:
    kind, raw = cell.get("t", "n"), cell.findtext(S + "v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(S + "t"))
    if raw is None:
        return None
    if kind == "s":
        return strings[int(raw)]
    if kind == "b":
        return str(raw == "1")
    if kind != "n":
        return raw
    number = float(raw) if re.search("[.eE]", raw) else int(raw)
    if int(cell.get("s", 0)) in dated:
        moment = epoch + timedelta(seconds=round(float(number) * 86400))
        return str(moment if number >= 1 else time(moment.hour, moment.minute, moment.second))
    return str(number)


def xlsx_text(archive: zipfile.ZipFile) -> str:
    strings, dated = _shared_strings(archive), _date_styles(archive)
    settings = ElementTree.fromstring(archive.read("xl/workbook.xml")).find(S + "workbookPr")
    since_1904 = settings is not None and settings.get("date1904") in ("1", "true")
    epoch = datetime(1904, 1, 1) if since_1904 else datetime(1899, 12, 30)
    lines = []
    for title, member in _sheets(archive):
        lines.append(f"[Sheet: {title}]")
        for row in ElementTree.fromstring(archive.read(member)).iter(S + "row"):
            values = [_cell_value(c, strings, dated, epoch) for c in row.findall(S + "c")]
            filled = [v for v in values if v is not None]
            if filled:
                lines.append(" | ".join(filled))
    return "\n".join(lines)


def xlsx_properties(archive: zipfile.ZipFile) -> dict:
    titles = [title for title, _ in _sheets(archive)]
    return {**_core_properties(archive, "document_description"),
            "sheet_count": len(titles), "sheet_names": titles}


def _archive_job(text_of, properties_of):
    """A batch function: text and properties fail independently of each other."""
    fields = EXTRACTED.fieldNames()

    def one(path: str, content: bytes) -> dict:
        row = {"path": path}
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                row["content"] = text_of(archive)
        except Exception as failure:  # noqa: BLE001 - any broken file becomes an error row
            row["error"] = f"Error extracting content from {path}: {failure}"
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                row.update(properties_of(archive))
        except Exception as failure:  # noqa: BLE001 - metadata is optional
            row["metadata_error"] = str(failure)
        return row

    def job(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            paths, contents = batch["path"].tolist(), batch["content"].tolist()
            # Texts are many times larger than their archives; few are held at a time.
            for first in range(0, len(paths), FILES_PER_BATCH):
                rows = [one(p, c) for p, c in zip(paths[first:first + FILES_PER_BATCH], contents[first:first + FILES_PER_BATCH])]
                out = pd.DataFrame(rows, columns=fields, dtype=object)
                yield out.where(out.notna(), None)

    return job


def extract_docx(files: DataFrame) -> DataFrame:
    """(path, content) rows to text and properties: paragraphs first, then all table rows."""
    bounded_batches(files.sparkSession)
    return files.select("path", "content").mapInPandas(_archive_job(docx_text, docx_properties), EXTRACTED)


def extract_xlsx(files: DataFrame) -> DataFrame:
    """(path, content) rows to text and properties: a header per sheet, then its filled rows."""
    bounded_batches(files.sparkSession)
    return files.select("path", "content").mapInPandas(_archive_job(xlsx_text, xlsx_properties), EXTRACTED)
