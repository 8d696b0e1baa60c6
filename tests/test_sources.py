import html
import html.entities
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from foliospark.functions import text as X
from foliospark.session import local_rows
from foliospark.sources import assemble, extract, files, office
from foliospark.sources.html import html_to_text, unescape_entities
from foliospark.sources.walk import walk
from testkit import archives


@pytest.fixture
def tree(tmp_path):
    for name in ("a.txt", "sub/b c.TXT", "sub/deep/d.Docx", "excl/c.txt", "sub/excl/e.txt", "x.pdf", "n.xyz", ".hid/h.txt", "_u.txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"text of {name}")
    return tmp_path


def names(df, root):
    return sorted(r["path"].removeprefix(f"{root}/") for r in df.select("path").collect())


def test_recursive_scan_takes_allowed_types_in_any_case(spark, tree):
    found = files.scan_directory(spark, str(tree))
    assert names(found, tree) == ["a.txt", "excl/c.txt", "sub/b c.TXT", "sub/deep/d.Docx", "sub/excl/e.txt", "x.pdf"]


def test_excluded_directory_names_are_pruned_at_any_depth(spark, tree):
    found = files.scan_directory(spark, str(tree), exclude=["excl"])
    assert names(found, tree) == ["a.txt", "sub/b c.TXT", "sub/deep/d.Docx", "x.pdf"]
    # The root itself is never excluded and names compare exactly.
    assert names(files.scan_directory(spark, str(tree / "excl"), exclude=["excl"]), tree) == ["excl/c.txt"]
    assert "excl/c.txt" in names(files.scan_directory(spark, str(tree), exclude=["EXCL"]), tree)


def test_flat_scan_and_all_types(spark, tree):
    assert names(files.scan_directory(spark, str(tree), recursive=False), tree) == ["a.txt", "x.pdf"]
    assert names(files.scan_directory(spark, str(tree), recursive=False, extensions=None), tree) == ["a.txt", "n.xyz", "x.pdf"]


def test_walk_equals_the_scan(spark, tree):
    for how in ({}, {"exclude": ["excl"]}, {"exclude": ["EXCL"]}, {"recursive": False}, {"extensions": None}):
        walked, scanned = walk(spark, str(tree), **how), files.scan_directory(spark, str(tree), **how)
        columns = ["path", "modificationTime", "length"]
        assert sorted(walked.collect()) == sorted(scanned.select(*columns).collect())
    assert names(walk(spark, f"file://{tree}", where=F.col("length") > 18), tree) == ["sub/b c.TXT", "sub/deep/d.Docx", "sub/excl/e.txt"]
    assert names(walk(spark, [str(tree), str(tree / "sub") + "/"]), tree) == names(walk(spark, str(tree)), tree)


def test_walk_never_lists_excluded_folders(spark, tree):
    """An excluded folder that holds itself has no end, and one that vanishes while it is listed has no entries."""
    (tree / "sub" / "excl" / "loop").symlink_to(tree / "sub" / "excl")
    assert names(walk(spark, str(tree), exclude=["excl"]), tree) == ["a.txt", "sub/b c.TXT", "sub/deep/d.Docx", "x.pdf"]
    written = []
    assert names(walk(spark, str(tree), recursive=False, written=written), tree) == ["a.txt", "x.pdf"] and len(written) == 1


def test_walk_of_awkward_roots(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert walk(spark, str(tmp_path / "empty")).count() == 0 and walk(spark, []).count() == 0
    with pytest.raises(Exception, match="gone"):
        walk(spark, str(tmp_path / "gone")).count()
    wide = tmp_path / "wide"
    for i in range(300):
        (wide / f"d{i}" / "e").mkdir(parents=True)
        (wide / f"d{i}" / "e" / f"{i} [é].txt").write_text("x")
    assert walk(spark, str(wide)).count() == 300


def test_explicit_files_may_have_hidden_names(spark, tree):
    found = files.scan_files(spark, [str(tree / "_u.txt"), str(tree / "a.txt")])
    assert names(found, tree) == ["_u.txt", "a.txt"]


def test_listing_does_not_read_contents(spark, tree):
    plan = files.scan_directory(spark, str(tree)).select("path", "length")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_a_scan_holds_no_listing_in_the_driver(spark, tree):
    """Spark's reader does, even of a flat scan, for which it lists the whole tree."""
    for how in ({}, {"recursive": False}):
        found = files.scan_directory(spark, f"file://{tree}", **how)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "binaryFile" not in plan and "ArrowEvalPython" in plan
        assert "Python" not in found.select("path", "length")._jdf.queryExecution().executedPlan().toString()


def test_a_scan_reads_contents_in_parts(spark, tmp_path):
    texts = {f"{i}.txt": bytes([i]) * (3 << 20) for i in range(7)}  # several times what one part holds
    texts["none.txt"] = b""
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text)
    found = files.scan_directory(spark, str(tmp_path)).select("path", "content", F.length("content").alias("n"), "length")
    assert {r["path"].rpartition("/")[2]: bytes(r["content"]) for r in found.collect()} == texts
    assert all(r["n"] == r["length"] for r in found.collect())
    [one] = files.scan_directory(spark, f"{tmp_path}/[0]*.txt").select("path").collect()  # a pattern
    assert one["path"].endswith("/0.txt")


def test_size_gate_is_inclusive(spark):
    rows = spark.createDataFrame([(2**20,), (2**20 + 1,)], "length bigint")
    assert [r[0] for r in rows.filter(files.within_size("length", 1)).collect()] == [2**20]


@pytest.mark.parametrize("content, expected", [
    ("naïve\r\nline\rend".encode(), "naïve\nline\nend"),
    (b"\xef\xbb\xbfmarked", "﻿marked"),
    ("Grüße €😀".encode("utf-16"), "Grüße €😀"),
    (b"\xfe\xff" + "Grüße 😀".encode("utf-16-be"), "Grüße 😀"),
    ("café abc".encode("latin-1"), "café abc"),
    (b"\xff\xfea\x00\x00\xd8b\x00", b"\xff\xfea\x00\x00\xd8b\x00".decode("latin-1")),
    (b"\xfe\xff\x00a\xdc\x00\x00b", b"\xfe\xff\x00a\xdc\x00\x00b".decode("latin-1")),
    (b"\xff\xfea\x00b", b"\xff\xfea\x00b".decode("latin-1")),
    (b"", ""),
])
def test_decoding_falls_back_by_encoding(spark, content, expected):
    df = spark.createDataFrame([(bytearray(content),)], "content binary")
    assert df.select(files.decode_text("content")).first()[0] == expected


def test_decoding_of_a_long_utf16_text(spark):
    text = "äöü 😀 words " * 50_000
    df = spark.createDataFrame([(bytearray(text.encode("utf-16")),)], "content binary")
    assert df.select(files.decode_text("content")).first()[0] == text


def test_extraction_reports_errors_as_rows(spark, tree):
    good = archives.docx_bytes(["First", "  ", "Second"], [["a ", " b"]], "A title", "Someone")
    rows = [("/d/a.txt", b"plain"), ("/d/b.docx", good), ("/d/c.docx", b"broken"), ("/d/n.xyz", b"?"), ("/d/p.pptx", b"?")]
    made = spark.createDataFrame([(p, bytearray(c)) for p, c in rows], "path string, content binary")
    found = {r["path"]: r for r in extract.extract(made).collect()}
    assert found["/d/a.txt"]["content"] == "plain"
    assert found["/d/b.docx"]["content"] == "First\nSecond\na | b"
    assert (found["/d/b.docx"]["document_title"], found["/d/b.docx"]["paragraph_count"]) == ("A title", 3)
    assert found["/d/c.docx"]["error"].startswith("Error extracting content") and found["/d/c.docx"]["metadata_error"]
    assert found["/d/n.xyz"]["error"] == "Unsupported file type: .xyz"
    assert found["/d/p.pptx"]["error"] == "Unsupported file type: .pptx"


def test_metadata_failure_keeps_the_text(spark):
    buffer = io.BytesIO(archives.docx_bytes(["Text"], [], None, None))
    with zipfile.ZipFile(buffer, "a") as out:
        out.writestr("docProps/core.xml", "<broken")
    df = spark.createDataFrame([("/d/a.docx", bytearray(buffer.getvalue()))], "path string, content binary")
    row = office.extract_docx(df).first()
    assert row["content"] == "Text" and row["error"] is None and row["metadata_error"]


def test_registered_extractor_is_used(spark):
    made = spark.createDataFrame([("/d/a.csv", bytearray(b"x,y"))], "path string, content binary")
    own = {".csv": lambda df: df.select("path", F.upper(F.decode("content", "UTF-8")).alias("content"))}
    assert extract.extract(made, own).first()["content"] == "X,Y"


def test_merged_cells_repeat_their_text(spark):
    w = archives.W_NS
    cell = "<w:tc><w:tcPr>{p}</w:tcPr><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    table = ("<w:tbl><w:tr>" + cell.format(p='<w:gridSpan w:val="2"/>', t="wide") + cell.format(p='<w:vMerge w:val="restart"/>', t="tall")
             + "</w:tr><w:tr>" + cell.format(p="", t="1") + cell.format(p="", t="2") + cell.format(p="<w:vMerge/>", t="") + "</w:tr></w:tbl>")
    content = archives._packed({"word/document.xml": f'<w:document xmlns:w="{w}"><w:body>{table}</w:body></w:document>'})
    df = spark.createDataFrame([("/d/a.docx", bytearray(content))], "path string, content binary")
    assert office.extract_docx(df).first()["content"] == "wide | wide | tall\n1 | 2 | tall"


def test_sheet_values_dates_and_gaps(spark):
    s = archives.S_NS
    members = {
        "xl/workbook.xml": f'<workbook xmlns="{s}" xmlns:r="{archives.R_NS}"><sheets><sheet name="One" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships><Relationship Id="r1" Type="{archives.R_NS}/worksheet" Target="/xl/worksheets/s.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{s}"><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm"/></numFmts>'
                         '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/></cellXfs></styleSheet>',
        "xl/worksheets/s.xml": f'<worksheet xmlns="{s}"><sheetData><row><c><v>1</v></c><c/><c><v>2.50</v></c><c s="1"><v>45292</v></c>'
                               '<c s="2"><v>45292.5</v></c></row><row><c/></row><row><c t="b"><v>0</v></c><c t="str"><v>calc</v></c>'
                               '<c t="inlineStr"><is><t>in</t></is></c></row></sheetData></worksheet>',
    }
    df = spark.createDataFrame([("/d/a.xlsx", bytearray(archives._packed(members)))], "path string, content binary")
    assert office.extract_xlsx(df).first()["content"] == (
        "[Sheet: One]\n1 | 2.5 | 2024-01-01 00:00:00 | 2024-01-01 12:00:00\nFalse | calc | in")


def test_assembly_keeps_order_across_runs(spark):
    pages = spark.range(0, 2500).select(F.lit("d").alias("doc"), (F.col("id") + 1).alias("page"),
                                        F.when(F.col("id") % 7 == 0, " \n").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    expected = "\n\n".join(f"[Page {i + 1}]\nt{i}" for i in range(2500) if i % 7)
    assert assemble.assemble_pages(pages).first()["content"] == expected


def test_sheet_without_values_keeps_its_header(spark):
    cells = spark.createDataFrame([("d", 1, "Empty", 1, 1, None), ("d", 2, "Full", 2, 2, "b"), ("d", 2, "Full", 2, 1, "a"),
                                   ("d", 2, "Full", 1, 1, None), ("d", 2, "Full", 3000, 1, "z")],
                                  "doc string, sheet int, title string, row int, column int, value string")
    assert assemble.assemble_sheets(cells).first()["content"] == "[Sheet: Empty]\n[Sheet: Full]\na | b\nz"


def test_sheets_read_their_cells_once(spark, tmp_path):
    # Titles differ within a sheet of several runs, rows and titles are missing: the least title of a sheet stands once.
    rows = [("d", 7, "T" if r % 2000 else "S", r, c, f"v{r}.{c}" if (r + c) % 3 else None) for r in range(0, 4100, 50) for c in (2, 1)]
    rows += [("d", 3, None, 5, 1, "x"), ("d", 3, None, None, 1, "y"), ("d", 8, None, 1, 1, None), ("d", None, "N", 1, 1, "n"), ("e", 1, None, 1, 1, None),
             (None, 1, "E", 2, 1, ""), (None, 1, "E", 1, 1, None), (None, 1, "E", 3, 2, "b"), (None, 1, "E", 3, 1, "a")]
    spark.createDataFrame(rows, "doc string, sheet int, title string, row int, column int, value string").write.parquet(str(tmp_path / "cells"))
    out = assemble.assemble_sheets(spark.read.parquet(str(tmp_path / "cells")))
    lines = [" | ".join(f"v{r}.{c}" for c in (1, 2) if (r + c) % 3) for r in range(0, 4100, 50)]
    expected = "\n".join(["[Sheet: N]", "n", "y", "x", "[Sheet: S]", *[x for x in lines if x]])
    assert {r["doc"]: r["content"] for r in out.collect()} == {"d": expected, "e": "", None: "[Sheet: E]\n\na | b"}
    assert out._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1


def test_html_entities_and_hidden_parts(spark):
    page = "<html><head><STYLE>p{}</STYLE><script>var a='<p>';</script></head><body><!-- no --><p>A &amp; B &#8364; &lt;x&gt;</p>2 < 3</body>"
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(html_to_text("html")).first()[0] == "A & B € <x>2 < 3"
    assert df.select(html_to_text("html", " ")).first()[0].split() == ["A", "&", "B", "€", "<x>", "2", "<", "3"]


@pytest.mark.parametrize("path, suffix, stem", [
    ("/a/b.tar.GZ", ".gz", "b.tar"), ("/a/.bashrc", "", ".bashrc"), ("/a/..x.y", ".y", "..x"), ("/a/plain", "", "plain"),
    ("/a.d/none", "", "none"), ("/a/end.", ".", "end")])
def test_suffix_rules(spark, path, suffix, stem):
    row = spark.createDataFrame([(path,)], "p string").select(X.extension("p"), X.stem("p")).first()
    assert tuple(row) == (suffix, stem)


def test_redaction_order_and_patterns(spark):
    text = "mail jürgen.m-x@exämple.com or call 743-555-3824, 7435553824, ssn 123-45-6789, card 4111 1111 1111 1111."
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(X.redact("t")).first()[0] == "mail [EMAIL] or call [PHONE], [PHONE], ssn [SSN], card [CARD]."
    wide = {**X.PII_PATTERNS, "PHONE": X.WIDE_PHONE}
    other = spark.createDataFrame([("(743) 555-3824",)], "t string")
    assert other.select(X.redact("t")).first()[0] == "(743) 555-3824"
    assert other.select(X.redact("t", wide)).first()[0] == "[PHONE]"
    assert df.select(*[X.pii_count("t", c) for c in X.PII_PATTERNS]).first()[:] == (1, 2, 1, 1)


def test_every_named_entity_and_number(spark):
    names = sorted(n for n in html.entities.html5 if n.endswith(";"))
    texts = [f"a &{n} b" for n in names] + [f"&#{n};" for n in (65, 128, 150, 159, 160, 233, 8364, 128512, 0, 55296, 1114112, 10**12)]
    texts += ["&#xe9;&#XE9;", "&amp;lt;", "&eacute;t&eacute; &szlig;&rarr;&nbsp;", "&nosuchname;", "&", "&;", "&#;", "AT&T; &amp", "caf&Eacute;;"]
    rows = local_rows(spark, list(enumerate(texts)), "i int, text string")
    found = {r["i"]: r["out"] for r in rows.select("i", unescape_entities(F.col("text")).alias("out")).collect()}
    for i, text in enumerate(texts):
        # Names without a semicolon stay as they are here.
        assert found[i] == ("AT&T; &amp" if text.endswith("&amp") else html.unescape(text)), text


def test_a_null_page_stays_null(spark):
    assert local_rows(spark, [(None,)], "text string").select(unescape_entities(F.col("text")).alias("t")).first()["t"] is None
