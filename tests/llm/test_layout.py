import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliospark.llm import layout
from foliospark.session import local_rows

CASES = [
    ("<p>One<p>Two <b>bold</b>  text", "One\n\nTwo bold text"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>z", "- a\n- b\n\n3. c\n4. d\n\nz"),
    ("<ul><li><p>a</p><p>b</p></li></ul>", "- a\n\nb"),
    ("<table><tr><th>A<th>Bee<tr><td>long<td>2</table>", "A    | Bee\nlong | 2"),
    ("<table><tr><td colspan=2>x<td>y<tr><td>1<td>2<td>3</table>", "x |   | y\n1 | 2 | 3"),
    ("<div hidden>no</div><p style='display: none'>no</p><script>if (a < b) no()</script><!-- no -->yes", "yes"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<pre>\n x\n  y</pre>", " x\n  y"),
    ("&lt;b&gt; &amp; &#233;&nbsp;x", "<b> & é\xa0x"),
    ("<title>t</title><body><h1>H</h1>x", "H\n\nx"),
    ("</p></div>stray <b>un</i>closed", "stray unclosed"),
    ("<table><tr><td><table><tr><td>in</table><td>out</table>", "in\n\nout"),
    ("1 < 2 and <", "1 < 2 and <"),
    ("<select><option>a<option>b</select>c<dialog>no</dialog><dialog open>d</dialog>", "a\nc\nd"),
    ("<img alt='pic'> <img>", "pic"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\nd\nu"),
    ("", ""), ("<", "<"), ("<p", ""), ("<!-- open", ""), ("<p title=\"a>b\">x", "x"),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_pages(page, text):
    assert layout.page_text(page) == text


def test_deep_and_long_pages():
    assert layout.page_text("<div>" * 50_000 + "x") == "x"
    assert layout.page_text("<b>x " * 50_000).split() == ["x"] * 50_000
    assert layout.page_text("<" * 100_000 + "1").endswith("<1")
    assert layout.page_text("<a href='" * 2_000 + "x") is not None


def test_all_visible_words_of_real_pages_are_there(spark):
    """Word by word against removal of scripts, styles, comments, head and tags."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    import html
    for row in pages:
        plain = re.sub(r"(?is)<(script|style|head|title|noscript|template)\b.*?</\1\s*>|<!--.*?-->", " ", row.html)
        if re.search(r"(?i)hidden|display\s*:\s*none|visibility", plain):
            continue
        plain = html.unescape(re.sub(r"<[^>]*>", " ", plain))
        got = re.sub(r"[|\s-]|\d+\.", "", layout.page_text(row.html))
        assert got == re.sub(r"[|\s-]|\d+\.", "", plain)


def test_awkward_rows(spark):
    pages = local_rows(spark, [(1, None, "k"), (2, "", "k"), (None, "<p>x", "k"), (3, "<p>x", None), (3, "<p>x", None)],
                       "page_id long, html string, text string")
    got = layout.rendered_pages(pages)
    assert sorted(map(tuple, got.collect()), key=str) == [(1, ""), (2, ""), (3, "x"), (3, "x"), (None, "x")]
    assert layout.rendered_pages(pages.limit(0)).count() == 0


SHOWN = [
    ("<p>so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>no</annotation></math></p>", "so x=1 2"),
    ("<svg><title>no</title><desc>no</desc><style>no</style><defs/><path d='M0'/><text>one <tspan>a</tspan></text><text>two</text></svg>", "one a\ntwo"),
    ("a<textarea>\nb &amp; <i>\n c</textarea>d", "a\n\nb & <i>\n c\n\nd"),
    ("<select multiple><option>a<option>b</select>c", "a\nb\nc"), ("<select size=3><optgroup><option>a<option>b</select>c", "a\nb\nc"),
    ("<select><option>a<option selected>b</select>c", "b\nc"),
    ("<div style='visibility:hidden'>no<p style='visibility: visible'>yes <b>too</b></p>no<img alt=no></div>", "yes too"),
    ("<ul><li style='visibility:hidden'>no<b style='visibility:visible'>yes</b><li>a</ul>", "yes\n- a"),
    ("<pre style='visibility:hidden'>no <b style='visibility:visible'>yes</b></pre>z", "yes\n\nz"),
]


TABLES = [
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
    ("<table><tr><td>x<td rowspan=0>y<tr><td>z<td>w</table>", "x | y\nz |   | w"),
    ("<table><tbody><tr><td rowspan=9>a<td>b<tbody><tr><td>c<td>d</table>", "a | b\nc | d"),
    ("<table><tr><td>漢字<td>b<tr><td>abcd<td>c<tr><td>e\u0301<td>d</table>", "漢字 | b\nabcd | c\ne\u0301    | d"),
    ("<table><tr><td colspan=1000>a<td>b<tr><td>c</table>", "a | b\nc"),
    ("<table><form><tr><td>a<td>bb</form><tr><td>ccc<td>d</table>", "a   | bb\nccc | d"),
    ("<table><tr><td>a<td>b<tr><td><table><tr><td>in<td>x</table><td>out<tr><td>long<td>c</table>", "a    | b\n\nin | x\n\nout\nlong | c"),
    ("<table><caption>t<table><tr><td>in</table></caption><tr><td>a<td>b</table>z", "t\n\nin\n\na | b\n\nz"),
    ("<select><optgroup disabled><option>a</optgroup><option disabled>b<option>c<option>d</select>", "c"),
    ("<select><option disabled>a</select>z", "z"),
]


@pytest.mark.parametrize(("page", "text"), TABLES)
def test_tables_and_menus(page, text):
    assert layout.page_text(page) == text


def grid_by_marks(rows):
    """Each cell in the first place of its row that is not marked, with all places it spans marked."""
    marked, at = set(), {}
    for r, cells in enumerate(rows):
        c = 0
        for text, wide, high in cells:
            while (r, c) in marked:
                c += 1
            at[r, c] = text
            marked |= {(r + i, c + j) for i in range(high) for j in range(wide)}
            c += wide
    return at


@settings(max_examples=500, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["a", "bb", "ccc", "漢"]), st.integers(1, 3), st.integers(1, 4)), min_size=1, max_size=5), min_size=1, max_size=6))
def test_cells_stand_where_a_plain_grid_has_them(rows):
    page = "<table>" + "".join("<tr>" + "".join(f"<td colspan={w} rowspan={h}>{t}" for t, w, h in r) for r in rows) + "</table>"
    at = grid_by_marks(rows)
    columns = sorted({c for _, c in at})
    first, widths = {}, {c: max(2 if t == "漢" else len(t) for (_, k), t in at.items() if k == c) for c in columns}
    for n, c in enumerate(columns):
        first[c] = sum(widths[k] + 3 for k in columns[:n])
    lines = layout.page_text(page).split("\n")
    assert len(lines) == len(rows)
    for r, line in enumerate(lines):
        shown = "".join(x + "\0" if x == "漢" else x for x in line)  # one character for each column of the screen
        for c in columns:
            text = at.get((r, c), "")
            cell = shown[first[c]:first[c] + widths[c]].replace("\0", "").strip()
            assert cell == text


def test_tables_take_time_and_room_by_their_length():
    wide = "<table><tr>" + "<td rowspan=60000>a" * 5000 + "<tr><td>b" * 5000 + "</table>"
    assert len(got := layout.page_text(wide)) < 40 * len(wide) and got.count("a") == got.count("b") == 5000
    long = "<table><tr><td>" + "x" * 500_000 + "<tr><td>a<td>b" * 20_000 + "</table>"
    assert len(got := layout.page_text(long)) < 2 * PADDED * len(long) and got.count("a") == 20_000
    assert layout.page_text("<table><tr><td>" * 20_000 + "x") == "x"
    assert layout.page_text("<p><table><tr><td>" + "<div>" * 30_000 + "x") == "x"
    assert layout.page_text("<table><tr><td colspan=1000 rowspan=60000>y" * 3000).count("y") == 3000


PADDED = layout.PADDING + 1


@pytest.mark.parametrize(("page", "text"), SHOWN)
def test_what_a_browser_shows_is_kept(page, text):
    assert layout.page_text(page) == text
