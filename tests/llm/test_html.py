from __future__ import annotations

import re
from html.parser import HTMLParser

import pytest

from lexmill.llm import html_layout as H


class Words(HTMLParser):
    """All text outside of the elements that are never shown."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.words: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("title", "script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("title", "script", "style")

    def handle_data(self, data):
        if not self.hidden:
            self.words += data.split()


def test_all_pages_keep_their_words(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    sources = {r.page_id: r.html for r in pages.collect()}
    found = H.extracted(pages)
    assert found.columns == ["page_id", "url", "text"]
    for r in found.collect():
        parser = Words()
        parser.feed(sources[r.page_id])
        parser.close()
        shown = re.sub(r"^ *- ", "", r.text, flags=re.MULTILINE).split()
        assert shown == parser.words


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<p>a<p>b<div>c</div>d", "a\n\nb\n\nc\nd"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<h1>T</h1>x  <b>y</b>\nz", "T\n\nx y z"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  * c\n- d"),
        ("<ol start=3><li>a<li value=9>b<li>c</ol>", "3. a\n9. b\n10. c"),
        ("<table><tr><th>Name<th>N<tr><td>Apple pie<td>1</table>", "Name       N\nApple pie  1"),
        ("<table><tr><td>a<td>b<tr><td colspan=2>long cell<tr><td>c<td>d</table>", "a  b\nlong cell\nc  d"),
        ("<table><tr><td>a<br>b<td>x<table><tr><td>in</table></table>", "a  x\nb\n   in"),
        ("<table>stray<tr><td>cell</table>after", "stray\ncell\n\nafter"),
        ("<pre>\n a  b\n\n  c</pre>d", " a  b\n\n  c\n\nd"),
        ("<blockquote>q<p>r</blockquote>", "    q\n\n    r"),
        ("a<span hidden>no</span><i style='color:red; display : none'>no</i>b", "ab"),
        ("<div style=visibility:hidden>no</div>yes", "yes"),
        ("<details><summary>S</summary>no<p>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
        ("<dialog>no</dialog><template>no</template><noscript>no</noscript>x", "x"),
        ("<script>if (a < b) '</p>'</script>x<style>p{}</style>", "x"),
        ("<title>no</title><p>a &amp; b&nbsp;&lt;c&gt;", "a & b\xa0<c>"),
        ("<select><option>a<option>b</select>", "a\nb"),
        ("<dl><dt>t<dd>d<dt>u</dl>", "t\n    d\nu"),
        ("<p title=it's>a</p><p title='x > y'>b", "a\n\nb"),
        ("</p>a</div></b>b", "ab"),
        ("x<!-- no --><!doctype html><?php no ?>y", "xy"),
        ("a < b <", "a < b <"),
        ("<p", ""),
        ("a<hr>b", "a\n\n---\n\nb"),
        ("<a>one<a>two</a>", "onetwo"),
        ("", ""),
    ],
)
def test_layout(source, text):
    assert H.visible_text(source) == text


def test_hostile_pages_take_linear_time():
    assert H.visible_text("<div>" * 100_000 + "x") == "x"
    assert H.visible_text("<p><b>" * 20_000 + "x").endswith("x")
    assert H.visible_text("<a b='" * 20_000) == ""
    assert len(H.visible_text("<ul><li>y" * 20_000)) < 20_000 * 2 * H.MAX_INDENT
    assert H.visible_text("<" * 50_000) == "<" * 50_000
    wide = "<table>" + "<tr><td>a<td>b" * 500 + "<tr><td>" + "w" * 100_000 + "<td>c</table>"
    assert len(H.visible_text(wide)) < 100_000 + 502 * (H.MAX_WIDTH + 10)


def test_odd_rows(spark):
    pages = spark.createDataFrame(
        [(1, None, "t"), (2, "", "t"), (2, "", "t"), (None, "<b>x", "t")], "page_id bigint, html string, text string"
    )
    found = H.extracted(pages)
    assert found.columns == ["page_id", "text"]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, [(1, ""), (2, ""), (2, ""), (None, "x")]))
    assert H.extracted(pages.where("false")).collect() == []


def test_tables_do_not_multiply_their_page():
    wide = "<table><tr>" + ("<td>" + "x" * 400) * 500 + "<tr><td colspan=500><td>x" * 2000 + "</table>"
    long = "<table><tr>" + "<td>" + "y" * 400 + "<tr><td>a<td>b" * 20_000
    nested = "<table><tr><td>a<td>" * 300 + "b" * 300 + "<tr><td>c" * 300
    reaching = "<table><tr>" + "<td rowspan=9999>x" * 2000 + "<tr><td>y" * 2000
    for page in (wide, long, nested, reaching, "<table>" + "<tr><td colspan=1000>a<td>b" * 3000):
        text = H.visible_text(page)
        assert len(text) < 10 * len(page)
        assert "".join(text.split()) == "".join(H._MARKUP.sub("", page).split())


def test_alignment_of_common_tables_stays():
    page = "<table><tr><td>" + "a" * 60 + "<td>b" + "<tr><td>c<td>d" * 9 + "</table>"
    assert [line.index(x) for line, x in zip(H.visible_text(page).split("\n"), "bdddddddd", strict=False)] == [62] * 9


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<table><tr><td rowspan=2>A<td>B<tr><td>C<td>D</table>", "A  B\n   C  D"),
        ("<table><tr><td>A<td rowspan=3>B<td>E<tr><td colspan=2>C<tr><td>D</table>", "A  B  E\n      C\nD"),
        ("<ul><li>a<li>b</ul>text", "- a\n- b\n\ntext"),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>text", "- a\n  * b\n- c\n\ntext"),
        ("<p>x <svg><title>no</title><desc>no</desc><text>label</text></svg> <math><mi>a</mi><mo>=</mo></math>", "x label a="),
        ("<map name=m><p>in a map</map>", "in a map"),
        ("<div style='visibility:hidden'>no <b style='visibility: visible'>yes</b><ul><li>no</ul></div>z", "yes\n\nz"),
        ("<p style='visibility: hidden'>no <i style='display:none; visibility: visible'>no</i></p>z", "z"),
        ("<table><tr><td style='visibility:hidden'>no<td>b<tr><td>cc<td>d</table>", "    b\ncc  d"),
    ],
)
def test_layout_of(page, text):
    assert H.visible_text(page).strip("\n") == text
