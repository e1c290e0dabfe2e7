"""Page rendering: layout cases, and all visible words by another parser."""

from html.parser import HTMLParser

import pytest

from footfall.llm import html_text as H
from footfall.llm.common import table
from tests.conftest import SF_MID


class Words(HTMLParser):
    """All text outside of head, script and style, blocks kept apart."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title"):
            self.skip += 1
        elif tag in H.BLOCK or tag in ("br", "td", "th", "tr", "li"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "title"):
            self.skip -= 1
        elif tag in H.BLOCK or tag in ("td", "th", "tr", "li"):
            self.out.append(" ")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_whole_table_keeps_all_visible_words(spark):
    rows = {r.page_id: r for r in H.extract(table(spark, SF_MID, "pages")).collect()}
    pages = table(spark, SF_MID, "pages").collect()
    assert len(rows) == len(pages)
    marks = {"-", *(f"{k}." for k in range(1, 60))}
    for p in pages:
        w = Words()
        w.feed(p.html)
        w.close()
        want = [x for x in "".join(w.out).replace("\xa0", " ").split() if x not in marks]
        assert [x for x in rows[p.page_id].text.split() if x not in marks] == want, p.page_id
        assert rows[p.page_id].n_chars == len(rows[p.page_id].text)


@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two<br>three</p>", "one\n\ntwo\nthree"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("<h1>T</h1>x<ul><li>a<li>b<ol start=9><li>n<li>m</ol></ul>y", "T\n\nx\n\n- a\n- b\n  9. n\n  10. m\n\ny"),
    ("<table><tr><th>Name<th>N<tr><td rowspan=2>ab<td>1<tr><td>22</table>", "Name  N\nab    1\n      22"),
    ("<table><tr><td colspan=2>wide<td>k</tr><tr><td>a<td>b<td>c</table>", "wide  k\na  b  c"),
    ("<table><tr><td colspan=2>a wide text<td>k</tr><tr><td>a<td>b<td>c</table>", "a wide text  k\na      b     c"),
    ("<td>loose</td> cell", "loose cell"),
    ("<pre>  a\n   b\n\n c</pre>", "  a\n   b\n\n c"),
    ("<head><title>t</title></head>x<script>if (a < b) '</p>'</script><style>p{}</style>y", "xy"),
    ("a<div hidden>no<p>no</div><span style='display: none'>no</span><i style='visibility:hidden'>no</i>b", "ab"),
    ("<details><summary>S</summary>body<p>more</details><details open><summary>T</summary>seen</details>", "S\nT\nseen"),
    ("<!-- no --><!doctype html><?php no ?>x<noscript>no</noscript><template>no</template>", "x"),
    ("3 < 4 <unfinished", "3 < 4 <unfinished"), ("<a title='x>y'>link</a></p></b></table>", "link"),
    ("<select><option>a<option>b</select>c<input type=hidden value=h><input type=submit value=Go>", "acGo"),
    ("<textarea> <b>raw</b></textarea>", "<b>raw</b>"), ("<dl><dt>T<dd>D<dt>U</dl>", "T\n    D\nU"),
    ("a&nbsp;b &lt;c&gt; &#233;", "a b <c> é"), ("<p>a\n  b\t<b> c</b>  d", "a b c d"),
    ("<table><tr><td>x<table><tr><td>in<td>2<tr><td>o<td>3</table></td><td>y</table>", "x      y\nin  2\no   3"),
    ("<table><tr><td><ul><li>a<li>bb</ul><td>k<br>l<td>z</table>", "- a   k  z\n- bb  l"),
    ("x<svg><title>no</title><defs><text>no</text></defs><text>hi</text></svg> <math><mi>y</mi><mo>=</mo>"
     "<annotation>no</annotation><mn>2</mn></math>", "xhi y=2"),
    ("<object data=x>fallback</object><canvas>no</canvas>", "fallback"),
    ("<select><option>a<option selected>b</select> <select multiple><option>c</option><option>d</select>", "b c d"),
    ("a<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b><p>no</div>b", "a\nyes\n\nb"),
    ("<table><tr><td>" + "w" * 200 + "<td>b<tr><td>c<td>d</table>", "w" * 200 + "  b\nc  d"),
])
def test_layout(html, text):
    assert H.render(html) == text


def test_depth_and_malformed_pages_stay_linear():
    for html in ("<div>" * 100_000 + "x", "<table><tr><td>" * 2000 + "x", "<li>" * 50_000 + "x", "<p \"" * 50_000,
                 "<a b=\"" * 50_001, "<" * 100_000, "</p>" * 50_000, "<!--" * 50_000):
        H.render(html)


def test_edges(spark):
    rows = [(1, None, "t"), (None, "", "t"), (2, "<p>x", None), (2, "<p>x", None), (3, "<b>w</b> " * 100_000, "")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted((r.page_id or 0, r.n_chars) for r in H.extract(df).collect())
    assert got == [(0, 0), (1, 0), (2, 1), (2, 1), (3, 199_999)]
    assert H.extract(df.limit(0)).count() == 0
