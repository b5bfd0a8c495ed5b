import re
from html.parser import HTMLParser

from helpers import DATA, rows_of

from pulselake.llm import queries
from pulselake.llm.html_layout import HIDDEN, extract, extract_pages


class Words(HTMLParser):
    """All words outside hidden elements, for well-formed hiding."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.hidden = [], []

    def handle_starttag(self, tag, attrs):
        if tag in HIDDEN and tag not in ("meta", "link"):
            self.hidden.append(tag)

    def handle_endtag(self, tag):
        if self.hidden and tag == self.hidden[-1]:
            self.hidden.pop()

    def handle_data(self, data):
        if not self.hidden:
            self.words += data.split()


def test_all_visible_words_of_the_table(spark):
    got = {r.page_id: r for r in queries.op7_html_layout(spark, str(DATA)).collect()}
    pages = rows_of("pages")
    assert len(got) == len(pages)
    for p in pages:
        plain = Words()
        plain.feed(p["html"])
        plain.close()
        shown = got[p["page_id"]].text
        strip = lambda ws: "".join(re.findall(r"\w", "".join(ws)))
        assert strip(re.sub(r"(?m)^ *\d+\. ", "", shown).split()) == strip(plain.words)
        assert got[p["page_id"]].n_chars == len(shown)


CASES = [
    ("<p>one<p>two <b>bold</b>\n x", "one\n\ntwo bold x"),
    ("a<br>b<br/>c", "a\nb\nc"),
    ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>after", "- a\n- b\n  - c\n- d\n\nafter"),
    ("<ol start=3><li>a<li>b<li value=9>c</ol>", "3. a\n4. b\n9. c"),
    ("<table><tr><th>Name<th>N<tr><td>apples<td>3<tr><td>fig<td>12</table>", "Name   | N\napples | 3\nfig    | 12"),
    ("<table><tr><td colspan=2>wide</td><td>x</td></tr><tr><td>aaa<td>b<td>c</table>", "wide    | x\naaa | b | c"),
    ("<table><caption>Cap</caption><tr><td>a<br>b<td>c</table>", "Cap\na | c\nb |"),
    ("<pre>  x\n    y</pre>z", "  x\n    y\n\nz"),
    ("<p hidden>no</p><p style='color:red; display : none'>no</p><span style=visibility:hidden>no</span>yes", "yes"),
    ("<script>if (a < b) '</p>'</script><style>p{}</style><!-- <p>no --><p>yes", "yes"),
    ("<title>t</title><head><meta x><title>t</title></head><body>b &amp; c&nbsp;d &lt;e&gt;", "b & c\xa0d <e>"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<h1>H</h1>text<hr>more<blockquote>q</blockquote>", "H\n\ntext\n\n---\n\nmore\n\n  q"),
    ("x </b></div> y <unclosed <p>z", "x y z"),
    ("<a title='a > b'>link</a> 1 < 2", "link 1 < 2"),
    ("", ""),
    ("<", "<"),
    ("<!-- open", ""),
    ("<p", ""),
    ("<textarea>a <b> c</textarea>", "a <b> c"),
]


def test_layout():
    for html, want in CASES:
        assert extract(html)[0] == want, html


def test_deep_nesting_keeps_text():
    assert extract("<div>" * 50_000 + "deep")[0] == "deep"
    assert extract("<ul><li>" * 3000 + "deep")[0].endswith("deep")


def test_odd_rows(spark):
    rows = [(1, None, "t"), (1, "", "t"), (None, "<p>a", "t"), (2, "<p>" + "word " * 100_000, "t"), (2, "<p>a", "t")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = extract_pages(pages).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, 1, 1, 499_999]
    assert extract_pages(pages.limit(0)).count() == 0
