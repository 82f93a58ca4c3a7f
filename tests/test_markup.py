"""Markup against literals of the HTML standard and the standard library's parser."""

from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from foliosift.functions import text

#: Markup and its text, nodes stripped and joined by one space.
STATES = [
    ('<a title="a > b">link</a> end', "link end"),
    ("<a title='<b>' href=x>link</a>", "link"),
    ("<a title=don't>one</a> two's", "one two's"),
    ("<a b = \"x>y\" c = 'p>q' d>t</a>", "t"),
    ("<a/href='>'/>t", "t"),
    ("<div <p>t", "t"),
    ("a<!-- <p>no</p> > -- --> b", "a b"),
    ("a<!-->b<!--->c<!-- x --!>d", "a b c d"),
    ("a<!-- open <p>b", "a"),
    ("<script>if (a<b) {'</scripty>'}</script >t", "t"),
    ("<SCRIPT src='>'>x</sCript\n>t<style>p{}</style/>u", "t u"),
    ("<!-- <script> -->t", "t"),
    ("<a title='<script>'>t</a>", "t"),
    ("<script>never ends <p>t", ""),
    ("<scripted>t</scripted>", "t"),
    ("<title>a <b> c</title>t", "a <b> c t"),
    ("<textarea><script>x</textarea>t", "<script>x t"),
    ("<!DOCTYPE html><?php x ?>t<![CDATA[y]]>u", "t u"),
    ("</>t</ p>u</p\n>v", "t u v"),
    ("a < b and c > d, 1 <3, x<", "a < b and c > d, 1 <3, x<"),
    ("t<p class='open", "t"),
    ("t<p", "t"),
    ("caf&eacute &copy 2020 &nbsp;&check; &notin; &notit; &NotEqualTilde; &ampamp;", "café © 2020  ✓ ∉ ¬it; ≂̸ &amp;"),
    ("&#8364; &#8364 &#x20AC; &#X20ac &#128; &#x99 R&D &nosuch; & &; &# &#x; &a &#0; &#x0 &#99999999;", "€ € € € € ™ R&D &nosuch; & &; &# &#x; &a &#0; &#x0 &#99999999;"),
    ("&lt;b&gt; &amp;lt;", "<b> &lt;"),
    ("plain", "plain"),
    ("", ""),
    (None, None),
]


def columns(texts, *exprs):
    rows = texts([html for html, _ in STATES]).orderBy("doc_id").select(*exprs).collect()
    return list(zip(*map(tuple, rows), strict=True))


def test_states(texts):
    nodes, plain = columns(texts, text.strip_html_parsed(F.col("text")), text.strip_html(F.col("text")))
    for (html, want), got in zip(STATES, nodes, strict=True):
        assert got == want, html
    squeeze = lambda t: None if t is None else " ".join(t.replace(" ", " ").split(" ")).strip()
    for (html, want), got in zip(STATES, plain, strict=True):
        assert got is want is None or " ".join(got.split()) == " ".join(squeeze(want).split()), html


def test_all_references(texts):
    rows = [f"a &{name} b" for name in html5] + [f"&{name}x;" for name in html5 if not name.endswith(";")]
    got = [r[0] for r in texts(rows).orderBy("doc_id").select(text.decode_entities(F.col("text"), " ")).collect()]
    assert got == [unescape(r) for r in rows]


class Nodes(HTMLParser):
    """The text nodes of the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.nodes = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.depth -= tag in ("script", "style") and self.depth > 0

    def handle_data(self, data):
        if not self.depth and data.strip():
            self.nodes.append(data.strip())


def parsed(html):
    parser = Nodes()
    parser.feed(html)
    parser.close()
    return " ".join(parser.nodes)


#: Hostile, but read alike by that parser, which knows neither text elements nor ends of file.
ALIKE = [STATES[i][0] for i in (0, 1, 2, 3, 6, 11, 12, 14, 22)]


def test_equal_to_a_parser_on_pages(spark):
    pytest.importorskip("pyarrow")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select(
        F.explode(F.array(*[F.concat("html", F.lit("<br>" + x)) for x in ALIKE])).alias("html")
    )
    for r in pages.select("html", text.strip_html_parsed(F.col("html")).alias("got")).collect():
        assert r.got == parsed(r.html)


@pytest.mark.parametrize("part", ["<a b=", "<!-- ", "<script>", "<a 'x ", '<p "', "&amp", "</", "<a / ", "<title>", "<![", "< "])
def test_linear(spark, part):
    """A text of half a million characters of open markup is read in one pass."""
    html = spark.range(1).select(F.repeat(F.lit(part), 500_000 // len(part)).alias("html"))
    assert html.select(F.length(text.strip_html(F.col("html")))).first()[0] >= 0
