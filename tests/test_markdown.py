"""Literal pages, what broken ones become, and time in proportion to length."""

import time

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lodestone.functions import html as H
from lodestone.functions.markdown import convert

PAGES = {
    "headings": ("<h1>A</h1><h2>B<br>C</h2><h6 id=x> D </h6>text", "# A\n\n## B C\n\n###### D\n\ntext"),
    "emphasis": ("<p>a <b> bold </b>and <em>it</em>, <del>old</del><b></b> <i> </i>.", "a **bold** and *it*, ~~old~~ ."),
    "same mark twice": ("<b>x<strong>y</strong>z</b>", "**xyz**"),
    "mark over blocks": ("<b><p>one</p><p>two</p></b>", "**one**\n\ntwo"),
    "unclosed mark": ("<p><b>One<br>two<p>Three", "**One\ntwo**\n\nThree"),
    "links": ('<a href="/x (1)" title=q>the <b>link</b></a> <a name=n>no</a> <a href="javascript:x()">js</a>', "[the **link**](/x%20%281%29) no js"),
    "link in link": ("<a href=u>one <a href=v>two</a>", "[one](u) [two](v)"),
    "empty link": ("<p>a<a href=u></a>b", "ab"),
    "images": ('<img src=i.png alt="an [img]"><img alt=none><img src="data:image/png;base64,AA">', "![an \\[img\\]](i.png)"),
    "lists": ("<ul><li>x<li>y<ul><li>z</ul><li><p>p<p>q</ul>end", "- x\n- y\n  - z\n- p\n\n  q\n\nend"),
    "ordered": ("<ol start=9><li>a<li>b<ol><li>c</ol></ol>", "9. a\n10. b\n    1. c"),
    "empty items": ("<ul><li><li> <li>x</ul>", "- x"),
    "quotes": ("<p>a<blockquote><p>b<p>c<blockquote>d</blockquote></blockquote>e", "a\n\n> b\n>\n> c\n>\n> > d\n\ne"),
    "code": ("<p>run <code>a`b</code> or <kbd> x  y </kbd>", "run ``a`b`` or `x y`"),
    "pre": (
        '<pre class="language-py"><code>\ndef f():\n    return "&lt;```"\n</code></pre>',
        '````py\ndef f():\n    return "<```"\n````',
    ),
    "pre in list": ("<ul><li>a<pre>b\n  c</pre></ul>", "- a\n\n  ```\n  b\n    c\n  ```"),
    "table": (
        "<table><caption>Cap</caption><thead><tr><th>A<th>B|C</thead><tr><td>1<td><p>x<p><b>y</b><tr><td>2</table>",
        "Cap\n\n| A | B\\|C |\n| --- | --- |\n| 1 | x **y** |\n| 2 |  |",
    ),
    "table in table": ("<table><tr><td>a<table><tr><td>b<td>c</table>d<td>e</table>f", "| a b c d | e |\n| --- | --- |\n\nf"),
    "text between cells": ("<table>loose<tr><td>a</table>", "loose\n\n| a |\n| --- |"),
    "entities": ("&#8364;&#x41;&eacute;&nbsp;&copy;&amp;lt; &unknown; &lt;b&gt; a & b", "€Aé ©&lt; &unknown; \\<b> a & b"),
    "escapes": ("<p>* a_b [c] `d` \\<p># e<p>1. f<p>- g<p>+h<p>&gt; i<p>3 > 2", "\\* a\\_b \\[c\\] \\`d\\` \\\\\n\n\\# e\n\n1\\. f\n\n\\- g\n\n+h\n\n\\> i\n\n3 > 2"),
    "rule and breaks": ("a<br>b<br><br>c<hr>d<br><p>e", "a\nb\nc\n\n---\n\nd\n\ne"),
    "not content": (
        "<head><title>t</title><style>p{}</style></head><nav>n</nav><div class='x ad'>ad</div><div class=adjective>kept</div><p hidden>h</p>"
        "<script>'<p>s</p>'</script><!-- c --><footer>f</footer><aside>a</aside><form>in a form<select><option>o</select></form>",
        "kept\n\nin a form",
    ),
    "unended navigation": ("<div><nav>menu<ul><li>x</div>text", "text"),
    "unended comment": ("a<!-- b <p>c", "a"),
    "unended script": ("a<script>b<p>c", "a"),
    "unended code": ("<p><code>a<p>b", "`a`\n\nb"),
    "unended tag": ("a <b c", "a \\<b c"),
    "bracket in a value": ('<p title="a > b">x', "x"),
    "stray ends": ("</b>a</p>b</li></table>c", "a\n\nbc"),
    "upper case": ("<P>A<BR>B</P><UL><LI>C</UL>", "A\nB\n\n- C"),
    "no content": ("<html><body> \n </body></html>", ""),
    "plain text": ("just text", "just text"),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    html, markdown = PAGES[name]
    assert convert(html)[0] == markdown


def test_metadata_is_read_in_any_form():
    page = "<HTML class=x lang='de'><TITLE> A &amp;amp;\n B </TITLE><meta content='D &#233;' name=Description><title>other</title>"
    assert convert(page)[1:] == ("A &amp; B", "D é", "de")
    assert convert("<p>x")[1:] == ("", "", None)


BROKEN = [
    "<", "<!--", "<a ", '<a "', "<a '\" ", "<div>", "<b>x", "<b><div>x", "<b><i><s><div>x", "<a href=x><div>y", "<ul><li>x",
    "<blockquote>x", "<title>", "<b>x</i></u>", '<a "<a" ', "<table><tr><td>x", "<p><b>x", "<code>`", "&", "<noscript>", "<iframe></iframe",
    "<table><caption>x", "<tr><td>x", "<h1>x", "<pre>", "</p>", "x=y ",
]


@pytest.mark.parametrize("part", BROKEN)
def test_time_follows_the_length(part):
    def spent(n):
        start = time.process_time()
        convert(part * n)
        return time.process_time() - start

    spent(500)
    short, long = min(spent(3_000) for _ in range(3)), spent(24_000)
    assert long < 40 * short + 0.2


TAGS = ["<p>", "</p>", "<b>", "</b>", "<ul>", "<li>", "</ul>", "<table>", "<tr>", "<td>", "</table>", "<pre>", "</pre>", "<code>", "</code>", "<a href=u>", "</a>", "<nav>", "</nav>", "<blockquote>", "</blockquote>", "<br>", "<hr>", "<h2>", "</h2>", "<caption>", "<div>", "</div>"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*TAGS, "word ", " ", "&amp;"]), max_size=40))
def test_any_order_of_tags_keeps_visible_words(parts):
    markdown = convert("".join(parts))[0]
    muted, seen = 0, 0
    if "<nav>" not in parts:
        assert markdown.count("word") == parts.count("word ")
    assert markdown == markdown.strip("\n") and "\n\n\n" not in markdown


def test_columns_take_nulls(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<html lang=''><p>x")], "id int, html string")
    html = F.col("html")
    rows = pages.select("id", H.to_markdown(html), H.title(html), H.description(html), H.language(html)).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, None, None, None, None), (2, "", "", "", "en"), (3, "x", "", "", "en")]


def test_few_pages_are_python_objects_at_once(spark, monkeypatch):
    sizes, converted = [], H._converted
    monkeypatch.setattr(H, "_converted", lambda part: sizes.append(len(part)) or converted(part))
    pages = ["<p>a</p>", None, "", "<p>\ud800</p>".encode("utf-8", "replace").decode()] * 100
    found = H._page.func(pa.array(pages)).to_pylist()
    assert max(sizes) <= H.AT_ONCE < len(pages) and len(found) == 400
    assert found[0]["markdown"] == "a" and found[1]["markdown"] is None and found[2]["markdown"] == ""
    assert H._page.func(pa.array([], pa.string())).to_pylist() == []
