"""Main text of pages: structure, boilerplate, broken markup."""

import html
import re
import time

import pytest

from wattline.llm.op4_html_text import extract, extract_text

PAGE = """<html><body><header><h1>Site</h1></header><div id="cookie-notice">We use cookies and a very long text goes here to
look like content, really, at length, so that density alone would take it for some.</div><div class="wrap"><div class="menu">
<a href=x>m1</a> <a href=y>m2</a></div><main><article><header><h1>Title &eacute; &#233;&nbsp;x</h1></header><section><p>One <i>two</i>
 three<p>Four</section><section><h2>Sub</h2><ul><li>a<li>b</ul><pre>x  y</pre><table><tr><td>c1<td>c2</table></section>
<blockquote>quote<br>here</blockquote><form>f<input></form></article><div class="comments"><p>Reader said a lot of things in
this comment, more than the article itself has to say about anything at all.</p></div></main></div><aside>side</aside>
<footer>foot</footer><script>var t="</p>"</script></body></html>"""


def test_page():
    assert extract(PAGE).split("\n\n") == ["Title é é x", "One two three", "Four", "Sub", "a", "b", "x y", "c1", "c2", "quote here"]


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain < text & more", "plain < text & more"), ("<p>", ""), ("<div>a</div>", "a"),
    ('<a href="x>y">k</a>', "k"), ("<article>unclosed <b>bold", "unclosed bold"), ("<!-- x", ""), ("<script>var a=1", ""),
    ("<p>a<p>b</p></p>c", "a\n\nb\n\nc"), ("&lt;p&gt; <p>5 < 6 and 7 > 3</p>", "<p>\n\n5 < 6 and 7 > 3"), ("<p>cut off <b", "cut off"),
    ("<ARTICLE><P>Up</ARTICLE>", "Up"), ("<p>a &amp;amp; b</p>", "a &amp; b"),
])
def test_odd_pages(page, text):
    assert extract(page) == text


@pytest.mark.parametrize(("page", "text"), [
    ("<article><p title=it's>First.</p><p>Second.</p><p>Third.</p></article>", "First.\n\nSecond.\n\nThird."),
    ('<p>a <img alt=5"> b</p>', "a b"), ("<p>a <img alt=\'x\'y > b</p>", "a b"), ("<p a=b>c<d e</p>", "c"), ("<p>x<![CDATA[abc def", "xabc def"), ("<p>x<![CDATA[abc]]>d", "xabcd"),
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>3</mn></math> be <label>so</label>.</p>", "Let x=3 be so."),
    ("<article><p>Story here.</p></article><form><label>Name</label><p>f</p></form>", "Story here."),
    ("<!-->a<!-- b -->c<!-- d", "ac"), ("a </ b>c <3", "a c <3"), ("<script>x</script y>z", "z"), ("<p>q<br/>r</p>", "q r"),
])
def test_markup_by_the_standard(page, text):
    assert extract(page) == text


@pytest.mark.parametrize("part", ["a < b <x ", "<x ", '<p title="', "<![CDATA[", "<!--", "<script>", "</", "<p a=", "<a b='\">"])
def test_time_grows_with_the_page(part):
    page = part * (1_000_000 // len(part))
    started = time.process_time()
    extract(page)
    assert time.process_time() - started < 6


def test_deep_and_long_pages():
    assert extract("<div>" * 20_000 + "deep") == "deep"
    assert extract("<article>" + "<p>word</p>" * 20_000 + "</article>").count("word") == 20_000


def test_article_without_a_tag_of_its_own():
    links = "".join(f'<a href="{i}">link number {i}</a> ' for i in range(30))
    body = "".join(f"<p>Sentence {i} of the story has some length to it, as stories do.</p>" for i in range(8))
    page = f'<body><div class="x1">{links}</div><div class="x2"><div><p>Short.</p>{body}</div></div><div class="x3">{links}</div></body>'
    text = extract(page)
    assert text.startswith("Short.") and text.count("Sentence") == 8 and "link number" not in text


@pytest.mark.parametrize("attribute", ['style="overflow: hidden"', "style='overflow: hidden'", 'title="the hidden truth"', 'data-x=1 title="a class=menu b"', "data-hidden=1"])
def test_values_are_not_attributes(attribute):
    page = f"<body><div {attribute}><article {attribute}><p>Story of some length.</p><p>More of it.</p></article></div></body>"
    assert extract(page) == "Story of some length.\n\nMore of it."


@pytest.mark.parametrize("attribute", ["hidden", 'hidden=""', 'id="x" HIDDEN', "hidden=hidden style='a: b'"])
def test_hidden_attribute(attribute):
    assert extract(f"<p>Story of some length.</p><div {attribute}>Not shown</div><p>More of it.</p>") == "Story of some length.\n\nMore of it."


STORY = "<p>Story of some length.</p><p>More of it.</p>"


@pytest.mark.parametrize("page", [
    f'<div id="page" class="site has-sidebar"><article>{STORY}</article></div>', f'<div class="elementor-widget">{STORY}</div>',
    f'<article class="post comments-open">{STORY}</article>', f'<article class="comments">{STORY}</article>', f'<div class="widget">{STORY}</div>',
    f'<div class="sidebar"><div class="menu"><main role="search">{STORY}</main></div></div>', f"<form><article>{STORY}</article></form>",
    f'<center class="ad"><div>{STORY}</div></center>', f"<form>{STORY}</form>", f"<div hidden>{STORY}</div>",
    f'<div class="widgets"><div class="related">{STORY}</div></div>',
    '<p>Story <span class="share">x <span>y</span> z</span>of some length.</p><p>More of it.</p>',
    f'<div class="sidebar">Aside.</div><div class="post">{STORY}</div><div class="sidebar-2">Aside.</div>',
    f'<article>{STORY}</article><ol class="comments">{"<li><p>A reader had this to say.</p></li>" * 9}</ol>',
    f'<article>{STORY}<div class="comments">{"<article><p>A reader had this to say.</p></article>" * 9}</div></article>',
])
def test_words_do_not_cut_the_text(page):
    assert extract(f"<body>{page}</body>") == "Story of some length.\n\nMore of it."


def test_text_in_many_unwanted_parts():
    parts = [f"Part {i} of the story has some length to it." for i in range(4)]
    assert extract("".join(f'<div class="widget"><p>{x}</p></div>' for x in parts)).split("\n\n") == parts


def test_given_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    found = {r.page_id: r for r in extract_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        parts = re.sub(r"</?b>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\0", article))).split("\0")
        text = "\n\n".join(filter(None, (" ".join(html.unescape(p).split()) for p in parts)))
        assert (found[r.page_id].text, found[r.page_id].n_chars, found[r.page_id].url) == (text, len(text), r.url)


def test_tables(spark):
    df = spark.createDataFrame([(1, "u", None, "t"), (1, "u", None, "t"), (2, None, "<p>é</p>", "t")], "page_id bigint, url string, html string, text string")
    assert sorted((r.page_id, r.text, r.n_chars) for r in extract_text(df).collect()) == [(1, "", 0), (1, "", 0), (2, "é", 1)]
    assert extract_text(df.limit(0)).count() == 0
