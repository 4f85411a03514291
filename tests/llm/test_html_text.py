import html
import re

import numpy as np

from riskmart.llm import html_text

PAGE = """<html><head><title>Site</title><script>var a = "<p>no</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site, please accept them all or leave it now.</p></div>
<article><header><h1>The &eacute;tude</h1></header><p>First   paragraph with <b>bold</b> &amp; <a href=x>linked</a> words
in two lines.</p><!-- <p>not this</p> --><p>Short.</p><form><p>Sign up with your mail address</p></form>
<section class="comments"><p>I liked this article a lot and shall read it again, thank you for it.</p></section></article>
<aside><p>A long sidebar text with many words that are of no interest to the reader.</p></aside><footer>&copy; 2020</footer>"""


def test_page():
    want = "The étude\nFirst paragraph with bold & linked words in two lines.\nShort."
    assert html_text.main_text(PAGE) == want


def test_pages_equal_their_articles(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r.page_id: r for r in html_text.extract(pages).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", page.html, re.S)[1].replace("<br>", " ")
        parts = (html.unescape(re.sub("<[^>]*>", "", x)) for x in re.split(r"</?(?:p|h1)>", article))
        want = "\n".join(x for x in (re.sub(r"\s+", " ", p).strip() for p in parts) if x)
        assert found[page.page_id].text == want
        assert found[page.page_id].n_chars == len(want) and found[page.page_id].url == page.url


def test_page_without_article_uses_neighbours():
    text = "A fairly long paragraph with at least a dozen words of real content in it."
    page = f"<div><a href=/>Home</a></div><div><h1>My title</h1><p>{text}</p><p>{text}</p></div><div><a>x</a> <a>y</a></div>"
    assert html_text.main_text(page).endswith(f"{text}\n{text}")


def test_odd_pages(spark):
    rows = [(1, "u", None, 1), (1, "u", None, 1), (None, None, "", 2), (3, "v", "<p>a", 3), (4, "w", "<script>" * 9, 4), (5, "x", "a < b <", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int").selectExpr("*", "'t' AS text")
    found = html_text.extract(pages).collect()
    assert len(found) == 6 and all(r.n_chars == len(r.text) for r in found)
    assert html_text.extract(pages.limit(0)).count() == 0
    for hostile in ("<" * 100_000, "<!--" * 50_000, "<p>" * 50_000, "<a href='" * 20_000):
        html_text.main_text(hostile)


def test_article_after_deep_chrome_is_kept():
    text = "A fairly long paragraph with at least a dozen words of real content in it."
    rows = "".join(f"<tr><td>Cell {i}<td>more" for i in range(200))
    terms = "".join(f"<dt>Term {i}<dd>what it says" for i in range(200))
    deep = "<div>" * 300 + "x" + "</div>" * 299
    for chrome in (f"<table>{rows}</table>", f"<dl>{terms}</dl>", deep, f"<table>{rows}", terms):
        for opened, closed in (("<aside>", "</aside>"), ("<div class=sidebar>", "</div>")):
            page = f"<body>{opened}{chrome}{closed}<article><p>{text}</p></article>"
            if chrome is not deep or closed == "</aside>":
                assert html_text.main_text(page) == text


def test_omitted_end_tags_end_where_html_says():
    rows = "".join(f"<tr><td>a{i}<th>b{i}" for i in range(50)) + "<tbody>" + "<tr><td><table><tr><td>in<td>ner</table><td>x" * 9
    for source, depth in ((f"<table>{rows}", 4), ("<dl>" + "<dt>a<dd>b" * 50, 2), ("<ul>" + "<li><p>a<div>b" * 50, 3), ("<p>a<div>b</div>" * 50, 0)):
        assert len(html_text._Page(source).open) == depth
    assert len(html_text._Page("<ul><li>a<ul><li>b<li>c").open) == 4


def test_tree_fits_its_table():
    table = np.array(html_text.LABELLED, float)
    right = [html_text.is_article(html_text.default_tree(), row[:-1]) == row[-1] for row in table]
    assert np.mean(right) > 0.95


LONG = "A fairly long paragraph with at least a dozen words of real content in it, and no link."
BODY = "<nav><a href=/>Home</a></nav><div><h1>A title of the article</h1>" + f"<p>{LONG}</p>" * 3 + "</div><footer>end</footer>"
WANT = "A title of the article\n" + "\n".join([LONG] * 3)


def test_head_without_end_tag(spark, sf_dir):
    for head in ("<head><title>t</title><meta charset=utf-8>", "<head><script>var a;</script>", "<head>"):
        assert html_text.main_text(f"<html>{head}<body>{BODY}") == WANT
        assert html_text.main_text(f"<html>{head}{BODY}") == WANT
    assert html_text.main_text(f"<head><title>t</title>{LONG} {LONG}<p>{LONG}</p>") == f"{LONG} {LONG}\n{LONG}"
    assert html_text.main_text("<head><template><p>never</p></template></head>" + BODY) == WANT
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert any("</head>" in p.html for p in pages)
    for page in pages:
        assert html_text.main_text(page.html.replace("</head>", "")) == html_text.main_text(page.html)


def test_page_in_one_form():
    search = '<form class=search><p>Search this site</p><button>Go</button></form>'
    assert html_text.main_text(f"<body><form id=aspnet>{BODY}</form>") == WANT
    assert html_text.main_text(f"<body><form><article>{BODY}</article></form>") == WANT
    assert html_text.main_text(f"<body>{search}{BODY}<form><fieldset><p>Your mail address please</p></fieldset></form>") == WANT


def test_names_of_containers_are_doubts_not_verdicts():
    for named in ('class="social-history article"', "id=legal-history", "class=search-results-story", "class='banner-years notice'"):
        assert html_text.main_text(f"<body><nav><a href=/>Home</a></nav><div {named}>{BODY}</div>") == WANT
    for named in ("class=social", "id=legal", "class='search box'", "class=alert"):
        for text in ("Follow us on all the networks now", LONG):
            assert html_text.main_text(f"<body>{BODY}<div {named}><p>{text}</p></div>") == WANT
    comments = f"<div class=comments>{f'<p>{LONG} And more.</p>' * 9}</div>"
    assert html_text.main_text(f"<body>{BODY}{comments}") == WANT
