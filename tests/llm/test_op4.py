"""Main text of pages: templates per host, structure, broken markup."""

import html
import re

import pytest

from lapforge.llm import op4

FOLDER = "/root/testdata/sf0.01"


def page(i, host_bar="<div class='x'><p>Our weekly picks</p><p>More of them</p></div>"):
    return f"<html><body><div id=a><p>Story {i} begins.</p>{host_bar}<p>Story {i} ends.</p></div></body></html>"


def texts(spark, pages, **more):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in op4.main_text(df, **more).collect()}


@pytest.mark.parametrize("sent", [op4.SENT, 0])
def test_templates_of_a_host_go(spark, sent):
    pages = [("http://a.example/%d" % i, page(i)) for i in range(12)] + [("http://b.example/1", page(99))]
    got = texts(spark, pages, sent=sent)
    assert got[0] == "Story 0 begins.\n\nStory 0 ends."
    # the same block on one page of another host is content there
    assert got[12] == "Story 99 begins.\n\nOur weekly picks\n\nMore of them\n\nStory 99 ends."


def test_copies_are_no_templates(spark):
    article = "<body><div><section><p>One</p><p>and the same</p></section></div></body>"
    got = texts(spark, [("http://a.example/%d" % i, article) for i in range(30)])
    assert set(got.values()) == {"One\n\nand the same"}


def test_sentences_that_articles_share_stay(spark):
    pages = [("http://a.example/%d" % i, f"<article><h1>T{i}</h1><p>shared line</p></article>") for i in range(30)]
    assert texts(spark, pages)[3] == "T3\n\nshared line"


PARTS = (
    "<html><head><title>t</title><style>p{}</style><script>var x='</p><article>';</script></head><body><header>site</header>"
    "<nav><a href='/'>home</a></nav><div class='cookie-notice'>cookies</div><main><article class='post'><header><h1>Head &amp; line</h1></header>"
    "<p>First <b>bold</b>,\n\t<i>text</i>&nbsp;&copy; 2<br>lines<p>second<ul><li>one<li>two</ul><!-- no --><div class='ad-slot'>buy</div>"
    "<table><tr><td>a</td><td>b</td></tr></table><form><input value=q>ask</form><aside>side</aside>"
    "<section id='comments'><p>reader says</p></section></article></main><footer>&copy; us</footer></body></html>"
)


def test_structure(spark):
    want = "Head & line\n\nFirst bold, text © 2 lines\n\nsecond\n\none\n\ntwo\n\na b"
    got = texts(spark, [("http://a.example/", PARTS), ("http://a.example/", PARTS)])
    assert got == {0: want, 1: want}


IN_ARTICLE = [
    "<h2 id=\"related-work\">A</h2>", "<section id=\"social-history\"><p>B</p></section>", "<p id=\"search\">C</p>", "<p class=\"notice-period\">D</p>",
    "<div class=\"share-price\">E</div>", "<p class=\"comment\">F</p>", "<div title=\"a hidden gem\">G</div>", "<blockquote class='promo'>H</blockquote>", "<div id='sidebar-history'>I</div>",
]
NO_CONTENT = [
    "<div class='ad-slot'>x</div>", "<div class=\"post shareButtons\">x</div>", "<section class='reader-comments'><p>x</p></section>", "<ul class='related-posts'><li>x</ul>",
    "<div hidden>x</div>", "<div role='search'>x</div>", "<ins class='adsense'>x</ins>", "<div class='newsletter-signup-form'>x</div>",
]


def test_only_whole_names_of_containers_count_within_an_article(spark):
    page = "<body><div id='content-with-sidebar' class='page'><article>" + "".join(IN_ARTICLE + NO_CONTENT) + "<p>end</p></article></div></body>"
    assert texts(spark, [("http://a.example/", page)]) == {0: "\n\n".join("ABCDEFGHI") + "\n\nend"}


def test_the_size_of_a_host_does_not_matter(spark):
    """A box on ten pages of a host goes, be it of 40 pages or of 1 500."""
    box = "<div class='x'><p>Our weekly picks</p><p>More of them</p></div>"
    for n in (40, 1500):
        got = texts(spark, [("http://a.example/%d" % i, page(i, box if i < 10 else "")) for i in range(n)])
        assert all(got[i] == f"Story {i} begins.\n\nStory {i} ends." for i in range(n))


def test_edge_cases(spark):
    cases = [None, "", "plain < text > 3", "<p>open <b>never closed", "</p></div>x", "<a href='x>broken <p>y</p>", "<p>" + "long " * 60000 + "</p>", "<" * 2000, "<div>" * 3000 + "deep"]
    got = texts(spark, [(u, h) for h in cases for u in (None, "no url")])
    assert got[0] == got[2] == "" and got[6] == "open never closed" and got[8] == "x" and got[12] == ("long " * 60000).strip()
    assert got[16] == "deep" and len(got) == 2 * len(cases)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert op4.main_text(empty).count() == 0


def test_extra_columns_are_not_read(spark):
    df = spark.createDataFrame([(1, "u", "<p>x</p>", "h", 5)], "page_id long, url string, html string, host string, text int")
    assert [tuple(r) for r in op4.main_text(df).collect()] == [(1, "u", "x", 1)]


def test_all_pages_against_a_plain_reading(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in op4.main_text(pages).collect():
        inner = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split() for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(" ".join(b) for b in blocks if b) and r.n_chars == len(r.text)
