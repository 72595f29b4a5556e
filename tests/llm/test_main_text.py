"""Main texts against an article parser, a plain search of all regions, and hand-made pages."""

from __future__ import annotations

import random
from html.parser import HTMLParser

import pytest

from creditloom.llm import main_text

PAGES = "/root/testdata/sf0.001/pages.parquet"
HEAD = '<!DOCTYPE html><html><head><title>T t</title><style>p{}</style><script>var a="</p>";</script></head><body>'
NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav>'
FOOT = "<footer>&copy; example &middot; All rights reserved here</footer></body></html>"


class ArticleParser(HTMLParser):
    """The text of the article element, by the parser of the standard library."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.pieces = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in ("p", "h1", "br"):
            self.pieces.append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in ("p", "h1"):
            self.pieces.append(" ")

    def handle_data(self, data):
        if self.depth:
            self.pieces.append(data)


def parsed(page):
    parser = ArticleParser()
    parser.feed(page)
    parser.close()
    return " ".join("".join(parser.pieces).split())


@pytest.fixture(scope="module")
def weights(spark):
    return main_text.learned_weights(spark.read.parquet(PAGES))


def test_given_pages_equal_a_parser(spark):
    pages = spark.read.parquet(PAGES)
    found = main_text.main_texts(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    html = {r.page_id: r.html for r in pages.collect()}
    rows = found.collect()
    assert len(rows) == len(html)
    for r in rows:
        assert r.text == parsed(html[r.page_id]) and r.n_chars == len(r.text)


def test_words_score_positive_and_tags_negative(weights):
    assert all(w > 0 for (kind, f), w in weights.items() if kind == "words" and f != main_text.FURNITURE)
    assert all(w < 0 for (kind, _), w in weights.items() if kind == "tag")


def test_region_is_the_best_of_all():
    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.choice([-2, -1, -0.5, 0, 0.5, 1, 3]) for _ in range(rng.randrange(14))]
        start, stop = main_text.best_region(scores)
        best = max([0, *(sum(scores[a:b]) for a in range(len(scores)) for b in range(a, len(scores) + 1))])
        assert sum(scores[start:stop]) == best and (best > 0 or start == stop)


BODY = "<h1>The  title</h1><p>First <b>bold</b>word &amp; more&nbsp;text &lt;here&gt;.<p>Second<br>paragraph is long enough.</p>"
TEXT = "The title First boldword & more text <here>. Second paragraph is long enough."


@pytest.mark.parametrize("page", [
    f"{HEAD}{NAV}<article>{BODY}</article>{FOOT}",
    f"{HEAD}{NAV}<div class='post-content'>{BODY}</div>{FOOT}",
    f"{HEAD}<header><a href='/'>Site name</a></header>{NAV}<main>{BODY}</main><aside><p>Read this too</p></aside>{FOOT}",
    f"{HEAD}{NAV}<article>{BODY}<section id='comments'><p>I like this very much</p></section></article>{FOOT}",
    f"{HEAD}{NAV}<article>{BODY}</article><div class='comment-list'><article><p>A long reader comment it is</p></article></div>{FOOT}",
    f"{HEAD}<div id='cookieNotice'><p>We use cookies on this site, do you agree?</p></div><article>{BODY}</article>{FOOT}",
    f"{HEAD}<div class='wrap with-sidebar'><div class='sidebar'><p>Links and more links</p></div><div>{BODY}</div></div>{FOOT}",
    f"{HEAD}<article>{BODY.replace('<p>Second', '<div class=ad>Buy these nice shoes now</div><p>Second')}</article>{FOOT}",
    f"{HEAD}<article>{BODY.replace('<p>Second', '<form><label>Mail</label><button>Send it</button></form><script>x<p>y</script><p>Second')}</article>",
    f"{HEAD}<nav><ul><li>Home<li>About<div class=banner><article><header>{BODY.replace('</h1>', '</h1></header>')}</article>",
    f"{HEAD}<!-- <p>hidden</p> --><ARTICLE><div><div>{BODY}</div></ARTICLE>{FOOT}",
    f"{HEAD}{NAV}<article>{BODY}<p><!-- never closed <p>lost</p></article>",
])
def test_furniture_is_left_out(weights, page):
    assert main_text.extract(page, weights) == TEXT


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("just words", "just words"), (f"{HEAD}{NAV}{FOOT}", ""),
    ("<article><h1>One</h1><p>two</p></article>", "One two"), ("<p>cut &am", "cut &am"), ("<p>a < b <", "a < b <"),
    ("<article></article><footer>x</footer>", ""), ("<p>&#x41;&#66;&quot", 'AB"'),
])
def test_edge_pages(weights, page, text):
    assert main_text.extract(page, weights) == text
    if "h1" not in (page or ""):  # unlearned tags outweigh a word
        assert main_text.extract(page, {}) == text


def test_edge_tables(spark):
    long = "<article>" + "<p>word <b>x" * 200_000 + "</article>"
    rows = [(1, "u", f"{HEAD}<article>{BODY}</article>{FOOT}", 9), (1, "u", f"{HEAD}<article>{BODY}</article>{FOOT}", 9),
            (None, None, None, 9), (2, "v", "", 9), (3, "w", long, None), (4, "w", "<" * 300_000 + "<b '" * 100_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int").repartition(2)
    found = {(r.page_id, r.url): r.text for r in main_text.main_texts(pages).collect()}
    assert found[1, "u"] == TEXT and found[None, None] == "" and found[2, "v"] == ""
    assert found[3, "w"] == " ".join(["word x"] * 200_000)
    assert main_text.main_texts(pages).count() == 6
    assert main_text.main_texts(pages.limit(0)).count() == 0
