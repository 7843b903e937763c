"""Main text of hand-made pages, with and without marked-up articles, and broken ones."""

import time

import pytest

from farebox.llm import html_text

TREE = html_text.grow(html_text.LABELLED[:, :-1], html_text.LABELLED[:, -1])
LONG = " ".join(f"word{n}" for n in range(40))


def text(page):
    return html_text.main_text(page, TREE).split("\n")


def test_neighbours_decide():
    def features(tree):
        if isinstance(tree, bool):
            return set()
        return {tree[0]} | features(tree[2]) | features(tree[3])

    # Place, page with article, words, link density; words and density before and after.
    assert {4, 5, 6, 7} & features(TREE) >= {5, 7}
    judged = html_text.judge(TREE, html_text.LABELLED[:, :-1])
    assert (judged == html_text.LABELLED[:, -1]).all()


def test_short_lines_of_a_story_stay():
    lines = [
        "It was late when the two of them came home from the fair that day.", "Yes.", "No way.",
        "one egg", "They went on like this until the lamps were lit in the long street.", "The end.",
    ]
    page = "".join(f"<p>{line}</p>" for line in lines)
    assert text(f"<div>{page}</div>") == lines
    menu = "<ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul>"
    links = "<div><a href=c>Imprint</a></div><div><a href=d>Privacy</a></div>"
    assert text(f"{menu}<div><h1>A fair</h1>{page}</div>{links}") == ["A fair", *lines]


def test_paragraphs_before_links_stay():
    links = "<div><a href=c>Imprint</a></div><div><a href=d>Privacy</a></div>"
    paragraph = "A paragraph of a dozen words or more that ends what there is to say."
    assert text(f"<h1>Short heading</h1><p>{paragraph}</p>{links}") == ["Short heading", paragraph]


def test_menus_and_footers_of_plain_pages_go():
    menu = "".join(f"<div><a href={n}>Topic {n}</a></div>" for n in range(6))
    assert text(f"{menu}<div>{LONG}</div><div>{LONG}</div>{menu}") == [LONG, LONG]
    assert text(menu) == [""]


def test_class_names_that_only_hold_a_marker():
    kept = [
        '<div class="related-work"><p>Work by others</p></div>', '<p class="menu">Soup</p>',
        '<li class="search">Look for it</li>', '<div id="share-price"><p>Up by two</p></div>',
        '<div class="header-bidding-explained"><p>How it works</p></div>',
    ]
    gone = [
        '<div class="related">More</div>', '<div class="related-posts">More</div>',
        '<p class="ad">Buy!</p>', '<div class="share-box">Share</div>', '<p class="promo">Now!</p>',
        '<div id="comments-list"><p>First!</p></div>', '<nav>Up</nav>', '<div class="x menu">Up</div>',
    ]
    for part in kept:
        assert len(text(f"<article><p>{LONG}</p>{part}<p>{LONG}</p></article>")) == 3, part
    for part in gone:
        assert text(f"<article><p>{LONG}</p>{part}<p>{LONG}</p></article>") == [LONG, LONG], part


@pytest.mark.parametrize(
    "piece", ['<a href="x ', "<a 'x <b \"y ", '<div class="', "<svg ", "<!-- ", "<p title='", "< ", "</a "]
)
def test_broken_tags_take_linear_time(piece):
    page = piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    text(page)
    assert time.perf_counter() - start < 2


def test_tags_end_where_they_do():
    found = [(t.name, t.leaving, t.attributes) for t in html_text.tokens(
        "a<P CLASS='x>y'>b</p ><br/>1 < 2 <i <b c>d<!-- <u> -->e<script>'<p>'</SCRIPT >f<u t=\"v"
    )]
    assert found == [
        ("p", False, " CLASS='x>y'"), ("p", True, " "), ("br", False, "/"), ("i", False, " "),
        ("b", False, " c"), ("", False, ""), ("", False, ""), ("u", False, ' t="v'),
    ]


def test_a_quote_that_nothing_closes():
    assert text(f"<article><p title=\"x>{LONG}</p><p>{LONG}</p></article>") == [LONG, LONG]
