import html
import itertools
import re
import time

import numpy as np
import pytest

from shelfwise.llm import html_text
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.shared import table


def article_of(source):
    """The article element of the given tables' pages, by plain replacement."""
    found = re.search(r"<article>(.*?)(</article>|$)", source or "", re.S)
    if not found:
        return ""
    marked = re.sub(r"<[^>]*(>|$)", "", re.sub(r"</?(p|h1|br)\b[^>]*>", "\0", found[1]))
    return " ".join(x for part in marked.split("\0") if (x := " ".join(html.unescape(part).split())))


def text_of(source):
    return html_text.main_texts(html_text.train(), [source])[0]


@pytest.mark.parametrize("data", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_finds_the_article(spark, data):
    wanted = {r.page_id: article_of(r.html) for r in table(spark, data, "pages").collect()}
    found = QUERIES["op5_main_text"](spark, data).collect()
    assert len(found) == len(wanted)
    assert all(r.text == wanted[r.page_id] and r.n_chars == len(r.text) for r in found)


@pytest.mark.parametrize("plain", [0.0, 1.0])
def test_pages_built_by_rule_that_it_has_not_seen(plain):
    """With containers that say what they hold, and without."""
    right = 0
    pages = list(html_text.labelled_pages(seed=123, n=100, plain=plain))
    for source, marks in pages:
        page = html_text.parse(source)
        keep = html_text.chosen(page, html_text.train().odds(html_text.features(page)))
        right += all(k == m for k, m, b in zip(keep, marks, page.blocks, strict=True) if b.own)
    assert right >= 0.95 * len(pages)


PARAGRAPH = "The committee met on Tuesday to discuss the plans for the new bridge. It will be built over the river next year. Many people in the town have waited for it."
MENU = "<nav><ul>" + "".join(f'<li><a href="/{k}">Link {k}</a></li>' for k in range(6)) + "</ul></nav>"
NEWS = "".join(f'<h3><a href="/x{k}">Other news {k}</a></h3><p>Something else happened.</p>' for k in range(3))


def page_around(body):
    return f"<html><body>{MENU}{body}<footer>&copy; example.com</footer></body></html>"


@pytest.mark.parametrize("paragraphs", [1, 8, 30])
@pytest.mark.parametrize("container", ["div", "section", 'div class="td-12"', "table", 'div id="mw-parser-output"', "article", "main", 'div class="content"'])
def test_articles_in_any_container(container, paragraphs):
    inner = "".join(f"<p>{k} {PARAGRAPH}</p>" for k in range(paragraphs))
    held = f"<table><tr><td>{inner}</td></tr></table>" if container == "table" else f"<{container}>{inner}</{container.split()[0]}>"
    assert text_of(page_around(f"<h1>A title here</h1>{held}")) == " ".join(["A title here", *[f"{k} {PARAGRAPH}" for k in range(paragraphs)]])


@pytest.mark.parametrize(
    "body",
    [
        "<article>{inner}</article><article class='related'>{news}</article>",
        "<article>{inner}<section class='related'><h2>Related</h2>{news}</section></article>",
        "<div>{inner}</div><div class='related'>{news}</div>",
        "<article>{inner}<div class='comments'><div class='comment'><b>Bob</b><p>Something else happened. I like that.</p></div></div></article>",
    ],
)
def test_related_boxes_and_comments_go(body):
    inner = "<h1>A title here</h1>" + "".join(f"<p>{k} {PARAGRAPH}</p>" for k in range(8))
    expected = " ".join(["A title here", *[f"{k} {PARAGRAPH}" for k in range(8)]])
    assert text_of(page_around(body.format(inner=inner, news=NEWS))) == expected


def all_decisions(blocks, gain, k):
    """(worth, kept blocks) of every way to keep, drop or split the block and what is below it."""
    below = [k]
    for x in below:
        below += blocks[x].children
    total = sum(gain[x] for x in below)
    yield total, frozenset(below)
    yield -total, frozenset()
    if blocks[k].children:
        price = 0.0 if blocks[k].tag in html_text.FREE_TO_SPLIT else html_text.SPLIT_PRICE
        own = (abs(gain[k]) if blocks[k].own else 0.0) - price
        for parts in itertools.product(*[list(all_decisions(blocks, gain, c)) for c in blocks[k].children]):
            yield own + sum(w for w, _ in parts), frozenset([k] if gain[k] > 0 else []).union(*[kept for _, kept in parts])


def test_decoding_is_the_best_of_all_decisions():
    rng = np.random.default_rng(1)
    sources = ["<body>a<div>bb<p>ccc</p><p>dddd</p></div><div><p>eeeee</p></div></body>", "<div>aaaa<p>b</p><div>cc<div>ddd<p>eee</p></div></div></div>", "<section><h1>a</h1><p>bbbbbbbb</p></section><p>ccc</p>"]
    for source in sources:
        page = html_text.parse(source)
        for _ in range(60):
            odds = rng.normal(size=len(page.blocks)) * 4
            gain = np.clip(odds, -html_text.MOST_ODDS, html_text.MOST_ODDS) * [np.log1p(b.own) + (0.5 if b.children else 0.0) for b in page.blocks]
            _, best = max(all_decisions(page.blocks, gain, 0), key=lambda d: d[0])
            keep = html_text.chosen(page, odds)
            assert {k for k, b in enumerate(page.blocks) if b.own and keep[k]} == {k for k in best if page.blocks[k].own}


def test_deep_pages_take_time_in_proportion():
    def seconds(depth):
        start = time.perf_counter()
        html_text.parse("<div>" * depth + "</article></section>" * depth + "x" + "</div>" * depth)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(32_000) < 12 * seconds(8_000) + 0.5


def test_no_contradictions():
    """No kept text below a block that is dropped as a whole, and the other way round."""
    for source, _ in html_text.labelled_pages(seed=5, n=20):
        page = html_text.parse(source)
        odds = html_text.train().odds(html_text.features(page))
        assert html_text.chosen(page, odds * 0 - 1) == [False] * len(odds)
        assert html_text.chosen(page, odds * 0 + 1) == [True] * len(odds)


def test_white_space_references_and_blocks():
    page = html_text.parse("<article><p>a &amp;\n  b<br>c&nbsp;d</p>\n<p>e<b>f</b> g<p>h &lt;i&gt; &am</article>")
    assert [t for _, t in page.runs] == ["a & b c d", "ef g", "h <i> &am"]


@pytest.mark.parametrize(
    "source",
    ["", "<", "<<<>>>", "<p", "</p></p>", "<!--", "<!-- x", "<script>", "<script>x", '<a href="', "<p>" * 3000, "<div>" * 3000 + "x", "text only", "a < b > c", "<li><li><td><tr>", '<p title="a>b">x</p>', "<p a=\"'>x", "\0<p>\0"],
)
def test_broken_pages(source):
    assert isinstance(text_of(source), str)


def test_script_style_and_comments_leave_nothing():
    page = html_text.parse('<body><style>p{}</style><script>var t="</p>";</script><!-- <p>no</p> --><p>yes</p><SCRIPT>a</ScRiPt></body>')
    assert [t for _, t in page.runs] == ["yes"]


@pytest.mark.parametrize(
    "source",
    [
        '<p>a<svg class="i"/></p><p>b</p>',
        "<p>a<svg viewBox='0 0 1 1'><path d='M0'/><title>no</title><g><text>no</text></g></svg></p><p>b</p>",
        "<p>a</p><noscript><p>b</p>",
        "<p>a</p><template><svg><p>b</p>",
        "<div><p>a</p><div><noscript><img src='x'><p>no</p></div><p>b</p></div><noscript>no</noscript>",
        "<p>a</p><template><div>no<template>no</template>no</div>no</template><p>b</p>",
        "<p>a</p><svg><path></svg><NOSCRIPT><div>no < no</NoScript><p>b</p>",
        "<p>a</p><noscript><div/>no</div>no</noscript><p>b</p>",
        "<p>a</p><svg/><svg><g/>no</svg><p>b</p>",
    ],
)
def test_veiled_elements_hide_only_themselves(source):
    assert [t for _, t in html_text.parse(f"<body>{source}</body>").runs] == ["a", "b"]


def test_text_goes_on_after_a_veiled_element():
    page = html_text.parse("<p>one <svg><path d='M0'></path></svg>two <template><a>no</a></template>three</p>")
    assert [(page.blocks[b].tag, t) for b, t in page.runs] == [("p", "one two three")]


def test_the_place_among_many_siblings():
    page = html_text.parse("<article>" + "<p>Text.</p>" * 100 + "</article>")
    column = 2 * (html_text.N_TAGS + html_text.N_WORDS) + 11
    assert html_text.features(page)[2:, column].tolist() == pytest.approx([k / 100 for k in range(100)])


def test_many_unclosed_elements_take_no_long_time():
    for tag in ("svg", "noscript", "template"):
        assert html_text.parse(f"<{tag}>" * 50_000 + "x").runs == [(0, "x")]
        assert html_text.parse(f"<{tag}>" * 50_000 + f"</{tag}>x").runs == []
        assert html_text.parse(f"<{tag}>" + "<div>" * 50_000 + f"</i></{tag}>x").runs == [(0, "x")]


def test_trees_fit_a_simple_rule():
    x = np.random.default_rng(0).random((400, 5)).astype(np.float32)
    y = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    forest = html_text.boost(x, y, np.ones(400))
    assert ((forest.odds(x) > 0) == (y > 0)).mean() > 0.97


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<article><p>Some text here.</p></article>"), (4, "u", "<article><p>Same row here.</p></article>"), (4, "u", "<article><p>Same row here.</p></article>"), (5, "u", "<article>" + "<p>A sentence of this very long page.</p>" * 20_000 + "</article>")]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = html_text.extract(pages, html_text.train()).collect()
    assert [(r.page_id, r.text) for r in found[:2]] == [(1, ""), (2, "")]
    assert len(found) == 6 and found[5].n_chars == 20_000 * len("A sentence of this very long page. ") - 1
    assert html_text.extract(pages.limit(0), html_text.train()).count() == 0
