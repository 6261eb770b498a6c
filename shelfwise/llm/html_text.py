"""Main text of web pages by gradient-boosted trees over DOM-node features.

A page becomes a tree of block elements. Each gets features of itself (tag, words of its class, id
and role, depth), of its subtree (text, link and tag density, sentences, its share of the page's paragraphs), of its
siblings, of its ancestors and of its place beside the main heading and on the way that leads to the most prose. Boosted trees, fitted on a small labelled table of pages built by rule, give each
block log-odds of being main text. Decoding is hierarchical: a block is kept as a whole, dropped
as a whole, or split at a price into its children's own best choices; so no block is kept below
one that was dropped, or dropped below one that was kept.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.shared import output, slices

SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template svg iframe object select textarea button title head".split())
RAW = frozenset("script style iframe textarea title".split())
"""Their content is no markup: they end at their closing tag, and without one with the page."""
VEILED = frozenset("noscript template svg".split())
"""Their content is markup that shows nothing: they end with their closing tag or that of an element around them."""
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
"""Open elements that an opening tag ends, up to the next list, table or other container."""
SCOPES = frozenset("ul ol dl table select html body div article section".split())

TAG_GROUPS = ("article main", "nav menu", "header", "footer", "aside", "form fieldset", "p blockquote pre", "h1 h2 h3 h4 h5 h6", "ul ol li dl dt dd", "table tbody tr td th", "div section", "html body")
WORD_GROUPS = (
    "article content main post entry story text body prose",
    "ad ads adv advert advertisement sponsor sponsored promo banner",
    "nav navigation menu navbar breadcrumb breadcrumbs toolbar tabs",
    "side sidebar widget related recommended more aside share social",
    "comment comments reply replies discussion respond disqus",
    "cookie consent notice alert popup modal overlay gdpr message",
    "footer foot copyright legal bottom",
    "header head masthead top logo brand",
    "form subscribe newsletter login signup search contact",
)
GROUP_OF_TAG = {tag: k for k, tags in enumerate(TAG_GROUPS) for tag in tags.split()}
GROUP_OF_WORD = {word: k for k, words in enumerate(WORD_GROUPS) for word in words.split()}
SPACE = re.compile(r"[ \t\n\r\f\v  -     　\u0085 \x1c-\x1f]+")
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""")
_MARKS = re.compile(r"""(?:class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_NAMES = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_SENTENCE = re.compile(r"[.!?…](?:\s|$)")


@dataclass
class Block:
    tag: str
    parent: int
    depth: int
    words: frozenset[int]
    place: int = 0  # among the children of its parent
    children: list[int] = field(default_factory=list)
    own: int = 0  # characters of its own, outside child blocks
    linked: int = 0
    tags: int = 0
    sentences: int = 0


@dataclass
class Page:
    blocks: list[Block]
    runs: list[tuple[int, str]]  # (block, text) in page order; a run ends where a block or a line does


def parse(source: str) -> Page:
    """Blocks and text runs of a page; hidden elements, comments and unfinished tags leave nothing."""
    blocks = [Block("root", -1, 0, frozenset())]
    runs: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("root", 0)]  # open elements with the block they belong to
    opened: Counter[str] = Counter()  # how many of each are in it
    buffer: list[str] = []
    veil: list[str] = []  # open elements from a veiled one on
    held: Counter[str] = Counter()  # how many of each
    last_end = {tag: max((m.start() for m in re.finditer(f"</{tag}\\b", source, re.I)), default=-1) for tag in VEILED}
    links = 0
    at, size = 0, len(source)

    def flush() -> None:
        if buffer:
            text = SPACE.sub(" ", entities.unescape("".join(buffer))).strip()
            buffer.clear()
            if text:
                block = blocks[stack[-1][1]]
                block.own += len(text)
                block.sentences += len(_SENTENCE.findall(text))
                runs.append((stack[-1][1], text))

    while at < size:
        opening = source.find("<", at)
        if opening < 0:
            if not veil:
                buffer.append(source[at:])
            break
        if opening > at and not veil:
            buffer.append(source[at:opening])
            if links:
                blocks[stack[-1][1]].linked += opening - at
        follows = source[opening + 1 : opening + 2]
        if follows in ("!", "?"):
            end = source.find("-->", opening + 4) + 2 if source.startswith("<!--", opening) else source.find(">", opening)
            if end < opening + 2:
                break
            at = end + 1
            continue
        if not (follows.isalpha() and follows.isascii()) and follows != "/":
            if not veil:
                buffer.append("<")
            at = opening + 1
            continue
        found = _TAG.match(source, opening)
        if not found:
            end = source.find(">", opening)
            if end < 0:
                break  # an unfinished tag at the end of the page
            at = end + 1  # quotes that don't match: the tag ends at the next bracket
            continue
        at = found.end()
        closes, tag, marks = found[1], found[2].lower(), found[3]
        if closes:
            if tag in INLINE:
                if tag == "a" and not veil:
                    links = max(0, links - 1)
                continue
            if held[tag]:
                ended = ""
                while ended != tag:
                    ended = veil.pop()
                    held[ended] -= 1
                continue
            if opened[tag]:
                veil.clear()
                held.clear()
                flush()
                while stack[-1][0] != tag:
                    opened[stack.pop()[0]] -= 1
                opened[stack.pop()[0]] -= 1
                links = 0
            continue
        if not veil:
            blocks[stack[-1][1]].tags += 1
        if tag in HIDDEN and tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            if not closing:
                break
            at = closing.end()
            continue
        if veil or tag in VEILED:
            foreign = tag == "svg" or held["svg"]  # only there a slash closes
            ends = tag not in VEILED or last_end[tag] > at  # one that is never closed hides nothing
            if tag not in VOID and tag not in INLINE and ends and not (foreign and marks.endswith("/")):
                veil.append(tag)
                held[tag] += 1
            continue
        if tag == "br" or tag == "hr":
            buffer.append(" ")
            continue
        if tag in VOID:
            continue
        if tag in INLINE:
            links += tag == "a"
            continue
        flush()
        links = 0
        if any(name == "p" for name, _ in stack[-3:]):
            while stack[-1][0] != "p":
                opened[stack.pop()[0]] -= 1
            opened[stack.pop()[0]] -= 1
        if tag in CLOSED_BY:
            ends = CLOSED_BY[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends:
                    opened.subtract(name for name, _ in stack[k:])
                    del stack[k:]
                    if tag != "tr":
                        break
                elif stack[k][0] in SCOPES:
                    break
        parent = stack[-1][1]
        words = frozenset(GROUP_OF_WORD[w] for m in _MARKS.finditer(marks) for w in map(str.lower, _NAMES.findall(m[1] or m[2] or m[3] or "")) if w in GROUP_OF_WORD) if marks else frozenset()
        blocks[parent].children.append(len(blocks))
        blocks.append(Block(tag, parent, blocks[parent].depth + 1, words, place=len(blocks[parent].children) - 1))
        stack.append((tag, len(blocks) - 1))
        opened[tag] += 1
    flush()
    hidden = {k for k, b in enumerate(blocks) if b.tag in HIDDEN}
    for k, b in enumerate(blocks):
        if b.parent in hidden:
            hidden.add(k)
    return Page(blocks, [r for r in runs if r[0] not in hidden])


N_TAGS, N_WORDS = len(TAG_GROUPS), len(WORD_GROUPS)
N_FEATURES = 2 * (N_TAGS + N_WORDS) + 22


def features(page: Page) -> np.ndarray:
    """A row for each block."""
    blocks = page.blocks
    n = len(blocks)
    out = np.zeros((n, N_FEATURES), dtype=np.float32)
    text, linked, tags, sentences, paragraphs, prose, titles = ([0] * n for _ in range(7))
    for k in range(n - 1, -1, -1):
        b = blocks[k]
        text[k] += b.own
        linked[k] += b.linked
        tags[k] += b.tags
        sentences[k] += b.sentences
        paragraphs[k] += b.tag == "p"
        prose[k] += b.own if b.tag == "p" else 0
        titles[k] += b.tag == "h1"
        if k:
            for column in (text, linked, tags, sentences, paragraphs, prose, titles):
                column[b.parent] += column[k]
    whole, all_prose, all_paragraphs = max(1, text[0]), max(1, prose[0]), max(1, paragraphs[0])
    # the way from the root that follows the child with the most prose, and where the main heading stands
    path, at = {0}, 0
    while blocks[at].children:
        at = max(blocks[at].children, key=prose.__getitem__)
        if not prose[at]:
            break
        path.add(at)
    first_title = next((k for k, b in enumerate(blocks) if b.tag == "h1"), -1)
    under_path = [0] * n
    base = 2 * (N_TAGS + N_WORDS)
    for k, b in enumerate(blocks):
        row = out[k]
        if b.tag in GROUP_OF_TAG:
            row[GROUP_OF_TAG[b.tag]] = 1
        for w in b.words:
            row[N_TAGS + w] = 1
        if k:  # what stands above it, the nearest counting most
            above = out[b.parent]
            row[N_TAGS + N_WORDS : base] = np.maximum(above[N_TAGS + N_WORDS : base] * 0.9, above[: N_TAGS + N_WORDS])
        siblings = blocks[b.parent].children if k else [0]
        nearby = (text[b.parent] - text[k]) / max(1, len(siblings) - 1) if k else 0
        row[base:] = (
            b.depth,
            np.log1p(text[k]),
            linked[k] / max(1, text[k]),
            tags[k] / max(1, text[k]) * 100,
            text[k] / whole,
            np.log1p(b.own),
            sentences[k] / max(1, text[k]) * 100,
            np.log1p(sentences[k]),
            np.log1p(paragraphs[k]),
            len(b.children),
            len(siblings),
            b.place / max(1, len(siblings)),
            np.log1p(nearby),
            k / n,
            prose[k] / all_prose,
            paragraphs[k] / all_paragraphs,
            text[k] / max(1, text[b.parent]) if k else 1.0,
            prose[k] / max(1, prose[b.parent]) if k else 1.0,
            min(titles[k], 2),
            titles[b.parent] - titles[k] if k else 0,  # a main heading beside it
            (k > first_title) if first_title >= 0 else -1,
            under_path[k],
        )
        # how far down the way with the most prose it or the block above it lies: 0 off the way
        if k in path:
            under_path[k] = 2
        elif k and (b.parent in path) and blocks[b.parent].tag not in ("root", "html", "body"):
            under_path[k] = 1
        row[-1] = under_path[k]
    return out


# --- boosted trees -----------------------------------------------------------------------------

DEPTH = 3


@dataclass(frozen=True)
class Forest:
    """Complete trees of equal depth: per tree the feature and threshold of each inner node, and leaf values."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 90, rate: float = 0.25, bins: int = 24, damping: float = 2.0) -> Forest:
    """Newton boosting of the logistic loss with histogram splits."""
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    binned = [np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)]
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    share = float((weight * y).sum() / weight.sum())
    start = float(np.log(share / (1 - share)))
    odds = np.full(len(y), start)
    found: tuple[list, list, list] = ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        g, h = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-6)
            sums = [np.bincount(node - first, v, minlength=width) for v in (g, h)]
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                place = (node - first) * (len(c) + 1) + binned[f]
                left_g, left_h = (np.cumsum(np.bincount(place, v, minlength=width * (len(c) + 1)).reshape(width, -1), axis=1)[:, :-1] for v in (g, h))
                total_g, total_h = sums[0][:, None], sums[1][:, None]
                gain = left_g**2 / (left_h + damping) + (total_g - left_g) ** 2 / (total_h - left_h + damping) - total_g**2 / (total_h + damping)
                at = gain.argmax(axis=1)
                for k in np.flatnonzero(gain[np.arange(width), at] > best).tolist():
                    best[k], feature[first + k], threshold[first + k] = gain[k, at[k]], f, c[at[k]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, minlength=leaves) / (np.bincount(leaf, h, minlength=leaves) + damping)
        odds += value[leaf]
        for store, part in zip(found, (feature, threshold, value), strict=True):
            store.append(part)
    return Forest(start, *(np.stack(part) for part in found))


# --- the small labelled table ------------------------------------------------------------------

MAIN = 'data-main="1"'


PLAIN = ("div", "div", "section", 'div class="td-12"', "table", 'div id="mw-parser-output"', 'div class="{word}"', 'div class="col-{number}"', 'div class="container"', 'div id="{word}-{number}"')
"""Containers of an article that do not say what they hold."""
NAMED = ("article", "article", "article", "main", 'div class="content"', 'div id="main"', 'section class="post"', 'div class="entry-content"', 'article class="post-{number}"')


def labelled_pages(seed: int = 11, n: int = 420, plain: float = 0.5) -> Iterator[tuple[str, list[bool]]]:
    """Pages built by rule, with, for each block in order of opening, whether it is main text.

    A share `plain` of the articles stands in containers without a telling name, among boxes that may have none either.
    """
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]) for _ in range(rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda: words(1, 18).capitalize() + "."
    prose = lambda: " ".join(sentence() for _ in range(rng.choice([1, 1, 2, 3, 5, 9, 20])))
    link = lambda: f'<a href="/{word()}">{words(1, 3)}</a>'

    def filled(name: str) -> str:
        return name.format(word=word(), number=rng.randint(1, 99))

    def box(inner: str, *names: str) -> str:
        """A container of one of these names, or of one that says nothing."""
        name = filled(rng.choice([f'div class="{x}"' for x in names] * 3 + ["div", 'div class="{word}"', "section"]))
        return f"<{name}>{inner}</{name.split()[0]}>"

    def menu() -> str:
        items = "".join(f"<li>{link()}</li>" for _ in range(rng.randint(3, 9)))
        return rng.choice([f"<nav><ul>{items}</ul></nav>", box(f"<ul>{items}</ul>", "menu", "nav", "navbar", "breadcrumbs"), f'<ul id="menu">{items}</ul>'])

    def advert() -> str:
        name = rng.choice(["ad", "ads", "advert", "sponsored", "promo", "banner"])
        return f'<div class="{name}">{rng.choice([words(2, 12), sentence(), link(), f"<p>{prose()}</p>"])}</div>'

    def side() -> str:
        inner = "".join(rng.choice([f"<li>{link()}</li>", f"<p>{words(3, 20)}</p>"]) for _ in range(rng.randint(2, 7)))
        return rng.choice([f"<aside><h3>{words(1, 3)}</h3>{inner}</aside>", f'<div class="{rng.choice(["sidebar", "related", "widget"])}"><h4>{words(1, 3)}</h4>{inner}</div>'])

    def teasers() -> str:
        """Links to other articles, each with a line or two, in boxes that may call themselves articles."""
        each = lambda: rng.choice([f"<h3>{link()}</h3><p>{sentence()}</p>", f"<h4>{link()}</h4>", f"<p>{link()} {sentence()}</p>", f"<p>{sentence()} {link()}</p>"])
        name = rng.choice(["related", "recommended", "more", "teasers related", "related-posts"])
        items = [each() for _ in range(rng.randint(1, 5))]
        many = "".join(f'<article class="{rng.choice([name, "teaser related"])}">{x}</article>' for x in items)
        one = f"<h2>{words(1, 3)}</h2>{''.join(items)}"
        return rng.choice([many, f'<section class="{name}">{one}</section>', f'<div class="{name}">{one}</div>', f'<article class="{name}">{one}</article>', f"<aside>{one}</aside>"])

    def notice() -> str:
        return f'<div class="{rng.choice(["cookie", "notice", "consent", "popup", "alert"])}"><p>{sentence()}</p>{rng.choice(["", "<button>OK</button>", link()])}</div>'

    def form() -> str:
        return f'<form class="{rng.choice(["search", "newsletter", "login", ""])}"><label>{words(1, 4)}</label><input name="q"><p>{sentence()}</p></form>'

    def comments() -> str:
        each = "".join(f'<div class="comment"><b>{word()}</b><p>{prose()}</p></div>' for _ in range(rng.randint(1, 5)))
        return rng.choice([f'<section id="comments"><h2>{words(1, 2)}</h2>{each}</section>', f'<div class="comments">{each}</div>'])

    def footer() -> str:
        inner = rng.choice([f"&copy; {word()}.example.com &middot; {sentence()}", f"<p>&copy; 2024 {words(2, 6)}</p>{link()}", f"<ul><li>{link()}</li></ul>"])
        return rng.choice([f"<footer>{inner}</footer>", f'<div class="footer">{inner}</div>'])

    def header() -> str:
        return rng.choice([f"<header><h1>{words(1, 3)}</h1></header>", f'<div class="header">{words(1, 4)}</div>', f"<header>{link()} {link()}</header>"])

    def article() -> str:
        title = f"<h1 {MAIN}>{words(2, 9)}</h1>" if rng.random() < 0.9 else ""
        unnamed = rng.random() < plain
        number = rng.choice([1, 2, 4, 8, 8, 15, 25, 30, 50])
        long = unnamed and number <= 2  # a short article without a name shows itself by its paragraphs only
        parts = []
        for _ in range(number):
            text = (lambda: " ".join(sentence() for _ in range(rng.randint(2, 12)))) if long else prose
            parts.append(
                rng.choice(
                    [f"<p {MAIN}>{text()}</p>"] * 7
                    + [f"<p {MAIN}>{prose()}", f"<p {MAIN}><b>{sentence()}<br><p {MAIN}>{prose()}</p>", f"<p {MAIN}>{prose()} {link()} {sentence()}</p>", f"<h2 {MAIN}>{words(1, 6)}</h2>"]
                    + [f"<ul {MAIN}>{''.join(f'<li {MAIN}>{sentence()}</li>' for _ in range(4))}</ul>", f"<blockquote {MAIN}>{prose()}</blockquote>", f"<p {MAIN}>{word().capitalize()}.</p>"]
                )
                if not long
                else f"<p {MAIN}>{text()}</p>"
            )
            if rng.random() < 0.04:
                parts.append(rng.choice([advert, notice, form, teasers])())
        if rng.random() < 0.2:
            parts.append(rng.choice([teasers, comments, side])())
        name = filled(rng.choice(PLAIN if unnamed else NAMED))
        inner = "".join(parts)
        if name == "table":
            return f"{title}<table {MAIN}><tr {MAIN}><td {MAIN}>{inner}</td></tr></table>"
        if title and rng.random() < (0.4 if unnamed else 0.1):
            return f"{title}<{name} {MAIN}>{inner}</{name.split()[0]}>"
        return f"<{name} {MAIN}>{title}{inner}</{name.split()[0]}>"

    maybe = lambda make, p: make() if rng.random() < p else ""
    for _ in range(n):
        middle = maybe(side, 0.3) + article() + maybe(side, 0.3) + maybe(teasers, 0.3)
        if rng.random() < 0.3:
            middle = f'<div class="{rng.choice(["wrapper", "page", "container", word()])}">{middle}</div>'
        body = maybe(notice, 0.3) + maybe(header, 0.5) + maybe(menu, 0.8) + maybe(advert, 0.6) + middle + maybe(advert, 0.2) + maybe(form, 0.3) + maybe(comments, 0.4) + maybe(notice, 0.15) + maybe(footer, 0.9)
        page = f"<!DOCTYPE html><html><head><title>{word()}</title></head><body>{body}"
        page = page[: rng.randint(len(page) // 2, len(page))] if rng.random() < 0.1 else page + "</body></html>"
        marked = [m[3] for m in _TAG.finditer(page) if not m[1] and m[2].lower() not in INLINE | VOID | RAW]
        yield page.replace(f" {MAIN}", ""), [False] + [MAIN in m for m in marked]


@functools.lru_cache(maxsize=2)
def train(seed: int = 11) -> Forest:
    rows, labels, weights = [], [], []
    for source, marks in labelled_pages(seed):
        page = parse(source)
        x = features(page)
        if len(marks) != len(x):
            raise RuntimeError("a labelled page was not parsed as it was built")
        rows.append(x)
        labels += marks
        weights += [0.2 + np.log1p(b.own) for b in page.blocks]
    return boost(np.concatenate(rows), np.array(labels, dtype=float), np.array(weights))


# --- decoding ----------------------------------------------------------------------------------

SPLIT_PRICE = 6.0
FREE_TO_SPLIT = frozenset(["root", "html", "body"])
"""Every page has more than its main text in these."""
MOST_ODDS = 4.0


def chosen(page: Page, odds: np.ndarray) -> list[bool]:
    """Which blocks' own text is kept. A tie keeps the whole block."""
    blocks = page.blocks
    n = len(blocks)
    gain = (np.clip(odds, -MOST_ODDS, MOST_ODDS) * np.array([np.log1p(b.own) + (0.5 if b.children else 0.0) for b in blocks])).tolist()
    whole, best = list(gain), [0.0] * n
    parts = [0.0] * n
    for k in range(n - 1, -1, -1):
        parts[k] += abs(gain[k]) if blocks[k].own else 0.0
        price = 0.0 if blocks[k].tag in FREE_TO_SPLIT else SPLIT_PRICE
        best[k] = max(abs(whole[k]), parts[k] - price if blocks[k].children else -np.inf)
        if k:
            whole[blocks[k].parent] += whole[k]
            parts[blocks[k].parent] += best[k]
    keep = [False] * n
    settled: list[bool | None] = [None] * n
    for k, b in enumerate(blocks):
        above = settled[b.parent] if k else None
        if above is None and best[k] > abs(whole[k]):
            keep[k] = gain[k] > 0
        else:
            settled[k] = above if above is not None else whole[k] >= 0
            keep[k] = settled[k]
    return keep


def main_texts(forest: Forest, sources: list[str]) -> list[str]:
    """Main text of each page: kept runs in page order, joined by single spaces."""
    pages = [parse(source) for source in sources]
    if not pages:
        return []
    rows = [features(page) for page in pages]
    odds = np.split(forest.odds(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
    out = []
    for page, o in zip(pages, odds, strict=True):
        keep = chosen(page, o)
        out.append(" ".join(text for block, text in page.runs if keep[block]))
    return out


def extract(pages: DataFrame, forest: Forest) -> DataFrame:
    """page_id, url, main text and its code points for every row of `pages`, from the whole html.

    A null or empty html, or one without main text, gives an empty text. Character references are
    decoded, white space within a block becomes one space, blocks are joined by one space. Long pages are read whole. Repeated
    rows are read each, other columns are ignored, an empty table gives an empty result.
    """
    shared = pages.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = main_texts(shared.value, [x or "" for x in part.column("html").to_pylist()])
            yield output(SCHEMA.names, [part.column("page_id"), part.column("url"), texts, [len(t) for t in texts]], SCHEMA)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, SCHEMA)
