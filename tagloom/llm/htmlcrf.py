"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page is read by a forgiving parser into blocks: runs of text inside one block element, white space as one space. A block
has features of its ancestors (tags, words of class and id), of its own element and of its text. The field has two labels,
article or not; it is trained on labelled pages and decoded by Viterbi, and the article blocks are joined by line feeds.

Labelled pages are a bounded sample of the given ones that mark their article by ``<article>`` or ``<main>``, and pages put
together from their texts in other layouts (see ``layouts``), with menus, notices, forms, adverts, side columns and reader
comments, so that the field learns names and neighbourhoods rather than one template. Null and empty pages have no text;
contents of head, script, style and the like are never text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm import arrays

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre section summary table
tbody td tfoot th thead title tr ul""".split())
HIDDEN = frozenset("head title script style template noscript svg iframe object textarea select canvas audio video".split())
# An open head ends where anything else begins, as its end tag and the tags of the body may be left out.
IN_HEAD = frozenset("base basefont bgsound head html link meta noscript script style template title".split())
RAW = "script|style|textarea|title|iframe|noscript|template"
# A new element of the key closes an open one of the value that no other container stands before.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTAINERS = frozenset("article aside blockquote body details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split())
CLOSING_P = BLOCK - {"option", "label", "button", "html", "head", "body", "title"}

TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/><]*)"""
    # A quoted value may hold < and > where it ends as a value does; other quotes end before the next tag, or are plain characters.
    r"""(?P<rest>(?>[^<>"'=]++|=\s*+(?:"[^"]*+"(?=[\s/>])|'[^']*+'(?=[\s/>]))|"[^"<]*+"|'[^'<]*+'|["'=])*+)>|<[!?/][^>]*>?|(?P<text>[^<]+|<)""",
    re.S | re.I)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")


class Reader:
    """Blocks of a page. With weights the features are summed as elements open and close, without they are collected."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = weights

    def read(self, page: str) -> list[tuple[str, float | list[str]]]:
        self.blocks: list = []
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.within: list[str] = [""]  # open block elements
        self.open: Counter = Counter()
        self.active: Counter = Counter()
        self.total = 0.0
        self.hidden = 0
        self.parts: list[str] = []
        self.linked = 0
        for m in TOKEN.finditer(page):
            text = m["text"]
            if text is not None:
                if self.open["head"] and text.strip():
                    self.close("head")
                if not self.hidden:
                    text = html.unescape(text) if "&" in text else text
                    self.parts.append(text)
                    if self.open["a"]:
                        self.linked += len(text.strip())
            elif m["tag"]:
                tag = m["tag"].lower()
                if m["end"]:
                    self.close(tag)
                else:
                    self.start(tag, m["rest"])
            # Raw elements and comments leave nothing, and do not cut a block.
        self.flush()
        return self.blocks

    def start(self, tag: str, rest: str) -> None:
        if self.open["head"] and tag not in IN_HEAD:
            self.close("head")
        if tag in BLOCK:
            self.flush()
            if tag in CLOSING_P and self.open["p"]:
                self.leave({"p"}, CONTAINERS)
            if tag in CLOSES:
                self.leave(CLOSES[tag], CONTAINERS - {"table"} if tag in ("td", "th", "tr") else CONTAINERS)
        elif tag == "br":
            self.parts.append(" ")
        # A slash at the end of an unquoted value is part of the value.
        if tag in VOID or rest.endswith("/") and (rest[-2:-1].isspace() or rest[-2:-1] in ("", '"', "'")):
            return
        names = [f"in={tag}"]
        if "=" in rest:
            for found in NAMED.findall(rest):
                names += [f"is={w}" for w in WORD.findall("".join(found).lower())]
        self.stack.append((tag, tuple(names)))
        if tag in BLOCK:
            self.within.append(tag)
        self.open[tag] += 1
        self.hidden += tag in HIDDEN
        for x in names:
            self.active[x] += 1
            if self.weights is not None and self.active[x] == 1:
                self.total += self.weights.get(x, 0.0)

    def pop(self) -> str:
        tag, names = self.stack.pop()
        if tag in BLOCK:
            self.within.pop()
        self.open[tag] -= 1
        self.hidden -= tag in HIDDEN
        for x in names:
            self.active[x] -= 1
            if not self.active[x]:
                del self.active[x]
                if self.weights is not None:
                    self.total -= self.weights.get(x, 0.0)
        return tag

    def leave(self, tags: set[str], stop: frozenset[str]) -> None:
        """Close the innermost of ``tags`` that is open inside the innermost of ``stop``."""
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] in tags:
                while len(self.stack) > depth:
                    self.pop()
                return
            if self.stack[depth][0] in stop:
                return

    def close(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if not self.open[tag]:
            return
        if tag not in BLOCK and tag not in HIDDEN:
            # An inline element ends only where no block stands between.
            depth = len(self.stack) - 1
            while self.stack[depth][0] != tag:
                if self.stack[depth][0] in BLOCK:
                    return
                depth -= 1
        while self.pop() != tag:
            pass

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        linked, self.parts, self.linked = self.linked, [], 0
        if not text:
            return
        own = [f"own={self.within[-1]}", *text_features(text, linked)]
        if self.weights is None:
            self.blocks.append((text, [*self.active, *own]))
        else:
            self.blocks.append((text, self.total + sum(self.weights.get(x, 0.0) for x in own)))


def text_features(text: str, linked: int) -> list[str]:
    words = text.count(" ") + 1
    out = ["any", f"words={min(words.bit_length(), 8)}", f"link={min(4 * linked // len(text), 4)}"]
    if text[-1] in ".!?…":
        out.append("sentence")
    if "©" in text:
        out.append("copyright")
    if not any(c.isalpha() for c in text):
        out.append("letterless")
    return out


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]  # of a feature, for article against not
    start: tuple[float, float]
    moves: tuple[tuple[float, float], tuple[float, float]]

    def labels(self, scores: list[float]) -> list[int]:
        """The likeliest labels of a page's blocks (Viterbi); not article wins ties."""
        if not scores:
            return []
        (aa, ab), (ba, bb) = self.moves
        zero, one = self.start[0], self.start[1] + scores[0]
        back = []
        for x in scores[1:]:
            back.append((int(one + ba > zero + aa), int(one + bb > zero + ab)))
            zero, one = max(zero + aa, one + ba), max(zero + ab, one + bb) + x
        out = [int(one > zero)]
        for pair in reversed(back):
            out.append(pair[out[-1]])
        return out[::-1]

    def main_text(self, page: str | None) -> str:
        blocks = Reader(self.weights).read(page or "")
        return "\n".join(t for (t, _), y in zip(blocks, self.labels([s for _, s in blocks])) if y)


def train(pages: list[tuple[list[list[str]], list[int]]], epochs: int = 150, rate: float = 0.5, l2: float = 1e-3) -> Model:
    """Likelihood of the labels, climbed by AdaGrad on the whole set; expectations by the forward-backward algorithm,
    all pages at once."""
    pages = [p for p in pages if p[0]]
    names = sorted({f for blocks, _ in pages for b in blocks for f in b})
    number = {f: i for i, f in enumerate(names)}
    if not pages:
        return Model({"in=article": 1.0, "in=main": 1.0, "any": -0.5}, (0.0, 0.0), ((0.0, 0.0), (0.0, 0.0)))
    n, long = len(pages), max(len(b) for b, _ in pages)
    cell = np.array([r * long + t for r, (blocks, _) in enumerate(pages) for t, b in enumerate(blocks) for _ in b])
    feature = np.array([number[f] for blocks, _ in pages for b in blocks for f in b])
    gold, real = np.zeros((n, long), np.int64), np.zeros((n, long), bool)
    for r, (_, y) in enumerate(pages):
        gold[r, : len(y)], real[r, : len(y)] = y, True
    w, start, moves = np.zeros(len(names)), np.zeros(2), np.zeros((2, 2))
    history = [np.full(x.shape, 1e-8) for x in (w, start, moves)]
    pair = real[:, 1:]
    gold_moves = np.array([[((gold[:, :-1] == a) & (gold[:, 1:] == b) & pair).sum() for b in (0, 1)] for a in (0, 1)], float)
    gold_start = np.array([(gold[:, 0] == a).sum() for a in (0, 1)], float)
    for _ in range(epochs):
        score = np.zeros((n, long, 2))
        score[:, :, 1] = np.bincount(cell, w[feature], n * long).reshape(n, long)
        ahead, behind = np.zeros((n, long, 2)), np.zeros((n, long, 2))
        ahead[:, 0] = start + score[:, 0]
        for t in range(1, long):
            step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves[None], axis=1) + score[:, t]
            ahead[:, t] = np.where(real[:, t, None], step, ahead[:, t - 1])
        for t in range(long - 2, -1, -1):
            step = np.logaddexp.reduce(moves[None] + (score[:, t + 1] + behind[:, t + 1])[:, None], axis=2)
            behind[:, t] = np.where(real[:, t + 1, None], step, 0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        node = np.exp(ahead + behind - total[:, None, None]) * real[:, :, None]
        edge = np.exp(ahead[:, :-1, :, None] + moves + (score + behind)[:, 1:, None, :] - total[:, None, None, None]) * pair[:, :, None, None]
        gap = (gold * real - node[:, :, 1]).reshape(-1)
        grads = (np.bincount(feature, gap[cell], len(names)) / n - l2 * w, (gold_start - node[:, 0].sum(axis=0)) / n - l2 * start,
                 (gold_moves - edge.sum(axis=(0, 1))) / n - l2 * moves)
        for x, g, h in zip((w, start, moves), grads, history):
            h += g * g
            x += rate * g / np.sqrt(h)
    return Model({f: float(w[i]) for f, i in number.items()}, tuple(map(float, start)), tuple(tuple(map(float, r)) for r in moves))


def marked(page: str) -> tuple[list[str], list[list[str]], list[int]]:
    """Texts, features and labels of a page that marks its article; blocks of inner menus, forms and so on are not part."""
    blocks = Reader().read(page)
    inside = [int(("in=article" in f or "in=main" in f) and not {"in=aside", "in=nav", "in=form", "in=footer"} & set(f)) for _, f in blocks]
    return [t for t, _ in blocks], [f for _, f in blocks], inside


ARTICLES = ("<article>{}</article>", "<main><article class='post'>{}</article></main>", "<main id='main'>{}</main>",
            "<div class='content'><div class='post-body'>{}</div></div>", "<div id='main-content'>{}</div>",
            "<section class='entry-content'>{}</section>", "<div class='page'><div class='article-text'>{}</div></div>", "<div class='story'>{}</div>")
PARAGRAPHS = ("<p>{}</p>",) * 8 + ("<h2>{}</h2>", "<blockquote><p>{}</p></blockquote>", "<ul><li>{}</li></ul>", "<p><b>{}</b>", "<p>{}<br>")
BEFORE = ("<nav><ul><li><a href='/'>{}</a></li><li><a href='/'>{}</a></li><li><a href='/'>{}</a></li></ul></nav>",
          "<header><div class='logo'>{}</div><p>{}</p></header>", "<div class='menu'><a href='/'>{}</a></div>",
          "<div class='cookie notice'><p>{}</p><button>{}</button></div>", "<div id='banner'><p>{}</p></div>",
          "<div class='breadcrumb'><a href='/'>{}</a></div>", "<div class='notice'>{}</div>", "<div class='ad'>{}</div>", "<div class='header top'>{}</div>")
AFTER = ("<aside><h3>{}</h3><p>{}</p></aside>", "<aside class='sidebar'><ul><li><a href='/'>{}</a></li><li><a href='/'>{}</a></li></ul></aside>",
         "<div class='sidebar widget'><p>{}</p></div>", "<div class='ad'>{}</div>", "<div class='advert sponsored promo'><p>{}</p></div>",
         "<form action='/'><label>{}</label><p>{}</p></form>", "<form class='newsletter signup'><p>{}</p><button>{}</button></form>",
         "<section id='comments' class='comments'><h2>{}</h2><div class='comment'><p class='author'>{}</p><p>{}</p></div><div class='comment'><p>{}</p></div></section>",
         "<div class='comment-list'><article class='comment'><p>{}</p></article></div>", "<div class='related links'><a href='/'>{}</a></div>",
         "<div class='share social'>{}</div>", "<footer>© {}</footer>", "<footer><p>{}</p></footer>", "<div class='footer'>{}</div>")


def layouts(content: list[list[str]], other: list[str], seed: int = 7, copies: int = 2) -> list[tuple[list[list[str]], list[int]]]:
    """Labelled pages: each article in ``copies`` layouts drawn at random, around it and inside it other blocks with texts
    of either kind."""
    rng = np.random.default_rng(seed)
    pool = [t for texts in content for t in texts] + other
    out = []

    def fill(form: str) -> tuple[str, int]:
        n = form.count("{}")
        return form.format(*(html.escape(pool[i]) for i in rng.integers(0, len(pool), n))), n

    def some(forms: tuple[str, ...], most: int) -> list[tuple[str, int]]:
        return [fill(forms[i]) for i in rng.integers(0, len(forms), rng.integers(0, most + 1))]

    for texts in content * copies:
        body, labels = "", []
        for i, t in enumerate(texts):
            body += ("<h1>{}</h1>" if not i else PARAGRAPHS[rng.integers(0, len(PARAGRAPHS))]).format(html.escape(t))
            labels.append(1)
            if rng.random() < 0.08:
                part, n = fill(AFTER[rng.integers(0, len(AFTER) - 3)])
                body, labels = body + part, labels + [0] * n
        head, tail = some(BEFORE, 4), some(AFTER, 5)
        page = "".join(p for p, _ in head) + ARTICLES[rng.integers(0, len(ARTICLES))].format(body.replace("{", "&#123;").replace("}", "&#125;")) + "".join(p for p, _ in tail)
        labels = [0] * sum(n for _, n in head) + labels + [0] * sum(n for _, n in tail)
        blocks = Reader().read(f"<html><body>{page}</body></html>")
        if len(blocks) == len(labels):
            out.append(([f for _, f in blocks], labels))
    return out


def fit(pages: DataFrame, page: str = "html", max_pages: int = 256) -> Model:
    """Train on at most ``max_pages`` pages, those with the smallest hash of their source, and layouts made of their texts."""
    rows = pages.select(F.col(page).alias("html")).where("html is not null").withColumn("h", F.xxhash64("html"))
    # Hashes first, so that no task sends pages that are not chosen; copies of a page count once.
    first = [r["h"] for r in rows.select("h").distinct().orderBy("h").limit(max_pages).collect()]
    some = rows.where(F.col("h").isin(first)).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").select("html")
    own, content, other = [], [], []
    for (source,) in some.collect():
        texts, features, labels = marked(source)
        if not any(labels):
            other += texts
            continue
        own.append((features, labels))
        content.append([t for t, y in zip(texts, labels) if y])
        other += [t for t, y in zip(texts, labels) if not y]
    return train(own + layouts(content or [other[i : i + 8] for i in range(0, len(other), 8)], other or ["-"]))


def extract(page: Column | str, model: Model) -> Column:
    """Main text of each whole page."""
    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([model.main_text(x) for x in batch.to_pylist()], pa.string())

    return text(page)
