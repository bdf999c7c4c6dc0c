"""Main text of web pages by a tree-structured graphical model (operator 9).

The model (see ``html_tree``) is trained on labelled pages: the ``train_pages`` pages of the table that
come first by a hash and mark their text with ``<article>`` or ``<main>`` give articles, and each is set
into ``layouts`` page layouts whose menus, headers, sidebars, notices, adverts, forms, comments and
footers are known, so every node has a label.  Names of elements and classes vary between layouts, and
the other blocks borrow their words from other pages, so that the model has to go by structure.  This
sample is bounded; every page is then read whole and judged by the model.

Defined results: a null, empty or tag-only page has the empty text; a page without markup is one
block, judged like any other;
unclosed tags and quotes are read as browsers do, nearly; repeated rows get equal results; an empty table
gives an empty result."""
from __future__ import annotations

import html
import random
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cytospark.llm import textops
from cytospark.llm.html_tree import Node, TreeModel, parse, texts_under

TRAIN_PAGES = 200
LAYOUTS = 5
# A training page longer than this is not used as an example (its whole text would come to the driver).
TRAIN_CHARS = 20_000
# Kept ready for tables whose pages mark no article.
FILLER = ["It was late when the boat came in, and nobody on the shore had a lamp.", "Two days passed before word reached the town.",
          "The council met again; the bridge, it said, would have to wait.", "She had read the letter twice, and still it made no sense."]

# Names under which pages mark their parts.
CONTENT = ["content", "post", "entry", "entry-content", "article", "article-body", "main", "main-content", "story", "story-body",
           "text", "post-body", "page-content", "body-text", "single-post", "hentry", "prose"]
PARTS = {
    "nav": ["nav", "menu", "navbar", "navigation", "main-menu", "topnav", "breadcrumb", "breadcrumbs", "tabs", "pagination", "skip-links"],
    "header": ["header", "site-header", "masthead", "top", "banner", "branding", "logo", "page-header"],
    "aside": ["sidebar", "side", "widget", "widgets", "related", "recommended", "popular", "aside", "right-column", "more-stories",
              "trending", "tags", "author-box", "toc"],
    "footer": ["footer", "site-footer", "bottom", "copyright", "colophon", "legal", "footer-links"],
    "notice": ["cookie", "cookie-notice", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "newsletter", "subscribe",
               "paywall", "warning", "message", "promo-banner", "notification"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "promo", "banner-ad", "adsbygoogle", "dfp", "commercial"],
    "form": ["form", "search", "login", "signup", "contact-form", "search-form", "newsletter-form"],
    "comments": ["comments", "comment", "comment-list", "discussion", "responses", "replies", "disqus", "respond", "reader-comments",
                 "user-comments", "feedback", "reviews"],
    "share": ["share", "social", "social-share", "sharing", "follow-us", "buttons", "print"],
}
TAGS = {"nav": ["nav", "div", "ul", "section"], "header": ["header", "div"], "aside": ["aside", "div", "section"],
        "footer": ["footer", "div"], "notice": ["div", "section", "aside", "p"], "ad": ["div", "aside", "section", "ins", "p"],
        "form": ["form", "div"], "comments": ["section", "div", "ol", "aside"], "share": ["div", "ul"]}


class _Layout:
    """Writes one labelled page: an article among other parts.  What is content is held in ``<x-content>``
    marks, which ``labelled`` reads and takes out."""

    def __init__(self, rng: random.Random, words: list[str]):
        self.rng, self.words = rng, words

    def some(self, low: int, high: int) -> str:
        text = self.rng.choice(self.words)
        parts = text.split()
        at = self.rng.randrange(max(1, len(parts) - high))
        return html.escape(" ".join(parts[at:at + self.rng.randint(low, high)]))

    def links(self, low: int, high: int) -> str:
        rng = self.rng
        items = [f'<a href="#">{self.some(1, 4)}</a>' for _ in range(rng.randint(low, high))]
        return rng.choice([lambda: "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", lambda: " | ".join(items),
                           lambda: "".join(f"<div>{x}</div>" for x in items)])()

    def part(self, kind: str) -> str:
        rng = self.rng
        tag = rng.choice(TAGS[kind])
        # A part is told by its tag or by its names, or by both.
        named = tag in ("div", "section", "ul", "ol", "p", "ins") or rng.random() < 0.5
        names = " ".join(rng.sample(PARTS[kind], rng.randint(1, 2))) if named else ""
        attr = (f' {rng.choice(["class", "class", "id"])}="{names}"' if names else "")
        if kind == "nav":
            body = self.links(3, 9)
        elif kind == "header":
            body = f"<{rng.choice(['h1', 'h2', 'div', 'p'])}>{self.some(1, 5)}</{'div'}>" + (f"<p>{self.some(3, 12)}</p>" if rng.random() < 0.6 else "") + (
                self.links(2, 6) if rng.random() < 0.5 else "")
        elif kind == "aside":
            body = f"<h3>{self.some(1, 4)}</h3>" + rng.choice([lambda: self.links(3, 8), lambda: f"<p>{self.some(4, 70)}</p>",
                                                              lambda: self.links(2, 4) + f"<p>{self.some(3, 60)}</p>"])()
        elif kind == "footer":
            body = rng.choice([lambda: f"&copy; {self.some(2, 20)}", lambda: f"<p>&copy; {self.some(3, 25)}</p>" + self.links(2, 6),
                               lambda: self.links(2, 6) + f"<p>{self.some(3, 25)}</p>"])()
        elif kind == "notice":
            body = rng.choice([lambda: f"<p>{self.some(4, 60)}</p><button>{self.some(1, 2)}</button>", lambda: self.some(3, 50),
                               lambda: f"<p>{self.some(6, 30)} <a href='#'>{self.some(1, 3)}</a></p>"])()
        elif kind == "ad":
            body = rng.choice([lambda: self.some(3, 25), lambda: f"<p>{self.some(2, 60)}</p>", lambda: f"<a href='#'>{self.some(3, 15)}</a>"])()
        elif kind == "form":
            body = f"<label>{self.some(1, 3)}</label><input type=text><p>{self.some(2, 15)}</p><button>{self.some(1, 2)}</button>"
        elif kind == "comments":
            one = rng.choice(["div", "li", "article", "section"])
            body = f"<h3>{self.some(1, 3)}</h3>" + "".join(
                f'<{one} class="comment"><div class="comment-author">{self.some(1, 3)}</div><p>{self.some(2, 90)}</p></{one}>'
                for _ in range(rng.randint(1, 5)))
        else:
            body = self.links(2, 5)
        return f"<{tag}{attr}>{body}</{tag}>"

    def page(self, title: str, blocks: list[str]) -> str:
        rng = self.rng

        def mark(x: str) -> str:
            return f"<x-content>{x}</x-content>"
        inner = []
        head = f"<h1>{html.escape(title)}</h1>"
        if title:
            inner.append(rng.choice([lambda: mark(head), lambda: mark(f"<header>{head}</header>"), lambda: mark(f"<div class='title'>{head}</div>")])())
        for k, b in enumerate(blocks):
            tag = rng.choices(["p", "h2", "blockquote", "li", "div", "pre", "td", "figcaption"], [30, 2, 2, 2, 2, 1, 1, 1])[0]
            if rng.random() < 0.3:
                words = b.split()
                b = " ".join(words[:rng.randint(1, 10)]) or b
            text = html.escape(b)
            if rng.random() < 0.1:
                text = f'{text} <a href="#">{self.some(1, 4)}</a>'
            x = f"<{tag}>{text}</{tag}>"
            x = {"li": f"<ul>{x}</ul>", "td": f"<table><tr>{x}</tr></table>", "figcaption": f"<figure>{x}</figure>"}.get(tag, x)
            inner.append(mark(x))
            if rng.random() < 0.08:
                inner.append(self.part(rng.choice(["ad", "ad", "aside", "share", "notice", "form"])))
        wrap = rng.choice(["article", "main", "named", "named", "named", "bare", "plain"])
        body = "".join(inner)
        if wrap == "article" or wrap == "main":
            name = f' class="{rng.choice(CONTENT)}"' if rng.random() < 0.4 else ""
            body = f"<{wrap}{name}>{body}</{wrap}>"
        elif wrap == "named":
            tag = rng.choice(["div", "div", "section"])
            body = f'<{tag} {rng.choice(["class", "id"])}="{" ".join(rng.sample(CONTENT, rng.randint(1, 2)))}">{body}</{tag}>'
        elif wrap == "plain":
            body = f"<div>{body}</div>"
        before = [self.part(k) for k, p in (("notice", 0.4), ("header", 0.6), ("nav", 0.8), ("ad", 0.5), ("form", 0.3), ("aside", 0.2)) if rng.random() < p]
        after = [self.part(k) for k, p in (("share", 0.3), ("ad", 0.3), ("comments", 0.6), ("aside", 0.6), ("form", 0.2), ("nav", 0.2),
                                           ("footer", 0.8), ("notice", 0.2)) if rng.random() < p]
        rng.shuffle(before)
        if rng.random() < 0.4:
            cut = rng.randint(0, len(after))
            body = f'<div class="{rng.choice(["container", "wrapper", "row", "page", "layout", "site"])}">{body}{"".join(after[:cut])}</div>'
            after = after[cut:]
        return f"<html><head><title>{html.escape(title)}</title></head><body>{''.join(before)}{body}{''.join(after)}</body></html>"


def labelled(page: str) -> list[Node]:
    """Nodes of a page of ``_Layout`` with their labels; the marks are no nodes of the result.  A node around
    marks is content itself if nothing else lies in it but parts."""
    nodes = parse(page)
    for i, x in enumerate(nodes):
        x.label = int(x.tag == "x-content" or i > 0 and nodes[x.parent].label)
    kept, place = [], {}
    for i, x in enumerate(nodes):
        if x.tag == "x-content":
            place[i] = place[x.parent]
            continue
        place[i] = len(kept)
        if i:
            x.parent = place[x.parent]
        kept.append(x)
    # The element that holds the marked blocks, unless it is the page's own body or frame.
    for i, x in enumerate(kept):
        if x.label and i and not kept[x.parent].label and kept[x.parent].tag not in ("#root", "html", "body"):
            up = kept[x.parent]
            frame = up.tag == "div" and set(up.names) & {"container", "wrapper", "row", "page", "layout", "site"}
            if not frame:
                up.label = 2
    for x in kept:
        x.label = min(x.label, 1)
    for x in kept:
        x.kids = 0
    for x in kept[1:]:
        kept[x.parent].kids += 1
    return kept


def training_pages(articles: list[list[str]], layouts: int = LAYOUTS, seed: int = 5) -> list[list[Node]]:
    """Labelled pages made from articles (their blocks, the first one the title)."""
    rng = random.Random(seed)
    words = [b for a in articles for b in a] or FILLER
    out = []
    for blocks in articles or [FILLER]:
        for _ in range(layouts):
            some = blocks[1:][:rng.randint(2, 30)] or blocks
            out.append(labelled(_Layout(rng, words).page(blocks[0][:90], some)))
    return out


def learn(pages: DataFrame, html_col: str = "html", train_pages: int = TRAIN_PAGES) -> TreeModel:
    """Train on the bounded sample of pages that mark an article."""
    marked = pages.where(F.lower(html_col).rlike(r"<(article|main)\b") & (F.length(html_col) <= TRAIN_CHARS)) \
        .select(F.xxhash64(html_col).alias("k"), F.col(html_col).alias("html"))
    # First the keys alone, so that tasks send no pages that are not used; copies of a page are one.
    last = marked.select("k").distinct().orderBy("k").limit(train_pages).agg(F.max("k").alias("k")).first()["k"]
    rows = marked.where(F.col("k") <= F.lit(last)).groupBy("k").agg(F.min("html").alias("html")).orderBy("k").collect() if last is not None else []
    articles = []
    for r in rows:
        nodes = parse(r["html"])
        blocks = list(texts_under(nodes, [i for i, x in enumerate(nodes) if x.tag in ("article", "main")]))
        if len(blocks) > 1:
            articles.append(blocks)
    return TreeModel().fit(training_pages(articles))


@lru_cache(maxsize=1)
def _model(holder) -> TreeModel:
    model = TreeModel()
    model.weights, model.edges = holder.value
    return model


def extract(pages: DataFrame, html_col: str = "html", model: TreeModel | None = None, out: str = "text") -> DataFrame:
    """``pages`` with the main text of every page in ``out`` and its length in ``n_chars`` instead of its html; other
    columns of these names, in any case, are replaced."""
    model = model or learn(pages, html_col)
    holder = pages.sparkSession.sparkContext.broadcast((model.weights, model.edges))
    at = pages.columns.index(html_col)
    keep = [k for k, c in enumerate(pages.columns) if k != at and c.lower() not in (out.lower(), "n_chars")]
    schema = StructType([pages.schema.fields[k] for k in keep] + [StructField(out, StringType()), StructField("n_chars", LongType())])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _model(holder)
        for batch in textops.small(batches):
            texts = [judge.content(p) if p else "" for p in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=names)
    return pages.mapInArrow(run, schema)
