"""Block trees of web pages, and a tree-structured model that tells content from the rest.

``parse`` turns a page into nodes (block elements and the runs of text between them).  ``TreeModel`` has a
weight per feature of a node and a table per kind of parent-child edge; sum-product messages up and
down the tree give each node's marginal probability of being content, and the same marginals give
the gradient of the likelihood of labelled pages."""
from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator

# How elements are read.
INLINE = set("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr br input picture source""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("""script style noscript template head title textarea iframe object svg math canvas audio video select option
datalist button map xmp noframes""".split())
CLOSED_BY = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
HOLDERS = set("ul ol dl table body div section article main nav aside header footer form".split())
# Elements whose whole content is left out, up to their end tag, without reading tags in it.
RAW = set("script style textarea title noscript iframe xmp noframes template".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_NAME = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("parent", "tag", "names", "text", "chars", "linked", "marks", "kids", "label")

    def __init__(self, parent: int, tag: str, names: tuple[str, ...] = ()):
        self.parent, self.tag, self.names = parent, tag, names
        self.text, self.chars, self.linked, self.marks, self.kids = "", 0, 0, 0, 0
        self.label = 0


def parse(page: str) -> list[Node]:
    """The nodes of a page in document order; node 0 is the root.  A text node has the tag ``#text``."""
    nodes = [Node(-1, "#root")]
    stack: list[tuple[int, int]] = [(0, 0)]
    unseen, links = 0, 0
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            node = Node(stack[-1][0], "#text")
            node.text, node.chars, node.linked = text, len(text), min(linked, len(text))
            node.marks = sum(map(text.count, ".,;:!?"))
            nodes.append(node)
        linked = 0

    def close(depth: int) -> None:
        nonlocal unseen, links
        flush()
        while len(stack) > depth:
            at, links = stack.pop()
            unseen -= nodes[at].tag in UNSEEN

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not unseen:
            text = html.unescape(raw)
            parts.append(text)
            if links:
                linked += len(" ".join(text.split()))
    at = 0
    while True:
        hit = _TOKEN.search(page, at)
        if hit is None:
            say(page[at:])
            break
        say(page[at:hit.start()])
        at = hit.end()
        tag = (hit["tag"] or hit["tag2"] or "").lower()
        if not tag:
            continue
        if hit["end"] or hit["end2"]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in ("br", "p") and not any(nodes[i].tag == tag for i, _ in stack):
                flush() if tag == "p" else parts.append(" ")
            elif tag not in INLINE:
                for depth in range(len(stack) - 1, 0, -1):
                    if nodes[stack[depth][0]].tag == tag:
                        close(depth)
                        break
            continue
        attrs = hit["attrs"] or hit["attrs2"] or ""
        if tag in RAW and not attrs.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                links = 1
            continue
        flush()
        if nodes[stack[-1][0]].tag == "p":
            close(len(stack) - 1)
        if tag in CLOSED_BY:
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = nodes[stack[depth][0]].tag
                if open_tag in CLOSED_BY[tag]:
                    close(depth)
                    break
                if open_tag in HOLDERS:
                    break
        if tag == "body":
            unseen -= sum(nodes[i].tag == "head" for i, _ in stack)
            for i, _ in stack:
                if nodes[i].tag == "head":
                    nodes[i].tag = "#head"
        names: list[str] = []
        if attrs and "=" in attrs or "hidden" in attrs:
            for m in _ATTR.finditer(attrs):
                key, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
                if key == "hidden" or key == "style" and "display:none" in value.replace(" ", "").lower():
                    names.append("unseen")
                elif key != "style":
                    for word in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower().split():
                        parts_of = _NAME.findall(word)
                        names += parts_of if len(parts_of) < 2 else [*parts_of, "-".join(parts_of)]
        node = Node(stack[-1][0], tag, tuple(dict.fromkeys(names)))
        nodes.append(node)
        if tag not in VOID and not attrs.endswith("/"):
            stack.append((len(nodes) - 1, links))
            unseen += tag in UNSEEN
    flush()
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[nodes[i].parent]
        up.chars += nodes[i].chars
        up.linked += nodes[i].linked
        up.marks += nodes[i].marks
        up.kids += 1
    # Elements without any text say nothing.
    kept = [i for i, x in enumerate(nodes) if i == 0 or x.chars]
    place = {i: k for k, i in enumerate(kept)}
    for i in kept[1:]:
        nodes[i].parent = place[nodes[i].parent]
    return [nodes[i] for i in kept]


def _step(x: float, steps: tuple) -> int:
    return sum(x >= s for s in steps)


# Elements whose name says what lies in them, wherever below.
TELLING = set("article main nav aside header footer form section figure table blockquote ul ol".split())


def features(nodes: list[Node]) -> list[list[str]]:
    """The features of every node, as names: its own element, names, size, links and punctuation, and the
    telling elements and names that it lies in."""
    out: list[list[str]] = []
    around: list[tuple[str, ...]] = []
    for x in nodes:
        share = x.linked / x.chars if x.chars else 0.0
        linky = _step(share, (0.01, 0.2, 0.5, 0.9))
        kind = "t" if x.tag == "#text" else "e"
        over = around[x.parent] if x.parent >= 0 else ()
        fs = [kind, f"{kind}link{linky}", f"{kind}size{_step(x.chars, (10, 25, 60, 150, 400, 1200))}",
              f"{kind}marks{_step(x.marks / max(x.chars, 1) * 100, (0.01, 0.7, 1.5, 4))}", *over]
        if kind == "t":
            up = nodes[x.parent]
            fs += [f"in:{up.tag}", f"in:{up.tag}:link{linky}"]
            around.append(over)
        else:
            own = [f"name:{n}" for n in x.names]
            fs += [f"tag:{x.tag}", *own, f"tag:{x.tag}:link{linky}", f"kids{_step(x.kids, (2, 4, 8))}"]
            more = [f"under:{n}" for n in x.names] + [f"under:<{x.tag}>"] * (x.tag in TELLING)
            around.append(tuple(dict.fromkeys((*over, *more))) if more else over)
        out.append(fs)
    return out


def _sum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


class TreeModel:
    """``weights`` by feature (for content, against 0 for the rest) and ``edges[kind][parent][child]``."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        self.edges = [[[0.0, 0.0], [0.0, 0.0]], [[0.0, 0.0], [0.0, 0.0]]]

    def marginals(self, nodes: list[Node], feats: list[list[str]], pairs: bool = False):
        """P(content) per node, and if asked for the pair marginals [p00, p01, p10, p11] per node with a
        parent (parent's label first)."""
        n, get = len(nodes), self.weights.get
        own = [[0.0, sum([get(f, 0.0) for f in fs])] for fs in feats]
        sent: list = [None] * n
        for i in range(n - 1, 0, -1):
            e = self.edges[nodes[i].tag == "#text"]
            b0, b1 = own[i]
            m0, m1 = _sum(b0 + e[0][0], b1 + e[0][1]), _sum(b0 + e[1][0], b1 + e[1][1])
            sent[i] = (m0, m1)
            up = own[nodes[i].parent]
            up[0] += m0
            up[1] += m1
        belief, both = [own[0]], [None]
        for i in range(1, n):
            e = self.edges[nodes[i].tag == "#text"]
            up, (m0, m1) = belief[nodes[i].parent], sent[i]
            q0, q1 = up[0] - m0, up[1] - m1
            b0, b1 = own[i]
            new = [b0 + _sum(q0 + e[0][0], q1 + e[1][0]), b1 + _sum(q0 + e[0][1], q1 + e[1][1])]
            top = max(new)
            belief.append([new[0] - top, new[1] - top])
            if pairs:
                four = [q0 + e[0][0] + b0, q0 + e[0][1] + b1, q1 + e[1][0] + b0, q1 + e[1][1] + b1]
                top = max(four)
                four = [math.exp(x - top) for x in four]
                total = sum(four)
                both.append([x / total for x in four])
        probs = [1 / (1 + math.exp(min(max(b[0] - b[1], -700), 700))) for b in belief]
        return (probs, both) if pairs else probs

    def fit(self, pages: list[list[Node]], epochs: int = 8, rate: float = 0.3, l2: float = 1e-4) -> TreeModel:
        """Raise the likelihood of the pages' labels by adaptive gradient steps, page by page in order."""
        squares: dict = {}
        data = [(nodes, features(nodes)) for nodes in pages]
        for _ in range(epochs):
            for nodes, feats in data:
                probs, both = self.marginals(nodes, feats, pairs=True)
                slope: dict = {}
                for x, fs, p in zip(nodes, feats, probs):
                    for f in fs:
                        slope[f] = slope.get(f, 0.0) + x.label - p
                for i in range(1, len(nodes)):
                    kind, seen = nodes[i].tag == "#text", nodes[nodes[i].parent].label * 2 + nodes[i].label
                    for k in range(4):
                        key = (kind, k >> 1, k & 1)
                        slope[key] = slope.get(key, 0.0) + (k == seen) - both[i][k]
                for key, g in slope.items():
                    edge = isinstance(key, tuple)
                    w = self.edges[key[0]][key[1]][key[2]] if edge else self.weights.get(key, 0.0)
                    g -= l2 * w
                    squares[key] = squares.get(key, 1e-3) + g * g
                    w += rate * g / math.sqrt(squares[key])
                    if edge:
                        self.edges[key[0]][key[1]][key[2]] = w
                    else:
                        self.weights[key] = w
        return self

    def content(self, page: str, threshold: float = 0.5) -> str:
        """The texts of a page that are content, a block a line."""
        nodes = parse(page)
        probs = self.marginals(nodes, features(nodes))
        return "\n".join(x.text for x, p in zip(nodes, probs) if x.tag == "#text" and p >= threshold)


def texts_under(nodes: list[Node], at: Iterable[int]) -> Iterator[str]:
    """The texts below the given nodes, in order."""
    inside = set(at)
    for i, x in enumerate(nodes):
        if x.parent in inside:
            inside.add(i)
            if x.tag == "#text":
                yield x.text
