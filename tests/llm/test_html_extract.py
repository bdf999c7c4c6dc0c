import itertools
import math
import random

import pytest

from cytospark.llm import html_extract as H
from cytospark.llm.html_tree import Node, TreeModel, features, parse, texts_under


def test_marginals_equal_enumeration():
    rng = random.Random(1)
    for _ in range(30):
        nodes = [Node(-1, "#root")] + [Node(rng.randrange(i), rng.choice(["div", "#text"])) for i in range(1, rng.randint(2, 8))]
        feats = [[f"f{rng.randrange(4)}"] for _ in nodes]
        m = TreeModel()
        m.weights = {f"f{k}": rng.uniform(-2, 2) for k in range(4)}
        m.edges = [[[rng.uniform(-2, 2) for _ in range(2)] for _ in range(2)] for _ in range(2)]
        total, on, both = 0.0, [0.0] * len(nodes), {}
        for y in itertools.product((0, 1), repeat=len(nodes)):
            s = sum(m.weights[f[0]] * v for f, v in zip(feats, y))
            s += sum(m.edges[x.tag == "#text"][y[x.parent]][y[i]] for i, x in enumerate(nodes) if i)
            p = math.exp(s)
            total += p
            for i, v in enumerate(y):
                on[i] += p * v
                if i:
                    key = (i, y[nodes[i].parent] * 2 + v)
                    both[key] = both.get(key, 0.0) + p
        probs, pairs = m.marginals(nodes, feats, pairs=True)
        assert probs == pytest.approx([x / total for x in on])
        for (i, k), p in both.items():
            assert pairs[i][k] == pytest.approx(p / total)


def blocks(page):
    return [x.text for x in parse(page) if x.tag == "#text"]


def test_parser_reads_blocks_as_they_show():
    assert blocks("<p>a <b>b</b>\n\tc<p>d&amp;e&nbsp;f<br>g") == ["a b c", "d&e f g"]
    assert blocks("<title>t</title><script>x('</p>')</script><style>p{}</style><!-- c <p> -->ok<noscript>n</noscript>") == ["ok"]
    assert blocks("<ul><li>1<li>2<ul><li>3</ul><li>4</ul>") == ["1", "2", "3", "4"]
    assert blocks("<a href='x>y'>l</a> 1 < 2 & 3 <table><tr><td>a<td>b<tr><td>c</table>") == ["l 1 < 2 & 3", "a", "b", "c"]
    assert blocks("") == [] and blocks("<div><p></p></div>") == [] and blocks("plain") == ["plain"]
    assert blocks("<div>" * 3000 + "deep") == ["deep"]
    assert blocks('<a title="open>text <p>more') != []


@pytest.fixture(scope="module")
def model():
    rng = random.Random(3)
    def prose():
        return " ".join(rng.choice("lorem ipsum dolor, sit amet. consectetur elit sed, do".split()) for _ in range(rng.randint(3, 80)))
    articles = [[prose()[:60], *[prose() for _ in range(rng.randint(2, 12))]] for _ in range(120)]
    return TreeModel().fit(H.training_pages(articles[:100], 4)), articles[100:]


def test_held_out_layouts(model):
    judge, articles = model
    right = total = 0
    for nodes in H.training_pages(articles, 6, seed=77):
        for x, p in zip(nodes, judge.marginals(nodes, features(nodes))):
            if x.tag == "#text":
                right += (p >= 0.5) == x.label
                total += 1
    assert right >= 0.95 * total


def test_a_page_with_all_kinds_of_parts(model):
    page = """<html><head><title>T</title></head><body><div id="cookie-banner"><p>We use cookies, of course. Accept all of them?</p></div>
<header><div>My Site</div><nav><a href=/>Home</a> <a href=/x>About</a></nav></header><article><h1>Big title &amp; more</h1>
<p>First  para with <b>bold</b> &eacute;text, long enough to be content, with a stop.</p><div class="advert"><p>Buy now, the best thing ever!</p></div>
<p>Second para, with <a href=x>a link</a> inside of it, and more words.</p></article><aside><h3>Related</h3><ul><li><a href=y>Other story</a></li></ul></aside>
<section id="comments"><h2>Comments</h2><div class="comment"><p>Great article, thanks for writing it.</p></div></section>
<form><label>Email</label><p>Subscribe to us.</p></form><footer><p>Copyright 2020, all rights reserved.</p></footer></body></html>"""
    assert model[0].content(page) == ("Big title & more\nFirst para with bold étext, long enough to be content, with a stop.\n"
                                      "Second para, with a link inside of it, and more words.")


def test_table_pages_give_their_articles_and_odd_rows_pass(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    more = spark.createDataFrame([(-1, "u", None), (-2, None, ""), (None, "u", "<div><br></div>"), (-3, "u", "<p>" * 50000)], pages.schema)
    got = H.extract(pages.unionByName(more).selectExpr("*", "1 AS extra"))
    assert got.columns == ["page_id", "url", "extra", "text", "n_chars"]
    found = {r["page_id"]: r for r in got.collect()}
    assert [found[i]["text"] for i in (-1, -2, None, -3)] == [""] * 4
    right = 0
    for r in pages.collect():
        nodes = parse(r["html"])
        want = "\n".join(texts_under(nodes, [i for i, x in enumerate(nodes) if x.tag == "article"]))
        right += found[r["page_id"]]["text"] == want
        assert found[r["page_id"]]["n_chars"] == len(found[r["page_id"]]["text"])
    assert right >= 0.95 * pages.count()
    assert H.extract(spark.createDataFrame([], pages.schema)).count() == 0


def test_columns_with_the_names_of_results_are_replaced(spark):
    from cytospark.llm import html_extract
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").selectExpr("page_id", "1 AS text", "html", "'x' AS N_CHARS", "2 AS block")
    out = html_extract.extract(pages)
    assert out.columns == ["page_id", "block", "text", "n_chars"]
    assert all(r["n_chars"] == len(r["text"]) > 0 for r in out.collect())
