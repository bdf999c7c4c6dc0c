"""Spelling variants against plain counting and comparison."""
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cytospark.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_near(words):
    """Near words by all single edits: words that share a deletion variant, then compared."""
    shared = defaultdict(set)
    for w in words:
        shared[w].add(w)
        for i in range(len(w)):
            shared[w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in shared.values():
        for a, b in combinations(group, 2):
            if len(a) == len(b):
                ok = sum(x != y for x, y in zip(a, b)) == 1
            else:
                s, t = sorted((a, b), key=len)
                ok = len(t) == len(s) + 1 and any(t[:i] + t[i + 1:] == s for i in range(len(t)))
            if ok:
                near[a].add(b)
                near[b].add(a)
    return near


def plain(rows):
    words = plain_counts(rows)
    near, form = plain_near(words), {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), None if form[w] is None else words[form[w]]))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_equals_comparing_all_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = plain([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert len(want) > 5000 and got(spelling.spelling_groups(docs)) == want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pairs_of_dense_words(spark, seed):
    """Short words of two letters and longer ones of repeated letters: many ties in the bigram order."""
    import random
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 9))) for _ in range(400)}
    words |= {w + "xyz" * rng.randint(0, 4) for w in list(words)[:60]} | {"a" * k for k in range(5, 30)}
    pairs = {tuple(r) for r in spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    near = plain_near(words)
    assert pairs == {(min(a, b), max(a, b)) for a in near for b in near[a]}


def test_pivots_are_the_rarest_disjoint(spark):
    import random
    rng = random.Random(5)
    for _ in range(300):
        ranks = [rng.randint(0, 6) for _ in range(rng.randint(4, 12))]
        prefix, pivots, last = spelling.choose(ranks)
        assert last == sorted(ranks)[2] and prefix == [i for i, r in enumerate(ranks) if r <= last]
        assert (sum(ranks[i] for i in pivots), pivots) == min(
            (ranks[i] + ranks[j], [i, j]) for i, j in combinations(prefix, 2) if j >= i + 2)


def test_edges(spark):
    text = "colour colour colour color color color color color color colr colr colr"
    long_text = ("harbour " * 200_000) + "harbor " * 3
    rows = [(1, text, 0), (1, text, 0), (2, None, 1), (3, "", 2), (None, "Étoile étoile Étoile ÷÷÷÷÷ " * 3, 3), (4, long_text, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word long").withColumn("n", F.lit("x")).withColumn("KEY", F.lit(1))
    assert got(spelling.spelling_groups(docs)) == plain([(r[0], r[1]) for r in rows])
    assert spelling.spelling_groups(docs.limit(0)).collect() == []


def test_forms_lead_to_the_last(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)], "word string, form string")
    assert {r["root"] for r in spelling.follow(forms).collect()} == {"w37"}
