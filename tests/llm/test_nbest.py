import random

import numpy as np
import pytest

from cytospark.llm import nbest as N


@pytest.fixture(scope="module")
def vocabulary():
    return N.Vocabulary(N.piece_path())


def every(vocabulary, text):
    """All segmentations of a normalised text, best first."""
    ends = vocabulary.arcs(text)

    def upto(j):
        if j == 0:
            return [(0.0, ())]
        return [(score + s, ids + piece) for i, piece, s in ends[j] for score, ids in upto(i)]
    return sorted(upto(len(text)), key=lambda x: -x[0])


def test_nbest_equals_all_paths(vocabulary):
    rng = random.Random(5)
    seg = N.Segmenter(vocabulary, 4)
    for _ in range(300):
        text = "".join(rng.choice("the an,.!  éあ\nx") for _ in range(rng.randint(0, 9)))
        paths = every(vocabulary, vocabulary.normalize(text))
        got = seg.text(text)
        scores = {ids: s for s, ids in paths}
        assert [s for s, _ in got] == [s for s, _ in paths][:4] and len(got) == min(4, len(paths))
        unpacked = [tuple(np.frombuffer(ids, "<u4").tolist()) for _, ids in got]
        assert len(set(unpacked)) == len(got) and all(scores[ids] == s for ids, (s, _) in zip(unpacked, got))
        assert all(vocabulary.decode(ids) == text for ids in unpacked)


def test_single_word_search_of_any_length(vocabulary):
    for word in ("▁international", "▁" + "ab" * 6, "▁x"):
        assert [s for s, _ in vocabulary.search(word, 7)] == [s for s, _ in every(vocabulary, word)][:7]
    s, ids = vocabulary.search("▁" + "abcd" * 5000, 2)[1]
    assert vocabulary.spell(ids) == "▁" + "abcd" * 5000


def test_units_join_to_the_text_and_no_piece_spans_them(vocabulary):
    for text in ("a, b.c (d) 1.5 x", "▁▁a", "…a.b", "é.é,  ..", "don't stop-it"):
        norm = vocabulary.normalize(text)
        units = vocabulary.unit.findall(norm)
        assert "".join(units) == norm
        cuts = set(np.cumsum([len(u) for u in units]).tolist()[:-1])
        for j, arcs in enumerate(vocabulary.arcs(norm)):
            assert all(not any(i < c < j for c in cuts) for i, _, _ in arcs)


def test_table_round_trip_and_edge_cases(docs_of, spark):
    rows = [(1, "hello there, world"), (2, None), (3, ""), (4, "x"), (4, "x"), (None, "  two  blanks\n"), (5, "word " * 4000)]
    docs = docs_of(rows).selectExpr("*", "1 AS rank", "2 AS score", "3 AS ids")
    got = N.n_best(docs, with_ids=True)
    back = N.decode(got, "ids", "spelt").collect()
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t or "")
    assert all(r["spelt"] == texts[r["doc_id"]] and r["n_pieces"] == len(r["ids"]) for r in back)
    assert sorted(r["rank"] for r in back if r["doc_id"] == 1) == [1, 2, 3, 4]
    assert [(r["rank"], r["score"], r["n_pieces"]) for r in back if r["doc_id"] in (2, 3)] == [(1, 0.0, 0)] * 2
    assert N.n_best(docs_of([])).count() == 0
