import random

import numpy as np
import pytest

from cytospark.llm import weak_quality as W


def test_label_model_finds_the_labellers_accuracies():
    rng = random.Random(1)
    rates = [0.95, 0.9, 0.85, 0.7, 0.6, 0.9]
    patterns, truth = {}, {}
    for _ in range(20000):
        good = rng.random() < 0.8
        p = "".join("." if rng.random() < 0.2 else "+" if (rng.random() < r) == good else "-" for r in rates)
        patterns[p] = patterns.get(p, 0) + 1
        truth[p] = truth.get(p, 0) + good
    posterior, found = W.label_model(patterns)
    assert found["prior"] == pytest.approx(0.8, abs=0.05)
    for k, r in enumerate(rates):
        assert found["rates"][k][1][W.GOOD] == pytest.approx(r, abs=0.05) and found["rates"][k][0][W.BAD] == pytest.approx(r, abs=0.08)
    right = sum(max(n - truth[p], truth[p]) if (posterior[p] >= 0.5) == (truth[p] * 2 >= n) else min(n - truth[p], truth[p])
                for p, n in patterns.items())
    assert right >= 0.9 * 20000


def test_junk_goes_and_clean_text_stays(docs_of):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randint(4, 8))) for _ in range(300)]
    def clean():
        return "\n".join(" ".join(rng.choice(words) for _ in range(15)).capitalize() + "." for _ in range(rng.randint(6, 20)))
    rows = [(i, clean()) for i in range(300)]
    rows += [(1000 + i, clean().upper().replace(" ", "!! ")) for i in range(20)] + [(1100 + i, "buy now " * 60) for i in range(20)]
    rows += [(1200 + i, clean().replace(" ", "*** ")) for i in range(20)] + [(5000, None), (5001, ""), (5002, "one"), (None, clean()), (7, rows[7][1])]
    docs = docs_of(rows).selectExpr("*", "1 AS votes", "2 AS score", "3 AS k")
    got = [(r["doc_id"], r["kept"], r["score"], r["posterior"]) for r in W.weak_quality(docs, sample_docs=200).collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 and 0 <= p <= 1 for _, _, s, p in got)
    kept = {}
    for i, k, _, _ in got:
        kept.setdefault(i, []).append(k)
    assert sum(kept[i][0] for i in range(300)) >= 0.98 * 300 and kept[None] == [True]
    assert sum(kept[i][0] for i in kept if i is not None and 1000 <= i < 1300) <= 6
    assert len(kept[7]) == 2 and kept[7][0] == kept[7][1]


def test_empty_table_and_training_by_order(docs_of):
    assert W.weak_quality(docs_of([])).count() == 0
    rows = [(np.array([1, 5]), np.array([0.6, 0.8], np.float32), 1.0), (np.array([2, 5]), np.array([0.6, 0.8], np.float32), 0.0)] * 20
    w, bias = W.train(rows)
    assert w[1] > 0 > w[2]
