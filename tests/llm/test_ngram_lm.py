import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cytospark.llm import ngram_lm as L


def corpus():
    rng = random.Random(1)
    words = "the of a Cat cat dog ran é sat x".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(150)]
    return rows + [(500, None), (501, ""), (502, " \n\t"), (503, "unseen words"), (503, "the cat"), (None, "the cat")]


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def out_of_training(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("max_bytes", [L.MAX_BYTES, 1])
def test_scores_equal_brute_force(docs_of, max_bytes):
    rows = corpus()
    one, two, starts = Counter(), Counter(), 0
    for i, t in rows:
        if not out_of_training(i):
            ts = tokens(t)
            one.update(ts)
            two.update(zip([0, *ts], ts))
            starts += 1
    n, v = sum(one.values()), len(one)
    seen = lambda c: float(L.count_at(L.level_of(np.array([c])))[0]) if c else 0.0
    want = []
    for i, t in rows:
        ts = tokens(t)
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in ts)
        score = 0.0
        for u, w in zip([0, *ts], ts):
            ctx = seen(starts if u == 0 else one[u])
            p = (seen(one[w]) + 1) / (n + v + 1)
            score += math.log10((min(seen(two[u, w]), ctx, seen(one[w])) + L.MU * p) / (ctx + L.MU))
        want.append((i, out_of_training(i), len(ts), sum(one[w] > 0 for w in ts), n, base, score))
    got = sorted(map(tuple, L.lm_scores(docs_of(rows), max_bytes=max_bytes).collect()), key=str)
    for g, w in zip(got, sorted(want, key=str)):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], abs=1e-9)
        # A false hit of the filter can only raise a level; with a few hundred entries it is rare.
        assert g[6] == pytest.approx(w[6], abs=1e-9 if max_bytes == 1 else 1.0)
    assert sum(abs(g[6] - w[6]) < 1e-9 for g, w in zip(got, sorted(want, key=str))) >= 0.7 * len(want)


def test_filter_never_loses_and_rarely_adds():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**64, 20000, dtype=np.uint64))
    levels = rng.integers(1, 4, len(keys))
    parts, bits = 4, int(levels.sum()) * L.BITS_PER_ENTRY // 32 * 8
    on = np.zeros((parts, bits), dtype=np.uint8)
    part = L._part(keys, parts)
    for level in range(1, 4):
        mine = levels >= level
        for at in L._probe_bits(keys[mine], level, bits):
            on[part[mine], at] = 1
    bloom = L.BloomCounts(np.packbits(on, axis=1, bitorder="little").reshape(-1), parts, bits)
    found = bloom.levels(keys)
    assert (found >= levels).all() and (found > levels).mean() < 0.02
    other = rng.integers(0, 2**64, 20000, dtype=np.uint64)
    assert (bloom.levels(other) > 0).mean() < 0.02


def test_counts_pack_and_levels_hold_their_counts():
    counts = np.array([1, 2, 254, 255, 256, 10**12, 3])
    assert L._wide(L._narrow(counts), len(counts)).tolist() == counts.tolist()
    for c in range(1, 300):
        level = int(L.level_of(np.array([c]))[0])
        assert L.QUANT ** (level - 1) <= c * (1 + 1e-9) and c < L.QUANT ** level * (1 + 1e-9)


def test_bigrams_beat_unigrams_on_held_out_text(docs_of):
    rng = random.Random(2)
    follow = {w: rng.sample(range(60), 4) for w in range(60)}
    rows = []
    for i in range(300):
        w, out = rng.randrange(60), []
        for _ in range(40):
            out.append(f"w{w}")
            w = rng.choice(follow[w])
        rows.append((i, " ".join(out)))
    held = [r for r in L.lm_scores(docs_of(rows)).collect() if r["held_out"]]
    assert held and all(r["score"] > r["base_score"] for r in held)


def test_empty_table_and_no_training_rows(docs_of):
    assert L.lm_scores(docs_of([])).count() == 0
    i = next(k for k in range(100) if out_of_training(k))
    r = L.lm_scores(docs_of([(i, "a b")])).first()
    assert (r["train_tokens"], r["n_known"], r["n_tokens"], r["base_score"], r["score"]) == (0, 0, 3, 0.0, 0.0)


def test_filter_in_parts_gives_the_scores_of_the_broadcast_filter(docs_of, monkeypatch):
    # Few bits an entry: many false hits, which both ways must have.  Small blocks and parts: many of them, and salts.
    for name, value in (("BITS_PER_ENTRY", 3), ("BLOCK_BYTES", 2000), ("PART_BYTES", 300)):
        monkeypatch.setattr(L, name, value)
    rng = random.Random(4)
    held = next(k for k in range(100) if out_of_training(k))
    text = lambda n: " ".join(f"w{int(rng.paretovariate(0.4)) % 900}" for _ in range(n))
    rows = [(i, text(rng.randint(0, 30))) for i in range(100)] + [(held, text(40)) for _ in range(900)] + [(None, None), (held, "")]
    small, large = (sorted(map(tuple, L.lm_scores(docs_of(rows), max_bytes=b).collect()), key=lambda r: (str(r[0]), *r[2:4], r[5], r[6]))
                    for b in (L.MAX_BYTES, 1))
    assert len(small) == len(large) == len(rows)
    for a, b in zip(small, large):
        assert a[:5] == b[:5]
        assert b[5:] == pytest.approx(a[5:], abs=1e-9)


def test_no_training_rows_with_the_filter_in_parts(docs_of):
    assert L.lm_scores(docs_of([]), max_bytes=1).count() == 0
    i = next(k for k in range(100) if out_of_training(k))
    r = L.lm_scores(docs_of([(i, "a b")]), max_bytes=1).first()
    assert (r["train_tokens"], r["n_known"], r["n_tokens"], r["base_score"], r["score"]) == (0, 0, 3, 0.0, 0.0)
