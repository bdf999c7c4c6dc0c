"""Data folders, planted blobs and scores shared by the tests."""
from __future__ import annotations

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def blobs(n_per=200, centers=((0, 0, 0), (8, 8, 0), (0, 8, 8)), sd=0.6, seed=1):
    import numpy as np
    rng = np.random.default_rng(seed)
    rows = []
    eid = 0
    for ci, c in enumerate(centers):
        for _ in range(n_per):
            v = rng.normal(c, sd)
            rows.append((eid % 3, eid, *map(float, v), str(ci)))
            eid += 1
    return rows


def adjusted_rand(a, b):
    """Adjusted Rand index of two labelings (lists)."""
    from collections import Counter
    from math import comb
    n = len(a)
    pairs = Counter(zip(a, b))
    sa, sb = Counter(a), Counter(b)
    s_ij = sum(comb(v, 2) for v in pairs.values())
    s_a = sum(comb(v, 2) for v in sa.values())
    s_b = sum(comb(v, 2) for v in sb.values())
    exp = s_a * s_b / comb(n, 2)
    mx = (s_a + s_b) / 2
    return 1.0 if mx == exp else (s_ij - exp) / (mx - exp)
