"""Numeric kernels against brute force, and invariants stated by the reference (FIXTURES §4)."""
import numpy as np
import pytest
from pyspark.sql import functions as F


def brute_silhouette(z, labels):
    n = len(z)
    s = np.zeros(n)
    for i in range(n):
        own = [j for j in range(n) if labels[j] == labels[i] and j != i]
        if not own:
            continue
        a = np.mean([abs(z[i] - z[j]) for j in own])
        b = min(np.mean([abs(z[i] - z[j]) for j in range(n) if labels[j] == g]) for g in set(labels) if g != labels[i])
        s[i] = (b - a) / max(a, b) if max(a, b) > 0 else 0.0
    return s.mean()


@pytest.mark.parametrize("groups", [2, 3, 4])
def test_prefix_sum_silhouette_equals_brute_force(groups):
    from cytospark.operators.cutpoints import silhouette_sorted
    rng = np.random.default_rng(groups)
    z = np.sort(np.concatenate([rng.normal(5 * g, 1, 40) for g in range(groups)]))
    bounds = [0] + [40 * g for g in range(1, groups)] + [len(z)]
    labels = np.repeat(np.arange(groups), 40)
    assert abs(silhouette_sorted(z, bounds) - brute_silhouette(z, labels)) < 1e-12


def test_bisect_two_humps():
    from cytospark.operators.cutpoints import bisect_np, multisect_np
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(0, 1, 1000), rng.normal(5, 1, 1000)])
    cut, sil = bisect_np(x, use_baseline=False, min_x=None)
    assert 1.5 < cut < 3.5 and sil > 0.5
    c4 = multisect_np(x, 4, use_baseline=False, min_x=None)
    assert c4 == sorted(c4) and len(set(c4)) == 3


def test_rev_arcsinh_round_trip(spark):
    from cytospark.operators.transform import arcsinh, rev_arcsinh
    df = spark.createDataFrame([(1, 1, float(v)) for v in (-1e6, -3.5, 0.0, 1e-9, 2.0, 12345.6)], "sample_id int, event_id long, x double")
    back = rev_arcsinh(arcsinh(df, b=1 / 150, a=1.0), a=1.0, b=1 / 150).collect()
    for r, v in zip(back, (-1e6, -3.5, 0.0, 1e-9, 2.0, 12345.6)):
        assert r.x == pytest.approx(v, rel=1e-9, abs=1e-6)


def test_label_shares_sum_to_one(spark):
    from helpers import SF001
    from cytospark.operators import labels, phenotype
    from cytospark.sources import fixtures as fx
    lab = labels.label_events(fx.line_events(spark, SF001), fx.LINE_CUTOFFS)
    c = phenotype.label_composition(lab, fx.LINE_CHANNELS, "cluster")
    plain = c.where(F.col("label").isin("-", "d", "+", "++")).groupBy("cluster", "channel").agg(F.sum("share").alias("s"))
    assert all(abs(r.s - 1) < 1e-12 for r in plain.collect())
    w = {(r.cluster, r.channel, r.label): r.share for r in c.collect()}
    for (cl, ch, lb), v in w.items():
        if lb == "-/d":
            assert v == pytest.approx(w[(cl, ch, "-")] + w[(cl, ch, "d")])


def test_exact_quantiles_match_percentile(spark):
    from cytospark.functions.stats import exact_quantiles
    rng = np.random.default_rng(3)
    rows = [(int(g), float(v)) for g in range(4) for v in rng.normal(g, 1, 50 + 37 * g)] + [(9, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: (r.q_0, r.q_1, r.q_2) for r in exact_quantiles(df, ["g"], "v", [0.05, 0.5, 0.95], accuracy=50).collect()}
    for g in range(4):
        vals = np.array([v for gg, v in rows if gg == g])
        for p, q in zip((0.05, 0.5, 0.95), got[g]):
            assert q == pytest.approx(np.quantile(vals, p), rel=1e-12)
    assert got[9] == (None, None, None)


def test_rank_within_is_exact(spark):
    from cytospark.functions.order import rank_within
    rows = [(i % 3, i, float((i * 7919) % 1000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, id long, t double")
    got = {r.id: r.rank for r in rank_within(df, ["g"], ["t", "id"], partitions=7).collect()}
    for g in range(3):
        order = sorted((t, i) for gg, i, t in rows if gg == g)
        for rank, (_, i) in enumerate(order):
            assert got[i] == rank


def test_merge_exclusive_greedy():
    from cytospark.operators.phenotype import exclusive_groups
    cooc = {("orig", "a"): 5, ("orig", "b"): 5, ("orig", "c"): 5, ("a", "b"): 0, ("a", "c"): 3, ("b", "c"): 0}
    assert exclusive_groups(cooc, ["orig", "a", "b", "c"]) == [["orig"], ["a", "b"], ["c"]]
    assert exclusive_groups({}, ["x", "y"]) == [["x"], ["y"]]


def test_resolve_query_nearest_state(spark):
    from cytospark.operators.phenotype import resolve_query, terms_frame
    r = {x.term: x.state for x in resolve_query(terms_frame(spark, ["CD4+", "cd8+/++ || cd3-"]), ["cd4", "cd8", "cd3"]).collect()}
    assert r == {"CD4+": "cd4+", "cd8+/++": "cd8+/++", "cd3-": "cd3-"}
