"""Marker enrichment against a plain complement, and the size of what its tasks hold."""
import numpy as np


def test_complement_quantiles_equal_plain_ones(spark):
    from cytospark.functions.stats import complement_quantiles
    rng = np.random.default_rng(3)
    rows = [(g, c, float(v)) for g in "abc" for c in ("x", "y") for v in np.round(rng.gamma(2, 10, 400), 1)] + [("a", "x", None), (None, "x", 5.0)]
    # A far value: nearly all others lie in one bin.
    rows += [("b", "y", 1e6), ("c", "y", 7.0), ("c", "y", 7.0)]
    got = complement_quantiles(spark.createDataFrame(rows, "cluster string, channel string, value double"), "cluster", [0.25, 0.5, 0.75], names=["r1", "r2", "r3"])
    found = {(r["cluster"], r["channel"]): [r["r1"], r["r2"], r["r3"]] for r in got.collect()}
    assert len(found) == 6
    for (g, c), q in found.items():
        rest = [v for h, k, v in rows if k == c and h is not None and h != g and v is not None]
        assert np.allclose(q, np.quantile(rest, [0.25, 0.5, 0.75]), rtol=1e-12)


def test_only_target_bins_are_kept_per_value(spark, monkeypatch):
    from cytospark.functions import stats
    from pyspark.sql import functions as F
    kept = []
    monkeypatch.setattr(stats, "cut_lineage", lambda d: kept.append(d.count()) or d)
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("cluster"), F.lit("x").alias("channel"),
                                    F.col("id").cast("double").alias("value"))
    got = stats.complement_quantiles(df, "cluster", [0.5])
    assert sorted(r[2] for r in got.collect()) == [19999.0, 20000.0]
    # Two bins of 4096 at most, of all 40 000 values.
    assert kept and max(kept) <= 40


def test_events_of_a_sample_are_not_brought_into_one_task(spark):
    from helpers import SF001
    from cytospark.sources import fixtures as fx
    name = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = fx.line_events(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, was)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
