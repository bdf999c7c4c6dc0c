"""Exact grouped quantiles that never hold a whole group in one task.

Spark's exact ``percentile`` keeps every distinct value of a group in its aggregation buffer, so one
sample holding a third of the rows would land in a single task.  Here each quantile is found in two
passes over the data:

1. per group: ``count``, ``min``, ``max`` and a ``percentile_approx`` bracket around each requested
   probability (rank error of the sketch is at most n/accuracy, so the bracket p ± 2/accuracy is sure
   to hold the target ranks);
2. per group and probability: the number of values below the bracket, and the distinct values inside it
   with their counts (ties are one row, however many) and a running count, from which the two order
   statistics around rank p·(n−1) are read and interpolated linearly (R type 7, DuckDB
   ``quantile_cont``, Spark ``percentile``).

The passes are hash aggregates with map-side partial aggregation; the only per-group state is the
sketch and the bracket.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cytospark.functions.plan import checked_side
from cytospark.session import cut_lineage

DEFAULT_ACCURACY = 100_000


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                    accuracy: int = DEFAULT_ACCURACY, names: Sequence[str] | None = None) -> DataFrame:
    """One row per group of ``keys`` with one column per probability (NULLs ignored, empty → NULL).

    Column names default to ``q_<i>``.
    """
    keys = list(keys)
    probs = [float(p) for p in probs]
    names = list(names) if names else [f"q_{i}" for i in range(len(probs))]
    eps = 2.0 / accuracy
    lo_ps = [max(p - eps, 0.0) for p in probs]
    hi_ps = [min(p + eps, 1.0) for p in probs]
    v = F.col(value).cast("double")
    stats = df.groupBy(*keys).agg(
        F.count(v).alias("_n"), F.min(v).alias("_mn"), F.max(v).alias("_mx"),
        F.percentile_approx(v, lo_ps + hi_ps, accuracy).alias("_br"))
    k = len(probs)
    bounds = []
    for i in range(k):
        lo = F.when(F.lit(lo_ps[i]) <= 0.0, F.col("_mn")).otherwise(F.col("_br")[i])
        hi = F.when(F.lit(hi_ps[i]) >= 1.0, F.col("_mx")).otherwise(F.col("_br")[k + i])
        bounds += [lo.alias(f"_lo{i}"), hi.alias(f"_hi{i}")]
    stats = checked_side(stats.select(*keys, "_n", *bounds))
    # Pass 2, one aggregate: per probability a row for all values below its bracket, one for all above, and one
    # for each distinct value inside.  A running count in that order gives every row its range of ranks.
    # (The bracket table has one row per group; broadcast when its measured size allows.)
    j = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull()).join(stats, keys) if keys else \
        df.select(v.alias("_v")).where(F.col("_v").isNotNull()).crossJoin(stats)
    side = [F.struct(F.lit(i).alias("i"), F.when(F.col("_v") < F.col(f"_lo{i}"), -1).when(F.col("_v") > F.col(f"_hi{i}"), 1)
                     .otherwise(0).alias("t")) for i in range(k)]
    counted = j.select(*keys, "_n", "_v", F.explode(F.array(*side)).alias("_s")) \
        .groupBy(*keys, F.col("_s.i").alias("_i"), F.col("_s.t").alias("_t"),
                 F.when(F.col("_s.t") == 0, F.col("_v")).alias("_x")) \
        .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"), F.first("_n").alias("_n"))
    w = Window.partitionBy(*keys, "_i").orderBy("_t", "_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_end", F.sum("_c").over(w)).withColumn("_start", F.col("_end") - F.col("_c"))
    p_of = F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("_i") + 1)
    ranked = ranked.withColumn("_h", p_of * (F.col("_n") - 1)).withColumn("_f", F.floor("_h"))

    def at(rank: Column) -> Column:
        """The value at a rank (from 0), if it is this row's: of values outside only the one next to the bracket."""
        return F.when((F.col("_t") == 0) & (F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_x")) \
            .when((F.col("_t") < 0) & (rank == F.col("_end") - 1), F.col("_mx")) \
            .when((F.col("_t") > 0) & (rank == F.col("_start")), F.col("_mn"))
    picks = []
    for i in range(k):
        mine = F.col("_i") == i
        picks += [F.max(F.when(mine, at(F.col("_f")))).alias(f"_x{i}"), F.max(F.when(mine, at(F.col("_f") + 1))).alias(f"_y{i}"),
                  F.max(F.when(mine, F.col("_h") - F.col("_f"))).alias(f"_r{i}")]
    picked = ranked.groupBy(*keys).agg(*picks)
    outs = [F.when(F.col(f"_r{i}") == 0, F.col(f"_x{i}")).otherwise(
        F.col(f"_x{i}") + F.col(f"_r{i}") * (F.col(f"_y{i}") - F.col(f"_x{i}"))).alias(names[i]) for i in range(k)]
    res = picked.select(*keys, *outs)
    # groups whose values are all NULL keep a row with NULL quantiles
    return stats.select(*keys).join(res, keys, "left") if keys else res


def long_form(df: DataFrame, keys: Sequence[str], channels: Sequence[str], name: str = "channel",
              value: str = "value") -> DataFrame:
    """``unpivot`` of channel columns into ``(keys…, channel, value)``."""
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in channels]) \
        .unpivot(list(keys), list(channels), name, value)


def channel_quantiles(df: DataFrame, keys: Sequence[str], channels: Sequence[str], probs: Sequence[float],
                      names: Sequence[str] | None = None, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Exact quantiles of every channel per group, long form ``(keys…, channel, q…)``."""
    lf = long_form(df, keys, channels)
    return exact_quantiles(lf, list(keys) + ["channel"], "value", probs, accuracy, names)


def complement_quantiles(lf: DataFrame, group: str, probs: Sequence[float], key: str = "channel",
                         value: str = "value", bins: int = 4096, names: Sequence[str] | None = None) -> DataFrame:
    """Exact type-7 quantiles, per group and ``key``, of all rows **not** in the group.

    Per key, values are binned on ``bins`` equal-width bins; the complement's bin counts are the
    key's counts minus the group's, so a small grouped task per (group, key) finds the bins holding
    the two order statistics of every probability.  The distinct values of
    those bins alone are then counted over all groups and in the group, and the differences are read in
    order; no event is paired with another group."""
    import numpy as np
    import pandas as pd

    names = list(names) if names else [f"q_{i}" for i in range(len(probs))]
    probs = [float(p) for p in probs]
    v = F.col(value).cast("double")
    src = lf.where(v.isNotNull() & F.col(group).isNotNull()).select(group, key, v.alias("_v"))
    rng = checked_side(src.groupBy(key).agg(F.min("_v").alias("_mn"), F.max("_v").alias("_mx")))
    b = src.join(rng, key).withColumn(
        "_bin", F.least(F.greatest(F.floor(F.try_divide(F.col("_v") - F.col("_mn"), (F.col("_mx") - F.col("_mn")) / bins)),
                                   F.lit(0)), F.lit(bins - 1)).cast("int"))
    b = b.withColumn("_bin", F.coalesce("_bin", F.lit(0)))
    hist = b.groupBy(group, key, "_bin").agg(F.count(F.lit(1)).alias("_c"))
    allh = hist.groupBy(key, "_bin").agg(F.sum("_c").alias("_a"))
    # dense arrays per key and per (group, key): bins numbers each
    tot = allh.groupBy(key).agg(F.collect_list(F.struct("_bin", "_a")).alias("_all"))
    grp = hist.groupBy(group, key).agg(F.collect_list(F.struct("_bin", "_c")).alias("_own"))
    task_in = grp.join(checked_side(tot), key)
    gtype = lf.schema[group].dataType.simpleString()

    def locate(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            a = np.zeros(bins, dtype=np.int64)
            o = np.zeros(bins, dtype=np.int64)
            for s in r["_all"]:
                a[s["_bin"]] += s["_a"]
            for s in r["_own"]:
                o[s["_bin"]] += s["_c"]
            comp = a - o
            cum = np.cumsum(comp)
            m = int(cum[-1]) if bins else 0
            for pi, p in enumerate(probs):
                if m == 0:
                    continue
                h = p * (m - 1)
                i0 = int(np.floor(h))
                for rank in sorted({i0, min(i0 + 1, m - 1)}):
                    bi = int(np.searchsorted(cum, rank, side="right"))
                    before = int(cum[bi - 1]) if bi > 0 else 0
                    out.append((r[group], r[key], pi, rank, bi, rank - before, m))
        return pd.DataFrame(out, columns=[group, key, "_p", "_rank", "_bin", "_pos", "_m"])

    tgt = task_in.groupBy(group, key).applyInPandas(
        locate, f"{group} {gtype}, {key} string, _p int, _rank long, _bin int, _pos long, _m long")
    tgt = checked_side(tgt)
    # Distinct values of the target bins with their counts in all groups, less those of the group itself.
    # Rows of other bins are left out before anything is kept per value.
    tb = tgt.select(F.col(group).alias("_g"), key, "_bin").distinct()
    inside = b.join(checked_side(tb.select(key, "_bin").distinct()), [key, "_bin"], "left_semi")
    own = cut_lineage(inside.groupBy(F.col(group).alias("_g"), key, "_bin", "_v").agg(F.count(F.lit(1)).alias("_o")))
    whole = own.groupBy(key, "_bin", "_v").agg(F.sum("_o").alias("_a"))
    left = whole.join(checked_side(tb), [key, "_bin"]).join(own, ["_g", key, "_bin", "_v"], "left") \
        .withColumn("_c", F.col("_a") - F.coalesce("_o", F.lit(0))).where(F.col("_c") > 0)
    w = Window.partitionBy("_g", key, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    vals = left.withColumn("_cum", F.sum("_c").over(w)).select(F.col("_g").alias(group), key, "_bin", "_v", "_c", "_cum")
    picked = tgt.join(vals, [group, key, "_bin"]).where((F.col("_cum") - F.col("_c") <= F.col("_pos")) & (F.col("_pos") < F.col("_cum"))) \
        .withColumn("_x", F.col("_v"))
    pv = picked.groupBy(group, key, "_p").agg(
        F.min(F.struct("_rank", "_x")).alias("_lo"), F.max(F.struct("_rank", "_x")).alias("_hi"), F.first("_m").alias("_m"))
    outs = []
    for pi, p in enumerate(probs):
        h = F.lit(p) * (F.col("_m") - 1)
        frac = h - F.floor(h)
        val = F.col("_lo._x") + frac * (F.col("_hi._x") - F.col("_lo._x"))
        outs.append(F.max(F.when(F.col("_p") == pi, F.when(frac == 0, F.col("_lo._x")).otherwise(val))).alias(names[pi]))
    return pv.groupBy(group, key).agg(*outs)
