"""Report tables: the data behind the reference's plots and spreadsheets (A5, A8, G10, G12, L1–L4,
L6, L7, L10)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cytospark.functions.expr import REPORT_MERGED_LABELS, cluster_sort_key
from cytospark.functions.plan import checked_side
from cytospark.functions.stats import channel_quantiles, long_form


def count_events(df: DataFrame, by: str = "sample_id") -> DataFrame:
    """Events per sample (A8)."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_events"))


def channel_ranges(df: DataFrame, channels: Sequence[str], desc: dict | None = None) -> DataFrame:
    """Per channel ``name, desc, min_range, max_range, range`` (A5): one aggregate over all channels."""
    aggs = []
    for c in channels:
        aggs += [F.min(c).cast("double").alias(f"_mn_{c}"), F.max(c).cast("double").alias(f"_mx_{c}")]
    w = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("name"), F.lit((desc or {}).get(c)).cast("string").alias("desc"),
                     F.col(f"_mn_{c}").alias("min_range"), F.col(f"_mx_{c}").alias("max_range"),
                     (F.col(f"_mx_{c}") - F.col(f"_mn_{c}")).alias("range")) for c in channels]
    return w.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def cluster_sizes(df: DataFrame, by: str = "cluster") -> DataFrame:
    """Events per cluster, NULL cluster included (G12)."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def centroids(df: DataFrame, channels: Sequence[str], by: Sequence[str] = ("sample_id", "cluster"),
              fun: str = "median") -> DataFrame:
    """Per group, the median (exact, type 7) or mean of every channel, NULLs ignored (G10).  Wide."""
    by = list(by)
    if fun == "mean":
        return df.groupBy(*by).agg(*[F.avg(c).alias(c) for c in channels])
    if callable(fun):
        return df.groupBy(*by).agg(*[fun(F.col(c)).alias(c) for c in channels])
    lq = channel_quantiles(df.where(F.col(by[-1]).isNotNull()), by, channels, [0.5], names=["median"])
    return lq.groupBy(*by).pivot("channel", list(channels)).agg(F.first("median"))


def cluster_medians(df: DataFrame, channels: Sequence[str], by: str = "cluster") -> DataFrame:
    """Median of each channel per cluster, NULL cluster left out (L2).  Long ``(by, channel, median)``."""
    return channel_quantiles(df.where(F.col(by).isNotNull()), [by], channels, [0.5], names=["median"])


def scale_medians(medians: DataFrame, by: str = "cluster", value: str = "median") -> DataFrame:
    """Z-scores of the medians (L3): ``z_channel`` per channel over clusters, ``z_cluster`` per
    cluster over channels (n−1 sd; NULL where the sd is 0 or undefined).  Windows run over the
    cluster × channel table, which is small."""
    wc = W.partitionBy("channel")
    wk = W.partitionBy(by)
    v = F.col(value)
    return medians.select(
        "*",
        ((v - F.avg(v).over(wc)) / F.nullif(F.stddev_samp(v).over(wc), F.lit(0.0))).alias("z_channel"),
        ((v - F.avg(v).over(wk)) / F.nullif(F.stddev_samp(v).over(wk), F.lit(0.0))).alias("z_cluster"))


def cell_counts(start: DataFrame, gated: DataFrame, meta: DataFrame | None = None, by: str = "sample_id") -> DataFrame:
    """Per sample: starting and gated counts, with the sample's group (L1)."""
    s = start.groupBy(by).agg(F.count(F.lit(1)).alias("n_start"))
    g = gated.groupBy(by).agg(F.count(F.lit(1)).alias("n_gated"))
    out = s.join(g, by, "left").withColumn("n_gated", F.coalesce("n_gated", F.lit(0)).cast("long"))
    if meta is not None:
        out = out.join(meta.select(by, "id", "group"), by, "left")
    return out


def phenotype_table(summary: DataFrame, by: str = "cluster", sep: str = ",") -> DataFrame:
    """Cluster × channel table of labels (L4), long ``(by, channel, labels)`` with only the report's
    merged labels (``-/d``, ``+/++``) kept beside the plain ones."""
    keep = ["-", "d", "+", "++"] + list(REPORT_MERGED_LABELS)
    s = summary.where(F.col("label").isin(*keep))
    return s.groupBy(by, "channel").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("label_no", "label"))), lambda x: x["label"]),
                     sep).alias("labels"))


def embedding_centroids(df: DataFrame, x: str = "dim1", y: str = "dim2", cluster: str = "cluster",
                        sample: str = "sample_id", group: str = "group") -> DataFrame:
    """Mean position per cluster, sample, group, sample×cluster and group×cluster (L6), long form
    ``(grouping, cluster, sample_id, group, x, y, n)``.  The one-way groupings come from one
    grouping-sets aggregate; the two crossed ones are completed to full grids (``n = 0`` and NULL
    means where a sample or group has no event of the cluster) by pivoting on the cluster ids and
    unpivoting back, so no join is needed."""
    base = df.select(x, y, cluster, sample, group).where(F.col(cluster).isNotNull())
    gs = base.groupingSets([[cluster], [sample], [group]], cluster, sample, group).agg(
        F.avg(x).alias("x"), F.avg(y).alias("y"), F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_gid"))
    tag = F.when(F.col("_gid") == 3, "cluster").when(F.col("_gid") == 5, "sample").otherwise("group")
    one = gs.withColumn("grouping", tag).drop("_gid")
    ids = [r[0] for r in base.select(cluster).distinct().collect()]          # cluster ids (report size)
    cols = ["grouping", cluster, sample, group, "x", "y", "n"]
    out = one.select(*cols)
    for key, name in ((sample, "sample_cluster"), (group, "group_cluster")):
        wide = base.groupBy(key).pivot(cluster, ids).agg(
            F.struct(F.avg(x).alias("x"), F.avg(y).alias("y"), F.count(F.lit(1)).alias("n")))
        lng = wide.unpivot([key], ids, cluster, "_s")
        full = lng.select(F.lit(name).alias("grouping"), cluster, key, "_s.x", "_s.y",
                          F.coalesce("_s.n", F.lit(0)).alias("n"))
        other = group if key == sample else sample
        full = full.withColumn(other, F.lit(None).cast(base.schema[other].dataType))
        out = out.unionByName(full.select(*cols))
    return out


def differential_overlay(df: DataFrame, results: DataFrame, meta: DataFrame | None = None,
                         alpha: float = 0.05, by: str = "cluster", sample: str = "sample_id") -> DataFrame:
    """Events ⟕ test results by cluster ⟕ metadata by sample (L7); ``logFC := 0`` where FDR > alpha,
    untested clusters stay NULL; empty when no cluster has FDR ≤ alpha."""
    r = checked_side(results.select(by, "logFC", "FDR"))
    out = df.join(r, by, "left")
    if meta is not None:
        out = out.join(meta, sample, "left")
    out = out.withColumn("logFC", F.when(F.col("FDR") > alpha, F.lit(0.0)).otherwise(F.col("logFC")))
    if r.where(F.col("FDR") <= alpha).limit(1).count() == 0:   # one number from the small results table
        return out.limit(0)
    return out


def gating_extents(df: DataFrame, channels: Sequence[str], cutoffs: DataFrame | None = None,
                   by: str | None = None) -> DataFrame:
    """Axis limits per channel: ``least(0, min)``, ``max`` (L10), with the cutoffs when given."""
    keys = [by] if by else []
    lf = long_form(df, keys, channels)
    ext = lf.groupBy(*keys, "channel").agg(F.least(F.lit(0.0), F.min("value")).alias("lo"), F.max("value").alias("hi"))
    if cutoffs is not None:
        cw = cutoffs.groupBy(*keys, "channel").agg(F.array_sort(F.collect_list("cutoff")).alias("cutoffs"))
        ext = ext.join(cw, keys + ["channel"], "left")
    return ext


def sorted_clusters(df: DataFrame, by: str = "cluster") -> DataFrame:
    """Clusters in report order: numeric when all ids parse as numbers, else text."""
    return df.orderBy(*cluster_sort_key(F.col(by)))
