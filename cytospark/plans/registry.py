"""Registered queries over the driver's tables, each with its DuckDB SQL twin.

Every query reads whole tables (the fixture views of FIXTURES.md §2) and returns a DataFrame whose
columns and rounding match the SQL twin; floats are rounded to 6 places on both sides.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytospark.functions.expr import LEVELS, MERGED_LABELS, label_case_sql, pm
from cytospark.session import configure
from cytospark.operators import gating, labels, phenotype, tables, transform
from cytospark.sources import fixtures as fx
from cytospark.sources.fixtures import LINE_CHANNELS as LC, LINE_CUTOFFS, LINE_DEFINITIONS, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)          # the settings that the operators' plans rely on
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


def _labelled(spark, sf):
    return labels.label_events(fx.line_events(spark, sf), LINE_CUTOFFS)


LABEL_COLS_SQL = ", ".join(f"{label_case_sql(c, LINE_CUTOFFS[c])} AS {c}__pm" for c in LC)
LINE_LABELS_CTE = f"line_labels AS (SELECT *, {LABEL_COLS_SQL} FROM line_events)"


def with_labels(sql: str, *extra_ctes: str, views: tuple[str, ...] = ()) -> str:
    """``WITH line_events, [views], line_labels, [extra CTEs]`` followed by ``sql``."""
    base = with_views("", "line_events", *views).rstrip()
    return ",\n".join([base, LINE_LABELS_CTE, *extra_ctes]) + "\n" + sql


THRESHOLD = 0.5
GATE = [
    ("price band", {"price": "between quantile(0.25), quantile(0.95)", "compare": "&", "disc": "< quantile(0.9)"}),
    ("taxed", {"tax": "> 0.01", "compare": "|", "qty": ">= quantile(0.99)"}),
]


# ------------------------------------------------------------------ C1, C2
@register("arcsinh", with_views("""SELECT sample_id, event_id,
  round(asinh(1 + qty / 8), 6) AS qty, round(asinh(1 + price / 8), 6) AS price,
  round(asinh(1 + disc / 8), 6) AS disc, round(asinh(1 + tax / 8), 6) AS tax FROM line_events""", "line_events"))
def q_arcsinh(spark, sf):
    df = transform.arcsinh(fx.line_events(spark, sf), b=1 / 8, channels=LC)
    return df.select("sample_id", "event_id", *[r6(F.col(c)).alias(c) for c in LC])


@register("rev_arcsinh", with_views("""SELECT sample_id, event_id,
  round(qty, 6) AS qty, round(price, 4) AS price, round(disc, 6) AS disc, round(tax, 6) AS tax FROM line_events""",
                                    "line_events"))
def q_rev_arcsinh(spark, sf):
    df = transform.arcsinh(fx.line_events(spark, sf), b=1 / 8, channels=LC)
    df = transform.rev_arcsinh(df, a=1.0, b=1 / 8, channels=LC)
    return df.select("sample_id", "event_id", r6(F.col("qty")).alias("qty"), F.round("price", 4).alias("price"),
                     r6(F.col("disc")).alias("disc"), r6(F.col("tax")).alias("tax"))


# ------------------------------------------------------------------ E1–E5
_gate_sql, _gate_names = gating.strategy_sql(GATE, "line_events")


@register("gate_quantile", with_views(f"""SELECT sample_id, event_id FROM ({_gate_sql}) WHERE {_gate_names[-1]}""",
                                      "line_events"))
def q_gate_quantile(spark, sf):
    return gating.gate(fx.line_events(spark, sf), GATE).select("sample_id", "event_id")


@register("gate_counts", with_views(f"""SELECT sample_id, step_no, step, n_in, n_out FROM (
  SELECT sample_id, 1 AS step_no, 'price band' AS step, count(*) AS n_in, sum(CASE WHEN g1 THEN 1 ELSE 0 END) AS n_out
    FROM ({_gate_sql}) GROUP BY sample_id
  UNION ALL
  SELECT sample_id, 2, 'taxed', sum(CASE WHEN g1 THEN 1 ELSE 0 END), sum(CASE WHEN g2 THEN 1 ELSE 0 END)
    FROM ({_gate_sql}) GROUP BY sample_id)""", "line_events"))
def q_gate_counts(spark, sf):
    return gating.gate_counts(fx.line_events(spark, sf), GATE).select(
        "sample_id", F.col("step_no").cast("int").alias("step_no"), "step",
        F.col("n_in").cast("long").alias("n_in"), F.col("n_out").cast("long").alias("n_out"))


@register("gate_labels", with_labels("""SELECT sample_id, event_id FROM line_labels
  WHERE qty__pm IN ('+', '++') AND price__pm = '-'"""))
def q_gate_labels(spark, sf):
    return gating.gate_labels(_labelled(spark, sf), "qty__pm IN ('+', '++') AND price__pm = '-'") \
        .select("sample_id", "event_id")


# ------------------------------------------------------------------ D7
@register("label_events", with_labels(f"""SELECT sample_id, event_id, {', '.join(c + '__pm' for c in LC)} FROM line_labels"""))
def q_label_events(spark, sf):
    return _labelled(spark, sf).select("sample_id", "event_id", *[pm(c) for c in LC])


# ------------------------------------------------------------------ F1–F4, L4
def _comp_sql(by: str | None) -> str:
    parts = []
    labs = LEVELS + list(MERGED_LABELS)
    for c in LC:
        for lv in labs:
            members = [lv] if lv in LEVELS else MERGED_LABELS[lv]
            cnt = " + ".join(f"sum(CASE WHEN {c}__pm = '{m}' THEN 1 ELSE 0 END)" for m in members)
            sel_by = f"{by}, " if by else ""
            parts.append(f"SELECT {sel_by}'{c}' AS channel, {LC.index(c)} AS channel_no, '{lv}' AS label, "
                         f"{labs.index(lv)} AS label_no, ({cnt}) / count(*) AS share FROM line_labels"
                         + (f" WHERE {by} IS NOT NULL GROUP BY {by}" if by else ""))
    return "\nUNION ALL ".join(parts)


@register("label_composition", with_labels(f"""SELECT cluster, channel, label, round(share, 6) AS share FROM (
{_comp_sql('cluster')})"""))
def q_label_composition(spark, sf):
    c = phenotype.label_composition(_labelled(spark, sf), LC, "cluster")
    return c.select("cluster", "channel", "label", r6(F.col("share")).alias("share"))


_SUMMARY_SQL = f"""summary AS (SELECT * FROM ({_comp_sql('cluster')}) WHERE share >= {THRESHOLD})"""


def _with_summary(sql: str) -> str:
    return with_labels("", _SUMMARY_SQL) + sql


@register("phenotype_summary", _with_summary("SELECT cluster, channel, label, round(share, 6) AS share FROM summary"))
def q_phenotype_summary(spark, sf):
    s = phenotype.summarize_phenotypes(_labelled(spark, sf), LC, "cluster", THRESHOLD)
    return s.select("cluster", "channel", "label", r6(F.col("share")).alias("share"))


@register("phenotype_strings", _with_summary("""SELECT cluster, string_agg(s, ';' ORDER BY channel_no) AS phenotype FROM (
  SELECT cluster, channel_no, channel || string_agg(label, ',' ORDER BY label_no) AS s FROM summary
  GROUP BY cluster, channel_no, channel) GROUP BY cluster"""))
def q_phenotype_strings(spark, sf):
    return phenotype.phenotype_strings(phenotype.summarize_phenotypes(_labelled(spark, sf), LC, "cluster", THRESHOLD))


@register("phenotype_table", _with_summary("""SELECT cluster, channel, string_agg(label, ',' ORDER BY label_no) AS labels
  FROM summary WHERE label IN ('-', 'd', '+', '++', '-/d', '+/++') GROUP BY cluster, channel"""))
def q_phenotype_table(spark, sf):
    return tables.phenotype_table(phenotype.summarize_phenotypes(_labelled(spark, sf), LC, "cluster", THRESHOLD))


def _ph_sql(c: str) -> str:
    merged = " ".join(f"|| CASE WHEN {c}__pm IN ({', '.join(repr(m) for m in ms)}) THEN ',{n}' ELSE '' END"
                      for n, ms in MERGED_LABELS.items())
    return f"CASE WHEN {c}__pm IS NULL THEN NULL ELSE {c}__pm {merged} END AS {c}__ph"


@register("event_phenotypes", with_labels(f"""SELECT sample_id, event_id, {', '.join(_ph_sql(c) for c in LC)} FROM line_labels"""))
def q_event_phenotypes(spark, sf):
    return phenotype.event_phenotypes(_labelled(spark, sf), LC).select(
        "sample_id", "event_id", *[c + "__ph" for c in LC])


# ------------------------------------------------------------------ F5–F8
SEARCH_QUERY = ["Qty+/++", "price+/++ || tax++"]   # 'Qty+/++' resolves to 'qty+/++' (distance 1)


@register("search_clusters", _with_summary("""SELECT cluster FROM summary GROUP BY cluster
  HAVING bool_or(channel || label = 'qty+/++') AND bool_or(channel || label IN ('price+/++', 'tax++'))"""))
def q_search_clusters(spark, sf):
    return phenotype.search_clusters(_labelled(spark, sf), SEARCH_QUERY, LC, "cluster", THRESHOLD)


@register("search_exact", _with_summary("""SELECT cluster FROM summary GROUP BY cluster
  HAVING bool_or(lower(channel || label) = 'qty-/d') AND bool_or(lower(channel || label) IN ('price+/++', 'price-/d'))"""))
def q_search_exact(spark, sf):
    return phenotype.search_exact(_labelled(spark, sf), ["QTY-/d", "price+/++ || Price-/d"], LC, "cluster", THRESHOLD)


_STATES = [c + lv for lv in LEVELS + list(MERGED_LABELS) for c in LC]
_STATES_SQL = ", ".join(f"('{s}')" for s in _STATES)


@register("search_grid", _with_summary(f"""SELECT k.cluster, s.state, coalesce(bool_or(m.cluster IS NOT NULL), false) AS hit
  FROM (SELECT DISTINCT cluster FROM line_labels WHERE cluster IS NOT NULL) k
  CROSS JOIN (VALUES {_STATES_SQL}) s(state)
  LEFT JOIN summary m ON m.cluster = k.cluster AND m.channel || m.label = s.state
  GROUP BY k.cluster, s.state"""))
def q_search_grid(spark, sf):
    return phenotype.search_grid(_labelled(spark, sf), LC, "cluster", THRESHOLD)


# ------------------------------------------------------------------ L2, L3, G10, G12, A5, A8
@register("cluster_medians", with_views(" UNION ALL ".join(
    f"SELECT cluster, '{c}' AS channel, round(quantile_cont({c}, 0.5), 6) AS median FROM line_events "
    f"WHERE cluster IS NOT NULL GROUP BY cluster" for c in LC), "line_events"))
def q_cluster_medians(spark, sf):
    m = tables.cluster_medians(fx.line_events(spark, sf), LC, "cluster")
    return m.select("cluster", "channel", r6(F.col("median")).alias("median"))


_MED_SQL = " UNION ALL ".join(f"SELECT cluster, '{c}' AS channel, quantile_cont({c}, 0.5) AS median FROM line_events "
                              f"WHERE cluster IS NOT NULL GROUP BY cluster" for c in LC)


@register("medians_scaled", with_views(f"""SELECT cluster, channel, round(median, 6) AS median,
  round((median - avg(median) OVER (PARTITION BY channel)) / nullif(stddev_samp(median) OVER (PARTITION BY channel), 0), 6) AS z_channel,
  round((median - avg(median) OVER (PARTITION BY cluster)) / nullif(stddev_samp(median) OVER (PARTITION BY cluster), 0), 6) AS z_cluster
  FROM ({_MED_SQL})""", "line_events"))
def q_medians_scaled(spark, sf):
    m = tables.scale_medians(tables.cluster_medians(fx.line_events(spark, sf), LC, "cluster"))
    return m.select("cluster", "channel", *[r6(F.col(c)).alias(c) for c in ("median", "z_channel", "z_cluster")])


@register("centroids", with_views("SELECT sample_id, cluster, " + ", ".join(
    f"round(quantile_cont({c}, 0.5), 6) AS {c}" for c in LC) + " FROM line_events GROUP BY sample_id, cluster",
                                  "line_events"))
def q_centroids(spark, sf):
    c = tables.centroids(fx.line_events(spark, sf), LC, ("sample_id", "cluster"))
    return c.select("sample_id", "cluster", *[r6(F.col(x)).alias(x) for x in LC])


@register("cluster_sizes", with_views("SELECT cluster2 AS cluster, count(*) AS n FROM line_events GROUP BY 1",
                                      "line_events"))
def q_cluster_sizes(spark, sf):
    return tables.cluster_sizes(fx.line_events(spark, sf).drop("cluster").withColumnRenamed("cluster2", "cluster"))


@register("channel_ranges", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS name, CAST(NULL AS VARCHAR) AS \"desc\", min({c}) AS min_range, max({c}) AS max_range, "
    f"round(max({c}) - min({c}), 6) AS range FROM line_events" for c in LC), "line_events"))
def q_channel_ranges(spark, sf):
    r = tables.channel_ranges(fx.line_events(spark, sf), LC)
    return r.withColumn("range", r6(F.col("range")))


@register("count_events", with_views("SELECT sample_id, count(*) AS n_events FROM line_samples_many GROUP BY 1",
                                     "line_samples_many"))
def q_count_events(spark, sf):
    return tables.count_events(fx.line_samples_many(spark, sf))


# ------------------------------------------------------------------ C8
@register("sample_events", with_views("""SELECT sample_id, event_id FROM (
  SELECT sample_id, event_id, row_number() OVER (PARTITION BY sample_id ORDER BY md5(CAST(event_id AS VARCHAR) || '|666'), event_id) AS rn
  FROM line_events) WHERE rn <= 1000""", "line_events"))
def q_sample_events(spark, sf):
    return transform.sample_events(fx.line_events(spark, sf), 1000, seed=666).select("sample_id", "event_id")


# ------------------------------------------------------------------ D1, D2, D6
from cytospark.operators import cutpoints  # noqa: E402


def _baseline_sql(src: str, dst: str) -> str:
    """SQL twin of the D1 histogram filter, per sample, on ``src(sample_id, v)``."""
    return f"""{dst}_st AS (SELECT sample_id, min(v) AS mn, max(v) AS mx, count(*) AS n FROM {src} GROUP BY sample_id),
{dst}_b AS (SELECT s.sample_id, s.v, t.mn, (t.mx - t.mn) / 99 AS w, t.n,
    least(greatest(ceil((s.v - t.mn) / ((t.mx - t.mn) / 99)), 1), 99) AS bin FROM {src} s JOIN {dst}_st t USING (sample_id)),
{dst}_h AS (SELECT sample_id, bin, count(*) AS c, any_value(n) AS n FROM {dst}_b GROUP BY sample_id, bin),
{dst}_r AS (SELECT sample_id, min(bin) AS lo, max(bin) AS hi FROM {dst}_h WHERE c > greatest(4, n / 99 / 10) GROUP BY sample_id),
{dst} AS (SELECT b.sample_id, b.v FROM {dst}_b b JOIN {dst}_r r USING (sample_id)
    WHERE b.v >= b.mn + (r.lo - 1) * b.w AND b.v < b.mn + (r.hi - 1) * b.w)"""


def _stream_long(spark, sf):
    return fx.stream_events(spark, sf).withColumnRenamed("value", "v")


@register("baseline_cut", with_views("", "stream_events").rstrip() + ",\n"
          + "src AS (SELECT sample_id, event_id, value AS v FROM stream_events WHERE value IS NOT NULL),\n"
          + _baseline_sql("src", "b1").replace("SELECT b.sample_id, b.v FROM", "SELECT b.sample_id, b.v, b.event_id FROM")
          .replace("SELECT s.sample_id, s.v, t.mn", "SELECT s.sample_id, s.v, s.event_id, t.mn")
          + "\nSELECT sample_id, event_id FROM b1")
def q_baseline_cut(spark, sf):
    return cutpoints.baseline_cut(fx.stream_events(spark, sf), "value", ["sample_id"]).select("sample_id", "event_id")


def _bisect_sql(src: str, p: str, positive: bool) -> str:
    """CTEs that give ``{p}_cut(sample_id, cutoff, silhouette)``: the best two-way cut of ``src(sample_id, v)`` over all
    rows, by ranks and prefix sums; of equal scores the smallest cut."""
    only = " WHERE mn + k * ((mx - mn) / 99) > 0" if positive else ""
    return f"""{p}_z AS (SELECT sample_id, v, row_number() OVER w AS p, sum(v) OVER w AS cp,
    count(*) OVER (PARTITION BY sample_id) AS n, sum(v) OVER (PARTITION BY sample_id) AS tot
  FROM {src} WINDOW w AS (PARTITION BY sample_id ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{p}_st AS (SELECT sample_id, min(v) AS mn, max(v) AS mx FROM {src} GROUP BY sample_id),
{p}_cuts AS (SELECT sample_id, k, mn + k * ((mx - mn) / 99) AS cut FROM {p}_st, range(100) t(k){only}),
{p}_cm AS (SELECT c.sample_id, c.k, c.cut, count(z.v) AS m, coalesce(sum(z.v), 0) AS c_m FROM {p}_cuts c
  LEFT JOIN {p}_z z ON z.sample_id = c.sample_id AND z.v <= c.cut GROUP BY c.sample_id, c.k, c.cut),
{p}_ms AS (SELECT sample_id, m, any_value(c_m) AS c_m FROM {p}_cm GROUP BY sample_id, m),
{p}_sc AS (SELECT ms.sample_id, ms.m, CASE WHEN ms.m = 0 OR ms.m = max(z.n) THEN -2 ELSE avg(
    CASE WHEN z.p <= ms.m THEN
      CASE WHEN ms.m = 1 THEN 0 ELSE
        (SELECT CASE WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END FROM (SELECT
          (z.v * (z.p - 1) - (z.cp - z.v) + (ms.c_m - z.cp) - z.v * (ms.m - z.p)) / (ms.m - 1) AS a,
          ((z.tot - ms.c_m) - z.v * (z.n - ms.m)) / (z.n - ms.m) AS b)) END
    ELSE
      CASE WHEN z.n - ms.m = 1 THEN 0 ELSE
        (SELECT CASE WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END FROM (SELECT
          (z.v * (z.p - 1 - ms.m) - (z.cp - z.v - ms.c_m) + (z.tot - z.cp) - z.v * (z.n - z.p)) / (z.n - ms.m - 1) AS a,
          (z.v * ms.m - ms.c_m) / ms.m AS b)) END
    END) END AS score
  FROM {p}_ms ms JOIN {p}_z z ON z.sample_id = ms.sample_id GROUP BY ms.sample_id, ms.m),
{p}_best AS (SELECT sample_id, m, score FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY round(score, 12) DESC, m) AS r
  FROM {p}_sc) WHERE r = 1),
{p}_cut AS (SELECT b.sample_id, min(c.cut) AS cutoff, any_value(b.score) AS silhouette
  FROM {p}_best b JOIN {p}_cm c ON c.sample_id = b.sample_id AND c.m = b.m GROUP BY b.sample_id)"""


_STREAM_V = with_views("", "stream_events").rstrip() + ",\nsrc AS (SELECT sample_id, value AS v FROM stream_events WHERE value IS NOT NULL),\n"


@register("bisect_silhouette", _STREAM_V + _baseline_sql("src", "b1") + ",\n" + _bisect_sql("b1", "f", True)
          + "\nSELECT sample_id, round(cutoff, 6) AS cutoff, round(silhouette, 6) AS silhouette FROM f_cut")
def q_bisect(spark, sf):
    r = cutpoints.bisect(fx.stream_events(spark, sf), ["value"])
    return r.select("sample_id", r6(F.col("cutoff")).alias("cutoff"), r6(F.col("silhouette")).alias("silhouette"))


def _sides_sql(whole: str, p: str) -> str:
    """CTEs of a four-bin search on ``whole(sample_id, v)`` (already cut to its baseline): ``{p}_c1``, ``{p}_t1``, ``{p}_t2``."""
    return ",\n".join([
        _baseline_sql(whole, f"{p}b"), _bisect_sql(f"{p}b", f"{p}1", True),
        f"{p}hi AS (SELECT s.sample_id, s.v FROM {whole} s JOIN {p}1_cut c USING (sample_id) WHERE s.v > c.cutoff)",
        f"{p}lo AS (SELECT s.sample_id, s.v FROM {whole} s JOIN {p}1_cut c USING (sample_id) WHERE s.v <= c.cutoff)",
        _bisect_sql(f"{p}hi", f"{p}2", False), _bisect_sql(f"{p}lo", f"{p}3", False)])


BLANK_THRESHOLD = 0.05   # discounts of 0 make up about 1/11 of the lines: disc is blank at this threshold


@register("blank_channels", with_views(" UNION ALL ".join(
    f"SELECT sample_id, '{c}' AS channel, round(sum(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) / count(*), 6) AS zero_share, "
    f"(sum(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) / count(*) >= {BLANK_THRESHOLD} OR count({c}) = 0 "
    f"OR (coalesce(stddev_samp({c}) <= 1.5e-8, false) AND count({c}) = count(*))) AS blank "
    f"FROM line_events GROUP BY sample_id" for c in LC), "line_events"))
def q_blank_channels(spark, sf):
    b = cutpoints.blank_channels(fx.line_events(spark, sf), LC, BLANK_THRESHOLD)
    return b.select("sample_id", "channel", r6(F.col("zero_share")).alias("zero_share"), "blank")


@register("mean_cutoffs", with_views(" UNION ALL ".join(
    f"""SELECT sample_id, '{c}' AS channel, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY cutoff) AS INTEGER) AS cut_no,
  round(cutoff, 6) AS cutoff FROM (
    SELECT sample_id, unnest([m, t1, t2]) AS cutoff FROM (
      SELECT e.sample_id, any_value(s.m) AS m, avg(CASE WHEN e.{c} > s.m THEN e.{c} END) AS t1,
             avg(CASE WHEN e.{c} <= s.m THEN e.{c} END) AS t2
      FROM line_events e JOIN (SELECT sample_id, avg({c}) AS m FROM line_events GROUP BY 1) s USING (sample_id)
      GROUP BY e.sample_id))""" for c in LC), "line_events"))
def q_mean_cutoffs(spark, sf):
    m = cutpoints.mean_cutoffs(fx.line_events(spark, sf), LC, bins=4)
    return m.select("sample_id", "channel", "cut_no", r6(F.col("cutoff")).alias("cutoff"))


# rows-only: the silhouette search has no SQL twin beyond bisect; checked by tests on planted data
_CUTS_SQL = ",\n".join(
    [with_views("", "line_events").rstrip()] + [
        f"{c}_src AS (SELECT sample_id, asinh(1 + {c} / 8) AS v FROM line_events WHERE {c} IS NOT NULL),\n"
        + _baseline_sql(f"{c}_src", f"{c}_o") + ",\n" + _sides_sql(f"{c}_o", f"{c}_") + f""",
{c}_ms AS (SELECT sample_id, avg(v) AS m FROM {c}_src GROUP BY sample_id),
{c}_mean AS (SELECT s.sample_id, any_value(m) AS m, avg(v) FILTER (v > m) AS t1, avg(v) FILTER (v <= m) AS t2, min(v) AS mn, max(v) AS mx
  FROM {c}_src s JOIN {c}_ms USING (sample_id) GROUP BY s.sample_id),
{c}_cuts AS (SELECT r.sample_id, CASE WHEN a.cutoff IS NULL OR b.cutoff IS NULL OR d.cutoff IS NULL
      OR len(list_distinct([a.cutoff, b.cutoff, d.cutoff])) < 3
      OR len(list_filter([a.cutoff, b.cutoff, d.cutoff], lambda x: x = r.mn OR x = r.mx)) > 0
    THEN list_sort(list_filter([r.m, r.t1, r.t2], lambda x: x IS NOT NULL)) ELSE list_sort([a.cutoff, b.cutoff, d.cutoff]) END AS cuts
  FROM {c}_mean r LEFT JOIN {c}_1_cut a USING (sample_id) LEFT JOIN {c}_2_cut b USING (sample_id) LEFT JOIN {c}_3_cut d USING (sample_id))"""
        for c in LC])


@register("find_cutoffs", _CUTS_SQL + "\n" + " UNION ALL ".join(
    f"SELECT sample_id, '{c}' AS channel, CAST(generate_subscripts(cuts, 1) AS INTEGER) AS cut_no, round(unnest(cuts), 6) AS cutoff FROM {c}_cuts"
    for c in LC))
def q_find_cutoffs(spark, sf):
    ev = transform.arcsinh(fx.line_events(spark, sf), b=1 / 8, channels=LC)
    return cutpoints.find_cutoffs(ev, LC, bins=4).select("sample_id", "channel", "cut_no", r6(F.col("cutoff")).alias("cutoff"))


@register("multisect", _STREAM_V + _baseline_sql("src", "b0") + ",\n" + _sides_sql("b0", "s_")
          + """\nSELECT sample_id, list_transform(list_sort([a.cutoff, b.cutoff, c.cutoff]), lambda x: round(x, 6)) AS cutoffs
FROM s_1_cut a JOIN s_2_cut b USING (sample_id) JOIN s_3_cut c USING (sample_id)""")
def q_multisect(spark, sf):
    m = cutpoints.multisect(fx.stream_events(spark, sf), ["value"], bins=4)
    return m.select("sample_id", F.transform("cutoffs", lambda x: F.round(x, 6)).alias("cutoffs"))


@register("trisect")
def q_trisect(spark, sf):
    return cutpoints.multisect(fx.stream_events(spark, sf), ["value"], bins=3)


_LABELS_SQL = ", ".join("CASE list_count(list_filter({c}_cuts.cuts, lambda x: x <= asinh(1 + {c} / 8))) "
                        "WHEN 0 THEN '-' WHEN 1 THEN 'd' WHEN 2 THEN '+' WHEN 3 THEN '++' END AS {c}__pm".format(c=c) for c in LC)


@register("augment", _CUTS_SQL + f"\nSELECT sample_id, event_id, {_LABELS_SQL} FROM line_events "
          + " ".join(f"JOIN {c}_cuts USING (sample_id)" for c in LC))
def q_augment(spark, sf):
    from cytospark.plans.pipeline import augment
    lab, _ = augment(fx.line_events(spark, sf), b=1 / 8, channels=LC)
    return lab.select("sample_id", "event_id", *[pm(c) for c in LC])


# ------------------------------------------------------------------ B
from cytospark.operators import panel as pnl  # noqa: E402

_NF = 5   # files in panel_fx: p_size % 5
_RANKED = "ranked AS (SELECT *, dense_rank() OVER (ORDER BY sample_id) AS fno FROM panel_fx)"
_WIDE = ("wide AS (SELECT name, " + ", ".join(f"max(CASE WHEN fno = {i} THEN \"desc\" END) AS desc_{i:02d}" for i in range(1, _NF + 1))
         + " FROM ranked GROUP BY name)")


def _panel_sql(sql: str) -> str:
    return with_views("", "panel_fx").rstrip() + ",\n" + _RANKED + ",\n" + _WIDE + "\n" + sql


_FREQ = ("freq AS (SELECT name, d AS \"desc\", count(*) AS freq, CAST(row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, "
         "d ASC NULLS LAST) AS INTEGER) AS rank FROM (" + " UNION ALL ".join(
             f"SELECT name, desc_{i:02d} AS d FROM wide" for i in range(1, _NF + 1)) + ") GROUP BY name, d)")


@register("channels_by_sample", _panel_sql("SELECT * FROM wide"))
def q_channels_by_sample(spark, sf):
    return pnl.channels_by_sample(fx.panel_fx(spark, sf))


@register("full_descriptions", _panel_sql("SELECT name, " + ", ".join(
    f"coalesce(desc_{i:02d}, name) AS desc_{i:02d}" for i in range(1, _NF + 1)) + " FROM wide"))
def q_full_descriptions(spark, sf):
    return pnl.channels_by_sample(fx.panel_fx(spark, sf), full=True)


@register("desc_frequency", _panel_sql(", " + _FREQ + " SELECT * FROM freq").replace("\n, freq AS", ",\nfreq AS"))
def q_desc_frequency(spark, sf):
    return pnl.desc_frequency(fx.panel_fx(spark, sf))


@register("desc_remap", _panel_sql(", " + _FREQ + """ SELECT name, "desc" AS new_desc FROM freq WHERE rank = 1
  AND name IN (SELECT name FROM freq GROUP BY name HAVING count(*) > 1)""").replace("\n, freq AS", ",\nfreq AS"))
def q_desc_remap(spark, sf):
    return pnl.desc_remap(fx.panel_fx(spark, sf))


@register("noncommon_channels", _panel_sql("SELECT name, n_descs FROM (SELECT name, CAST(count(DISTINCT d) AS INTEGER) AS n_descs FROM ("
                                           + " UNION ALL ".join(f"SELECT name, coalesce(desc_{i:02d}, name) AS d FROM wide"
                                                                for i in range(1, _NF + 1))
                                           + ") GROUP BY name) WHERE n_descs > 1"))
def q_noncommon(spark, sf):
    return pnl.noncommon_channels(fx.panel_fx(spark, sf))


GUESS_RE = {"cytof": "brushed|polished"}
GUESS_MARKER = r".*? (.*)"


@register("guess_channels", _panel_sql(f"""SELECT name,
  CASE WHEN NOT regexp_matches(coalesce(desc_01, name), '{GUESS_RE['cytof']}', 'i') THEN
    CASE WHEN regexp_matches(desc_01, '{GUESS_MARKER}') THEN regexp_extract(desc_01, '{GUESS_MARKER}', 1) END
  ELSE desc_01 END AS description,
  CASE WHEN NOT regexp_matches(coalesce(desc_01, name), '{GUESS_RE['cytof']}', 'i') THEN 'X' END AS use FROM wide"""))
def q_guess_channels(spark, sf):
    return pnl.guess_channels(fx.panel_fx(spark, sf), "cytof", GUESS_RE, GUESS_MARKER)


@register("reconcile", _panel_sql(", " + _FREQ + """,
remap AS (SELECT name, "desc" AS new_desc FROM freq WHERE rank = 1 AND name IN (SELECT name FROM freq GROUP BY name HAVING count(*) > 1))
SELECT p.sample_id, p.pos, p.name, CASE WHEN r.new_desc IS NOT NULL THEN r.new_desc ELSE p."desc" END AS "desc"
  FROM panel_fx p LEFT JOIN remap r USING (name)""").replace("\n, freq AS", ",\nfreq AS"))
def q_reconcile(spark, sf):
    p = fx.panel_fx(spark, sf)
    return pnl.reconcile_panel(p, pnl.desc_remap(p))


# ------------------------------------------------------------------ I
from cytospark.operators import samples as smp  # noqa: E402

ID_RE = r"[0-9]\.fcs"


def _files(spark, sf):
    return smp.number_files(fx.sample_files(spark, sf))


@register("sample_map", with_views("", "sample_files").rstrip() + f""",
f AS (SELECT file, CAST(dense_rank() OVER (ORDER BY file) AS INTEGER) AS sample_id FROM sample_files),
x AS (SELECT *, regexp_extract(regexp_extract(file, '([^/\\\\]+)$', 1), '{ID_RE}', 0) AS id0 FROM f)
SELECT file, sample_id, CASE WHEN count(*) OVER (PARTITION BY id0) > 1
  THEN printf('%s-%02d', id0, row_number() OVER (PARTITION BY id0 ORDER BY sample_id)) ELSE id0 END AS id FROM x""")
def q_sample_map(spark, sf):
    return smp.sample_id_map(_files(spark, sf), ID_RE).select("file", "sample_id", "id")


def _supplier_ids(spark, sf):
    return fx.table(spark, sf, "supplier").select(F.regexp_replace("s_name", "^Supplier#", "").alias("id"))


@register("match_metadata", with_views("", "sample_files").rstrip() + """,
f AS (SELECT file, regexp_replace(regexp_extract(file, '([^/\\\\]+)$', 1), '\\.[^.]*$', '') AS stem FROM sample_files),
m AS (SELECT regexp_replace(s_name, '^Supplier#', '') AS id FROM supplier),
d AS (SELECT f.file, f.stem, m.id, levenshtein(f.stem, m.id) AS dist,
  row_number() OVER (PARTITION BY f.file ORDER BY levenshtein(f.stem, m.id), m.id) AS r FROM f, m)
SELECT file, stem, id AS meta_id, CAST(dist AS INTEGER) AS distance FROM d WHERE r = 1""")
def q_match_metadata(spark, sf):
    files = fx.sample_files(spark, sf).withColumn("stem", smp.file_stem(F.col("file")))
    return smp.match_metadata(files, _supplier_ids(spark, sf)).select("file", "stem", "meta_id", "distance")


@register("impute_metadata", with_views("""SELECT id, "group", round(coalesce(balance, (SELECT quantile_cont(balance, 0.5) FROM covariates)), 6) AS balance,
  coalesce(segment, (SELECT segment FROM covariates WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)) AS segment
  FROM covariates""", "covariates"))
def q_impute_metadata(spark, sf):
    m = smp.impute_metadata(fx.covariates(spark, sf), numeric=["balance"], categorical=["segment"])
    return m.select("id", "group", r6(F.col("balance")).alias("balance"), "segment")


@register("metadata_summary", with_views("""SELECT "group", 'balance' AS variable, stat, round(value, 6) AS value FROM (
  SELECT "group", quantile_cont(balance, 0.25) AS q1, quantile_cont(balance, 0.5) AS median, quantile_cont(balance, 0.75) AS q3,
    avg(balance) AS mean, CAST(count(balance) AS DOUBLE) AS n FROM covariates GROUP BY 1)
  UNPIVOT (value FOR stat IN (q1, median, q3, mean, n))
UNION ALL
SELECT "group", 'segment=' || coalesce(segment, 'NA') AS variable, stat, round(value, 6) FROM (
  SELECT "group", segment, CAST(count(*) AS DOUBLE) AS n, count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY "group") AS percent
  FROM covariates GROUP BY 1, 2) UNPIVOT (value FOR stat IN (n, percent))""", "covariates"))
def q_metadata_summary(spark, sf):
    s = smp.summarize_metadata(fx.covariates(spark, sf), "group", numeric=["balance"], categorical=["segment"])
    return s.withColumn("value", r6(F.col("value")))


@register("reference_levels", with_views("""SELECT variable, level, CAST(row_number() OVER (PARTITION BY variable
  ORDER BY CASE WHEN variable = 'segment' AND level = 'MACHINERY' THEN 0 ELSE 1 END, level) AS INTEGER) AS level_no FROM (
  SELECT DISTINCT 'group' AS variable, "group" AS level FROM covariates WHERE "group" IS NOT NULL
  UNION SELECT DISTINCT 'segment', segment FROM covariates WHERE segment IS NOT NULL)""", "covariates"))
def q_reference_levels(spark, sf):
    return smp.reference_levels(fx.covariates(spark, sf), {"segment": "MACHINERY"}, ["group", "segment"])


# ------------------------------------------------------------------ H
from cytospark.operators import abundance as ab, enrichment as enr  # noqa: E402

_ABUND_SQL = """counts AS (SELECT c.cluster, m.sample_id, coalesce(k.n, 0) AS n, t.total,
    coalesce(k.n, 0) * 100.0 / t.total AS percent
  FROM (SELECT DISTINCT cluster FROM line_events WHERE cluster IS NOT NULL AND sample_id IN (SELECT sample_id FROM line_meta)) c
  CROSS JOIN (SELECT sample_id FROM line_meta) m
  JOIN (SELECT sample_id, count(*) AS total, count(cluster) AS clustered FROM line_events GROUP BY 1) t ON t.sample_id = m.sample_id
  LEFT JOIN (SELECT cluster, sample_id, count(*) AS n FROM line_events GROUP BY 1, 2) k ON k.cluster = c.cluster AND k.sample_id = m.sample_id
  WHERE t.clustered > 0)"""


def _abund_sql(sql):
    return with_views("", "line_events", "line_meta").rstrip() + ",\n" + _ABUND_SQL + "\n" + sql


def _counts(spark, sf):
    return ab.abundance_counts(fx.line_events(spark, sf), fx.line_samples(spark, sf).select("sample_id"))


@register("abundance", _abund_sql("SELECT cluster, sample_id, n, total, round(percent, 6) AS percent FROM counts"))
def q_abundance(spark, sf):
    c = _counts(spark, sf)
    return c.select("cluster", "sample_id", "n", "total", r6(F.col("percent")).alias("percent"))


@register("bh_adjust", _abund_sql("""SELECT cluster, sample_id, round(p, 6) AS p, round(least(1.0, min(q) OVER (PARTITION BY sample_id
    ORDER BY p DESC, cluster ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) AS FDR FROM (
  SELECT cluster, sample_id, percent / 100 AS p, (percent / 100) * count(*) OVER (PARTITION BY sample_id)
    / (count(*) OVER (PARTITION BY sample_id) - row_number() OVER (PARTITION BY sample_id ORDER BY percent DESC, cluster) + 1) AS q
  FROM counts)"""))
def q_bh_adjust(spark, sf):
    c = _counts(spark, sf).withColumn("p", F.col("percent") / 100)
    r = ab.bh_adjust(c, "p", "sample_id")
    return r.select("cluster", "sample_id", r6(F.col("p")).alias("p"), r6(F.col("FDR")).alias("FDR"))


@register("cohens_h", _abund_sql("""SELECT cluster, "group", 'A' AS reference, round(p, 6) AS p, round(p_ref, 6) AS p_ref, round(h, 6) AS h FROM (
  SELECT g.cluster, g."group", g.p, r.p AS p_ref, 2 * asin(sqrt(g.p)) - 2 * asin(sqrt(r.p)) AS h FROM
    (SELECT cluster, "group", sum(n) / sum(total) AS p FROM counts JOIN line_meta USING (sample_id) GROUP BY 1, 2) g
    JOIN (SELECT cluster, sum(n) / sum(total) AS p FROM counts JOIN line_meta USING (sample_id) WHERE "group" = 'A' GROUP BY 1) r
    USING (cluster) WHERE g."group" <> 'A') WHERE abs(h) >= 0.01"""))
def q_cohens_h(spark, sf):
    h = ab.cohens_h(_counts(spark, sf), fx.line_samples(spark, sf), "group", "A", min_effect_size=0.01)
    return h.select("cluster", "group", "reference", *[r6(F.col(c)).alias(c) for c in ("p", "p_ref", "h")])


@register("design_matrix", with_views("""SELECT sample_id, CAST(1 AS DOUBLE) AS "(Intercept)",
  CAST(CASE WHEN "group" = 'N' THEN 1 ELSE 0 END AS DOUBLE) AS groupN, CAST(CASE WHEN "group" = 'R' THEN 1 ELSE 0 END AS DOUBLE) AS groupR FROM line_meta""",
                                      "line_meta"))
def q_design_matrix(spark, sf):
    d, _ = ab.design_matrix(fx.line_samples(spark, sf).select("sample_id", "group"), "~ group")
    return d


@register("contrasts", with_views("""SELECT coefficient, CAST(CASE coefficient WHEN 'groupN' THEN 1 WHEN 'groupR' THEN -1 ELSE 0 END AS DOUBLE) AS NvsR,
  CAST(CASE coefficient WHEN 'groupN' THEN 1 ELSE 0 END AS DOUBLE) AS N FROM (SELECT '(Intercept)' AS coefficient UNION ALL
  SELECT DISTINCT 'group' || "group" FROM line_meta WHERE "group" <> (SELECT min("group") FROM line_meta))""", "line_meta"))
def q_contrasts(spark, sf):
    _, names = ab.design_matrix(fx.line_samples(spark, sf).select("sample_id", "group"), "~ group")
    return ab.make_contrasts(spark, {"NvsR": "groupN - groupR", "N": "groupN"}, names)


_MEM_SQL = with_views("", "line_events").rstrip() + ",\n" + """own AS (""" + " UNION ALL ".join(
    f"SELECT cluster, '{c}' AS channel, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3 "
    f"FROM line_events WHERE cluster IS NOT NULL GROUP BY cluster" for c in LC) + """),
ref AS (""" + " UNION ALL ".join(
    f"SELECT k.cluster, '{c}' AS channel, quantile_cont(e.{c}, 0.25) AS r1, quantile_cont(e.{c}, 0.5) AS rmed, quantile_cont(e.{c}, 0.75) AS r3 "
    f"FROM (SELECT DISTINCT cluster FROM line_events WHERE cluster IS NOT NULL) k JOIN line_events e ON e.cluster <> k.cluster GROUP BY k.cluster"
    for c in LC) + """),
raw AS (SELECT cluster, channel, CASE WHEN med < rmed THEN -1 ELSE 1 END *
    (abs(med - rmed) + (r3 - r1) / nullif(q3 - q1, 0) - 1) AS raw FROM own JOIN ref USING (cluster, channel)),
mem AS (SELECT cluster, channel, raw * 10 / (SELECT max(abs(raw)) FROM raw) AS score FROM raw)
"""


@register("mem", _MEM_SQL + "SELECT cluster, channel, round(score, 6) AS score FROM mem")
def q_mem(spark, sf):
    m = enr.mem_scores(fx.line_events(spark, sf), LC, "cluster")
    return m.select("cluster", "channel", r6(F.col("score")).alias("score"))


@register("enrichment_labels", _MEM_SQL.rstrip() + """,
t AS (SELECT quantile_cont(abs(score), 0.5) AS t FROM mem)
SELECT cluster, string_agg(channel || CASE WHEN score < -t THEN 'lo' WHEN score < 0 THEN '-' WHEN score > t THEN 'hi' ELSE '+' END, ''
  ORDER BY CASE channel WHEN 'qty' THEN 0 WHEN 'price' THEN 1 WHEN 'disc' THEN 2 ELSE 3 END) AS label
  FROM mem, t WHERE score <> 0 GROUP BY cluster""")
def q_enrichment_labels(spark, sf):
    return enr.enrichment_labels(enr.mem_scores(fx.line_events(spark, sf), LC, "cluster"), LC, "cluster")


# ------------------------------------------------------------------ F9–F12
_HITS = """hits AS (SELECT cluster,
   bool_or(channel || label = 'qty+/++') AS big, bool_or(channel || label = 'qty-/d') AS small,
   bool_or(channel || label = 'price+/++') AS dear,
   bool_or(channel || label = 'qty+/++') AND bool_or(channel || label = 'price+/++') AS big_dear,
   bool_or(channel || label IN ('price+/++', 'tax+/++')) AS dear_or_taxed FROM summary GROUP BY cluster)"""


@register("merge_clusters", with_labels("", _SUMMARY_SQL, _HITS) + """SELECT e.sample_id, e.event_id, e.cluster AS orig,
  coalesce(CASE WHEN h.big THEN 'big' END, CASE WHEN h.small THEN 'small' END) AS "big|small",
  CASE WHEN h.dear THEN 'dear' END AS dear, CASE WHEN h.big_dear THEN 'big dear' END AS "big dear",
  CASE WHEN h.dear_or_taxed THEN 'dear or taxed' END AS "dear or taxed"
  FROM line_labels e LEFT JOIN hits h USING (cluster)""")
def q_merge_clusters(spark, sf):
    return phenotype.merge_clusters(_labelled(spark, sf), LINE_DEFINITIONS, LC, "cluster", THRESHOLD)


@register("gate_by_definition", with_labels("""SELECT sample_id, event_id,
  CASE WHEN qty__pm IN ('+', '++') THEN 'big' WHEN qty__pm IN ('-', 'd') THEN 'small' END AS "big|small",
  CASE WHEN price__pm IN ('+', '++') THEN 'dear' END AS dear,
  CASE WHEN qty__pm IN ('+', '++') AND price__pm IN ('+', '++') THEN 'big dear' END AS "big dear",
  CASE WHEN price__pm IN ('+', '++') OR tax__pm IN ('+', '++') THEN 'dear or taxed' END AS "dear or taxed"
  FROM line_labels"""))
def q_gate_by_definition(spark, sf):
    return phenotype.gate_by_definition(_labelled(spark, sf), LINE_DEFINITIONS, LC)


@register("choose_set", with_views("""SELECT 'cluster' AS cluster_set, count(DISTINCT cluster) AS n_clusters FROM line_events
  UNION ALL SELECT 'cluster2', count(DISTINCT cluster2) FROM line_events""", "line_events"))
def q_choose_set(spark, sf):
    return phenotype.cluster_set_counts(fx.line_events(spark, sf), ["cluster", "cluster2"])


# ------------------------------------------------------------------ C3, C5, C7
from cytospark.operators import preprocess as pre  # noqa: E402


def _spill(spark, sf):
    """Spillover per sample derived from the data: qty→disc = mean(disc)/mean(qty)/10, disc→qty =
    mean(qty)/mean(disc)/1000."""
    m = fx.line_events(spark, sf).groupBy("sample_id").agg(F.avg("qty").alias("q"), F.avg("disc").alias("d"))
    return m.select("sample_id", F.explode(F.array(
        F.struct(F.lit("qty").alias("from_ch"), F.lit("disc").alias("to_ch"), (F.col("d") / F.col("q") / 10).alias("coef")),
        F.struct(F.lit("disc").alias("from_ch"), F.lit("qty").alias("to_ch"), (F.col("q") / F.col("d") / 1000).alias("coef")))
    ).alias("s")).select("sample_id", "s.*")


@register("compensate", with_views("""SELECT sample_id, event_id, round((qty - b * disc) / (1 - a * b), 6) AS qty,
  round((disc - a * qty) / (1 - a * b), 6) AS disc, price FROM line_events JOIN (
  SELECT sample_id, avg(disc) / avg(qty) / 10 AS a, avg(qty) / avg(disc) / 1000 AS b FROM line_events GROUP BY 1) USING (sample_id)""",
                                   "line_events"))
def q_compensate(spark, sf):
    c = pre.compensate(fx.line_events(spark, sf), _spill(spark, sf), ["qty", "disc"])
    return c.select("sample_id", "event_id", r6(F.col("qty")).alias("qty"), r6(F.col("disc")).alias("disc"), "price")


BARCODE_KEY = [("s_qp", 1, 1, 0, 0), ("s_qd", 1, 0, 1, 0), ("s_qt", 1, 0, 0, 1),
               ("s_pd", 0, 1, 1, 0), ("s_pt", 0, 1, 0, 1), ("s_dt", 0, 0, 1, 1)]


@register("debarcode", with_views("""SELECT sample_id, event_id, code, round(sep, 6) AS separation,
  CASE WHEN sep >= 0.1 THEN code_sample END AS barcode_sample FROM (
  SELECT sample_id, event_id, array_to_string(list_sort([s[1].c, s[2].c]), ',') AS code, s[2].v - s[3].v AS sep FROM (
    SELECT sample_id, event_id, list_sort([{'v': qty / q1, 'c': 'qty'}, {'v': price / q2, 'c': 'price'},
       {'v': disc / q3, 'c': 'disc'}, {'v': tax / q4, 'c': 'tax'}], 'DESC') AS s FROM line_events JOIN (
      SELECT sample_id, quantile_cont(qty, 0.95) AS q1, quantile_cont(price, 0.95) AS q2, quantile_cont(disc, 0.95) AS q3,
        quantile_cont(tax, 0.95) AS q4 FROM line_events GROUP BY 1) USING (sample_id)))
  LEFT JOIN (VALUES ('price,qty', 's_qp'), ('disc,qty', 's_qd'), ('qty,tax', 's_qt'), ('disc,price', 's_pd'),
    ('price,tax', 's_pt'), ('disc,tax', 's_dt')) k(code, code_sample) USING (code)""", "line_events"))
def q_debarcode(spark, sf):
    key = spark.createDataFrame(BARCODE_KEY, "barcode_sample string, qty int, price int, disc int, tax int")
    d = pre.debarcode(fx.line_events(spark, sf), key, LC, cutoff=0.1)
    return d.select("sample_id", "event_id", "code", r6(F.col("separation")).alias("separation"), "barcode_sample")


# Codes with one to three positive channels.
BARCODE_KEY_VARYING = [("s_q", 1, 0, 0, 0), ("s_qp", 1, 1, 0, 0), ("s_dt", 0, 0, 1, 1), ("s_pdt", 0, 1, 1, 1), ("s_t", 0, 0, 0, 1)]
_VARYING_CTE = """scaled AS (SELECT sample_id, event_id, list_sort([{'v': qty / q1, 'c': 'qty'}, {'v': price / q2, 'c': 'price'},
    {'v': disc / q3, 'c': 'disc'}, {'v': tax / q4, 'c': 'tax'}], 'DESC') AS s FROM line_events JOIN (
  SELECT sample_id, quantile_cont(qty, 0.95) AS q1, quantile_cont(price, 0.95) AS q2, quantile_cont(disc, 0.95) AS q3,
    quantile_cont(tax, 0.95) AS q4 FROM line_events GROUP BY 1) USING (sample_id)),
gaps AS (SELECT *, [s[1].v - s[2].v, s[2].v - s[3].v, s[3].v - s[4].v] AS g FROM scaled),
cut AS (SELECT sample_id, event_id, list_max(g) AS separation,
  array_to_string(list_sort(list_transform(s[1:list_position(g, list_max(g))], lambda x: x.c)), ',') AS code FROM gaps),
coded AS (SELECT cut.*, k.code_sample FROM cut LEFT JOIN (VALUES ('qty', 's_q'), ('price,qty', 's_qp'), ('disc,tax', 's_dt'),
  ('disc,price,tax', 's_pdt'), ('tax', 's_t')) k(code, code_sample) USING (code))"""


def _varying(spark, sf, cutoff):
    key = spark.createDataFrame(BARCODE_KEY_VARYING, "barcode_sample string, qty int, price int, disc int, tax int")
    return pre.debarcode(fx.line_events(spark, sf), key, LC, cutoff=cutoff)


@register("debarcode_varying", with_views("", "line_events").rstrip() + ",\n" + _VARYING_CTE + """
SELECT sample_id, event_id, code, round(separation, 6) AS separation, CASE WHEN separation >= 0.1 THEN code_sample END AS barcode_sample FROM coded""")
def q_debarcode_varying(spark, sf):
    return _varying(spark, sf, 0.1).select("sample_id", "event_id", "code", r6(F.col("separation")).alias("separation"), "barcode_sample")


@register("barcode_yields", with_views("", "line_events").rstrip() + ",\n" + _VARYING_CTE + """
SELECT barcode_sample, cutoff, n, round(n / max(n) OVER (PARTITION BY barcode_sample), 6) AS share FROM (
  SELECT k.code_sample AS barcode_sample, i / 100.0 AS cutoff, count(c.separation) AS n
  FROM (SELECT DISTINCT code_sample FROM coded WHERE code_sample IS NOT NULL) k CROSS JOIN range(101) t(i)
  LEFT JOIN coded c ON c.code_sample = k.code_sample AND least(floor(c.separation * 100), 100) >= i GROUP BY ALL)""")
def q_barcode_yields(spark, sf):
    y = pre.yield_curves(_varying(spark, sf, 0.0))
    return y.select("barcode_sample", "cutoff", "n", r6(F.col("share")).alias("share"))


@register("rescale_quantile", with_views("""SELECT sample_id, event_id, """ + ", ".join(
    f"round({c} / quantile_cont({c}, 0.95) OVER (PARTITION BY sample_id), 6) AS {c}" for c in ("qty", "price")) + """ FROM (
  SELECT sample_id, event_id, asinh(greatest(qty - 1.0, 0) / 5) AS qty, asinh(greatest(price - 1.0, 0) / 5) AS price
  FROM line_events WHERE sqrt(greatest(qty - 1.0, 0) ^ 2 + greatest(price - 1.0, 0) ^ 2) > 1000)""", "line_events"))
def q_rescale_quantile(spark, sf):
    r = pre.rescale(fx.line_events(spark, sf).select("sample_id", "event_id", "qty", "price"), ["qty", "price"],
                    noise_threshold=1.0, euclidean_length_threshold=1000.0, scaling_factor=5.0, transformation="ASINH",
                    rescale="QUANTILE", quantile=0.95, rescale_separately=True)
    return r.select("sample_id", "event_id", r6(F.col("qty")).alias("qty"), r6(F.col("price")).alias("price"))


@register("rescale_sd", with_views("", "line_events").rstrip() + """,
lim AS (SELECT sample_id, event_id, greatest(qty - 1.0, 0) AS qty, tax FROM line_events)
SELECT sample_id, event_id, round(qty / (SELECT stddev_samp(qty) FROM lim), 6) AS qty, tax FROM lim""")
def q_rescale_sd(spark, sf):
    ev = fx.line_events(spark, sf).select("sample_id", "event_id", "qty", "tax")
    r = pre.rescale(ev, ["qty"], noise_threshold=1.0, rescale="SD")
    return r.withColumn("qty", r6(F.col("qty")))


# ------------------------------------------------------------------ C6
from cytospark.operators import outliers as olr  # noqa: E402

_SEG_SQL = with_views("", "stream_events").rstrip() + """,
seg AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY sample_id ORDER BY time, event_id) - 1) / 500) AS INTEGER) AS segment
  FROM stream_events),
st AS (SELECT sample_id, segment, 'value' AS channel, avg(value) AS mean, quantile_cont(value, 0.5) AS median,
    quantile_cont(value, 0.05) AS p05, quantile_cont(value, 0.20) AS p20, quantile_cont(value, 0.80) AS p80,
    quantile_cont(value, 0.95) AS p95, var_samp(value) AS variance,
    avg(power(value - (SELECT avg(value) FROM seg s2 WHERE s2.sample_id = seg.sample_id AND s2.segment = seg.segment), 3))
      / power(var_pop(value), 1.5) AS skewness,
    count(value) AS n, count(value) / (max(time) - min(time)) AS density FROM seg GROUP BY sample_id, segment)
"""


@register("segment_stats", _SEG_SQL + "SELECT sample_id, segment, channel, " + ", ".join(
    f"round({s}, 6) AS {s}" for s in olr.STATS) + ", n, round(density, 6) AS density FROM st")
def q_segment_stats(spark, sf):
    seg = olr.segment(fx.stream_events(spark, sf))
    st = olr.segment_stats(seg, ["value"])
    return st.select("sample_id", "segment", "channel", *[r6(F.col(s)).alias(s) for s in olr.STATS], "n",
                     r6(F.col("density")).alias("density"))


@register("remove_outliers", _SEG_SQL + """, z AS (SELECT sample_id, segment, density, """ + " + ".join(
    f"coalesce(abs(({s} - avg({s}) OVER w) / nullif(stddev_samp({s}) OVER w, 0)), 0)" for s in olr.STATS)
          + """ AS score FROM st WINDOW w AS (PARTITION BY sample_id, channel)),
q AS (SELECT sample_id, segment, score > avg(score) OVER (PARTITION BY sample_id) + 1.0 * coalesce(stddev_samp(score) OVER (PARTITION BY sample_id), 0)
  OR coalesce(density < 0.1 * max(density) OVER (PARTITION BY sample_id), false) AS removed FROM z)
SELECT s.sample_id, s.event_id FROM seg s JOIN q USING (sample_id, segment) WHERE NOT q.removed""")
def q_remove_outliers(spark, sf):
    return olr.remove_outlier_segments(fx.stream_events(spark, sf), ["value"], 500, 1.0, 0.10).select("sample_id", "event_id")


# ------------------------------------------------------------------ C4
from cytospark.functions.order import rank_within  # noqa: E402
from cytospark.operators import beads as bds  # noqa: E402


@register("bead_smooth", with_views("""SELECT sample_id, event_id, round(quantile_cont(value, 0.5) OVER (PARTITION BY sample_id
  ORDER BY time, event_id ROWS BETWEEN 250 PRECEDING AND 250 FOLLOWING), 6) AS value_med FROM stream_events""", "stream_events"))
def q_bead_smooth(spark, sf):
    r = rank_within(fx.stream_events(spark, sf), ["sample_id"], ["time", "event_id"], "rank")
    m = bds.framed_median(r, ["sample_id"], "rank", ["value"], half=250, chunk=700)
    return m.select("sample_id", "event_id", r6(F.col("value_med")).alias("value_med"))


@register("bead_interpolate", with_views("", "stream_events").rstrip() + """,
u AS (SELECT sample_id, event_id, time, CASE WHEN event_id % 10 = 0 THEN value END AS pv FROM stream_events),
w AS (SELECT *, last_value(CASE WHEN pv IS NOT NULL THEN {'t': time, 'v': pv} END IGNORE NULLS) OVER (PARTITION BY sample_id
    ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p,
  first_value(CASE WHEN pv IS NOT NULL THEN {'t': time, 'v': pv} END IGNORE NULLS) OVER (PARTITION BY sample_id
    ORDER BY time, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM u)
SELECT sample_id, event_id, round(CASE WHEN p IS NULL THEN n.v WHEN n IS NULL THEN p.v WHEN n.t = p.t THEN p.v
  ELSE p.v + (time - p.t) / (n.t - p.t) * (n.v - p.v) END, 6) AS interp FROM w""")
def q_bead_interpolate(spark, sf):
    ev = fx.stream_events(spark, sf)
    pts = ev.where(F.col("event_id") % 10 == 0).select("sample_id", "time", "value")
    out = bds.interpolate(ev.select("sample_id", "event_id", "time"), pts, "sample_id", "time", "value", chunk=700)
    return out.select("sample_id", "event_id", r6(F.col("interp")).alias("interp"))


@register("bead_normalize")
def q_bead_normalize(spark, sf):
    return bds.bead_normalize(fx.stream_events(spark, sf), ["value"], [], ["value"], k=100, gate="quantile")


@register("bead_gate")
def q_bead_gate(spark, sf):
    """Where the beads of every sample of the stream begin, if its values have two populations."""
    return bds.bead_thresholds(fx.stream_events(spark, sf), ["value"])


# ------------------------------------------------------------------ G1, G2
from cytospark.operators import neighbors as nbr  # noqa: E402

VC = fx.VEC_CHANNELS
_DIST = " + ".join(f"(a.c{i} - b.c{i}) * (a.c{i} - b.c{i})" for i in range(1, 65))
_KNN_SQL = with_views("", "vec_events").rstrip() + f""",
knn AS (SELECT src, dst, rank, distance FROM (
  SELECT a.event_id AS src, b.event_id AS dst, sqrt({_DIST}) AS distance,
    CAST(row_number() OVER (PARTITION BY a.event_id ORDER BY sqrt({_DIST}), b.event_id) AS INTEGER) AS rank
  FROM vec_events a JOIN vec_events b ON a.event_id <> b.event_id) WHERE rank <= 15)
"""


@register("knn", _KNN_SQL + "SELECT src, dst, rank, round(distance, 6) AS distance FROM knn")
def q_knn(spark, sf):
    g = nbr.knn_graph(fx.vec_events(spark, sf), VC, k=15, cell_size=60)
    return g.select("src", "dst", "rank", r6(F.col("distance")).alias("distance"))


@register("knn_approx")
def q_knn_approx(spark, sf):
    return nbr.knn_graph(fx.vec_events(spark, sf), VC, k=15, mode="approx")


@register("jaccard", _KNN_SQL + """, nb AS (SELECT src, list(dst) AS n FROM knn GROUP BY src)
SELECT k.src, k.dst, round(len(list_intersect(a.n, b.n)) / len(list_distinct(list_concat(a.n, b.n))), 6) AS weight,
  CAST(len(list_intersect(a.n, b.n)) AS INTEGER) AS shared
  FROM knn k JOIN nb a ON a.src = k.src JOIN nb b ON b.src = k.dst""".replace("\n, nb AS", ",\nnb AS"))
def q_jaccard(spark, sf):
    g = nbr.knn_graph(fx.vec_events(spark, sf), VC, k=15, cell_size=60)
    j = nbr.jaccard_graph(g)
    return j.select("src", "dst", r6(F.col("weight")).alias("weight"), F.col("shared").cast("int").alias("shared"))


# ------------------------------------------------------------------ G3 (rows-only: checked on planted data), G8, G9
from cytospark.operators import community as cmt, density as dns  # noqa: E402


@register("phenograph")
def q_phenograph(spark, sf):
    return cmt.phenograph(fx.vec_events(spark, sf), VC, k=15, cell_size=100)


_RHO_SQL = _KNN_SQL.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + """,
rho AS (SELECT src, 1.0 / avg(distance) AS rho FROM knn GROUP BY src)"""
# Every event's root: parents are followed until one is its own.
_ROOTS_SQL = """walk AS (SELECT node, parent AS at FROM par UNION ALL
  SELECT w.node, p.parent FROM walk w JOIN par p ON p.node = w.at WHERE p.parent <> w.at),
roots AS (SELECT w.node, w.at AS root FROM walk w JOIN par p ON p.node = w.at WHERE p.parent = p.node)"""


@register("xshift", _RHO_SQL + """,
e AS (SELECT k.src, k.dst, s.rho AS rs, d.rho AS rd FROM knn k JOIN rho s ON s.src = k.src JOIN rho d ON d.src = k.dst),
up AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY rd DESC, dst) AS i FROM e WHERE rd > rs OR (rd = rs AND dst < src)),
par AS (SELECT r.src AS node, r.rho, coalesce(u.dst, r.src) AS parent FROM rho r LEFT JOIN up u ON u.src = r.src AND u.i = 1),
""" + _ROOTS_SQL + """
SELECT node AS event_id, CAST(root AS VARCHAR) AS cluster, round(rho, 6) AS rho FROM roots JOIN par USING (node)""")
def q_xshift(spark, sf):
    return dns.xshift(fx.vec_events(spark, sf), VC, k=15, cell_size=100).withColumn("rho", r6(F.col("rho")))


@register("density_peaks", _RHO_SQL + f""",
denser AS (SELECT a.event_id AS src, b.event_id AS dst, sqrt({_DIST}) AS distance,
    row_number() OVER (PARTITION BY a.event_id ORDER BY sqrt({_DIST}), b.event_id) AS i
  FROM vec_events a JOIN rho ra ON ra.src = a.event_id, vec_events b JOIN rho rb ON rb.src = b.event_id
  WHERE rb.rho > ra.rho OR (rb.rho = ra.rho AND b.event_id < a.event_id)),
t AS (SELECT r.src AS node, r.rho, n.dst, n.distance AS delta FROM rho r LEFT JOIN denser n ON n.src = r.src AND n.i = 1),
st AS (SELECT avg(rho) AS mr, stddev_samp(rho) AS sr, avg(delta) AS md, stddev_samp(delta) AS sd, max(delta) AS xd FROM t),
par AS (SELECT node, rho, coalesce(delta, xd) AS delta, CASE WHEN dst IS NULL OR (rho > mr
    AND coalesce(delta, xd) > md + 2 * coalesce(sd, 0)) THEN node ELSE dst END AS parent FROM t, st),
""" + _ROOTS_SQL + """
SELECT node AS event_id, CAST(root AS VARCHAR) AS cluster, round(rho, 6) AS rho, round(delta, 6) AS delta FROM roots JOIN par USING (node)""")
def q_density_peaks(spark, sf):
    d = dns.density_peaks(fx.vec_events(spark, sf), VC, k=15, cell_size=100)
    return d.withColumn("rho", r6(F.col("rho"))).withColumn("delta", r6(F.col("delta")))


# ------------------------------------------------------------------ L5 (rows-only: checked on planted data and against plain steps)
from cytospark.operators import embedding as emb  # noqa: E402


@register("embed_umap")
def q_embed_umap(spark, sf):
    return emb.embed_umap(fx.vec_events(spark, sf), VC, cell_size=100)


# ------------------------------------------------------------------ G4–G7 (SOM and consensus: rows-only), L
from cytospark.operators import kde as kd, som as sm  # noqa: E402


@register("som")
def q_som(spark, sf):
    _, asg = sm.som(fx.vec_events(spark, sf), VC)
    return asg


@register("som_clusters")
def q_som_clusters(spark, sf):
    return sm.som_clusters(fx.vec_events(spark, sf), VC)


@register("optimal_cluster_count")
def q_optimal_cluster_count(spark, sf):
    """PAC of every number of clusters from 2 to 28 for the 64 channels, 100 resamples each, and the one chosen."""
    best, scores = sm.optimal_cluster_count(fx.vec_events(spark, sf), VC)
    return spark.createDataFrame([(k, v, k == best) for k, v in sorted(scores.items())], "k int, pac double, chosen boolean")


_PAIRS = [(a, b) for i, a in enumerate(VC) for j, b in enumerate(VC) if i < j]


@register("channel_correlation", with_views(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM vec_events" for a, b in _PAIRS), "vec_events"))
def q_channel_correlation(spark, sf):
    c = sm.channel_correlation(fx.vec_events(spark, sf), VC)
    return c.select("a", "b", r6(F.col("r")).alias("r"))


@register("cell_counts", with_views("""SELECT s.sample_id, s.n_start, coalesce(g.n_gated, 0) AS n_gated, m.id, m."group" FROM
  (SELECT sample_id, count(*) AS n_start FROM line_events GROUP BY 1) s
  LEFT JOIN (SELECT sample_id, count(*) AS n_gated FROM line_events WHERE qty > 25 GROUP BY 1) g USING (sample_id)
  LEFT JOIN line_meta m USING (sample_id)""", "line_events", "line_meta"))
def q_cell_counts(spark, sf):
    ev = fx.line_events(spark, sf)
    return tables.cell_counts(ev, ev.where("qty > 25"), fx.line_samples(spark, sf))


@register("gating_extents", with_views(" UNION ALL ".join(
    f"SELECT sample_id, '{c}' AS channel, least(0, min({c})) AS lo, max({c}) AS hi FROM line_events GROUP BY 1"
    for c in LC), "line_events"))
def q_gating_extents(spark, sf):
    return tables.gating_extents(fx.line_events(spark, sf), LC, by="sample_id")


@register("centroid_grid", with_views("""SELECT 'cluster' AS grouping, cluster, NULL::INTEGER AS sample_id, NULL::VARCHAR AS "group",
    round(avg(c1), 6) AS x, round(avg(c2), 6) AS y, count(*) AS n FROM vec_events GROUP BY cluster
  UNION ALL SELECT 'sample', NULL, sample_id, NULL, round(avg(c1), 6), round(avg(c2), 6), count(*) FROM vec_events GROUP BY sample_id
  UNION ALL SELECT 'group', NULL, NULL, "group", round(avg(c1), 6), round(avg(c2), 6), count(*) FROM vec_events GROUP BY "group"
  UNION ALL SELECT 'sample_cluster', k.cluster, s.sample_id, NULL, round(avg(e.c1), 6), round(avg(e.c2), 6), count(e.c1)
    FROM (SELECT DISTINCT cluster FROM vec_events) k CROSS JOIN (SELECT DISTINCT sample_id FROM vec_events) s
    LEFT JOIN vec_events e ON e.cluster = k.cluster AND e.sample_id = s.sample_id GROUP BY 1, 2, 3
  UNION ALL SELECT 'group_cluster', k.cluster, NULL, s."group", round(avg(e.c1), 6), round(avg(e.c2), 6), count(e.c1)
    FROM (SELECT DISTINCT cluster FROM vec_events) k CROSS JOIN (SELECT DISTINCT "group" FROM vec_events) s
    LEFT JOIN vec_events e ON e.cluster = k.cluster AND e."group" = s."group" GROUP BY 1, 2, 4""", "vec_events"))
def q_centroid_grid(spark, sf):
    c = tables.embedding_centroids(fx.vec_events(spark, sf), "c1", "c2", "cluster", "sample_id", "group")
    return c.select("grouping", "cluster", "sample_id", "group", r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"), "n")


_BW = """st AS (SELECT sample_id, stddev_samp(value) AS sd, count(value) AS n, min(value) AS mn, max(value) AS mx,
    quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM stream_events WHERE value IS NOT NULL GROUP BY 1),
bw AS (SELECT *, 0.9 * coalesce(nullif(least(sd, (q3 - q1) / 1.34), 0), nullif(sd, 0), nullif(abs(mn), 0), 1.0) * pow(n, -0.2) AS bw FROM st),
grid AS (SELECT sample_id, i, (mn - 3.0 * bw) + i * (((mx + 3.0 * bw) - (mn - 3.0 * bw)) / 49) AS x, bw, n FROM bw, range(50) t(i))"""


@register("density1d", with_views("", "stream_events").rstrip() + ",\n" + _BW + """
SELECT g.sample_id, 'value' AS channel, CAST(g.i AS INTEGER) AS i, round(g.x, 6) AS x,
  round(sum(exp(-0.5 * ((g.x - e.value) / g.bw) * ((g.x - e.value) / g.bw))) / (g.n * g.bw * sqrt(2 * pi())), 6) AS density
  FROM grid g JOIN stream_events e ON e.sample_id = g.sample_id AND e.value IS NOT NULL GROUP BY g.sample_id, g.i, g.x, g.n, g.bw""")
def q_density1d(spark, sf):
    d = kd.density_curves(fx.stream_events(spark, sf), ["value"], n_grid=50)
    return d.select("sample_id", "channel", "i", r6(F.col("x")).alias("x"), r6(F.col("density")).alias("density"))


# The same over a channel that is zero in four events of five, as channels without signal are.
_ZEROS_CTE = "stream_zeros AS (SELECT sample_id, event_id, CASE WHEN event_id % 5 = 0 THEN value ELSE 0 END AS value FROM stream_events)"


@register("density_zeros", with_views("", "stream_events").rstrip() + ",\n" + _ZEROS_CTE + ",\n" + _BW.replace("FROM stream_events", "FROM stream_zeros") + """
SELECT g.sample_id, 'value' AS channel, CAST(g.i AS INTEGER) AS i, round(g.x, 6) AS x,
  round(sum(exp(-0.5 * ((g.x - e.value) / g.bw) * ((g.x - e.value) / g.bw))) / (g.n * g.bw * sqrt(2 * pi())), 6) AS density
  FROM grid g JOIN stream_zeros e ON e.sample_id = g.sample_id AND e.value IS NOT NULL GROUP BY g.sample_id, g.i, g.x, g.n, g.bw""")
def q_density_zeros(spark, sf):
    ev = fx.stream_events(spark, sf).withColumn("value", F.when(F.col("event_id") % 5 == 0, F.col("value")).otherwise(0.0))
    d = kd.density_curves(ev, ["value"], n_grid=50)
    return d.select("sample_id", "channel", "i", r6(F.col("x")).alias("x"), r6(F.col("density")).alias("density"))


_BW2 = """sx AS (SELECT stddev_samp(c1) AS sd, count(*) AS n, min(c1) AS mn, max(c1) AS mx, quantile_cont(c1, 0.25) AS q1,
    quantile_cont(c1, 0.75) AS q3 FROM vec_events),
sy AS (SELECT stddev_samp(c2) AS sd, count(*) AS n, min(c2) AS mn, max(c2) AS mx, quantile_cont(c2, 0.25) AS q1,
    quantile_cont(c2, 0.75) AS q3 FROM vec_events),
h AS (SELECT greatest(4 * 1.06 * coalesce(nullif(least(sx.sd, (sx.q3 - sx.q1) / 1.34), 0), nullif(sx.sd, 0), nullif(abs(sx.mn), 0), 1.0) * pow(sx.n, -0.2),
                      4 * 1.06 * coalesce(nullif(least(sy.sd, (sy.q3 - sy.q1) / 1.34), 0), nullif(sy.sd, 0), nullif(abs(sy.mn), 0), 1.0) * pow(sy.n, -0.2)) / 4 AS s, sx.n AS n,
    sx.mn AS xlo, sx.mx AS xhi, sy.mn AS ylo, sy.mx AS yhi FROM sx, sy),
g AS (SELECT i, j, xlo + i * ((xhi - xlo) / 49) AS gx, ylo + j * ((yhi - ylo) / 49) AS gy, s, n FROM h, range(50) a(i), range(50) b(j))"""


@register("density2d", with_views("", "vec_events").rstrip() + ",\n" + _BW2 + """
SELECT CAST(g.i AS INTEGER) AS i, CAST(g.j AS INTEGER) AS j, round(g.gx, 6) AS gx, round(g.gy, 6) AS gy,
  round(sum(exp(-0.5 * ((g.gx - e.c1) / g.s) * ((g.gx - e.c1) / g.s)) / (g.s * sqrt(2 * pi()))
          * exp(-0.5 * ((g.gy - e.c2) / g.s) * ((g.gy - e.c2) / g.s)) / (g.s * sqrt(2 * pi()))) / any_value(g.n), 6) AS density
  FROM g, vec_events e GROUP BY g.i, g.j, g.gx, g.gy""")
def q_density2d(spark, sf):
    d = kd.density_2d(fx.vec_events(spark, sf), "c1", "c2", n=50)
    return d.select("i", "j", r6(F.col("gx")).alias("gx"), r6(F.col("gy")).alias("gy"), r6(F.col("density")).alias("density"))


# ------------------------------------------------------------------ G11 (join-back given assignments)
from cytospark.operators import metacluster as mcl  # noqa: E402


@register("metacluster_join", with_views("""SELECT e.sample_id, e.event_id, e.cluster, m.metacluster FROM line_events e LEFT JOIN (
  SELECT sample_id, cluster, CASE WHEN quantile_cont(qty, 0.5) >= 25.5 THEN 'big' ELSE 'small' END AS metacluster
  FROM line_events GROUP BY 1, 2) m USING (sample_id, cluster)""", "line_events"))
def q_metacluster_join(spark, sf):
    ev = fx.line_events(spark, sf)
    cen = tables.centroids(ev, ["qty"], ("sample_id", "cluster"))
    assign = cen.select("sample_id", "cluster", F.when(F.col("qty") >= 25.5, "big").otherwise("small").alias("metacluster"))
    return mcl.map_back(ev.select("sample_id", "event_id", "cluster"), assign)


@register("metacluster")
def q_metacluster(spark, sf):
    return mcl.metacluster(fx.vec_events(spark, sf), VC, k=10)


# ------------------------------------------------------------------ B3, B7, B9, B11, B12
@register("common_channel_order", with_views("", "panel_fx").rstrip() + """
SELECT count(DISTINCT names) <= 1 AS common FROM (SELECT sample_id, string_agg(name, '/' ORDER BY pos, name) AS names FROM panel_fx GROUP BY sample_id)""")
def q_common_channel_order(spark, sf):
    return spark.createDataFrame([(pnl.common_channel_order(fx.panel_fx(spark, sf)),)], "common boolean")


@register("rename_reorder", with_views("SELECT sample_id, event_id, tax, price AS worth, qty AS amount FROM line_events", "line_events"))
def q_rename_reorder(spark, sf):
    ev = fx.line_events(spark, sf).select("sample_id", "event_id", "qty", "price", "tax")
    return pnl.reorder_channels(pnl.rename_to_markers(ev, {"price": "worth", "qty": "amount"}), ["tax", "worth"])


_SHEET = "CASE p_size % 4 WHEN 0 THEN '  ' WHEN 1 THEN ' y ' WHEN 2 THEN NULL ELSE 'X' END"


@register("normalise_usage", f"""SELECT p_partkey AS id, p_name AS name, CASE WHEN coalesce(trim({_SHEET}), '') <> '' THEN 'X' END AS use FROM part""")
def q_normalise_usage(spark, sf):
    sheet = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.expr(_SHEET).alias("use"))
    return pnl.normalise_usage(sheet)


# ------------------------------------------------------------------ C9, C10
@register("expression_subset", with_views("""SELECT sample_id, event_id, round(asinh(1 + qty / 8), 6) AS qty, round(asinh(1 + tax / 8), 6) AS tax FROM (
  SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY md5(CAST(event_id AS VARCHAR) || '|666'), event_id) AS rn FROM line_events)
  WHERE rn <= 700""", "line_events"))
def q_expression_subset(spark, sf):
    e = transform.expression_subset(fx.line_events(spark, sf), b=1 / 8, channels=["qty", "tax"], n=700)
    return e.select("sample_id", "event_id", r6(F.col("qty")).alias("qty"), r6(F.col("tax")).alias("tax"))


_STRATEGY = [("cheap", {"price": "< 40000"}), ("taxed", {"tax": "> 0.01"})]


@register("aggregate_samples", with_views("""SELECT sample_id, event_id, gated FROM (
  SELECT sample_id, event_id, count(*) OVER (PARTITION BY sample_id) AS gated,
    row_number() OVER (PARTITION BY sample_id ORDER BY md5(CAST(event_id AS VARCHAR) || '|666'), event_id) AS rn
  FROM line_events WHERE price < 40000 AND tax > 0.01) WHERE rn <= 500""", "line_events"))
def q_aggregate_samples(spark, sf):
    events, totals = transform.aggregate_samples(fx.line_events(spark, sf), _STRATEGY, n=500)
    return events.join(totals, "sample_id").select("sample_id", "event_id", "gated")


# ------------------------------------------------------------------ F12, I4, I5
@register("choose_cluster_set", with_views("""SELECT CASE WHEN count(DISTINCT cluster) >= count(DISTINCT cluster2) THEN 'cluster' ELSE 'cluster2' END AS chosen
  FROM line_events""", "line_events"))
def q_choose_cluster_set(spark, sf):
    return spark.createDataFrame([(phenotype.choose_cluster_set(fx.line_events(spark, sf), "cluster", "cluster2"),)], "chosen string")


@register("prepare_metadata", "SELECT s_name AS id, 'B6' AS \"group\" FROM supplier")
def q_prepare_metadata(spark, sf):
    return smp.prepare_metadata(fx.sample_files(spark, sf), group="B6")


@register("check_metadata", 'SELECT id, "group", balance FROM (' + with_views('SELECT id, "group", round(balance, 6) AS balance FROM covariates', "covariates") + ")")
def q_check_metadata(spark, sf):
    return smp.check_metadata(fx.covariates(spark, sf)).select("id", "group", r6(F.col("balance")).alias("balance"))


# ------------------------------------------------------------------ H1 with empty cells and NULL clusters, H3, H4, L7
_SPARSE = "CASE WHEN qty < 5 THEN NULL WHEN qty > 45 AND sample_id % 2 = 0 THEN 'rare' WHEN sample_id = 3 AND qty > 20 THEN 'one' ELSE cluster2 || '' END"


@register("abundance_sparse", with_views("", "line_events").rstrip() + f""",
e AS (SELECT sample_id, {_SPARSE} AS cluster FROM line_events)
SELECT c.cluster, t.sample_id, coalesce(k.n, 0) AS n, t.total, round(coalesce(k.n, 0) * 100.0 / t.total, 6) AS percent
FROM (SELECT DISTINCT cluster FROM e WHERE cluster IS NOT NULL) c
CROSS JOIN (SELECT sample_id, count(*) AS total FROM e GROUP BY 1 HAVING count(cluster) > 0) t
LEFT JOIN (SELECT cluster, sample_id, count(*) AS n FROM e GROUP BY 1, 2) k ON k.cluster = c.cluster AND k.sample_id = t.sample_id""")
def q_abundance_sparse(spark, sf):
    ev = fx.line_events(spark, sf)
    c = ab.abundance_counts(ev.select("sample_id", F.expr(_SPARSE.replace("|| ''", "").replace("ELSE cluster2", "ELSE CAST(cluster2 AS STRING)")).alias("cluster")))
    return c.withColumn("percent", r6(F.col("percent")))


def _abundance_fit(spark, sf):
    """The fit of every sample's counts on its supplier's region (all five levels), and the coefficients' names."""
    from cytospark.operators import models
    counts = ab.abundance_counts(fx.line_samples_many(spark, sf))
    design, names = ab.design_matrix(fx.supplier_regions(spark, sf), "~ group", key="sample_id")
    return models.differential_abundance(counts, design, names), names


@register("abundance_glm")
def q_abundance_glm(spark, sf):
    fits, _ = _abundance_fit(spark, sf)
    return fits.select("cluster", "coefficients", "dispersion", "deviance", "df", "s2", "logCPM")


@register("test_contrasts")
def q_test_contrasts(spark, sf):
    from cytospark.operators import models
    fits, names = _abundance_fit(spark, sf)
    return models.test_contrasts(fits, {n: {n: 1.0} for n in names[1:]})


@register("overlay", with_views("", "line_events", "line_meta").rstrip() + """,
res AS (SELECT cluster, round(ln(avg(price) / 30000) / ln(2), 6) AS logFC, round(avg(disc), 6) AS FDR FROM line_events WHERE cluster IS NOT NULL GROUP BY cluster)
SELECT e.sample_id, e.event_id, e.cluster, CASE WHEN r.FDR > 0.05 THEN 0 ELSE r.logFC END AS logFC, r.FDR, m."group"
FROM line_events e LEFT JOIN res r USING (cluster) LEFT JOIN line_meta m ON m.sample_id = e.sample_id""")
def q_overlay(spark, sf):
    ev = fx.line_events(spark, sf)
    res = ev.where("cluster IS NOT NULL").groupBy("cluster").agg(
        r6(F.log(F.avg("price") / 30000) / F.log(F.lit(2.0))).alias("logFC"), r6(F.avg("disc")).alias("FDR"))
    o = tables.differential_overlay(ev, res, fx.line_samples(spark, sf).select("sample_id", "group"))
    return o.select("sample_id", "event_id", "cluster", "logFC", "FDR", "group")


# ------------------------------------------------------------------ M1, A9
from cytospark.plans import analysis as ana  # noqa: E402
from cytospark.session import scratch_folder  # noqa: E402


def _line_config(**more) -> dict:
    base = {"channels": {"names": LC}, "transform": {"b": None}, "cutoffs": {"fixed": LINE_CUTOFFS},
            "gates": {"strategy": [["price band", {"price": "between quantile(0.05), quantile(0.95)"}]]}, "stack": {"n": None},
            "merge": {"definitions": LINE_DEFINITIONS, "label_threshold": THRESHOLD},
            "densities": {"enabled": False}, "embedding": {"enabled": False}, "tables": {"enabled": False}}
    return {**base, **more}


_GATED_CTE = """line_gated AS (SELECT e.* FROM line_events e JOIN (SELECT sample_id, quantile_cont(price, 0.05) AS lo, quantile_cont(price, 0.95) AS hi
  FROM line_events GROUP BY sample_id) q USING (sample_id) WHERE e.price BETWEEN q.lo AND q.hi)"""
_GATED_LABELS_CTE = f"line_labels AS (SELECT *, {LABEL_COLS_SQL} FROM line_gated)"
_NAMED_CTE = """named AS (SELECT e.sample_id, e.cluster, coalesce(CASE WHEN h.big THEN 'big' END, CASE WHEN h.small THEN 'small' END) AS big_small,
  CASE WHEN h.dear THEN 'dear' END AS dear, CASE WHEN h.big_dear THEN 'big dear' END AS big_dear,
  CASE WHEN h.dear_or_taxed THEN 'dear or taxed' END AS dear_or_taxed FROM line_labels e LEFT JOIN hits h USING (cluster)),
sets AS (SELECT 'cluster' AS cluster_set, sample_id, cluster FROM named UNION ALL SELECT 'big|small', sample_id, big_small FROM named
  UNION ALL SELECT 'dear', sample_id, dear FROM named UNION ALL SELECT 'big dear', sample_id, big_dear FROM named
  UNION ALL SELECT 'dear or taxed', sample_id, dear_or_taxed FROM named)"""


def _line_analysis(spark, sf, config):
    """The configured analysis over the line events in a folder of its own, so that every call computes all stages."""
    inputs = {"events": fx.line_events(spark, sf).drop("cluster2"), "metadata": fx.line_samples(spark, sf).select("sample_id", "id", "group")}
    return ana.build(spark, config, inputs, scratch_folder(spark))


@register("pipeline_counts", ",\n".join([with_views("", "line_events", "line_meta").rstrip(), _GATED_CTE, _GATED_LABELS_CTE, _SUMMARY_SQL, _HITS, _NAMED_CTE]) + """
SELECT c.cluster_set, c.cluster, t.sample_id, coalesce(k.n, 0) AS n, t.total, round(coalesce(k.n, 0) * 100.0 / t.total, 6) AS percent
FROM (SELECT DISTINCT cluster_set, cluster FROM sets WHERE cluster IS NOT NULL) c
JOIN (SELECT cluster_set, sample_id, count(*) AS total FROM sets GROUP BY ALL HAVING count(cluster) > 0) t USING (cluster_set)
LEFT JOIN (SELECT cluster_set, sample_id, cluster, count(*) AS n FROM sets GROUP BY ALL) k
  ON k.cluster_set = c.cluster_set AND k.cluster = c.cluster AND k.sample_id = t.sample_id""")
def q_pipeline_counts(spark, sf):
    """Transform, fixed cut points, labels, gate, given clusters, their names by definition and the counts, from one configuration."""
    g = _line_analysis(spark, sf, _line_config(clusters={"method": "column"}, models={"enabled": False}))
    return g.result("counts").select("cluster_set", "cluster", "sample_id", "n", "total", r6(F.col("percent")).alias("percent"))


@register("run_pipeline")
def q_run_pipeline(spark, sf):
    """From searched cut points over clusters by a self-organising map to the tests of their abundance between groups."""
    inputs = {"events": fx.line_samples_many(spark, sf).drop("cluster", "cluster2"),
              "metadata": fx.supplier_regions(spark, sf).withColumn("id", F.format_string("s%d", "sample_id"))}
    config = _line_config(clusters={"method": "som", "k": 10}, cutoffs={"fixed": {c: LINE_CUTOFFS[c] for c in ("disc", "tax")}})
    return ana.build(spark, config, inputs, scratch_folder(spark)).result("contrasts")


@register("summary_export", ",\n".join([with_views("", "line_events").rstrip(), LINE_LABELS_CTE, _SUMMARY_SQL]) + f"""
SELECT 'events' AS family, 'cluster' AS cluster_set, c.cluster, CAST(s.sample_id AS VARCHAR) AS item, CAST(coalesce(k.n, 0) AS DOUBLE) AS value, NULL AS labels
  FROM (SELECT DISTINCT cluster FROM line_events) c CROSS JOIN (SELECT DISTINCT sample_id FROM line_events) s
  LEFT JOIN (SELECT cluster, sample_id, count(*) AS n FROM line_events GROUP BY ALL) k ON k.cluster = c.cluster AND k.sample_id = s.sample_id
UNION ALL SELECT 'PM', 'cluster', cluster, channel, NULL, string_agg(label, ',' ORDER BY label_no)
  FROM summary WHERE label IN ('-', 'd', '+', '++', '-/d', '+/++') GROUP BY cluster, channel
UNION ALL SELECT 'medians', 'cluster', cluster, channel,
  round((median - avg(median) OVER (PARTITION BY cluster)) / nullif(stddev_samp(median) OVER (PARTITION BY cluster), 0), 6), NULL FROM ({_MED_SQL})""")
def q_summary_export(spark, sf):
    from cytospark.operators import report
    made = report.summary_long(report.summary_tables(_labelled(spark, sf), ["cluster"], LC, THRESHOLD))
    return made.withColumn("value", r6(F.col("value")))
