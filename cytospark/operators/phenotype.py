"""Phenotype summaries, search and merges over label columns (F1–F12).

Terms are ``<channel><label>`` with label in ``-, d, +, ++, -/d, +/++, d/+, all``; ``a || b`` inside a
term means either.  Per-cluster work is one wide aggregate per group (label counters for every
channel), so events are read once and never exploded per channel.
"""
from __future__ import annotations

import itertools
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytospark.functions.expr import LEVELS, MERGED_LABELS, pm
from cytospark.functions.plan import checked_side, literal_side


def _labels(merged: Mapping[str, Sequence[str]]) -> list[str]:
    return LEVELS + [m for m in merged if m not in LEVELS]


def label_composition(df: DataFrame, channels: Sequence[str], by: str | None = None,
                      merged: Mapping[str, Sequence[str]] = MERGED_LABELS) -> DataFrame:
    """Share of every label per channel (F1): count / all rows of the group, NA-labelled rows included;
    merged labels are sums of their members.  Long form ``([by], channel, label, share, n,
    channel_no, label_no)``.  Rows with a NULL ``by`` are not a group."""
    keys = [by] if by else []
    src = df.where(F.col(by).isNotNull()) if by else df
    aggs = [F.count(F.lit(1)).alias("_n")]
    for ci, ch in enumerate(channels):
        for li, lv in enumerate(LEVELS):
            aggs.append(F.sum(F.when(F.col(pm(ch)) == lv, 1).otherwise(0)).alias(f"_k{ci}_{li}"))
    wide = src.groupBy(*keys).agg(*aggs)
    rows = []
    for ci, ch in enumerate(channels):
        for li, lv in enumerate(_labels(merged)):
            members = [lv] if lv in LEVELS else list(merged[lv])
            cnt = None
            for m in members:
                c = F.col(f"_k{ci}_{LEVELS.index(m)}")
                cnt = c if cnt is None else cnt + c
            rows.append(F.struct(F.lit(ch).alias("channel"), F.lit(lv).alias("label"),
                                 (cnt / F.col("_n")).alias("share"), F.col("_n").alias("n"),
                                 F.lit(ci).alias("channel_no"), F.lit(li).alias("label_no")))
    return wide.select(*keys, F.explode(F.array(*rows)).alias("_r")).select(*keys, "_r.*")


def overall_excluded(df: DataFrame, channels: Sequence[str], threshold: float | None,
                     merged: Mapping[str, Sequence[str]] = MERGED_LABELS) -> DataFrame:
    """Channels whose overall share of some label (``all`` left out) exceeds ``threshold``."""
    comp = label_composition(df, channels, None, merged)
    return comp.where((F.col("label") != "all") & (F.col("share") > F.lit(float(threshold)))) \
        .select("channel").distinct()


def summarize_phenotypes(df: DataFrame, channels: Sequence[str], by: str = "cluster",
                         label_threshold: float = 0.90, overall_label_threshold: float | None = None,
                         merged: Mapping[str, Sequence[str]] = MERGED_LABELS) -> DataFrame:
    """Labels (plain and merged) whose share in the cluster is ≥ ``label_threshold`` (F2).

    Long form ``(by, channel, label, share, channel_no, label_no)``; a channel meeting none of the
    labels has no rows.  With ``overall_label_threshold``, channels over-represented in all events
    are dropped (anti join on the small channel list)."""
    comp = label_composition(df, channels, by, merged)
    out = comp.where(F.col("share") >= F.lit(float(label_threshold)))
    if overall_label_threshold is not None and overall_label_threshold != float("inf"):
        out = out.join(literal_side(overall_excluded(df, channels, overall_label_threshold, merged)), "channel", "left_anti")
    return out.select(by, "channel", "label", "share", "channel_no", "label_no")


def phenotype_strings(summary: DataFrame, by: str = "cluster", collapse: str = ";", sep: str = ",") -> DataFrame:
    """One string per cluster (F3): channel name followed by its labels joined by ``sep``; channels
    joined by ``collapse``, in channel order."""
    per_ch = summary.groupBy(by, "channel", "channel_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("label_no", "label"))), lambda s: s["label"]),
                     sep).alias("_labs"))
    return per_ch.groupBy(by).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("channel_no", F.concat("channel", "_labs").alias("s")))),
                                 lambda s: s["s"]), collapse).alias("phenotype"))


def event_phenotypes(df: DataFrame, channels: Sequence[str], merged: Mapping[str, Sequence[str]] = MERGED_LABELS,
                     sep: str = ",") -> DataFrame:
    """Per event and channel (F4): own label plus every merged label that contains it, as
    ``<channel>__ph`` strings; NULL label → NULL."""
    cols = {}
    for ch in channels:
        lab = F.col(pm(ch))
        parts = [lab] + [F.when(lab.isin(*members), F.lit(name)) for name, members in merged.items()]
        cols[ch + "__ph"] = F.when(lab.isNotNull(), F.concat_ws(sep, *parts))
    return df.withColumns(cols)


# ------------------------------------------------------------------ query terms
def split_terms(query: Sequence[str]) -> list[list[str]]:
    """Each query element → its ``||`` alternatives."""
    return [[t.strip() for t in re.split(r"\s*\|\|\s*", q)] for q in query]


def state_dictionary(channels: Sequence[str], merged: Mapping[str, Sequence[str]] = MERGED_LABELS) -> list[str]:
    """All ``channel+label`` states, channel varying fastest (the enumeration that breaks ties)."""
    return [ch + lv for lv in _labels(merged) for ch in channels]


def terms_frame(spark: SparkSession, query: Sequence[str]) -> DataFrame:
    rows = [(gi, ai, t) for gi, alts in enumerate(split_terms(query)) for ai, t in enumerate(alts)]
    return spark.createDataFrame(rows, "grp int, alt int, term string")


def resolve_query(terms: DataFrame, channels: Sequence[str],
                  merged: Mapping[str, Sequence[str]] = MERGED_LABELS) -> DataFrame:
    """Each ``term`` → the closest state by Levenshtein distance (case-sensitive), first in
    dictionary order on ties (F5).  The dictionary is an array literal, so this is a projection."""
    states = F.array(*[F.lit(s) for s in state_dictionary(channels, merged)])
    d = F.transform(states, lambda s: F.levenshtein(F.col("term"), s))
    return terms.withColumn("state", F.element_at(states, F.array_position(d, F.array_min(d)).cast("int")))


def _hits(tokens: DataFrame, resolved: DataFrame, by: str, n_groups: int, match_col: str = "state",
          case_insensitive: bool = False) -> DataFrame:
    """Clusters whose token set holds, for every term group, at least one alternative (equi-join)."""
    t = tokens.withColumn("_tok", F.lower("token") if case_insensitive else F.col("token"))
    r = resolved.withColumn("_tok", F.lower(match_col) if case_insensitive else F.col(match_col))
    j = t.join(literal_side(r.select("grp", "_tok")), "_tok")
    return j.groupBy(by).agg(F.countDistinct("grp").alias("_g")).where(F.col("_g") == n_groups).select(by)


def summary_tokens(summary: DataFrame, by: str = "cluster") -> DataFrame:
    return summary.select(by, F.concat("channel", "label").alias("token"))


def search_clusters(df: DataFrame, query: Sequence[str], channels: Sequence[str], by: str = "cluster",
                    label_threshold: float = 0.90, overall_label_threshold: float | None = None,
                    summary: DataFrame | None = None) -> DataFrame:
    """Clusters meeting all query terms (F6): ``(by)`` rows.  Terms resolve to their nearest state."""
    sm = summary if summary is not None else summarize_phenotypes(df, channels, by, label_threshold, overall_label_threshold)
    resolved = resolve_query(terms_frame(df.sparkSession, query), channels)
    return _hits(summary_tokens(sm, by), resolved, by, len(list(query)))


def search_exact(df: DataFrame, query: Sequence[str], channels: Sequence[str], by: str = "cluster",
                 label_threshold: float = 0.90, summary: DataFrame | None = None) -> DataFrame:
    """Like ``search_clusters`` with case-insensitive exact matching of the terms (F8)."""
    sm = summary if summary is not None else summarize_phenotypes(df, channels, by, label_threshold)
    terms = terms_frame(df.sparkSession, query)
    return _hits(summary_tokens(sm, by), terms, by, len(list(query)), "term", case_insensitive=True)


def search_grid(df: DataFrame, channels: Sequence[str], by: str = "cluster", label_threshold: float = 0.90,
                summary: DataFrame | None = None) -> DataFrame:
    """Clusters × every state, TRUE where the cluster has it (F7): long ``(by, state, hit)``."""
    sm = summary if summary is not None else summarize_phenotypes(df, channels, by, label_threshold)
    sets = summary_tokens(sm, by).groupBy(by).agg(F.collect_set("token").alias("_set"))
    allc = df.where(F.col(by).isNotNull()).select(by).distinct()
    sets = allc.join(sets, by, "left")
    states = F.array(*[F.lit(s) for s in state_dictionary(channels)])
    pairs = F.transform(states, lambda s: F.struct(s.alias("state"),
                                                   F.coalesce(F.array_contains(F.col("_set"), s), F.lit(False)).alias("hit")))
    return sets.select(by, F.explode(pairs).alias("_p")).select(by, "_p.*")


# ------------------------------------------------------------------ merges
def exclusive_groups(cooc: Mapping[tuple[str, str], int], cols: Sequence[str]) -> list[list[str]]:
    """Greedy merge of mutually exclusive columns (F11) on the pairwise co-occurrence counts.

    Repeatedly the first pair (in combination order over the current columns) with no row where both
    are non-NULL is merged into the left one; a merged column is exclusive with another iff all its
    members are.  Fewer than three columns → unchanged; stops at one column."""
    groups = [[c] for c in cols]
    if len(groups) < 3:
        return groups

    def excl(a, b):
        return all(cooc.get((x, y), cooc.get((y, x), 0)) == 0 for x in a for y in b)

    while len(groups) > 1:
        for i, j in itertools.combinations(range(len(groups)), 2):
            if excl(groups[i], groups[j]):
                groups[i] = groups[i] + groups[j]
                del groups[j]
                break
        else:
            break
    return groups


def cooccurrence(df: DataFrame, cols: Sequence[str]) -> dict[tuple[str, str], int]:
    """Rows where both columns of each pair are non-NULL (and, under ``(c, c)``, rows where the
    column is non-NULL): one aggregate, k·(k+1)/2 numbers."""
    pairs = list(itertools.combinations(cols, 2)) + [(c, c) for c in cols]
    if not cols:
        return {}
    aggs = [F.sum(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1).otherwise(0)).alias(f"_c{i}")
            for i, (a, b) in enumerate(pairs)]
    row = df.agg(*aggs).first()
    return {p: int(row[f"_c{i}"] or 0) for i, p in enumerate(pairs)}


def merge_exclusive(df: DataFrame, cols: Sequence[str], sep: str = "|", keep: Sequence[str] = ()) -> DataFrame:
    """Merge mutually exclusive columns into ``a|b`` columns by ``coalesce`` (F11)."""
    co = cooccurrence(df, cols)
    groups = exclusive_groups({k: v for k, v in co.items() if k[0] != k[1]}, cols)
    out = [F.coalesce(*[F.col(c) for c in g]).alias(sep.join(g)) if len(g) > 1 else F.col(g[0]) for g in groups]
    return df.select(*keep, *out)


def _thresholds(names: Sequence[str], label_threshold) -> dict[str, float]:
    """Per-definition thresholds: named ones by name, unnamed recycled over the rest."""
    if isinstance(label_threshold, Mapping):
        named = {k: float(v) for k, v in label_threshold.items() if k in names}
        rest = [n for n in names if n not in named]
        default = [float(v) for k, v in label_threshold.items() if k not in names] or [0.90]
        for i, n in enumerate(rest):
            named[n] = default[i % len(default)]
        return named
    if isinstance(label_threshold, (list, tuple)):
        return {n: float(label_threshold[i % len(label_threshold)]) for i, n in enumerate(names)}
    return {n: float(label_threshold) for n in names}


def definition_hits(df: DataFrame, definitions: Mapping[str, Sequence[str]], channels: Sequence[str],
                    by: str = "cluster", label_threshold=0.90) -> DataFrame:
    """``(by, definition)`` for every cluster hit by every definition (the small hit table of F9).

    The summary tokens are materialised once per distinct threshold; all definitions' terms are
    resolved in one projection and matched in one equi-join."""
    names = list(definitions)
    th = _thresholds(names, label_threshold)
    spark = df.sparkSession
    tokens = None
    for t in sorted(set(th.values())):
        tk = summary_tokens(summarize_phenotypes(df, channels, by, t), by).withColumn("_t", F.lit(t))
        tokens = tk if tokens is None else tokens.unionByName(tk)
    tokens = checked_side(tokens)
    rows = [(n, th[n], gi, ai, t) for n in names for gi, alts in enumerate(split_terms(definitions[n]))
            for ai, t in enumerate(alts)]
    tf = spark.createDataFrame(rows, "definition string, _t double, grp int, alt int, term string")
    resolved = resolve_query(tf, channels).select("definition", "_t", "grp", F.col("state").alias("token"))
    need = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(len(definitions[n])))])
    j = tokens.join(literal_side(resolved), ["_t", "token"])
    return j.groupBy(by, "definition").agg(F.countDistinct("grp").alias("_g")) \
        .where(F.col("_g") == need[F.col("definition")]).select(by, "definition")


def merge_clusters(df: DataFrame, definitions: Mapping[str, Sequence[str]], channels: Sequence[str],
                   by: str = "cluster", label_threshold=0.90, keep: Sequence[str] = ("sample_id", "event_id"),
                   sep: str = "|") -> DataFrame:
    """Name clusters from definitions (F9): one column per definition (its name on events of hit
    clusters, else NULL), definitions without hits dropped, then merged by ``merge_exclusive`` next to
    the original ``orig`` ids.  No hit at all → only ``orig``."""
    hits = checked_side(definition_hits(df, definitions, channels, by, label_threshold)
                        .groupBy(by).agg(F.collect_set("definition").alias("_defs")))
    found = [r[0] for r in hits.select(F.explode("_defs")).distinct().collect()]   # definition names only
    names = [n for n in definitions if n in found]
    j = df.join(hits, by, "left")
    cols = {n: F.when(F.array_contains(F.col("_defs"), n), F.lit(n)) for n in names}
    j = j.withColumns(cols).withColumn("orig", F.col(by))
    return merge_exclusive(j, ["orig"] + names, sep, keep=list(keep))


def term_predicate(token: str, channels: Sequence[str], merged: Mapping[str, Sequence[str]] = MERGED_LABELS) -> Column:
    """Event-level test of one resolved state ``channel+label`` against the label columns."""
    for ch in sorted(channels, key=len, reverse=True):
        if token.startswith(ch):
            lv = token[len(ch):]
            members = [lv] if lv in LEVELS else list(merged[lv])
            return F.coalesce(F.col(pm(ch)).isin(*members), F.lit(False))
    raise ValueError(token)


def gate_by_definition(df: DataFrame, definitions: Mapping[str, Sequence[str]], channels: Sequence[str],
                       keep: Sequence[str] = ("sample_id", "event_id"), merge: bool = True, sep: str = "|") -> DataFrame:
    """Each event tested against each definition directly (F10): a column per definition with its name
    where every term (any alternative) holds, else NULL; then ``merge_exclusive`` unless ``merge=False``."""
    spark = df.sparkSession
    rows = [(n, gi, ai, t) for n, q in definitions.items() for gi, alts in enumerate(split_terms(q))
            for ai, t in enumerate(alts)]
    tf = spark.createDataFrame(rows, "definition string, grp int, alt int, term string")
    resolved = resolve_query(tf, channels).orderBy("definition", "grp", "alt").collect()  # query terms only
    cols = {}
    for name in definitions:
        pred = None
        for gi in sorted({r["grp"] for r in resolved if r["definition"] == name}):
            alt = None
            for r in [r for r in resolved if r["definition"] == name and r["grp"] == gi]:
                p = term_predicate(r["state"], channels)
                alt = p if alt is None else (alt | p)
            pred = alt if pred is None else (pred & alt)
        cols[name] = F.when(pred, F.lit(name))
    j = df.withColumns(cols)
    if not merge:
        return j.select(*keep, *definitions.keys())
    co = cooccurrence(j, list(definitions))
    hit = [n for n in definitions if co[(n, n)] > 0]          # definitions without any hit are dropped
    groups = exclusive_groups({k: v for k, v in co.items() if k[0] != k[1]}, hit)
    out = [F.coalesce(*[F.col(c) for c in g]).alias(sep.join(g)) if len(g) > 1 else F.col(g[0]) for g in groups]
    return j.select(*keep, *out)


def choose_cluster_set(df: DataFrame, a: str, b: str) -> str:
    """The cluster column with more distinct clusters; ties → ``a`` (the direct clustering) (F12)."""
    r = df.agg(F.countDistinct(a).alias("a"), F.countDistinct(b).alias("b")).first()
    return a if r["a"] >= r["b"] else b


def cluster_set_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct clusters per cluster column, long ``(cluster_set, n_clusters)``."""
    w = df.agg(*[F.countDistinct(c).alias(c) for c in cols])
    return w.unpivot([], list(cols), "cluster_set", "n_clusters")
