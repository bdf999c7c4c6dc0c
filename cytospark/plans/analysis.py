"""The whole analysis from one configuration (M1): panel and channels, preprocessing, transform, cut points and labels,
gates and stacking, clustering, naming, abundance models, layout, and the report tables.

``run_pipeline(spark, config, inputs)`` builds a graph of stages (see ``stage_graph``) whose results are stored and read
back by content key, so a second run computes nothing and a changed option recomputes only what lies behind it.

Inputs, by name: ``events`` (sample_id, event_id, channels), and where the configuration asks for them ``panel``
(sample_id, pos, name, desc), ``metadata`` (sample_id or id, group, covariates), ``files`` (file, if the metadata
have no sample_id), ``spillover`` (sample_id, from_ch, to_ch, coef), ``barcodes`` (the key of ``debarcode``)."""
from __future__ import annotations

import copy
import tomllib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytospark.functions.expr import EXCLUDED_CHANNELS_RE, channels_of, transformable
from cytospark.operators import (abundance, beads, community, cutpoints, density, embedding, enrichment, gating, kde, labels, metacluster, models,
                                 outliers, panel, phenotype, preprocess, report, samples, som, tables, transform)
from cytospark.plans.stage_graph import StageGraph
from cytospark.sources import events as sinks

METHODS = ("phenograph", "xshift", "density_peaks", "som", "column")

#: Every option with its default; None stands for "not given".
DEFAULTS: dict[str, dict] = {
    "channels": {"names": None, "type": "cytof", "exclude": EXCLUDED_CHANNELS_RE},
    "panel": {"reconcile": False, "name_remap": {}},
    "compensate": {"enabled": False},
    "beads": {"enabled": False, "bead_channels": [], "dna_channels": [], "mass_channels": [], "k": 500, "gate": "valley", "bead_q": 0.9, "dna_q": 0.5},
    "debarcode": {"enabled": False, "channels": [], "cutoff": 0.1, "separate": False},
    "outliers": {"enabled": False, "size": 500, "z_cutoff": 3.0, "density_frac": 0.1},
    "metadata": {"impute_numeric": [], "impute_categorical": [], "reference": {}},
    "transform": {"b": 1 / 150},
    "densities": {"enabled": True, "n_grid": 512},
    "cutoffs": {"bins": 4, "zero_threshold": 0.90, "max_sample": None, "seed": 666, "fixed": {}},
    "gates": {"strategy": []},
    "stack": {"n": 10_000, "seed": 666},
    "clusters": {"method": "phenograph", "k": 50, "per_sample": False, "meta_k": 15, "column": "cluster", "seed": 666, "options": {}},
    "merge": {"definitions": {}, "by": "clusters", "label_threshold": 0.9},
    "models": {"enabled": True, "formula": "~ group", "contrasts": {}, "include_other_vars": False, "alpha": None},
    "embedding": {"enabled": True, "n_neighbors": 15, "min_dist": 0.2, "epochs": 200, "seed": 666, "options": {}},
    "tables": {"enabled": True, "enrichment": True},
    "output": {"folder": None, "format": "parquet", "by_cluster": False},
}


def validated(config: Mapping) -> dict[str, dict]:
    """The configuration with all defaults filled in; unknown sections and options, wrong types and impossible choices
    raise with every fault named."""
    full, faults = copy.deepcopy(DEFAULTS), []
    for section, options in config.items():
        if section not in full:
            faults.append(f"unknown section [{section}]")
        elif not isinstance(options, Mapping):
            faults.append(f"[{section}] must hold options")
        else:
            for name, value in options.items():
                if name not in full[section]:
                    faults.append(f"unknown option {section}.{name}")
                    continue
                default = DEFAULTS[section][name]
                number = isinstance(default, (int, float)) and not isinstance(default, bool)
                right = default is None or value is None or isinstance(value, type(default)) or (
                    number and isinstance(value, (int, float)) and not isinstance(value, bool)) or (
                    isinstance(default, list) and isinstance(value, tuple)) or (isinstance(default, dict) and isinstance(value, Mapping))
                if not right:
                    faults.append(f"{section}.{name} must be {type(default).__name__}, not {type(value).__name__}")
                else:
                    full[section][name] = value
    if full["clusters"]["method"] not in METHODS:
        faults.append(f"clusters.method must be one of {', '.join(METHODS)}")
    if full["cutoffs"]["bins"] not in (2, 3, 4):
        faults.append("cutoffs.bins must be 2, 3 or 4")
    if full["merge"]["by"] not in ("clusters", "events"):
        faults.append("merge.by must be clusters or events")
    if full["beads"]["enabled"] and not full["beads"]["bead_channels"]:
        faults.append("beads.bead_channels must be given")
    if full["beads"]["gate"] not in ("valley", "quantile"):
        faults.append("beads.gate must be valley or quantile")
    if full["debarcode"]["enabled"] and not full["debarcode"]["channels"]:
        faults.append("debarcode.channels must be given")
    if full["output"]["by_cluster"] and not full["output"]["folder"]:
        faults.append("output.folder must be given for output.by_cluster")
    if faults:
        raise ValueError("; ".join(faults))
    return full


def read_config(path: str) -> dict[str, dict]:
    """A validated configuration from a TOML file."""
    with open(path, "rb") as f:
        return validated(tomllib.load(f))


def _clusters(df: DataFrame, channels: Sequence[str], o: Mapping) -> DataFrame:
    """``sample_id, event_id, cluster`` and, per sample, ``metacluster``."""
    method, more = o["method"], dict(o["options"])
    if method == "column":
        return df.select("sample_id", "event_id", F.col(o["column"]).cast("string").alias("cluster"))
    if o["per_sample"]:
        if method not in ("xshift", "density_peaks"):
            raise ValueError("clusters.per_sample needs method xshift or density_peaks")
        one = getattr(density, method)
        return metacluster.metacluster(df, channels, k=o["meta_k"], per_sample=lambda d: one(d, channels, k=o["k"], group="sample_id", **more)
                                       .select("sample_id", "event_id", "cluster"))
    if method == "phenograph":
        found = community.phenograph(df, channels, k=o["k"], seed=o["seed"], **more)
    elif method == "som":
        found = som.som_clusters(df, channels, k=o["k"], seed=o["seed"], **more)
    else:
        found = getattr(density, method)(df, channels, k=o["k"], **more)
    return df.select("sample_id", "event_id").join(found.select("event_id", F.col("cluster").cast("string").alias("cluster")), "event_id") \
        .select("sample_id", "event_id", "cluster")


def build(spark: SparkSession, config: Mapping, inputs: Mapping[str, DataFrame], root: str | None = None, refresh: Sequence[str] = (),
          keep: Sequence[str] = ()) -> StageGraph:
    """The stages that the configuration asks for, none computed yet (but for the channel list, when the panel names it)."""
    c = validated(config)
    wanted = {"events"} | ({"panel"} if c["panel"]["reconcile"] else set()) | ({"spillover"} if c["compensate"]["enabled"] else set()) \
        | ({"barcodes"} if c["debarcode"]["enabled"] else set()) | ({"metadata"} if c["models"]["enabled"] else set())
    if wanted - set(inputs):
        raise ValueError(f"missing inputs: {', '.join(sorted(wanted - set(inputs)))}")
    g = StageGraph(spark, inputs, root, refresh, keep)

    # ---- samples and panel
    if "metadata" in inputs:
        has_id = "sample_id" in inputs["metadata"].columns
        if not has_id and "files" not in inputs:
            raise ValueError("metadata without sample_id need the input files")

        def described(r):
            meta = samples.check_metadata(r["metadata"])
            if not has_id:
                listed = samples.number_files(r["files"]).withColumn("stem", samples.file_stem(F.col("file")))
                found = samples.match_metadata(listed, meta)
                meta = found.select("sample_id", *[k for k in meta.columns])
            o = c["metadata"]
            if o["impute_numeric"] or o["impute_categorical"]:
                meta = samples.impute_metadata(meta, o["impute_numeric"], o["impute_categorical"])
            return meta
        g.add("samples", described, ["metadata"] if has_id else ["metadata", "files"], c["metadata"], [samples.match_metadata])
        g.add("metadata_summary", lambda r: samples.summarize_metadata(r["samples"], "group", categorical=["id"]), ["samples"],
              code=[samples.summarize_metadata])
    last = "events"
    if c["panel"]["reconcile"]:
        g.add("channel_sheet", lambda r: panel.guess_channels(panel.reconcile_panel(r["panel"], name_remap=c["panel"]["name_remap"] or None),
                                                              c["channels"]["type"]), ["panel"], {**c["panel"], "type": c["channels"]["type"]},
              [panel.guess_channels])
        g.add("reconciled", lambda r: panel.reconcile_events(r["events"], r["panel"], name_remap=c["panel"]["name_remap"] or None),
              ["events", "panel"], c["panel"], [panel.reconcile_events])
        last = "reconciled"

    # ---- preprocessing; each step reads the one before it
    def step(name, section, work, fn, *more):
        nonlocal last
        before = last
        g.add(name, lambda r: work(r[before], r), [before, *more], c[section], [fn])
        last = name
    b = c["beads"]
    if b["enabled"]:
        step("normalised", "beads", lambda d, r: beads.bead_normalize(d, b["bead_channels"], b["dna_channels"], b["mass_channels"] or b["bead_channels"],
                                                                      k=b["k"], bead_q=b["bead_q"], dna_q=b["dna_q"], gate=b["gate"]), beads.bead_normalize)
    if c["debarcode"]["enabled"]:
        def assigned(d, r):
            found = preprocess.debarcode(d, r["barcodes"], c["debarcode"]["channels"], c["debarcode"]["cutoff"])
            return preprocess.separate_samples(found)[0] if c["debarcode"]["separate"] else found
        step("debarcoded", "debarcode", assigned, preprocess.debarcode, "barcodes")
    names = c["channels"]["names"]
    if names is None and c["panel"]["reconcile"]:
        # One row per channel: the sheet is as long as the panel's list of channels.
        used = panel.selected_channels(g.result("channel_sheet")).select("name")
        names = [row["name"] for row in used.orderBy("name").collect()]
    if names is None:
        known = {k for k in inputs["events"].columns if k in ("sample_id", "event_id", "time", c["clusters"]["column"])}
        names = [k for k in channels_of(inputs["events"]) if k not in known]
    names = transformable(list(names), c["channels"]["exclude"])
    if not names:
        raise ValueError("no channels left to analyse")
    if c["compensate"]["enabled"]:
        step("compensated", "compensate", lambda d, r: preprocess.compensate(d, r["spillover"], names), preprocess.compensate, "spillover")
    o = c["outliers"]
    if o["enabled"]:
        step("screened", "outliers", lambda d, r: outliers.remove_outlier_segments(d, names, o["size"], o["z_cutoff"], o["density_frac"]),
             outliers.remove_outlier_segments)
    with_names = {**c["transform"], "channels": names}
    raw = last
    g.add("transformed", lambda r: transform.arcsinh(r[raw], c["transform"]["b"], channels=names), [raw], with_names, [transform.arcsinh])
    if c["densities"]["enabled"]:
        g.add("densities", lambda r: kde.density_curves(r["transformed"], names, n_grid=c["densities"]["n_grid"]), ["transformed"],
              {**c["densities"], "channels": names}, [kde.density_curves])

    # ---- cut points and labels
    k = c["cutoffs"]
    fixed = {name: list(cuts) for name, cuts in k["fixed"].items()}
    searched = [n for n in names if n not in fixed]

    def cut(r):
        parts = []
        if searched:
            parts.append(cutpoints.find_cutoffs(r["transformed"], searched, k["bins"], k["zero_threshold"], k["max_sample"], k["seed"]))
        if fixed:
            rows = [(name, i + 1, float(x)) for name, cuts in fixed.items() for i, x in enumerate(sorted(cuts))]
            given = spark.createDataFrame(rows, "channel string, cut_no int, cutoff double")
            parts.append(r["transformed"].select("sample_id").distinct().join(F.broadcast(given))
                         .select("sample_id", "channel", "cut_no", "cutoff", F.lit("fixed").alias("method")))
        kinds = {f.name: f.dataType for f in parts[0].schema.fields if f.name in ("sample_id", "channel", "cut_no", "cutoff", "method")}
        parts = [p.select(*[F.col(n).cast(t).alias(n) for n, t in kinds.items()]) for p in parts]
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    g.add("cutoffs", cut, ["transformed"], {**k, "channels": names}, [cutpoints.find_cutoffs])
    g.add("labelled", lambda r: labels.label_events(r["transformed"], r["cutoffs"], names), ["transformed", "cutoffs"], {"channels": names},
          [labels.label_events])

    # ---- gates, counts, stacking
    strategy = [(s[0], dict(s[1])) if not isinstance(s, Mapping) else (s["name"], {n: v for n, v in s.items() if n != "name"})
                for s in c["gates"]["strategy"]]
    gated = "labelled"
    if strategy:
        g.add("gate_counts", lambda r: gating.gate_counts(r["labelled"], strategy), ["labelled"], {"strategy": strategy}, [gating.gate_counts])
        g.add("gated", lambda r: gating.gate(r["labelled"], strategy), ["labelled"], {"strategy": strategy}, [gating.gate])
        gated = "gated"
    described_by = ["samples"] if "metadata" in inputs else []
    g.add("cell_counts", lambda r: tables.cell_counts(r[raw], r[gated], r.get("samples")), [raw, gated, *described_by], code=[tables.cell_counts])
    g.add("stacked", lambda r: transform.sample_events(r[gated], c["stack"]["n"], c["stack"]["seed"]), [gated], c["stack"], [transform.sample_events])

    # ---- clusters and their names
    m = c["clusters"]
    if m["method"] == "column" and m["column"] not in inputs["events"].columns:
        raise ValueError(f"clusters.column {m['column']} is no column of the events")
    g.add("clusters", lambda r: _clusters(r["stacked"], names, m), ["stacked"], {**m, "channels": names},
          [_clusters, community.louvain, density.xshift, som.som_clusters, metacluster.metacluster])
    sets = ["cluster", "metacluster"] if m["per_sample"] and m["method"] != "column" else ["cluster"]

    def joined(r):
        own = [n for n in sets if n in r["stacked"].columns]
        return r["stacked"].drop(*own).join(r["clusters"].select("sample_id", "event_id", *sets), ["sample_id", "event_id"])
    g.add("clustered", joined, ["stacked", "clusters"], {"sets": sets})
    # Of several cluster columns the one with the most clusters goes on, the direct clustering on ties (F12).
    g.add("set_sizes", lambda r: phenotype.cluster_set_counts(r["clustered"], sets), ["clustered"], {"sets": sets}, [phenotype.cluster_set_counts])
    g.add("cluster_sizes", lambda r: tables.cluster_sizes(r["clustered"]), ["clustered"], code=[tables.cluster_sizes])
    n = c["merge"]
    threshold = n["label_threshold"]
    g.add("phenotypes", lambda r: phenotype.phenotype_strings(phenotype.summarize_phenotypes(
        r["clustered"].where("cluster IS NOT NULL"), names, "cluster", threshold)), ["clustered"], {"channels": names, "threshold": threshold},
        [phenotype.summarize_phenotypes])
    definitions = {name: list(terms) for name, terms in n["definitions"].items()}

    def named(r):
        if not definitions:
            return r["clustered"]
        if n["by"] == "events":
            found = phenotype.gate_by_definition(r["clustered"], definitions, names)
        else:
            found = phenotype.merge_clusters(r["clustered"], definitions, names, "cluster", threshold).drop("orig")
        return r["clustered"].join(found, ["sample_id", "event_id"])
    g.add("named", named, ["clustered"], {**n, "channels": names}, [phenotype.merge_clusters, phenotype.gate_by_definition])

    def cluster_sets(df: DataFrame) -> list[str]:
        """Cluster columns of the named events: found ones first, then those that the definitions made."""
        return [*sets, *[x for x in df.columns if x not in set(g.result("clustered").columns)]]

    # ---- abundance
    def counted(r):
        parts = []
        kept = r.get("samples")
        for name in cluster_sets(r["named"]):
            own = r["named"].select("sample_id", F.col(f"`{name}`").cast("string").alias("cluster"))
            if own.where("cluster IS NOT NULL").isEmpty():
                continue
            parts.append(abundance.abundance_counts(own, kept).withColumn("cluster_set", F.lit(name)))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    g.add("counts", counted, ["named", *described_by], code=[abundance.abundance_counts])
    f = c["models"]
    if f["enabled"]:
        levels_of = f["formula"].replace("~", " ").replace("+", " ").replace(":", " ").split()

        def modelled(r):
            meta = r["samples"]
            factors = [x for x in dict.fromkeys(levels_of) if dict(meta.dtypes).get(x) == "string"]
            order = {}
            if factors:
                listed = samples.reference_levels(meta, c["metadata"]["reference"], factors).orderBy("variable", "level_no")
                for row in listed.collect():          # one row per level of the formula's factors
                    order.setdefault(row["variable"], []).append(row["level"])
            design, coefficients = abundance.design_matrix(meta, f["formula"], order)
            # One fit per cluster set; the sets share the samples, not their dispersion.
            out = None
            for (name,) in r["counts"].select("cluster_set").distinct().orderBy("cluster_set").collect():
                fits = models.differential_abundance(r["counts"].where(F.col("cluster_set") == name), design, coefficients)
                asked = {x: dict(w) if isinstance(w, Mapping) else {w: 1.0} for x, w in f["contrasts"].items()} or {
                    x: {x: 1.0} for x in coefficients[1:]}
                tested = models.test_contrasts(fits, asked, f["include_other_vars"], f["alpha"]).withColumn("cluster_set", F.lit(name))
                out = tested if out is None else out.unionByName(tested)
            return out
        g.add("contrasts", modelled, ["counts", "samples"], {**f, "reference": c["metadata"]["reference"]},
              [models.differential_abundance, models.test_contrasts, abundance.design_matrix])

    # ---- layout and its tables
    e = c["embedding"]
    if e["enabled"]:
        g.add("embedding", lambda r: embedding.embed_umap(r["stacked"], names, n_neighbors=e["n_neighbors"], min_dist=e["min_dist"],
                                                          epochs=e["epochs"], seed=e["seed"], **e["options"]), ["stacked"],
              {**e, "channels": names}, [embedding.embed_umap])

        def placed(r):
            d = r["clustered"].select("sample_id", "event_id", "cluster").join(
                r["embedding"].select("event_id", F.col("x").alias("dim1"), F.col("y").alias("dim2")), "event_id")
            group = r["samples"].select("sample_id", "group") if "samples" in r else None
            d = d.join(group, "sample_id", "left") if group is not None else d.withColumn("group", F.lit(None).cast("string"))
            return tables.embedding_centroids(d)
        g.add("embedding_centroids", placed, ["clustered", "embedding", *described_by], code=[tables.embedding_centroids])
        if f["enabled"]:
            g.add("overlay", lambda r: tables.differential_overlay(
                r["clustered"].select("sample_id", "event_id", "cluster").join(r["embedding"], "event_id"),
                r["contrasts"].where("cluster_set = 'cluster'").groupBy("cluster").agg(
                    F.min_by(F.struct("logFC", "FDR"), F.struct("FDR", "contrast")).alias("r")).select("cluster", "r.logFC", "r.FDR"),
                r["samples"].select("sample_id", "group"), alpha=f["alpha"] or 0.05), ["clustered", "embedding", "contrasts", "samples"],
                {"alpha": f["alpha"]}, [tables.differential_overlay])

    # ---- report tables
    if c["tables"]["enabled"]:
        g.add("medians", lambda r: tables.scale_medians(tables.cluster_medians(r["clustered"], names)), ["clustered"], {"channels": names},
              [tables.cluster_medians])
        g.add("centroids", lambda r: tables.centroids(r["clustered"], names), ["clustered"], {"channels": names}, [tables.centroids])
        g.add("summary", lambda r: report.summary_long(report.summary_tables(r["named"], cluster_sets(r["named"]), names, threshold)),
              ["named"], {"channels": names, "threshold": threshold}, [report.summary_tables])
        if c["tables"]["enrichment"]:
            g.add("enrichment", lambda r: enrichment.enrichment_labels(enrichment.mem_scores(r["clustered"].where("cluster IS NOT NULL"), names), names),
                  ["clustered"], {"channels": names}, [enrichment.mem_scores])
    g.config, g.channels, g.cluster_sets = c, names, lambda: cluster_sets(g.result("named"))
    return g


def run_pipeline(spark: SparkSession, config: Mapping, inputs: Mapping[str, DataFrame], root: str | None = None, refresh: Sequence[str] = (),
                 keep: Sequence[str] = ()) -> StageGraph:
    """Compute (or read back) every stage and write what ``[output]`` asks for; the graph's ``result(name)`` gives the
    tables, ``computed`` and ``reused`` tell what was done."""
    g = build(spark, config, inputs, root, refresh, keep)
    g.results()
    out = g.config["output"]
    if out["folder"]:
        made = report.summary_tables(g.result("named"), g.cluster_sets(), g.channels, g.config["merge"]["label_threshold"])
        sinks.write_summary_tables(made, f"{out['folder'].rstrip('/')}/summary", out["format"])
        if out["by_cluster"]:
            sinks.write_by_cluster(g.result("named"), g.cluster_sets(), f"{out['folder'].rstrip('/')}/by_cluster")
    return g
