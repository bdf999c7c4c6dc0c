"""The configured analysis: stages by content key, markers, refreshes, validation, and a planted end-to-end run."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from cytospark.plans import analysis
from cytospark.plans.stage_graph import StageGraph
from cytospark.plans.stages import StageStore
from cytospark.session import path_exists, read_marker


def chain(spark, root, calls, factor=1, inputs=None, **kw):
    inputs = inputs or {"base": spark.range(5)}
    g = StageGraph(spark, inputs, root, **kw)

    def stage(name, work):
        def make(r):
            calls.append(name)
            return work(r)
        return make
    g.add("a", stage("a", lambda r: r["base"].selectExpr("id + 1 AS id")), ["base"])
    g.add("b", stage("b", lambda r: r["a"].selectExpr(f"id * {factor} AS id")), ["a"], {"factor": factor})
    g.add("c", stage("c", lambda r: r["b"].agg(F.sum("id").alias("s"))), ["b"])
    g.add("d", stage("d", lambda r: r["a"].agg(F.max("id").alias("m"))), ["a"])
    return g


def test_only_what_changed_is_computed(spark, tmp_path):
    root, calls = str(tmp_path / "graph"), []
    g = chain(spark, root, calls)
    assert g.result("c").first()["s"] == 15 and g.result("d").first()["m"] == 5 and calls == ["a", "b", "c", "d"]
    again = chain(spark, root, calls)
    assert again.result("c").first()["s"] == 15 and calls == ["a", "b", "c", "d"] and again.reused == ["c"]
    other = chain(spark, root, calls, factor=3)
    other.results()
    assert other.result("c").first()["s"] == 45 and other.computed == ["b", "c"] and set(other.reused) == {"a", "d"}
    chain(spark, root, calls).results()
    assert calls == ["a", "b", "c", "d", "b", "c"]


def test_new_input_is_noticed(spark, tmp_path):
    root, calls, place = str(tmp_path / "graph"), [], str(tmp_path / "in")
    spark.range(3).write.parquet(place)
    assert chain(spark, root, calls, inputs={"base": spark.read.parquet(place)}).result("c").first()["s"] == 6
    chain(spark, root, calls, inputs={"base": spark.read.parquet(place)}).result("c")
    assert calls == ["a", "b", "c"]
    spark.range(4).write.mode("overwrite").parquet(place)
    assert chain(spark, root, calls, inputs={"base": spark.read.parquet(place)}).result("c").first()["s"] == 10


def test_unfinished_results_are_not_read(spark, tmp_path):
    root, calls = str(tmp_path / "graph"), []
    g = chain(spark, root, calls)
    g.result("c")
    marker = g._marker("b", g.key("b"))
    folder = read_marker(spark, marker)
    assert path_exists(spark, folder)
    # The data of b are there, but not its marker: as after a job that died before it was done.
    from cytospark.session import drop_path
    drop_path(spark, marker)
    again = chain(spark, root, calls)
    again.results()
    assert again.computed == ["b", "d"] and read_marker(spark, marker) != folder

    def fails(r):
        return r["base"].select(F.raise_error(F.lit("broken")).alias("x"))
    g = StageGraph(spark, {"base": spark.range(5)}, root)
    g.add("f", fails, ["base"])
    with pytest.raises(Exception, match="broken"):
        g.result("f")
    assert not g.finished("f")
    store = StageStore(spark, "run", ["f"], root)
    with pytest.raises(Exception, match="broken"):
        store.run("f", lambda: fails({"base": spark.range(5)}))
    assert not store.exists("f")
    spark.range(2).write.mode("overwrite").parquet(store.path("f"))       # a folder alone is no finished stage
    assert not store.exists("f")


def test_refresh_goes_on_to_later_stages(spark, tmp_path):
    root, calls = str(tmp_path / "graph"), []
    chain(spark, root, calls).results()
    calls.clear()
    chain(spark, root, calls, refresh=["b"]).results()
    assert calls == ["b", "c"]
    calls.clear()
    chain(spark, root, calls, refresh=["a"], keep=["c"]).results()
    assert calls == ["a", "b", "d"]
    calls.clear()
    chain(spark, root, calls).results()
    assert calls == []


def test_faulty_configurations(spark):
    with pytest.raises(ValueError, match="unknown section .colour..*unknown option stack.many.*cutoffs.bins"):
        analysis.validated({"colour": {}, "stack": {"many": 1}, "cutoffs": {"bins": 5}})
    for bad, text in (({"clusters": {"method": "kmeans"}}, "clusters.method"), ({"stack": {"n": "all"}}, "stack.n must be int"),
                      ({"beads": {"enabled": True}}, "bead_channels"), ({"models": {"enabled": 1}}, "models.enabled must be bool")):
        with pytest.raises(ValueError, match=text):
            analysis.validated(bad)
    df = spark.createDataFrame([(1, 1, 0.5)], "sample_id int, event_id long, a double")
    with pytest.raises(ValueError, match="missing inputs: metadata"):
        analysis.build(spark, {}, {"events": df})
    with pytest.raises(ValueError, match="no column"):
        analysis.build(spark, {"clusters": {"method": "column", "column": "x"}, "models": {"enabled": False}}, {"events": df})


def test_configuration_from_a_file(tmp_path):
    path = tmp_path / "run.toml"
    path.write_text('[clusters]\nmethod = "xshift"\nk = 20\n\n[gates]\nstrategy = [["live", {a = "> 0"}]]\n\n[merge.definitions]\n"T cell" = ["cd3+/++"]\n')
    c = analysis.read_config(str(path))
    assert c["clusters"]["k"] == 20 and c["stack"]["n"] == 10_000 and c["merge"]["definitions"] == {"T cell": ["cd3+/++"]}


def planted(spark):
    """Eight samples of two groups; three kinds of events in three channels, the second twice as frequent in group g2."""
    rng, rows, eid = np.random.default_rng(4), [], 0
    for sample in range(8):
        for kind, n in enumerate((60, 30 if sample < 4 else 60, 40)):
            for v in rng.normal([(5, 0.5, 0.5), (0.5, 5, 0.5), (0.5, 0.5, 5)][kind], 0.3, (n, 3)):
                rows.append((sample, eid, *map(float, v)))
                eid += 1
    meta = [(s, f"s{s}", "g1" if s < 4 else "g2") for s in range(8)]
    return spark.createDataFrame(rows, "sample_id int, event_id long, a double, b double, c double"), \
        spark.createDataFrame(meta, "sample_id int, id string, group string")


def test_some_cut_points_given_and_some_searched(spark, tmp_path):
    events, _ = planted(spark)
    config = {"transform": {"b": None}, "cutoffs": {"fixed": {"a": [2.5]}, "bins": 2}, "models": {"enabled": False}}
    g = analysis.build(spark, config, {"events": events}, str(tmp_path / "run"))
    rows = g.result("cutoffs").collect()
    assert {r["cutoff"] for r in rows if r["channel"] == "a"} == {2.5} and {r["channel"] for r in rows} == {"a", "b", "c"}
    assert all(0 < r["cutoff"] < 5 for r in rows) and len(rows) == 24 and {r["method"] for r in rows if r["channel"] != "a"} <= {"silhouette", "mean"}
    assert g.result("labelled").where("a__pm IS NULL OR b__pm IS NULL").count() == 0


def test_planted_analysis(spark, tmp_path):
    events, meta = planted(spark)
    fixed = {x: [1.0, 2.5, 6.0] for x in "abc"}
    config = {"transform": {"b": None}, "cutoffs": {"fixed": fixed}, "stack": {"n": None}, "densities": {"n_grid": 32},
              "gates": {"strategy": [["range", {"a": "< 20"}]]}, "clusters": {"method": "xshift", "k": 25, "options": {"cell_size": 300}},
              "merge": {"definitions": {"A": ["a+/++"], "B": ["b+/++"], "C": ["c+/++"]}, "label_threshold": 0.8},
              "embedding": {"epochs": 20, "options": {"cell_size": 300}},
              "output": {"folder": str(tmp_path / "out"), "by_cluster": True}}
    root = str(tmp_path / "run")
    g = analysis.run_pipeline(spark, config, {"events": events, "metadata": meta}, root)
    assert {"cutoffs", "gated", "clusters", "named", "counts", "contrasts", "embedding", "overlay", "summary", "enrichment"} <= set(g.computed)
    # The merged names are exclusive, so they make one column that follows the plant.
    named = g.result("named")
    assert "A|B|C" in named.columns
    kinds = named.groupBy("A|B|C").count().collect()
    assert {r[0]: r[1] for r in kinds} == {"A": 480, "B": 360, "C": 320}
    tested = {r["cluster"]: r for r in g.result("contrasts").where("cluster_set = 'A|B|C'").collect()}
    assert tested["B"]["FDR"] < 0.01 and tested["B"]["logFC"] > 0.4
    assert g.result("embedding").where("x IS NOT NULL").count() == 1160
    assert g.result("cell_counts").agg(F.sum("n_gated")).first()[0] == 1160
    folders = {p.name for p in (tmp_path / "out" / "summary").iterdir()}
    assert {"events--cluster", "PM--cluster", "medians--cluster", "events--A--B--C"} & folders
    assert spark.read.parquet(str(tmp_path / "out" / "by_cluster")).where(F.col("set") == "A|B|C").count() == 1160
    again = analysis.run_pipeline(spark, {**config, "output": {}}, {"events": events, "metadata": meta}, root)
    assert again.computed == []
    config["merge"] = {**config["merge"], "label_threshold": 0.7}
    changed = analysis.run_pipeline(spark, {**config, "output": {}}, {"events": events, "metadata": meta}, root)
    assert set(changed.computed) == {"phenotypes", "named", "counts", "contrasts", "overlay", "summary"}
