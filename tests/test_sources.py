"""Sources, sinks and stage store on small written tables."""
import tempfile

from pyspark.sql import functions as F

from helpers import SF001


def test_read_events_numbers_files_and_prunes(spark):
    from cytospark.sources.events import read_events
    d = tempfile.mkdtemp(prefix="cyto-src-")
    a = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "ch1 double, ch2 double")
    b = spark.createDataFrame([(5.0, 6.0, 7.0)], "ch1 double, ch2 double, ch3 double")
    a.write.parquet(f"{d}/a.parquet")
    b.write.parquet(f"{d}/b.parquet")
    ev = read_events(spark, [f"{d}/a.parquet", f"{d}/b.parquet"], channels=["ch1", "ch3"])
    rows = sorted((r.sample_id, r.ch1, r.ch3) for r in ev.collect())
    assert rows == [(1, 1.0, None), (1, 3.0, None), (2, 5.0, 7.0)]
    assert ev.select("event_id").distinct().count() == 3


def test_write_augmented_skips_existing(spark):
    from cytospark.sources.events import write_augmented
    from cytospark.sources import fixtures as fx
    d = tempfile.mkdtemp(prefix="cyto-aug-") + "/aug"
    ev = fx.line_events(spark, SF001)
    write_augmented(ev.where("sample_id <= 2"), d)
    out = write_augmented(ev, d, overwrite=False)
    assert out.count() == ev.count()
    assert out.groupBy("sample_id").count().count() == ev.select("sample_id").distinct().count()


def test_write_by_cluster_drops_null(spark):
    from cytospark.sources.events import write_by_cluster
    d = tempfile.mkdtemp(prefix="cyto-bycl-") + "/out"
    df = spark.createDataFrame([(1, 1, "a b", None), (1, 2, "c", "x"), (2, 3, None, "x")],
                               "sample_id int, event_id long, orig string, merged string")
    write_by_cluster(df, ["orig", "merged"], d)
    back = spark.read.parquet(d)
    assert back.count() == 4
    assert {r.cluster for r in back.where(F.col("set") == "orig").collect()} == {"a_b", "c"}


def test_stage_store_cascade(spark):
    from cytospark.plans.stages import StageStore
    root = tempfile.mkdtemp(prefix="cyto-stage-")
    calls = []

    def mk(v):
        def f():
            calls.append(v)
            return spark.createDataFrame([(v,)], "v int")
        return f
    s = StageStore(spark, "run1", ["a", "b", "c"], root)
    for n, v in zip("abc", (1, 2, 3)):
        s.run(n, mk(v))
    s2 = StageStore(spark, "run1", ["a", "b", "c"], root, refresh=["b"])
    for n, v in zip("abc", (1, 2, 3)):
        s2.run(n, mk(v))
    assert calls == [1, 2, 3, 2, 3]


def test_read_events_paths_with_spaces_and_equal_tails(spark, tmp_path):
    from cytospark.sources.events import read_events
    paths = []
    for i, name in enumerate(["one x/a b.parquet", "two/one x/a b.parquet", "plus+%41/c.parquet"]):
        p = str(tmp_path / name)
        spark.createDataFrame([(float(i),), (10.0 + i,)], "ch1 double").coalesce(1).write.parquet(p)
        paths.append(p)
    ev = read_events(spark, paths)
    rows = sorted((r.sample_id, r.ch1) for r in ev.collect())
    assert rows == [(1, 0.0), (1, 10.0), (2, 1.0), (2, 11.0), (3, 2.0), (3, 12.0)]
    again = {(r.event_id, r.ch1) for r in read_events(spark, paths).collect()}
    assert again == {(r.event_id, r.ch1) for r in ev.collect()} and len({i for i, _ in again}) == 6


def test_write_by_cluster_keeps_long_and_alike_names_apart(spark, tmp_path):
    from cytospark.sources.events import write_by_cluster
    long = "c" * 40
    df = spark.createDataFrame([(1, long + "1"), (2, long + "2"), (3, "a b"), (4, "a_b")], "event_id long, s string")
    write_by_cluster(df, ["s"], str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select("cluster").distinct().count() == 4


def test_broadcast_goes_by_bytes(spark):
    from cytospark.functions.plan import checked_side
    df = spark.range(100).selectExpr("id", "transform(sequence(1, 1000), x -> double(x)) AS a")
    plan = lambda d: d._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in plan(checked_side(df)) and "strategy=broadcast" not in plan(checked_side(df, 100_000))
