import numpy as np

from cytospark.llm import ann
from cytospark.llm.hnsw_index import Graph

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(ids, x, q, k=5):
    y = x / np.linalg.norm(x, axis=1)[:, None]
    s = y @ y[q]
    s[ids == ids[q]] = -9
    order = np.lexsort((ids, -np.round(s, 12)))[:k]
    return ids[order].tolist(), s[order]


def test_recall_ranks_and_scores_over_several_shards(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x[500:900] = x[500] + 0.05 * rng.normal(size=(400, 24))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    got = {}
    for r in ann.nearest(df, shard_rows=400).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hits = 0
    assert sorted(got) == list(range(0, 1500, 50))
    for q, found in got.items():
        want, scores = exact(np.arange(1500), x.astype(float), q)
        assert len(found) == 5 and q not in [v for v, _ in found]
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        hits += len(set(want) & {v for v, _ in found})
    assert hits >= 0.9 * 5 * len(got)


def test_copies_ties_odd_vectors_and_few_candidates(spark):
    bad = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [3.0, 4.0, 5.0]]
    rows = [(i, [1.0, 0.0], 0) for i in range(0, 400)] + [(50, [1.0, 0.0], 0), (None, [1.0, 0.0], 0)]
    rows += [(1000 + 50 * i, v, 0) for i, v in enumerate(bad)] + [(2001, [0.0, 1.0], 0), (2002, [1e-30, 1e30], 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rank", "2 AS score", "3 AS v")
    got = {}
    for r in ann.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    assert sorted(got) == [0, 50, 100, 150, 200, 250, 300, 350]
    assert got[0] == [(i, 1.0) for i in (1, 2, 3, 4, 5)] and got[50] == [(i, 1.0) for i in (0, 1, 2, 3, 4)]
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [1.0, 1.0], 0), (2, [-1.0, 0.0], 0)], SCHEMA)
    assert [(r["vec_id"], r["rank"]) for r in ann.nearest(few).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert ann.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_graph_survives_its_flat_form():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    g = Graph(x)
    h = Graph.unpack(g.pack())
    assert all((a == b).all() for a, b in zip(g.links, h.links))
    assert (g.search(x[:20], 5, 40) == h.search(x[:20], 5, 40)).all()
    assert (g.search(x[:20], 1, 40)[:, 0] == np.arange(20)).all()


def test_multiples_of_a_vector_tie(spark):
    """A third of all vectors have one direction, at many lengths: their ties go to the smallest ids."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 16))
    ids = rng.permutation(1500)
    x[:500] = x[0] * (2.0 ** rng.integers(-8, 8, 500))[:, None]
    whole = np.round(rng.normal(size=16) * 8)
    x[500:900] = whole * rng.integers(1, 200, 400)[:, None]
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x)], "vec_id long, embedding array<double>, label int")
    got = {}
    for r in ann.nearest(df, query="vec_id % 10 = 0", shard_rows=400).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    at = {int(i): k for k, i in enumerate(ids)}
    seen = 0
    for q, found in got.items():
        for low, high in ((0, 500), (500, 900)):
            if low <= at[q] < high:
                seen += 1
                assert found == sorted(i for i in ids[low:high].tolist() if i != q)[:5]
    assert seen > 60
