import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from cytospark.llm import simhash as s


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [brute_fp(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, j in combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 2:
            up[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, f"{fps[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def some_rows():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcde") for _ in range(3)) for _ in range(40)]
    rows, k = [], 0
    for _ in range(25):
        text = [rng.choice(words) for _ in range(rng.choice([2, 5, 60, 300]))]
        for _ in range(rng.randint(1, 5)):
            copy = list(text)
            if rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((k, " ".join(copy)))
            k += 1
    return rows + [(7000, None), (7001, ""), (7002, " \n"), (7003, "One"), (7004, "ONE"), (7004, "one"), (None, "one"), (None, "lonely words here now")]


def test_components_equal_brute_force(docs_of):
    rows = some_rows()
    got = sorted((tuple(r) for r in s.simhash_components(docs_of(rows)).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("hot", [2048, 3, 0])
@pytest.mark.parametrize("bits", [2, 4])
def test_links_are_complete_and_single_also_in_hot_buckets(spark, hot, bits):
    rng = random.Random(4)
    fps = set()
    for _ in range(8):
        base = rng.getrandbits(64)
        for _ in range(40):
            x = base
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x - (1 << 64) if x >> 63 else x)
    got = [tuple(r) for r in s.links(spark.createDataFrame([(x,) for x in fps], "fp long"), bits, hot).collect()]
    want = {(a, b) for a, b in combinations(sorted(fps), 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("hot", [2048, 10])
def test_variants_are_never_broadcast(spark, tmp_path, hot):
    """A small file of fingerprints becomes 64 times as many rows; Spark takes them for as small as the file."""
    spark.range(2000).select(F.xxhash64("id").bitwiseAND(~0xFFFFFFFF).bitwiseOR(F.col("id") % 50).alias("fp")).distinct().write.parquet(f"{tmp_path}/fps")
    found = s.links(spark.read.parquet(f"{tmp_path}/fps"), 2, hot)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join Inner" in line]
    assert len(joins) == (2 if hot == 10 else 1) and all("strategy=merge" in j for j in joins), joins


def test_long_chains_become_one_component(spark):
    edges = spark.range(199).selectExpr("(id * 37) % 200 AS a", "((id + 1) * 37) % 200 AS b")
    got = {r["node"]: r["rep"] for r in s.components(edges).collect()}
    assert len(got) == 200 and set(got.values()) == {0}
    assert s.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(docs_of):
    text = " ".join(f"word{i}" for i in range(50))
    rows = [(5, text), (3, text), (3, text), (9, "another text of its own"), (None, text), (11, None), (12, "")]
    docs = docs_of(rows).selectExpr("*", "1 AS fp", "2 AS _stay", "3 AS component_id", "4 AS _digest", "5 AS _stay_id")
    out = s.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted((str(r["doc_id"]) for r in out.collect())) == ["11", "3", "9"]
    assert s.keep_one(docs_of([])).count() == 0 and s.simhash_components(docs_of([])).count() == 0


def test_rows_with_one_id_are_judged_apart(docs_of):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")

    def kept(rows):
        return sorted(((r["doc_id"], r["text"][0]) for r in s.keep_one(docs_of(rows)).collect()), key=str)
    assert kept([(1, a), (1, b), (2, c)]) == [(1, "a"), (1, "b"), (2, "c")]
    assert kept([(1, a), (5, a), (5, b)]) == [(1, "a"), (5, "b")]
    assert kept([(None, a)] * 3 + [(None, b), (4, b)]) == [(4, "b"), (None, "a")]
    comp = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in s.simhash_components(docs_of([(1, a), (1, b), (5, b), (7, c)])).collect()}
    assert sorted(comp.values()) == [1, 1, 1, 7]


def test_text_of_many_shingle_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(500))
    whole = s._fingerprint(text.encode(), 3, 42)
    monkeypatch.setattr(s, "_BLOCK", 7)
    assert s._fingerprint(text.encode(), 3, 42) == whole == brute_fp(text)
