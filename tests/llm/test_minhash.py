"""MinHash components against comparing all sets."""
import random
import re

from pyspark.sql import functions as F

from cytospark.llm import minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i:i + 3]) for i in range(len(words) - 2)) if len(words) >= 3 else frozenset([tuple(words)] if words else [])


def plain(rows):
    """(doc_id, n, component, kept) by comparing each set with every other."""
    sets = [plain_set(t) for _, t in rows]
    owner = list(range(len(rows)))

    def find(i):
        while owner[i] != i:
            i = owner[i]
        return i
    distinct = {}
    for i, s in enumerate(sets):
        if s:
            owner[find(i)] = find(distinct.setdefault(s, i))
    items = sorted(distinct.items(), key=lambda x: len(x[0]))
    for i, (a, x) in enumerate(items):
        for b, y in items[i + 1:]:
            if 100 * len(a) < 85 * len(b):
                break
            common = len(a & b)
            if 100 * common >= 85 * (len(a) + len(b) - common):
                owner[find(x)] = find(y)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted(((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def near_copies(seed, n=300):
    """Families of texts with some words changed, in chains and stars, some just below and some above the limit."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(500)]
    rows, i = [], 0
    while len(rows) < n:
        text = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 8, 40, 120, 400]))]
        for _ in range(rng.randint(1, 25)):
            rows.append((i, " ".join(text)))
            i += 1
            if rng.random() < 0.7:
                text = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 40))):
                text[rng.randrange(len(text))] = rng.choice(vocab)
    return rows


def test_equals_comparing_all(spark):
    for seed in (1, 2):
        rows = near_copies(seed)
        assert got(minhash.minhash_components(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got(minhash.minhash_components(docs)) == plain([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_blocks_give_the_same(spark):
    rows = near_copies(3, 200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = minhash.marked(docs).where("n > 0").dropDuplicates(["node"])
    whole = minhash.components(minhash.match_links(nodes))
    parts = minhash.components(minhash.match_links(nodes, list_rows=4))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    groups = whole.join(nodes.select("node", "n", "doc_id", "text_hash"), "node")
    for limits in ({"group_rows": 5}, {"group_shingles": 900}):
        links = minhash.confirmed_links(groups, docs, "doc_id", "text", 3, **limits)
        full = minhash.confirmed_links(groups, docs, "doc_id", "text", 3)
        assert sorted(map(tuple, minhash.components(links).collect())) == sorted(map(tuple, minhash.components(full).collect()))


def test_edges(spark):
    long_text = " ".join(f"t{i % 5003}x{i % 77}" for i in range(300_000))
    base = " ".join(f"b{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "Two words"), (5, "two  WORDS"), (6, "two words more"), (7, long_text),
            (8, long_text + " end"), (9, base), (9, base + " x"), (9, "other text of one id"), (None, base), (None, "lonely null id"),
            (None, "lonely null id"), (10, "É é"), (11, "é é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)).withColumn("n", F.lit("x"))
    assert got(minhash.minhash_components(docs)) == plain(rows)
    assert minhash.minhash_components(docs.limit(0)).collect() == []


def test_hot_classes_are_joined_once(spark, monkeypatch):
    from cytospark.llm import common
    left = spark.createDataFrame([(i, "a" if i % 3 else f"k{i}") for i in range(30_000)], "id long, k string")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("least"))
    out = common.join_classes(left, right, "k", "rows")
    assert out.count() == 30_000 and out.where("least > id").count() == 0
