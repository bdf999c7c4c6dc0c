import random
import re
from collections import Counter

from pyspark.sql import functions as F

from cytospark.llm import common, quality_rules as q, textops

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] >= 2 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines)}


def texts():
    rng = random.Random(1)
    out = ["", "a", "a b", "a b c a b c", "\n \n\n", "x\n x\nx\n", "é ü b\u0085c\x1c d", "#*$ <a>|"]
    out += [" ".join(rng.choice("aa bé c# dd".split()) + rng.choice(["", "\n", "\t"]) for _ in range(rng.randint(0, 80)))
            for _ in range(60)]
    return out


def test_measures_equal_brute_force(monkeypatch):
    found = q.measure_texts([t.encode() for t in texts()])
    for i, t in enumerate(texts()):
        assert {k: int(v[i]) for k, v in found.items()} == brute(t), t
    monkeypatch.setattr(textops, "BLOCK_BYTES", 16)
    long = "word and " * 3000 + "x" * 500
    counts, hashes = textops.word_hashes([long.encode()], limit=64)
    assert counts.tolist() == [6001] and len(set(hashes.tolist())) == 3


def test_host_with_junk_is_rejected_and_null_host_is_not(docs_of):
    rng = random.Random(2)
    good = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    rows = [(i, good(), "en", f"h{i % 20}") for i in range(400)] + [(1000 + i, "too short", "en", "junk") for i in range(40)]
    rows += [(2000, good(), "en", "junk"), (2001, good(), "en", None), (2002, None, "en", None), (2001, good(), "en", "h1")]
    got = {}
    for r in q.quality_rules(docs_of(rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert got[2000][0]["host_rejected"] and not got[2000][0]["base_failed"] and not got[2000][0]["kept"]
    assert not got[2002][0]["host_rejected"] and not got[2002][0]["kept"] and got[2002][0]["n_words"] == 0
    assert len(got[2001]) == 2 and all(r["kept"] for r in got[2001])
    assert all(got[i][0]["kept"] for i in range(400))


def test_salted_join_gives_the_same_verdicts(docs_of, monkeypatch):
    rows = [(i, "a b c", "en", "junk") for i in range(30)] + [(100 + i, " ".join(f"wordy{j}" for j in range(60)), "en", f"h{i % 9}") for i in range(90)]
    want = sorted(map(tuple, q.quality_rules(docs_of(rows)).collect()))
    monkeypatch.setattr(q, "small_side", lambda df, *a, **k: (df, False))
    assert sorted(map(tuple, q.quality_rules(docs_of(rows)).collect())) == want


def test_salted_side_is_never_broadcast(spark):
    hosts = spark.range(20).selectExpr("concat('h', id) AS host", "true AS bad")
    joined = common.salted_join(spark.range(100).selectExpr("id", "concat('h', id % 30) AS host"), hosts, "host", F.col("id"))
    assert sorted((r["id"], r["bad"]) for r in joined.collect()) == [(i, True if i % 30 < 20 else None) for i in range(100)]
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    side, small = common.small_side(hosts, max_bytes=1)
    assert not small and "Broadcast" not in joined.join(side.drop("bad"), "host")._jdf.queryExecution().executedPlan().toString()


def test_filter_keeps_columns_and_survives_clashes_and_empty_tables(docs_of):
    rows = [(i, " ".join(f"wordy{j}" for j in range(60)), "en", "h") for i in range(5)] + [(9, "", "en", "h")]
    docs = docs_of(rows).selectExpr("*", "1 AS n_words", "2 AS kept", "3 AS _host", "4 AS _qr_n_words")
    out = q.keep_good(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [0, 1, 2, 3, 4]
    assert q.keep_good(docs_of([])).count() == 0 and q.quality_rules(docs_of([])).count() == 0
