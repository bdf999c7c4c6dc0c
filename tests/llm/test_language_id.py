import random
import zlib

from cytospark.llm import language_id as L

SYLLABLES = {"aa": "ka lo mi tu ra ne".split(), "bb": "sch ung ver ich ten ge".split(), "cc": "que oux aie ment le ré".split()}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def table(docs_of, n=240):
    rng = random.Random(1)
    return docs_of([(i, prose(rng, lang, rng.randint(20, 200)), lang) for i, lang in ((i, rng.choice("aa bb cc".split())) for i in range(n))])


def test_held_out_accuracy_and_fold(docs_of):
    docs = table(docs_of)
    rows = {r["doc_id"]: r for r in L.language_id(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    out = [i for i in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(rows[i]["held_out"] == (i in out) for i in rows)
    assert sum(rows[i]["lang_pred"] == truth[i] for i in out) >= 0.95 * len(out)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_only_training_labels_are_used(docs_of):
    docs = table(docs_of)
    lied = docs.selectExpr("doc_id", "text", "CASE WHEN pmod(crc32(cast(doc_id AS string)), 4) = 2 THEN 'zz' ELSE lang END AS lang", "source", "n_chars")
    pick = lambda d: sorted(tuple(r) for r in L.language_id(d).collect())
    assert pick(docs) == pick(lied)


def test_nulls_ties_empty_and_clashes(docs_of, spark):
    docs = table(docs_of, 60)
    odd = docs_of([(1000, None, "aa"), (1001, "", None), (1002, "123 ... !!", "bb"), (None, "kalo", None), (1003, "kalomi " * 30000, None)])
    rows = {r["doc_id"]: r for r in L.language_id(docs.unionByName(odd)).collect()}
    for i in (1000, 1001, 1002):
        assert (rows[i]["lang_pred"], rows[i]["score"], rows[i]["rejected"]) == ("und", 0.0, True)
    assert rows[1003]["lang_pred"] == "aa" and rows[None]["held_out"] is False
    kept = L.keep_identified(docs.unionByName(odd).selectExpr("*", "1 AS _lang_pred", "2 AS score"))
    assert kept.columns == [*docs.columns, "_lang_pred", "score"]
    assert not {1000, 1001, 1002} & {r["doc_id"] for r in kept.collect()}
    assert L.language_id(docs_of([])).count() == 0
    unlabelled = docs_of([(1, "some text", None)])
    assert L.language_id(unlabelled).first()["lang_pred"] == "und"
    one = L.language_id(docs_of([(i, "some text here", "en") for i in range(8)])).collect()
    assert all(r["lang_pred"] == "en" and r["margin"] == 1.0 and not r["rejected"] for r in one)


def test_dictionaries_are_bounded(docs_of):
    found = L.learn(table(docs_of), dict_bytes=1000, total_bytes=1500)
    assert set(found) == {"aa", "bb", "cc"} and all(len(x) <= 500 for x in found.values())
