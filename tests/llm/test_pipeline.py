import random

import corpus_pipeline as P


def test_stages_take_effect_in_order(spark, tmp_path):
    rng = random.Random(1)
    parts = {"aa": "ka lo mi tu ra ne po".split(), "bb": "schu ung ver ich ten gel".split()}

    def prose(lang, n=120):
        return " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows = [(i, prose("ab"[i % 2] * 2), "ab"[i % 2] * 2, f"s{i % 4}", 0) for i in range(60)]
    rows += [(100, rows[3][1], "bb", "s1", 0), (101, rows[3][1].upper(), "bb", "s1", 0), (102, "too short", "aa", "s1", 0), (103, None, None, None, 0),
             (104, "12 34 56 " * 7 + " ".join(str(i) for i in range(100)), "aa", "s2", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    ids, left = {r[0] for r in rows}, docs
    want = [ids - {102, 103}, ids - {102, 103, 104}, set(range(60))]
    for (name, stage), expected in zip(P.STAGES, want):
        left = stage(spark, left, str(tmp_path))
        assert left.columns == docs.columns, name
        assert {r["doc_id"] for r in left.collect()} == expected, name
    packed = P.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(range(60)) and all(r["offset"] + r["length"] <= 1024 for r in packed)
    assert P.ORACLE_SQL is None and [n for n, _ in P.STAGES][-1] == "best-fit packing"
