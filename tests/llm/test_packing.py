import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pytest

from cytospark.llm import byte_bpe, packing as p


@pytest.fixture(scope="module")
def enc():
    return byte_bpe.Encoder(P.path("byte_bpe_50k.json"))


def test_ids_equal_the_library(enc, monkeypatch):
    rng = random.Random(1)
    alphabet = "'''  \n\t\rstrevlmdABaé12½ª,.!-_­À×"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", "a<|endoftext|>b", "　x 中文 \x1c a\x00b", "I'll we've 're's  \n\n x  ", "  a\u0085b", "word " * 200]
    want = [e.ids for e in enc.library.encode_batch(texts, add_special_tokens=False)]
    assert enc.core is not None
    assert [x.tolist() for x in enc.encode(texts)] == want
    monkeypatch.setattr(byte_bpe, "BLOCK_CHARS", 40)
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 50)
    assert [x.tolist() for x in enc.encode(texts[-400:])] == want[-400:]


def test_fullest_combination_equals_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        items = [rng.randint(1, 20) for _ in range(rng.randint(0, 9))]
        slack = rng.randint(0, 40)
        counts = {x: items.count(x) for x in set(items)}
        best = max(sum(c) for k in range(len(items) + 1) for c in combinations(items, k) if sum(c) <= slack)
        chosen = p.fullest(counts, slack)
        assert sum(chosen) == best and all(chosen.count(x) <= counts[x] for x in set(chosen))


def check(rows, capacity):
    bins, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        parts[r["doc_id"]].append(r)
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return bins, parts


def test_packing_is_whole_gapless_and_tight(docs_of, enc):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["alpha", "beta", "x", "é", "zz\n"]) for _ in range(rng.choice([0, 1, 10, 100, 400]))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(900, None), (901, "")] + [(950 + i, "same text") for i in range(50)]
    docs = docs_of(rows).selectExpr("*", "1 AS length", "2 AS piece", "3 AS sequence_id")
    packed = p.pack_documents(docs, capacity=64, with_ids=True)
    got = packed.collect()
    bins, parts = check(got, 64)
    for doc_id, text in rows:
        ids = enc.library.encode(text or "", add_special_tokens=False).ids + [2]
        mine = sorted(parts[doc_id], key=lambda r: r["piece"])
        assert [i for r in mine for i in r["ids"]] == ids
        assert [r["start"] for r in mine] == list(np.cumsum([0] + [r["length"] for r in mine])[:-1])
        assert all(r["length"] == 64 for r in mine[1:]) and (len(mine) == 1 or mine[0]["length"] <= 64)
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in mine)
    total = sum(r["length"] for r in got)
    assert len(bins) <= -(-total // 64) * 1.02 + 1
    seqs = {r["sequence_id"]: r["ids"] for r in p.sequences(packed).collect()}
    assert sum(map(len, seqs.values())) == total and max(map(len, seqs.values())) <= 64


def test_repeated_rows_and_empty_table(docs_of):
    bins, _ = check(p.pack_documents(docs_of([(1, "a b c")] * 70), capacity=8).collect(), 8)
    assert len(bins) == 35
    assert p.pack_documents(docs_of([])).count() == 0
