"""Conversation repair against exhaustive search and plain code."""
import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from cytospark.llm import conversation_repair as repair
from cytospark.llm import repair_search as search

PATTERN = re.compile(r"(s?(ua)+)?")


def outcomes(codes):
    """Every audit with at most two inserts in a place, with its cost, if the roles follow the pattern."""
    for edits in product("KRD", repeat=len(codes)):
        if any(c == "-" and e != "D" for c, e in zip(codes, edits)):
            continue
        for inserts in product(range(3), repeat=len(codes) + 1):
            slots = []
            for k, n in enumerate(inserts):
                slots += [("I", "ua")] * n
                if k < len(codes) and edits[k] != "D":
                    slots.append((edits[k], codes[k].lower() if edits[k] == "K" else "ua"))
            for roles in {"".join(r) for r in product(*[s[1] for s in slots])}:
                if PATTERN.fullmatch(roles):
                    cost = 3 * sum(inserts) + sum({"K": 0, "R": 3, "D": 4}[e] + (3 if c.isupper() and e != "D" else 0)
                                                  for c, e in zip(codes, edits))
                    yield cost, "".join("I" * n + (edits[k] if k < len(codes) else "") for k, n in enumerate(inserts))


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_search_equals_all_edits(n):
    rng = random.Random(n)
    every = ["".join(c) for c in product("suaxSUAX-", repeat=n)]
    for codes in every if n < 3 else rng.sample(every, 60):
        assert search.cheapest(codes, search.START, search.ACCEPTED) == min(outcomes(codes)), codes


def by_table(codes, entry, exits):
    """Costs and audits row by row from the end, inserts settled by repetition."""
    best = {q: (0, "") if q in exits else None for q in range(4)}

    def with_inserts(best):
        for _ in range(4):
            for q in range(4):
                to = search.step(q, search.ROLE[q][0])
                if best[to] is not None:
                    new = (best[to][0] + 3, "I" + best[to][1])
                    best[q] = new if best[q] is None else min(best[q], new)
        return best
    best = with_inserts(best)
    for code in reversed(codes):
        now = {}
        for q in range(4):
            ways = [(best[q][0] + 4, "D" + best[q][1])] if best[q] else []
            if code != "-":
                more = 3 if code.isupper() else 0
                for letter, cost, to in (("K", more, search.step(q, code.lower())), ("R", 3 + more, search.step(q, search.ROLE[q][0]))):
                    if to is not None and best[to]:
                        ways.append((best[to][0] + cost, letter + best[to][1]))
            now[q] = min(ways, default=None)
        best = with_inserts(now)
    return best[entry]


def test_search_equals_table():
    rng = random.Random(3)
    for _ in range(400):
        codes = "".join(rng.choice("suaxSUAX--uaua") for _ in range(rng.randint(0, 30)))
        entry, exits = rng.randrange(4), tuple(rng.sample(range(4), rng.randint(1, 4)))
        assert search.cheapest(codes, entry, exits) == by_table(codes, entry, exits), (codes, entry, exits)


def plain(rows):
    def z(x):
        return " " if x is None else x
    convs = {}
    for conv, turn, role, text in rows:
        hurt = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{z(conv)}:{z(turn)}".encode()) % 20
        role, text = z(role), z(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            hurt += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, hurt in convs.items():
        hurt.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in hurt:
            body = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = [t for t, _, _ in hurt if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] if r[:1] in ("s", "u", "a") else "x" for _, r, _ in hurt]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        codes = "".join("-" if f in ("blank", "duplicate") else i.upper() if f else i for f, i in zip(faults, initials))
        cost, audit = by_table(codes, 0, (0, 3))
        state, left, lines = 0, iter(hurt), []
        for letter in audit:
            _, role, text = (None, None, "") if letter == "I" else next(left)
            if letter != "D":
                role = role if letter == "K" else search.ROLE[state]
                state = search.step(state, role[:1])
                lines.append(f"{role}:{text}")
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    return sorted((tuple(r) for r in repair.repair_conversations(df).select(*COLUMNS).collect()), key=repr)


def test_given_conversations(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert got(rows) == plain([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("chunk", [1, 3, 512])
def test_edges_and_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK_ROWS", chunk)
    rng = random.Random(chunk)
    texts = ["Yes.", "No!", "what", "", None, " \t\n", "Same.", "Same.", "é?  ", "x" * 200_000 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant", "User"]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in (1, 2, 3, None, -5) for t in [*range(rng.randint(1, 30)), None, 4, 4]]
    rows += [(50, 0, "user", "a.")] * 7 + [(60 + k, k, "user", "Hello.") for k in range(40)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("none", F.lit(1)) \
        .withColumn("chunk", F.lit("x"))
    assert got(docs) == plain(rows)
    assert got(docs.limit(0)) == []


def test_long_conversation(spark):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No", f"text {t}."])) for t in range(3000)]
    assert got(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")) == plain(rows)
