import hashlib
import random

from cytospark.llm import chat_format as C
from cytospark.llm.queries import CONTROL_TEXT

SCHEMA = "conv_id long, turn long, role string, text string"


def test_escape_is_reversible_and_hides_control_strings():
    rng = random.Random(2)
    alphabet = ["<", "s>", ">", "/", "[", "INST]", "]", "\\", "</s>", "[/INST]", "[INST]", "<s>", "\n", "a"]
    for _ in range(20000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9)))
        assert C.unescape(C.escape(text)) == text
        assert not any(x in C.escape(text) for x in ("<s>", "</s>", "[INST]", "[/INST]"))
        role = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 4)))
        turns = [(role, text), ("assistant", text), ("tool", "")]
        *_, last = C.expand(turns)
        assert C.parse(last[2]) == turns


def test_every_assistant_turn_is_one_example():
    turns = [("system", "s"), ("user", "u1"), ("assistant", "a1"), ("user", CONTROL_TEXT), ("assistant", CONTROL_TEXT), ("user", "u3")]
    found = list(C.expand(turns))
    assert [f[1] for f in found] == [2, 4, -1] and [f[5] for f in found] == [False, False, True]
    for number, target, text, start, end, _ in found:
        assert C.parse(text) == (turns[:target + 1] if target >= 0 else turns)
        assert C.unescape(text[start:end]) == (turns[target][1] if target >= 0 else "")
    assert [f[1] for f in C.expand(turns[:3])] == [2] and [f[1] for f in C.expand(turns[:2])] == [-1]


def test_digests_and_edge_cases(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<s>yo"), (1, 1, "assistant", "<s>yo"), (2, 5, "user", None), (2, None, None, "x"),
            (None, 0, "assistant", "z"), (3, 0, "assistant", "é" * 200000)]
    conv = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS example", "2 AS turns")
    got = {r["conv_id"]: r for r in C.digests(C.examples(conv)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\nhi\nassistant\n<s>yo\nassistant\n<s>yo\n")
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (3, 10, sha("<s>yo<s>yo"))
    assert (got[2]["n_turns"], got[2]["turns_sha256"], got[2]["loss_chars"]) == (2, sha("\nx\nuser\n\n"), 0)
    assert got[None]["loss_sha256"] == sha("z") and got[3]["loss_chars"] == 200000
    lengths = {r["conv_id"]: r["n"] for r in C.examples(conv).groupBy("conv_id").agg({"text": "count"}).toDF("conv_id", "n").collect()}
    assert lengths == {1: 2, 2: 1, None: 1, 3: 1}
    assert C.digests(C.examples(spark.createDataFrame([], SCHEMA))).count() == 0
