"""Chat formatting by prefix-target expansion (operator 7).

Every assistant turn becomes an example of its own: all turns before it as context, and only its
reply trainable.  A conversation that does not end with an assistant turn gets one more example
without a target, so that no turn is missing from the output.

Template: an assistant turn is ``<s>text</s>``; any other turn is ``[INST]role⏎text[/INST]``.  Where a
text holds one of these control strings, a backslash goes in behind its first character; one that
already has backslashes there gets one more, so that the reading back takes out exactly one.

Defined results: null texts and roles are empty; turns are ordered by turn, then role, then text (null
turns first); equal rows are turns each; rows with a null id form one conversation; an empty table
gives no examples.  A conversation's turns come together in one row, so one conversation must fit a
row (2 GB); its examples are made one at a time."""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

TARGET_ROLE = "assistant"
BATCH_CHARS = 8 << 20

_CONTROL = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
_ESCAPED = re.compile(r"([<\[])\\(\\*/?(?:s>|INST\]))")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_back(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    """(mark before, escaped text, mark after)."""
    if role == TARGET_ROLE:
        return "<s>", escape(text), "</s>"
    return f"[INST]{_role(role)}\n", escape(text), "[/INST]"


def expand(turns: list[tuple[str, str]]) -> Iterator[tuple[int, int, str, int, int, bool]]:
    """The examples of a conversation: (number, target turn or -1, text, start and end of the trainable
    span, whether it is the conversation's last)."""
    targets = [i for i, (role, _) in enumerate(turns) if role == TARGET_ROLE]
    last = len(targets) + (not targets or targets[-1] != len(turns) - 1) - 1
    context, number = [], 0
    for i, (role, text) in enumerate(turns):
        before, body, after = format_turn(role, text)
        if role == TARGET_ROLE:
            head = "".join(context) + before
            context = [head, body, after]
            yield number, i, head + body + after, len(head), len(head) + len(body), number == last
            number += 1
        else:
            context += [before, body, after]
    if number == last:
        whole = "".join(context)
        yield number, -1, whole, len(whole), len(whole), True


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    turns, at = [], 0
    while at < len(text):
        if text.startswith("<s>", at):
            end = text.index("</s>", at)
            turns.append((TARGET_ROLE, unescape(text[at + 3:end])))
            at = end + 4
        else:
            end = text.index("[/INST]", at)
            role, body = text[at + 6:end].split("\n", 1)
            turns.append((_role_back(role), unescape(body)))
            at = end + 7
    return turns


def examples(conversations: DataFrame) -> DataFrame:
    """``conv_id, example, target_turn, text, loss_start, loss_end, is_last`` from rows of
    ``conv_id, turn, role, text``."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns")).select(
        "conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))
    schema = StructType([grouped.schema["conv_id"], StructField("example", LongType()), StructField("target_turn", LongType()),
                         StructField("text", StringType()), StructField("loss_start", LongType()),
                         StructField("loss_end", LongType()), StructField("is_last", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, chars = batch.column(0), [], 0

            def made(rows: list) -> pa.RecordBatch:
                cols = list(zip(*rows))
                return pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64()),
                     pa.array(cols[6], pa.bool_())], names=[f.name for f in schema])
            for i in range(batch.num_rows):
                turns = list(zip(batch.column(1)[i].as_py(), batch.column(2)[i].as_py()))
                for made_row in expand(turns):
                    rows.append((i, *made_row))
                    chars += len(made_row[2])
                    if chars > BATCH_CHARS:
                        yield made(rows)
                        rows, chars = [], 0
            if rows:
                yield made(rows)
    return grouped.mapInArrow(run, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the examples back gives, per conversation: ``conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars``."""
    schema = StructType([formatted.schema["conv_id"], StructField("example", LongType()), StructField("loss", StringType()),
                         StructField("n_turns", LongType()), StructField("turns_sha256", StringType()),
                         StructField("chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = zip(batch.column("loss_start").to_pylist(), batch.column("loss_end").to_pylist())
            loss = [unescape(t[a:b]) for t, (a, b) in zip(texts, spans)]
            n_turns, sha = [], []
            for text, last in zip(texts, batch.column("is_last").to_pylist()):
                turns = parse(text) if last else []
                n_turns.append(len(turns) if last else None)
                sha.append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest() if last else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("example"), pa.array(loss, pa.string()), pa.array(n_turns, pa.int64()),
                 pa.array(sha, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[f.name for f in schema])
    read = formatted.mapInArrow(run, schema)
    losses = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "")
    return read.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), losses.alias("loss"),
        F.sum("chars").alias("formatted_chars")).select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
