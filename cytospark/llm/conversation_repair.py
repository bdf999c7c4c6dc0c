"""Conversation structure repair (operator 12): faults, and the cheapest edits to the pattern ``(s?(ua)+)?``.

Rows are numbered within their conversation over range partitions, and cut into chunks of at most ``CHUNK_ROWS``.  A
chunk is solved by the bidirectional search of ``repair_search`` between every state that it may be entered in and
every state that it may be left in; a conversation's chunks are then joined from its end, by cost and least audit.
What one task holds of a conversation are one letter a row, the chunks' few audits and the whole audit; its texts are
read as a sorted stream for the digest, which SHA-256 makes sequential by nature.

Defined results: nulls (also in the key of the damage) count as one space; rows with a null conversation are one
conversation; rows of one turn are ordered by role and text; a role whose first letter is none of s, u, a can't be
kept; conversations without rows after damage get zeros, an empty audit and the digest of the empty string; an empty
table gives an empty result; other columns are not read, whatever their names."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cytospark.llm import repair_search as search
from cytospark.session import cut_lineage

CHUNK_ROWS = 512
_KEY = ["none", "conv"]
_EMPTY = hashlib.sha256(b"").hexdigest()
_SPACE = r"\x20\x09-\x0D"


def _or_space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """``none, conv, turn, role, text`` after the damage; ``none`` marks the null conversation."""
    src = rows.select(F.col("conv_id").isNull().alias("none"),
                      F.coalesce("conv_id", F.lit(0).cast(rows.schema["conv_id"].dataType)).alias("conv"), "turn",
                      _or_space(F.col("role")).alias("role"), _or_space(F.col("text")).alias("text"),
                      F.pmod(F.crc32(F.concat(_or_space(F.col("conv_id")), F.lit(":"), _or_space(F.col("turn"))).cast("binary")),
                             F.lit(20)).alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.sequence(F.lit(1), F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)))
    return src.select("none", "conv", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``pos``, the place of a row in its conversation (from 0), without bringing a conversation into one task."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*_KEY, F.col("turn").asc_nulls_first(), "role", "text"]
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(*_KEY, "role", "text")
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            local = []
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != last:
                    last, count = key, 0
                local.append(count)
                count += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([here] * len(local), pa.int32()), pa.array(local, pa.int64())],
                                             names=["none", "conv", "role", "text", "piece", "local"])
    local = cut_lineage(placed.mapInArrow(run, f"none boolean, conv {kind}, role string, text string, piece int, local long"))
    before = W.partitionBy(*_KEY).orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    starts = local.groupBy(*_KEY, "piece").agg(F.count(F.lit(1)).alias("c")) \
        .select(*_KEY, "piece", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"))
    return local.join(starts, [*_KEY, "piece"]).select(*_KEY, "role", "text", (F.col("start") + F.col("local")).alias("pos"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds ``fault`` (blank, duplicate, truncated or null: the first that holds) and ``code``, the row's letter for the
    search."""
    # A row's place tells whether it is the first of its role and text, so no key of the join is common.
    first = rows.groupBy(*_KEY, "role", "text").agg(F.min("pos").alias("pos")).select(*_KEY, "pos", F.lit(True).alias("first"))
    fault = F.when(~F.col("text").rlike(f"[^{_SPACE}]"), "blank").when(F.col("first").isNull(), "duplicate") \
        .when(~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z"), "truncated")
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    return rows.join(first, [*_KEY, "pos"], "left").withColumn("fault", fault).withColumn("code", code) \
        .withColumn("initial", letter).drop("first")


def _solved(chunks: DataFrame) -> DataFrame:
    """Every chunk's ways: ``ways`` holds (entry, exit, cost, audit).  ``chunks``: key, ``chunk, codes, initials``."""
    kind = chunks.schema["conv"].dataType.simpleString()
    way = "struct<entry:int,exit:int,cost:long,audit:string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways = []
            for chunk, codes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                entries = search.STATES if chunk else (search.START,)
                # A chunk that is not full is its conversation's last: any accepted state will do behind it.
                exits = [(search.DONE, search.ACCEPTED)] if len(codes) < CHUNK_ROWS else [(q, (q,)) for q in search.STATES]
                made = [(e, name, search.cheapest(codes, e, to)) for e in entries for name, to in exits]
                ways.append([{"entry": e, "exit": x, "cost": w[0], "audit": w[1]} for e, x, w in made if w])
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in (0, 1, 2, 4)], pa.array(ways, arrow)],
                                             names=["none", "conv", "chunk", "initials", "ways"])
    arrow = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    return chunks.mapInArrow(run, f"none boolean, conv {kind}, chunk long, initials string, ways array<{way}>")


def _chosen(parts: list[tuple[int, str, list[dict]]]) -> Iterator[tuple[int, int, str, int, int, str | None]]:
    """The best way through a conversation's chunks, given from the last to the first: per chunk (chunk, entry, audit,
    illegal neighbours); the first chunk's row also has the whole cost and audit."""
    ahead: dict[int, tuple[int, str]] = {q: (0, "") for q in search.ACCEPTED}
    picked: list[dict[int, dict]] = []
    for _, _, ways in parts:
        now: dict[int, tuple[int, str]] = {}
        pick: dict[int, dict] = {}
        for way in ways:
            if way["exit"] in ahead:
                rest = ahead[way["exit"]]
                whole = (way["cost"] + rest[0], way["audit"] + rest[1])
                if way["entry"] not in now or whole < now[way["entry"]]:
                    now[way["entry"]], pick[way["entry"]] = whole, way
        ahead = now
        picked.append(pick)
    cost, audit = ahead[search.START]
    state, tail = search.START, ""
    for (chunk, initials, _), pick in zip(reversed(parts), reversed(picked)):
        joined = tail + initials
        illegal = sum(joined[i:i + 2] not in ("su", "ua", "au") for i in range(len(joined) - 1))
        yield chunk, state, pick[state]["audit"], illegal, cost, audit if chunk == 0 else None
        state, tail = pick[state]["exit"], initials[-1:]


def _joined(solved: DataFrame) -> DataFrame:
    """Per chunk ``chunk, entry, piece`` (its part of the audit), ``illegal``, and ``cost, audit`` on the first."""
    kind = solved.schema["conv"].dataType.simpleString()
    dealt = solved.repartition(*_KEY).sortWithinPartitions(*_KEY, F.desc("chunk"))
    names = ["none", "conv", "chunk", "entry", "piece", "illegal", "cost", "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        last, out, types = None, [], None
        for batch in batches:
            types = types or [batch.schema.field(0).type, batch.schema.field(1).type, pa.int64(), pa.int32(), pa.string(), pa.int64(),
                              pa.int64(), pa.string()]
            for none, conv, chunk, initials, ways in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (none, conv) != last:
                    out += [(*last, *row) for row in _chosen(held)]
                    held = []
                last = (none, conv)
                held.append((chunk, initials, ways))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)
                out = []
        if held:
            out = [(*last, *row) for row in _chosen(held)]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)
    return dealt.mapInArrow(run, f"none boolean, conv {kind}, chunk long, entry int, piece string, illegal long, cost long, audit string")


class _Writer:
    """Applies a conversation's edits to its rows as they come and digests what results."""

    def __init__(self) -> None:
        self.digest, self.empty, self.state, self.edits, self.at = hashlib.sha256(), True, search.START, "", 0

    def _put(self, role: str, text: str) -> None:
        if not self.empty:
            self.digest.update(b"\n")
        self.digest.update(f"{role}:{text}".encode())
        self.empty, self.state = False, search.step(self.state, role[:1])

    def _insert(self) -> None:
        while self.edits[self.at:self.at + 1] == "I":
            self.at += 1
            self._put(search.ROLE[self.state], "")

    def chunk(self, edits: str) -> None:
        self._insert()
        self.edits, self.at = edits, 0

    def row(self, role: str, text: str) -> None:
        self._insert()
        letter, self.at = self.edits[self.at], self.at + 1
        if letter != "D":
            self._put(role if letter == "K" else search.ROLE[self.state], text)

    def end(self) -> str:
        self._insert()
        return self.digest.hexdigest()


def repaired_digests(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """Key and ``repaired_sha256`` per conversation, from rows and audits in one sorted stream."""
    kind = rows.schema["conv"].dataType.simpleString()
    lines = rows.select(*_KEY, F.floor(F.col("pos") / CHUNK_ROWS).alias("chunk"), "pos", "role", "text") \
        .unionByName(pieces.select(*_KEY, "chunk", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("role"),
                                   F.col("piece").alias("text")))
    dealt = lines.repartition(*_KEY).sortWithinPartitions(*_KEY, "chunk", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, writer, types = None, None, None
        for batch in batches:
            types = types or [batch.schema.field(0).type, batch.schema.field(1).type, pa.string()]
            out = []
            for none, conv, _, pos, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if (none, conv) != last:
                    if writer:
                        out.append((*last, writer.end()))
                    last, writer = (none, conv), _Writer()
                if pos < 0:
                    writer.chunk(text)
                else:
                    writer.row(role, text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=["none", "conv", "sha"])
        if writer:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*last, writer.end()), types)], names=["none", "conv", "sha"])
    return dealt.mapInArrow(run, f"none boolean, conv {kind}, sha string")


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per original ``conv_id``: ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.
    ``conversations``: ``conv_id, turn, role, text``."""
    kind = conversations.schema["conv_id"].dataType
    every = conversations.select(F.col("conv_id").isNull().alias("none"), F.coalesce("conv_id", F.lit(0).cast(kind)).alias("conv")).distinct()
    hurt = damage(conversations)
    turns = hurt.select(*_KEY, "turn").distinct().groupBy(*_KEY).agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("long").alias("gaps"))
    rows = cut_lineage(with_faults(numbered(hurt)))
    faults = rows.groupBy(*_KEY).agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    chunks = rows.groupBy(*_KEY, F.floor(F.col("pos") / CHUNK_ROWS).alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "code", "initial"))).alias("r"))
    chunks = chunks.select(*_KEY, "chunk", F.array_join("r.code", "").alias("codes"), F.array_join("r.initial", "").alias("initials"))
    pieces = cut_lineage(_joined(_solved(chunks)))
    digests = cut_lineage(repaired_digests(rows, pieces))
    # Every part has at most one row or few rows a conversation; together they make its result in one aggregate.
    parts = [every, turns, faults, pieces.select(*_KEY, "illegal"), pieces.where("chunk = 0").select(*_KEY, "cost", "audit"), digests]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    out = out.groupBy(*_KEY).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in numbers],
                                 F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("sha"), F.lit(_EMPTY)).alias("sha"))
    return out.select(F.when(~F.col("none"), F.col("conv")).alias("conv_id"), *numbers, "audit", F.col("sha").alias("repaired_sha256"))
