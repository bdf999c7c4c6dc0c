"""Best-fit packing by minimum bin slack (operator 8).

Pieces of equal length are interchangeable, so the packing is decided on the histogram of piece
lengths alone (at most ``capacity`` counters, whatever the input).  For every bin the largest
remaining length is taken, and a bitset subset-sum over the remaining lengths finds the fullest
combination for the slack; the bin's pattern is repeated while the counts allow it.  Pieces are then
numbered within their length by a distributed ranking, and the number gives their bin and place.

Defined results: a null or empty text is its end id alone; a text of more than ``capacity`` ids is cut so
that all pieces but the first are full; repeated rows are packed each; an empty table packs nothing."""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from cytospark.llm import textops
from cytospark.llm.byte_bpe import encoder
from cytospark.llm.common import small_side
from cytospark.session import cut_lineage

CAPACITY = 1024
END_ID = 2
ROWS_PER_SALT = 50_000


def tokenizer_path() -> str:
    """The default tokenizer file, where the task runs."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length, ids_crc32`` and, if asked for,
    ``ids`` (array<int>)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    longs = ["piece", "start", "length", "ids_crc32"]
    fields = [src.schema["doc_id"], *[StructField(c, LongType()) for c in longs]]
    fields[1] = StructField("piece", IntegerType())
    if with_ids:
        fields.append(StructField("ids", ArrayType(IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path or tokenizer_path()), np.array([end_id], dtype="<u4")
        for batch in textops.small(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows, cols, kept = [], [[], [], [], []], []
            for i, ids in enumerate(enc.encode(texts)):
                ids = np.concatenate([ids, end])
                first = len(ids) % capacity or min(capacity, len(ids))
                for k, start in enumerate([0, *range(first, len(ids), capacity)]):
                    part = ids[start:first if k == 0 else start + capacity]
                    rows.append(i)
                    for col, v in zip(cols, (k, start, len(part), zlib.crc32(part.tobytes()))):
                        col.append(v)
                    if with_ids:
                        kept.append(part.astype(np.int32))
            arrays = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(cols[0], pa.int32()),
                      *[pa.array(c, pa.int64()) for c in cols[1:]]]
            if with_ids:
                arrays.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])
    return src.mapInArrow(run, StructType(fields))


def fullest(counts: dict[int, int], slack: int) -> list[int]:
    """Lengths whose sum is as near to ``slack`` as can be, from the lengths left (larger ones are
    preferred).  Bit s of a set says that the sum s can be reached."""
    mask, reach = (1 << (slack + 1)) - 1, [1]
    order = []
    for length in sorted(counts, reverse=True):
        if length > slack or not counts[length]:
            continue
        bits = reach[-1]
        for _ in range(min(counts[length], slack // length)):
            more = (bits | bits << length) & mask
            if more == bits:
                break
            bits = more
        order.append(length)
        reach.append(bits)
        if bits >> slack:
            break
    target, chosen = reach[-1].bit_length() - 1, []
    for k in range(len(order), 0, -1):
        while not reach[k - 1] >> target & 1:
            chosen.append(order[k - 1])
            target -= order[k - 1]
    return chosen


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """Slots ``(length, first rank, first bin, offset)``: the pieces of that length from the rank on go
    to the bins from the first on, one each, until the next slot of the length."""
    left = {length: n for length, n in histogram.items() if n > 0}
    taken = dict.fromkeys(left, 0)
    slots, bin_no = [], 0
    while left:
        largest = max(left)
        left[largest] -= 1
        pattern = [largest, *fullest(left, capacity - largest)]
        left[largest] += 1
        need = {length: pattern.count(length) for length in pattern}
        times = min(left[length] // n for length, n in need.items())
        offset = 0
        for length in pattern:
            slots.append((length, taken[length], bin_no, offset))
            taken[length] += times
            offset += length
        for length, n in need.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        bin_no += times
    return slots


def ranked(rows: DataFrame, by: str, key: list[str], out: str) -> DataFrame:
    """Number the rows of each ``by`` value from 0.  A value may hold most rows, so they are dealt over
    salts, numbered there, and moved on by the salts before."""
    salts = max(16, -(-rows.count() // ROWS_PER_SALT))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*key), F.lit(salts)).cast("int"))
    counts = cut_lineage(salted.groupBy(by, "_salt").agg(F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy(by).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.select(by, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    side, _ = small_side(cut_lineage(moved))
    local = Window.partitionBy(by, "_salt").orderBy(*key)
    return salted.withColumn("_local", F.row_number().over(local) - 1).join(side, [by, "_salt"]) \
        .withColumn(out, F.col("_before") + F.col("_local")).drop("_salt", "_local", "_before")


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (a table that is cheap to read again)."""
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = sorted(packing_plan(histogram, capacity))
    lengths, ranks, bins, offsets = (np.array([s[k] for s in slots], dtype=np.int64) for k in range(4))
    keyed = ranked(parts, "length", ["doc_id", "piece", "start", "ids_crc32"], "_rank")
    place = keyed.columns
    fields = [f for f in keyed.schema.fields if f.name != "_rank"]
    at_length, at_rank = place.index("length"), place.index("_rank")
    schema = StructType(fields + [StructField("sequence_id", LongType()), StructField("offset", LongType())])
    low = np.searchsorted(lengths, np.arange(capacity + 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(at_length).to_numpy(), batch.column(at_rank).to_numpy()
            slot = np.zeros(len(length), dtype=np.int64)
            for v in np.unique(length):
                mine = length == v
                slot[mine] = low[v] + np.searchsorted(ranks[low[v]:low[v + 1]], rank[mine], side="right") - 1
            cols = [c for k, c in enumerate(batch.columns) if k != at_rank]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(bins[slot] + rank - ranks[slot]), pa.array(offsets[slot])], schema=None,
                names=[f.name for f in schema.fields])
    return keyed.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and place (see ``pieces`` and ``pack``)."""
    return pack(cut_lineage(pieces(docs, id_col, text_col, capacity, end_id, path, with_ids)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from pieces with ids: ``sequence_id, ids, doc_ids`` (a group holds at
    most ``capacity`` ids)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
