"""SimHash near-duplicates by deletion-variant signatures (operator 5).

A 64-bit fingerprint is cut into ``max_bits // 2 + 1`` segments, so that of two fingerprints within
``max_bits`` bits one segment differs in at most one bit.  Every distinct fingerprint is indexed
under each segment with each single bit wildcarded; equal keys are joined and verified.  A key that
too many fingerprints share is refined by the same device on the remaining bits, so no bucket is
compared whole and no link is lost.  Linked fingerprints are merged to components by rounds of
joins; equal fingerprints are one node from the start, so copies never make pairs.

Defined results: a null or wordless text has fingerprint zero and is linked like any other; a
document with a null id gets its fingerprint and the component of the others that it reaches (null
if none has an id); repeated rows all get a row; an empty table gives an empty result."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cytospark.llm import textops
from cytospark.llm.common import fresh, join_classes, small_side
from cytospark.session import cut_lineage, drop_cut

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
# A segment value that more distinct fingerprints than this have makes its keys be refined.
HOT_SEGMENT = 2048
_BLOCK = 1 << 15


def _fingerprint(text: bytes, n: int, seed: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line, at = b" ".join(words), 0
    starts = []
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [s - 1 for s in starts[n:]] + [len(line)]
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, dtype=np.int64), len(ends)
    for first in range(0, total, _BLOCK):
        hashes = np.array([digest(line[s:e], seed) for s, e in zip(starts[first:first + _BLOCK], ends[first:first + _BLOCK])],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``(doc_id, fp)`` with the 64 bits of the fingerprint as a signed long."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = StructType([src.schema["doc_id"], StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.small(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([_fingerprint(t, shingle_words, seed) if t else 0 for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])
    return src.mapInArrow(run, schema)


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments."""
    n = max_bits // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _bits(x: Column, shift: int, width: int) -> Column:
    v = F.shiftrightunsigned(x, shift) if shift else x
    return v if width == 64 else v.bitwiseAND(F.lit((1 << width) - 1))


def _one_off(diff: Column, pos: Column) -> Column:
    """Whether ``diff`` has at most the bit ``pos``; with no bit at all only position 0 counts, so that
    a pair meets this at one position."""
    return F.when(diff == 0, pos == 0).otherwise(diff == F.call_function("shiftleft", F.lit(1).cast("long"), pos))


def _variants(df: DataFrame, value: Column, width: int, seg: str, pos: str, key: str) -> DataFrame:
    """A row for each wildcard position of ``value``: the position and the value without that bit."""
    out = df.withColumn(pos, F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    hole = F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), F.col(pos)))
    return out.withColumn(key, value.bitwiseAND(hole))


def links(fps: DataFrame, max_bits: int = MAX_BITS, hot_segment: int = HOT_SEGMENT) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of distinct fingerprints within ``max_bits`` bits, each once.
    ``fps`` has one row per distinct fingerprint in the column ``fp``."""
    segs = _segments(max_bits)
    base = fps.select("fp").withColumn("seg", F.explode(F.array(*[F.lit(i) for i in range(len(segs))])))

    def per_segment(x: Column, seg: Column) -> Column:
        e = None
        for i, (shift, width) in enumerate(segs):
            e = F.when(seg == i, _bits(x, shift, width)) if e is None else e.when(seg == i, _bits(x, shift, width))
        return e
    width = max(w for _, w in segs)
    base = base.withColumn("value", per_segment(F.col("fp"), F.col("seg")))
    hot = base.groupBy("seg", "value").count().where(F.col("count") > hot_segment)
    hot_keys = cut_lineage(_variants(hot, F.col("value"), width, "seg", "pos", "key").select("seg", "pos", "key").distinct())
    keyed = _variants(base, F.col("value"), width, "seg", "pos", "key").select("seg", "pos", "key", "fp")
    some_hot = not hot_keys.isEmpty()
    if some_hot:
        hot_keys, _ = small_side(hot_keys)
    plain = keyed.join(hot_keys, ["seg", "pos", "key"], "left_anti") if some_hot else keyed

    def first_close_segment(diff: Column, seg: Column) -> Column:
        """Whether ``seg`` is the first segment with at most one differing bit."""
        ok = F.lit(True)
        for i, (shift, w) in enumerate(segs[:-1]):
            ok = ok & ((seg <= i) | (F.bit_count(_bits(diff, shift, w)) > 1))
        return ok

    def matched(sides: DataFrame, keys: list[str], extra=None) -> DataFrame:
        a = sides.select(*[F.col(k).alias(f"a_{k}") for k in keys], F.col("fp").alias("a"))
        b = sides.select(*[F.col(k).alias(f"b_{k}") for k in keys], F.col("fp").alias("b"))
        diff = F.col("a").bitwiseXOR(F.col("b"))
        cond = (F.col("a") < F.col("b")) & (F.bit_count(diff) <= max_bits)
        cond = cond & _one_off(per_segment(diff, F.col("a_seg")), F.col("a_pos")) & first_close_segment(diff, F.col("a_seg"))
        if extra is not None:
            cond = cond & extra(diff)
        for k in keys:
            cond = cond & (F.col(f"a_{k}") == F.col(f"b_{k}"))
        # Spark sizes the variants like the fingerprints that they were made from: unasked it would broadcast them.
        return a.join(b.hint("merge"), cond).select("a", "b")
    found = matched(plain, ["seg", "pos", "key"])
    if some_hot:
        # The rest of the fingerprint differs in at most max_bits bits: cut it once more into as many
        # parts, of which one differs in at most one bit, and add that part's variants to the key.
        crowded = keyed.join(hot_keys, ["seg", "pos", "key"], "left_semi")
        n = len(segs)

        def rest(x: Column, seg: Column) -> Column:
            """The bits beside the segment, moved together (a rotation that leaves the segment on top)."""
            e = None
            for i, (shift, w) in enumerate(segs):
                turned = x if shift + w == 64 else F.call_function("shiftleft", x, F.lit(64 - shift - w)).bitwiseOR(
                    F.shiftrightunsigned(x, shift + w))
                e = F.when(seg == i, turned) if e is None else e.when(seg == i, turned)
            return e
        low = 64 - width
        cuts = [low * i // n for i in range(n + 1)]
        parts = [(x, y - x) for x, y in zip(cuts, cuts[1:])]
        crowded = crowded.withColumn("part", F.explode(F.array(*[F.lit(i) for i in range(n)])))

        def per_part(x: Column, seg: Column, part: Column) -> Column:
            e = None
            for i, (shift, w) in enumerate(parts):
                v = _bits(rest(x, seg), shift, w)
                e = F.when(part == i, v) if e is None else e.when(part == i, v)
            return e
        crowded = _variants(crowded, per_part(F.col("fp"), F.col("seg"), F.col("part")), max(w for _, w in parts),
                            "part", "pos2", "key2")

        def extra(diff: Column) -> Column:
            ok = _one_off(per_part(diff, F.col("a_seg"), F.col("a_part")), F.col("a_pos2"))
            for i in range(len(parts) - 1):
                ok = ok & ((F.col("a_part") <= i) | (F.bit_count(per_part(diff, F.col("a_seg"), F.lit(i))) > 1))
            return ok
        found = found.unionByName(matched(crowded, ["seg", "pos", "key", "part", "pos2", "key2"], extra))
    return found


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, rep)`` for every node that has an edge, ``rep`` the least node that
    it reaches.

    Each round turns every edge to the smallest neighbour of its larger end and then of its smaller
    end (alternating star contraction), which reaches a star per component in O(log² n) rounds; the
    edges of a round are a written table."""
    u = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        both = u.select("u", "v").union(u.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("u", "v", "m")
        turned = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
            .union(small.select("u", F.col("m").alias("v"))).distinct()
        new = cut_lineage(turned)
        same = new.count() == u.count() and new.exceptAll(u).isEmpty()
        drop_cut(u)
        u = new
        if same:
            break
    return u.select(F.col("u").alias("node"), F.col("v").alias("rep")).union(u.select(F.col("v").alias("node"), F.col("v").alias("rep")).distinct())


def _with_rep(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``nodes`` (one row per distinct ``fp``) with ``rep``, the least fingerprint that they reach."""
    rep = components(cut_lineage(links(nodes, max_bits))).withColumnRenamed("node", "fp")
    return nodes.join(rep, "fp", "left").withColumn("rep", F.coalesce("rep", "fp"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the
    smallest doc_id that it reaches over links of at most ``max_bits`` differing bits."""
    marked = cut_lineage(fingerprints(docs, id_col, text_col, shingle_words))
    # One node per distinct fingerprint.
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")))
    found = _with_rep(nodes, max_bits)
    least = found.groupBy("rep").agg(F.min("least").alias("component_id"))
    classes = cut_lineage(found.join(least, "rep").select("fp", "rows", "component_id"))
    return join_classes(marked, classes, "fp", "rows").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
             max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each near-duplicate group: the one with the smallest id (rows without id last), of several with that id the
    one whose text has the least digest, of equal rows one.  Rows count by id and text, so rows that share an id but not
    their text are judged apart, and rows without an id like any other."""
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    key = fresh(docs.columns, "_digest")
    with_key = docs.withColumn(key, digest)
    marked = cut_lineage(fingerprints(with_key.select(F.struct(id_col, key).alias("id"), text_col), "id", text_col, shingle_words))
    first = F.min(F.struct(F.col(f"doc_id.{id_col}").isNull().alias("none"), F.col(f"doc_id.{id_col}").alias("id"), F.col(f"doc_id.{key}").alias("digest")))
    nodes = cut_lineage(marked.groupBy("fp").agg(first.alias("first")))
    stay = cut_lineage(_with_rep(nodes, max_bits).groupBy("rep").agg(F.min("first").alias("first")).select(
        F.col("first.id").alias("_stay_id"), F.col("first.digest").alias("_stay_digest")))
    names = {n: fresh(with_key.columns, n) for n in ("_stay_id", "_stay_digest")}
    stay = stay.withColumnsRenamed(names)
    stay, _ = small_side(stay, F.concat_ws("", *names.values()))
    same = F.col(id_col).eqNullSafe(F.col(names["_stay_id"])) & (F.col(key) == F.col(names["_stay_digest"]))
    return with_key.join(stay, same, "left_semi").dropDuplicates([id_col, key]).drop(key)
