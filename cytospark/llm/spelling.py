"""Spelling variant grouping by pivotal grams (operator 11).

Two words are near if one inserted, deleted or replaced code point turns one into the other.  All positional
bigrams of a word are ordered by how rare they are; its prefix are the first three (with all others of the third's
rank).  Two disjoint pivots are chosen from the prefix by dynamic programming.  One edit spares one of two disjoint
pivots; of two near words, the pivots of the one whose prefix ends earlier in the order are looked up among the
prefix bigrams of the other.

Position limits make the lookup narrow.  A word is split between its pivots, as near its middle as they allow.  Either
the edit leaves the left part alone, with the first pivot at the same distance from the start, or it leaves the right
part alone, with the second pivot at the same distance from the end.  So every pivot is sought on one side only, with
the text of its part in the key (``MAX_CONTEXT`` code points at most, those at the word's end in question, unless the
bigram reaches further).  Where that text has at most ``SHORT_CONTEXT`` code points, many words share it; there the key
also holds the rest of the word, whole or without one code point, one of which near words have in common.  Found pairs
are verified by edit distance.

The vocabulary is never held whole by one task or the driver; only the bigram order is broadcast, which the alphabet
of 90 letters bounds to 8 100 entries.

Defined results: a null text has no words; a null id counts as an empty string before the colon; repeated rows count
each time; ties between near words go to the smaller one in code-point order; an empty table gives an empty result;
other columns are not read, whatever their names."""
from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytospark.llm import textops
from cytospark.session import cut_lineage, drop_cut

DAMAGE_EVERY = 97
MIN_CHARS = 5
MIN_COUNT = 3
PIVOTS = 2
MAX_CONTEXT = 6
SHORT_CONTEXT = 4
# Distinct runs that a task counts before it hands its counts on.
FLUSH_WORDS = 200_000
# Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8, after A-Z were lower-cased.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def _damaged(word: bytes, h: int) -> bytes:
    text = word.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1:]).encode()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)``: the runs of all texts after the damage, with their occurrences."""
    src = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()),
                                               pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held: dict[bytes, int] = {}
        crc, get = zlib.crc32, held.get
        for batch in textops.small(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for doc_id, text in zip(ids, texts):
                if not text.is_valid:
                    continue
                start = crc(doc_id.encode() + b":")
                for word, n in Counter(_RUN.findall(text.as_py().lower())).items():
                    h = crc(word, start)
                    if h % DAMAGE_EVERY == 0:
                        word = _damaged(word, h)
                    held[word] = get(word, 0) + n
            if len(held) >= FLUSH_WORDS:
                yield packed()
                held.clear()
        if held:
            yield packed()
    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
               min_count: int = MIN_COUNT) -> DataFrame:
    return word_counts(docs, id_col, text_col).where((F.col("n") >= min_count) & (F.char_length("word") >= min_chars))


def bigram_order(words: DataFrame) -> dict[str, int]:
    """Rank of every bigram of the words, the rarest first (ties by code points)."""
    grams = words.select(F.explode(F.sequence(F.lit(1), F.char_length("word") - 1)).alias("i"), "word") \
        .select(F.substring("word", F.col("i"), F.lit(2)).alias("gram"))
    counted = grams.groupBy("gram").count().collect()
    return {r["gram"]: k for k, r in enumerate(sorted(counted, key=lambda r: (r["count"], r["gram"])))}


def choose(ranks: Sequence[int], pivots: int = PIVOTS) -> tuple[list[int], list[int], int]:
    """For a word's bigram ranks by position: the prefix positions, the positions of ``pivots`` disjoint prefix bigrams
    of the least rank sum (ties to earlier positions), and the rank of the prefix's last."""
    last = sorted(ranks)[2 * (pivots - 1)]
    prefix = [i for i, r in enumerate(ranks) if r <= last]
    # best[k]: (sum, chosen) of k disjoint bigrams among those that end before the present one; `ahead` also
    # holds what the bigram directly before would allow later.
    best: list[tuple[int, list[int]] | None] = [(0, [])] + [None] * pivots
    held: list[tuple[int, list]] = []
    for i in prefix:
        while held and held[0][0] + 2 <= i:
            _, found = held.pop(0)
            best = [min((b for b in (old, new) if b is not None), default=None) for old, new in zip(best, found)]
        found = [None] + [None if b is None else (b[0] + ranks[i], b[1] + [i]) for b in best[:-1]]
        held.append((i, found))
    for _, found in held:
        best = [min((b for b in (old, new) if b is not None), default=None) for old, new in zip(best, found)]
    return prefix, best[pivots][1], last


def signatures(words: DataFrame, order: dict[str, int]) -> DataFrame:
    """``(word, prefix, pivots, last)`` of every word: positions of its prefix bigrams and of its pivots, both
    ascending, and the rank that ends its prefix."""
    sent = words.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = sent.value
        for batch in batches:
            got = [choose([rank[w[i:i + 2]] for i in range(len(w) - 1)]) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.list_(pa.int32())),
                 pa.array([g[1] for g in got], pa.list_(pa.int32())), pa.array([g[2] for g in got], pa.int32())],
                names=["word", "prefix", "pivots", "last"])
    return words.select("word").mapInArrow(run, "word string, prefix array<int>, pivots array<int>, last int")


def _keyed(df: DataFrame, side: str, at: Column, context: Column) -> DataFrame:
    """Rows with the key of ``context`` code points beside the bigram at ``at``: on side S the word's first ones, on
    side E its last ones.  ``at`` is counted from the start or the end."""
    n = F.char_length("word")
    near = F.substring("word", F.lit(1), context) if side == "S" else F.substring("word", n - context + 1, context)
    rest = F.substring("word", context + 1, n - context) if side == "S" else F.substring("word", F.lit(1), n - context)
    rows = df.withColumn("_near", near).withColumn("_rest", rest).withColumn("_at", at).withColumn("_c", context)
    # Position 0 stands for the whole rest, the others for the rest without that code point.
    holes = F.when(F.col("_c") <= SHORT_CONTEXT, F.sequence(F.lit(0), F.char_length("_rest"))).otherwise(F.array(F.lit(-1)))
    rows = rows.withColumn("_hole", F.explode(holes))
    variant = F.when(F.col("_hole") < 0, F.lit(None).cast("string")).when(F.col("_hole") == 0, F.col("_rest")).otherwise(
        F.concat(F.substring("_rest", F.lit(1), F.col("_hole") - 1), F.substring("_rest", F.col("_hole") + 1, F.char_length("_rest"))))
    return rows.select(F.xxhash64(F.lit(side), "_at", "_c", "_near", F.coalesce(variant, F.lit(":"))).alias("key"), "word", "last")


def _clip(context: Column, least: Column) -> Column:
    """``MAX_CONTEXT`` code points of the spared text at most, but at least those up to the bigram's far end."""
    return F.least(context, F.greatest(least, F.lit(MAX_CONTEXT)))


def index_rows(sig: DataFrame) -> DataFrame:
    """``(key, word, last)``: every prefix bigram under every context that another word's pivot may be sought with."""
    one = sig.withColumn("p", F.explode("prefix"))
    n = F.char_length("word")

    def side(name: str, far: Column, most: Column) -> DataFrame:
        # ``far``: code points from the word's end in question to the far end of the bigram.
        rows = one.where(far <= most).withColumn("_ctx", F.explode(F.sequence(far, _clip(most, far))))
        return _keyed(rows, name, far, F.col("_ctx"))
    return side("S", F.col("p") + 2, n - 1).unionByName(side("E", n - F.col("p"), n))


def pivot_rows(sig: DataFrame) -> DataFrame:
    """``(key, word, last)``: the first pivot with the left part of the word and the second with the right part."""
    n = F.char_length("word")
    p1, p2 = F.col("pivots")[0], F.col("pivots")[1]
    split = F.least(F.greatest(F.floor(n / 2).cast("int"), p1 + 2), p2)
    first = _keyed(sig, "S", p1 + 2, _clip(split, p1 + 2))
    second = _keyed(sig, "E", n - p2, _clip(n - split, n - p2))
    return first.unionByName(second)


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of words at edit distance one, each once.  ``words``: distinct ``word``s."""
    sig = cut_lineage(signatures(words, bigram_order(words)))
    left = pivot_rows(sig).select("key", F.col("word").alias("s"), F.col("last").alias("s_last"))
    right = index_rows(sig).select("key", F.col("word").alias("r"), F.col("last").alias("r_last"))
    close = F.abs(F.char_length("s") - F.char_length("r")) <= 1
    found = left.join(right, "key").where((F.col("s_last") <= F.col("r_last")) & (F.col("s") != F.col("r")) & close
                                          & (F.levenshtein("s", "r", 1) == 1))
    return cut_lineage(found.select(F.least("s", "r").alias("a"), F.greatest("s", "r").alias("b")).distinct())


def follow(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for the rows ``(word, form)``: forms followed to the last.  Forms grow in count, so there are no
    circles; every round doubles the distance looked ahead."""
    at = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        new = cut_lineage(at.join(ahead, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        moved = not new.where("_moved").isEmpty()
        drop_cut(at)
        at = new.drop("_moved")
        at._cytospark_path = new._cytospark_path
        if not moved:
            return at


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``."""
    words = cut_lineage(vocabulary(docs, id_col, text_col))
    pairs = near_pairs(words)
    links = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")) \
        .unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = links.join(counts, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= 2 * F.col("n")
    table = cut_lineage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))
    roots = follow(table.where("form IS NOT NULL"))
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
