"""Language-model scoring with a log-frequency Bloom filter (operator 2).

Unigram and bigram counts of the training texts are gathered by one shuffle and quantised to powers
of ``QUANT``.  An n-gram with the quantised level q is put into a Bloom filter under the levels
1..q; a scorer probes level 1, 2, … until one is missing and so gets its level back (errors only
upward, and rarely).  The filter's parts are built by the tasks of the shuffle and broadcast.

Model: p(w | v) = (c(v w) + MU · p(w)) / (c(v) + MU) with p(w) = (c(w) + 1) / (N + V + 1), where the
counts are those read from the filter, c(v w) at most c(v) and c(w), and v is a start mark before the
first word.  ``base_score`` uses exact unigram counts instead.

The filter and the exact unigram counts are broadcast only if the counted entries need at most
``max_bytes`` each; beyond that the texts' distinct n-grams are sent to the parts of the same filter and
probed there, so that the scores are the same on both sides of the limit.

Defined results: a null or empty text is one end token; null ids are in the training part if their
(absent) checksum is not 2, that is, always; repeated rows count and are scored each; with no
training text every probability is uniform over the one unseen class (N = V = 0)."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from cytospark.llm import textops
from cytospark.session import cut_lineage, drop_cut

# Counts are quantised to levels 1 + floor(log(count) / log(QUANT)).
QUANT = 1.5
MU = 50.0
BITS_PER_ENTRY = 12
PROBES = 6
MAX_BYTES = 192 << 20
PART_BYTES = 8 << 20
MIN_PARTS = 64
# Texts that ask the filter's parts together where the filter is not broadcast.
BLOCK_BYTES = 4 << 20
# Distinct bigrams that a task holds before it hands its counts on.
FLUSH_KEYS = 3 << 19
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_LEVEL_STEP = np.uint64(0xD1342543DE82EF95)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per text and their hashes: the words of the lower-cased text and one end."""
    counts, words = textops.word_hashes([t.lower() for t in texts])
    stops = np.cumsum(counts + 1)
    out = np.empty(stops[-1] if len(stops) else 0, dtype=np.uint64)
    is_end = np.zeros(len(out), dtype=bool)
    is_end[stops - 1] = True
    out[is_end] = END
    out[~is_end] = words
    return counts + 1, out


def _contexts(counts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The token before each token; the start mark before a text's first."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(counts) - counts] = START
    return before


def _pair(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return textops.mix(before * np.uint64(0x9FB21C651E98DF25) + tokens)


def level_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(QUANT) + 1e-9).astype(np.int64)


def count_at(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level (0 for level 0); level 1 is the count 1."""
    low = np.ceil(QUANT ** (np.maximum(levels, 1) - 1.0) - 1e-9)
    high = np.maximum(np.ceil(QUANT ** np.maximum(levels, 1.0) - 1e-9) - 1, low)
    return np.where(levels > 0, (low + high) / 2, 0.0)


class _Gathered:
    """Counts of n-grams in one task, kept as sorted arrays that are merged when they have doubled."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.more: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        u, c = np.unique(keys, return_counts=True)
        self.more.append((u, c))
        self.size += len(u)
        if self.size > max(1 << 18, len(self.keys) // 2):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.more]])
        counts = np.concatenate([self.counts, *[c for _, c in self.more]])
        self.keys, self.counts = _summed(keys, counts)
        self.more, self.size = [], 0


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


_SENT: list = []
_PACKED = "kind int, part int, keys binary, counts binary"


def gather(training: DataFrame, text_col: str, parts: int) -> DataFrame:
    """Counts of the training texts' n-grams by part of the hash range: ``kind`` (0: token, 1: bigram),
    ``part``, ``keys`` (sorted hashes) and ``counts``, packed, one row per kind, part and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (_Gathered(), _Gathered())

        def flush():
            rows = []
            for kind, g in enumerate(kinds):
                g.merge()
                part = _part(g.keys, parts)
                cuts = np.searchsorted(part, np.arange(parts + 1))
                for p in np.flatnonzero(np.diff(cuts)):
                    a, b = cuts[p], cuts[p + 1]
                    rows.append((kind, int(p), g.keys[a:b].tobytes(), _narrow(g.counts[a:b])))
                g.__init__()
            for i in range(0, len(rows), 64):
                cols = list(zip(*rows[i:i + 64]))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                                                  pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
                                                 names=["kind", "part", "keys", "counts"])
        for batch in textops.small(batches):
            texts = [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
            for a, b in textops.groups([len(t) for t in texts]):
                counts, tokens = _tokens(texts[a:b])
                kinds[0].add(tokens)
                kinds[1].add(_pair(_contexts(counts, tokens), tokens))
            if len(kinds[1].keys) > FLUSH_KEYS:
                yield from flush()
        yield from flush()
        textops.release()
    return training.select(text_col).mapInArrow(run, _PACKED)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts as bytes: one byte each, 255 standing for a larger one that follows after all bytes."""
    big = counts[counts >= 255]
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + big.astype("<i8").tobytes()


def _wide(packed: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(packed, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(packed, "<i8", offset=n)
    return counts


def merged(gathered: DataFrame) -> DataFrame:
    """One row per kind and part with the summed counts.  A part holds a share of the hash range, so a
    frequent n-gram adds at most one entry a task to it."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            ks = [np.frombuffer(k, np.uint64) for k in batch.column("keys").to_pylist()]
            cs = [_wide(c, len(k)) for k, c in zip(ks, batch.column("counts").to_pylist())]
            keys, counts = _summed(np.concatenate([keys, *ks]), np.concatenate([counts, *cs]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([keys.tobytes()], pa.binary()),
             pa.array([_narrow(counts)], pa.binary()), pa.array([len(keys)], pa.int64()),
             pa.array([int(level_of(counts).sum())], pa.int64()), pa.array([int(counts.sum())], pa.int64())],
            names=["kind", "part", "keys", "counts", "distinct", "entries", "total"])
        del keys, counts
        textops.release()
    return gathered.groupBy("kind", "part").applyInArrow(run, _PACKED + ", distinct long, entries long, total long")


def _probe_bits(keys: np.ndarray, level: int | np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The places of an n-gram at a level within its part, probe by probe."""
    h = textops.mix(keys + np.asarray(level).astype(np.uint64) * _LEVEL_STEP)
    step = textops.mix(h ^ _LEVEL_STEP) | np.uint64(1)
    for _ in range(PROBES):
        yield ((h >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)).astype(np.int64)
        h = h + step


def _put(on: np.ndarray, keys: np.ndarray, packed: bytes) -> None:
    """Set the bits of n-grams with their packed counts."""
    levels = level_of(_wide(packed, len(keys)))
    level = 1
    while len(keys):
        for at in _probe_bits(keys, level, len(on)):
            on[at] = 1
        level += 1
        left = levels >= level
        keys, levels = keys[left], levels[left]


def build_parts(counted: DataFrame, bits: int) -> DataFrame:
    """``(part, bits)``: the Bloom filter's part of ``bits`` bits over both kinds."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.zeros(bits, dtype=np.uint8)
        for batch in batches:
            for k, c in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                _put(on, np.frombuffer(k, np.uint64), c)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()),
                                          pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())],
                                         names=["part", "bits"])
        del on
        textops.release()
    return counted.select("part", "keys", "counts").groupBy("part").applyInArrow(run, "part int, bits binary")


class BloomCounts:
    """Quantised counts by probing: ``levels(keys)``."""

    def __init__(self, filters: np.ndarray, parts: int, bits: int):
        self.filters, self.parts, self.bits = filters, parts, bits

    def levels(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=np.int64)
        base = _part(keys, self.parts) * self.bits
        left = np.arange(len(keys))
        level = 1
        while len(left):
            found, at = left, None
            spot = base[left]
            hit = np.ones(len(left), dtype=bool)
            for at in _probe_bits(keys[left], level, self.bits):
                place = spot + at
                hit[hit] = (self.filters[place[hit] >> 3] >> (place[hit] & 7).astype(np.uint8) & 1).astype(bool)
            left = found[hit]
            out[left] = level
            level += 1
        return out


def _score_part(counts, tokens, levels_of, exact_of, total, distinct):
    """Per text: known tokens, base score and model score."""
    doc = np.repeat(np.arange(len(counts)), counts)
    uniq, inverse = np.unique(tokens, return_inverse=True)
    exact = exact_of(uniq)
    base = np.log10((exact + 1.0) / (total + distinct + 1.0))[inverse]
    c1_all = count_at(levels_of(uniq))
    before = _contexts(counts, tokens)
    pairs, at, pair_inverse = np.unique(_pair(before, tokens), return_index=True, return_inverse=True)
    c12 = count_at(levels_of(pairs))
    c_word = c1_all[inverse[at]]
    # A context's count: the start mark occurs once a training text, as often as the end.
    first = before[at] == START
    c_context = np.where(first, count_at(levels_of(np.array([END])))[0], c1_all[inverse[np.maximum(at - 1, 0)]])
    c12 = np.minimum(np.minimum(c12, c_context), c_word)
    unigram = (c_word + 1.0) / (total + distinct + 1.0)
    score = np.log10((c12 + MU * unigram) / (c_context + MU))[pair_inverse]
    n = len(counts)
    return (np.bincount(doc, weights=(exact > 0)[inverse], minlength=n).astype(np.int64),
            np.bincount(doc, weights=base, minlength=n), np.bincount(doc, weights=score, minlength=n))


_OUT = [("held_out", BooleanType()), ("n_tokens", LongType()), ("n_known", LongType()), ("train_tokens", LongType()),
        ("base_score", DoubleType()), ("score", DoubleType())]


def _small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Hand texts to the workers in batches of at most ``most`` bytes, on both sides of the pipe (the session's
    limit is lowered, never raised)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key, "64m"))) > most:
        spark.conf.set(key, str(most))


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document; learns
    from the documents that are not held out."""
    spark = docs.sparkSession
    _small_batches(spark)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    training = src.where(~held_out(F.col("doc_id")))
    size = training.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    parts = max(MIN_PARTS, size // PART_BYTES)
    counted = cut_lineage(merged(gather(training, "text", parts)))
    sums = {r["kind"]: r for r in counted.groupBy("kind").agg(
        F.sum("distinct").alias("distinct"), F.sum("total").alias("total")).collect()}
    total = sums[0]["total"] if sums else 0
    distinct = sums[0]["distinct"] if sums else 0
    # The parts are equally large, by the fullest one; with uniform hashes that is near the mean.
    fullest = counted.groupBy("part").agg(F.sum("entries").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    bits = max(64, (fullest * BITS_PER_ENTRY + 7) // 8 * 8)
    if parts * bits // 8 > max_bytes or distinct * 16 > max_bytes:
        return _scores_by_parts(src, counted, parts, bits, total, distinct)
    filters = np.zeros((parts, bits // 8), dtype=np.uint8)
    for r in cut_lineage(build_parts(counted, bits)).toLocalIterator():
        filters[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    keys, counts = [np.zeros(0, np.uint64)] * parts, [np.zeros(0, np.int64)] * parts
    for r in counted.where("kind = 0").select("part", "keys", "counts").toLocalIterator():
        keys[r["part"]] = np.frombuffer(r["keys"], np.uint64)
        counts[r["part"]] = _wide(r["counts"], len(keys[r["part"]]))
    exact = np.concatenate(counts)
    if exact.max(initial=0) < 2**32:
        exact = exact.astype(np.uint32)
    # Executors drop the copies of filters broadcast before; a query that still wants one fetches it again.
    while _SENT:
        _SENT.pop().unpersist()
    holder = spark.sparkContext.broadcast((filters, parts, bits, np.concatenate(keys), exact))
    _SENT.append(holder)
    del filters, keys, counts, exact
    textops.release()
    schema = StructType([src.schema["doc_id"], *[StructField(n, t) for n, t in _OUT if n != "held_out"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The broadcast itself is what a worker keeps between tasks; nothing else may hold its arrays.
        filters, _, _, known, exact = holder.value
        bloom = BloomCounts(filters.reshape(-1), parts, bits)

        def exact_of(words: np.ndarray) -> np.ndarray:
            return _exact_counts(known, exact, words)
        for batch in textops.small(batches):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            found = [[np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]]
            for a, b in textops.groups([len(t) for t in texts]):
                counts, tokens = _tokens(texts[a:b])
                found.append([counts, *_score_part(counts, tokens, bloom.levels, exact_of, total, distinct)])
            n, n_known, base, score = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(n_known, pa.int64()),
                 pa.array(np.full(len(texts), total, np.int64)), pa.array(base), pa.array(score)], names=[f.name for f in schema])
    scored = src.mapInArrow(run, schema)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *[n for n, _ in _OUT if n != "held_out"])


def _in_blocks(src: DataFrame) -> DataFrame:
    """``src`` with ``block``, the number of a run of neighbouring texts of about ``BLOCK_BYTES`` (or one text), and
    ``at``, the text's place in it."""
    most = BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at, held = TaskContext.get().partitionId() << 33, 0, 0
        for batch in batches:
            blocks, places = np.empty(batch.num_rows, dtype=np.int64), np.empty(batch.num_rows, dtype=np.int64)
            for i, t in enumerate(batch.column("text")):
                # A row costs something without text, too.
                n = (t.as_buffer().size if t.is_valid else 0) + 64
                if held and held + n > most:
                    block, at, held = block + 1, 0, 0
                blocks[i], places[i] = block, at
                at, held = at + 1, held + n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks), pa.array(places)], names=["doc_id", "text", "block", "at"])
    return src.mapInArrow(run, StructType([*src.schema.fields, StructField("block", LongType()), StructField("at", LongType())]))


def _held(counted: DataFrame, bits: int) -> DataFrame:
    """``part, bits, keys, counts``: the filter bits of each counted row, and the tokens' exact counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, part, k, c in zip(*(batch.column(n).to_pylist() for n in ("kind", "part", "keys", "counts"))):
                on = np.zeros(bits, dtype=np.uint8)
                _put(on, np.frombuffer(k, np.uint64), c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary()),
                     *[pa.array([x if kind == 0 else None], pa.binary()) for x in (k, c)]], names=["part", "bits", "keys", "counts"])
        textops.release()
    return counted.select("kind", "part", "keys", "counts").mapInArrow(run, "part int, bits binary, keys binary, counts binary")


def _answers(asked: DataFrame, held: DataFrame, bits: int) -> DataFrame:
    """Levels (one byte each) of the asked n-grams by the filter's parts, and packed exact counts of the tokens among them."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        filters, known, exact = np.zeros(bits // 8, np.uint8), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for r in right.to_pylist():
            filters |= np.frombuffer(r["bits"], np.uint8)
            if r["keys"] is not None:
                known = np.frombuffer(r["keys"], np.uint64)
                exact = _wide(r["counts"], len(known))
        packed = left.column("keys").to_pylist()
        # An n-gram that many blocks ask for is probed once.
        uniq, inverse = np.unique(np.frombuffer(b"".join(packed), np.uint64), return_inverse=True)
        levels = BloomCounts(filters, 1, bits).levels(uniq).astype(np.uint8)[inverse]
        counts = _exact_counts(known, exact, uniq)[inverse]
        cuts = np.cumsum([0, *[len(k) // 8 for k in packed]])
        out = left.select(["block", "first", "kind", "part"])
        out = out.append_column("levels", pa.array([levels[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()))
        out = out.append_column("exact", pa.array([_narrow(counts[a:b]) if kind == 0 else b"" for a, b, kind in
                                                   zip(cuts, cuts[1:], left.column("kind").to_pylist())], pa.binary()))
        textops.release()
        return out
    return asked.groupBy("part", "salt").cogroup(held.groupBy("part", "salt")).applyInArrow(
        run, "block long, first long, kind int, part int, levels binary, exact binary")


def _exact_counts(known: np.ndarray, exact: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Counts of ``words`` by the sorted ``known`` ones."""
    if not len(known):
        return np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    return np.where(known[at] == words, exact[at].astype(np.int64), 0)


def _scores_by_parts(src: DataFrame, counted: DataFrame, parts: int, bits: int, total: int, distinct: int) -> DataFrame:
    """The same scores where the filter or the counts are too many to broadcast: every block of texts asks each
    part of the filter for its distinct n-grams, so that a frequent n-gram is asked for once a block; the blocks are
    dealt over salts where the texts are many for the parts.  Parts are ranges of the hash, so that the answers in the
    order of the parts are those to the sorted n-grams, which need not come back."""
    held = cut_lineage(_held(counted, bits))
    drop_cut(counted)
    rows = cut_lineage(_in_blocks(src))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    salts = max(1, -(-size // (2 * PART_BYTES * parts)))
    held = held.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def distinct_grams(of: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return (np.unique(np.concatenate([np.unique(t) for _, t in of])),
                np.unique(np.concatenate([np.unique(_pair(_contexts(n, t), t)) for n, t in of])))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, block, first, after = [], 0, 0, -1

        def flush():
            for kind, keys in enumerate(distinct_grams(of) if of else ()):
                cuts = np.searchsorted(_part(keys, parts), np.arange(parts + 1))
                found = np.flatnonzero(np.diff(cuts))
                for i in range(0, len(found), 4096):
                    some = found[i:i + 4096]
                    same = (np.full(len(some), x, t) for x, t in ((block % salts, np.int32), (block, np.int64), (first, np.int64), (kind, np.int32)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some.astype(np.int32)), *map(pa.array, same), pa.array([keys[cuts[p]:cuts[p + 1]].tobytes() for p in some], pa.binary())],
                        names=["part", "salt", "block", "first", "kind", "keys"])
            of.clear()
        for batch in textops.small(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            blocks, at = batch.column("block").to_numpy(), batch.column("at").to_numpy()
            starts = [0, *(np.flatnonzero((np.diff(blocks) != 0) | (np.diff(at) != 1)) + 1).tolist(), len(texts)]
            for a, b in zip(starts, starts[1:]):
                # A block whose rows are read by several tasks asks in several pieces of neighbouring texts.
                if block != blocks[a] or after != at[a]:
                    yield from flush()
                    block, first = int(blocks[a]), int(at[a])
                after = int(at[b - 1]) + 1
                of.extend(_tokens(texts[a + i:a + j]) for i, j in textops.groups([len(t) for t in texts[a:b]]))
        yield from flush()
        textops.release()

    fields = [src.schema["doc_id"], *[StructField(n, t) for n, t in _OUT if n != "held_out"]]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.sort_by("at"), right.sort_by([("first", "ascending"), ("kind", "ascending"), ("part", "ascending")])
        texts = [t or b"" for t in left.column("text").cast(pa.binary()).to_pylist()]
        answers: dict[int, tuple[list, list]] = {}
        for first, kind, levels, exact in zip(*(right.column(n).to_pylist() for n in ("first", "kind", "levels", "exact"))):
            lv, counts = answers.setdefault(first, ([], []))
            lv.append(np.frombuffer(levels, np.uint8))
            if kind == 0:
                counts.append(_wide(exact, len(levels)))
        found = []
        for (lv, counts), a, b in zip(answers.values(), answers, [*list(answers)[1:], len(texts)]):
            of = [_tokens(texts[a + i:a + j]) for i, j in textops.groups([len(t) for t in texts[a:b]])]
            words, pairs = distinct_grams(of)
            levels, exact = np.concatenate(lv).astype(np.int64), np.concatenate(counts)
            if len(levels) != len(words) + len(pairs) or len(exact) != len(words):
                raise RuntimeError("the filter's answers do not fit a block's n-grams")
            asked, order = np.unique(np.concatenate([words, pairs]), return_index=True)
            levels = levels[order]
            found += [[n, *_score_part(n, t, lambda k: levels[np.searchsorted(asked, k)],
                                       lambda k: _exact_counts(words, exact, k), total, distinct)] for n, t in of]
        n, n_known, base, score = (np.concatenate(x) for x in zip(*found))
        out = pa.Table.from_arrays([left.column("doc_id"), pa.array(n, pa.int64()), pa.array(n_known, pa.int64()),
                                    pa.array(np.full(len(texts), total, np.int64)), pa.array(base), pa.array(score)], names=[f.name for f in fields])
        textops.release()
        return out
    asked = rows.mapInArrow(ask, "part int, salt int, block long, first long, kind int, keys binary")
    answers = _answers(asked, held, bits)
    scored = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, StructType(fields))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *[n for n, _ in _OUT if n != "held_out"])
