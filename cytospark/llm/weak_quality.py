"""Weak-label quality classifier (operator 10).

Overlapping heuristic labellers vote good, bad or nothing on every document.  The documents are counted
by their pattern of votes (at most 3^labellers patterns, whatever the input), and expectation
maximisation on these counts, that is, over all documents, estimates for each labeller how often it
gives each vote on good and on bad ones.  The posteriors label a bounded sample that trains a
logistic scorer on hashed features (words, and the shapes of words and of neighbouring words), and
the scorer judges every whole text.

The sample: the ``sample_docs`` documents that come first by a hash of id and text; everything else covers
all rows.  Defined results: a null or empty text has no words and no features, so it gets the votes
for that and the scorer's bias; repeated rows get equal results; null ids are kept as they are; an
empty table gives an empty result; if no labeller separates, all posteriors equal the prior."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cytospark.llm import textops
from cytospark.llm.quality_rules import measure_texts

SAMPLE_DOCS = 4000
SIZE = 1 << 18
EPOCHS = 6
RATE = 0.5
L2 = 1e-6
THRESHOLD = 0.5
GOOD, BAD, NONE = 1, 0, 2

_KIND = np.zeros(256, dtype=np.int64)
_UPPER, _LOWER = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_LOWER[ord("a"):ord("z") + 1] = True
_KIND[:] = np.arange(256)
_KIND[_UPPER] = 1
_KIND[_LOWER] = 2
_KIND[ord("0"):ord("9") + 1] = 3
_KIND[0x80:] = 2


# The marks whose runs count as junk.
_MARKS = [bytes([c]) for c in b"#*$%&|<>!?~=_"]


def _vote(n: int, bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, NONE)).astype(np.int8)


LABELLERS = ["length", "symbols", "repeats", "dup_lines", "word_length", "capitals", "sentence_ends", "exclamations", "variety",
             "symbol_runs", "letters"]


def votes(texts: list[bytes], measures: dict[str, np.ndarray], distinct: np.ndarray) -> np.ndarray:
    """(texts, labellers) votes from the measures of whole texts."""
    n = len(texts)
    words = np.maximum(measures["n_words"], 1).astype(float)
    lines = np.maximum(measures["n_lines"], 1).astype(float)
    upper, lower, ends, bangs, letters, runs = (np.zeros(n) for _ in range(6))
    for i, t in enumerate(texts):
        for at in range(0, len(t), textops.BLOCK_BYTES):
            buf = np.frombuffer(t, np.uint8, min(textops.BLOCK_BYTES, len(t) - at), at)
            upper[i] += _UPPER[buf].sum()
            lower[i] += _LOWER[buf].sum()
            letters[i] += (_KIND[buf] <= 2).sum() - (buf <= 2).sum()
        runs[i] = sum(t.count(c * 3) for c in _MARKS)
        ends[i] = sum(x.rstrip().endswith((b".", b"!", b"?", b":", b'"')) for x in t.split(b"\n"))
        bangs[i] = t.count(b"!")
    size = np.maximum([sum(map(len, t.split())) for t in texts], 1)
    enough = measures["n_words"] >= 20
    out = {
        "length": _vote(n, measures["n_words"] < 50, measures["n_words"] >= 80),
        "symbols": _vote(n, measures["n_symbols"] > 0.1 * words, measures["n_symbols"] <= 0.01 * words),
        "repeats": _vote(n, measures["n_repeat_words"] > 0.3 * words, enough & (measures["n_repeat_words"] < 0.05 * words)),
        "dup_lines": _vote(n, measures["n_dup_lines"] > 0.3 * lines, (lines >= 3) & (measures["n_dup_lines"] == 0)),
        "word_length": _vote(n, (measures["word_chars"] < 3 * words) | (measures["word_chars"] > 10 * words),
                             (measures["word_chars"] >= 4 * words) & (measures["word_chars"] <= 8 * words)),
        "capitals": _vote(n, upper > 0.5 * (upper + lower), enough & (upper <= 0.15 * (upper + lower))),
        "sentence_ends": _vote(n, ends < 0.1 * lines, ends >= 0.5 * lines),
        "exclamations": _vote(n, bangs > 0.3 * words, enough & (bangs <= 0.02 * words)),
        "symbol_runs": _vote(n, runs > 0.1 * words, enough & (runs <= 0.01 * words)),
        "letters": _vote(n, letters < 0.85 * size, letters > 0.92 * size),
        "variety": _vote(n, enough & (distinct < 0.2 * words), distinct > 0.4 * words),
    }
    return np.stack([out[name] for name in LABELLERS], axis=1)


def _features(counts: np.ndarray, words: np.ndarray, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed features of each text: (places, values), values of length 1 together."""
    out, at = [], 0
    for text, n in zip(texts, counts):
        mine = words[at:at + n]
        at += n
        if not n:
            out.append((np.zeros(0, np.int64), np.zeros(0, np.float32)))
            continue
        shapes = _shapes(text)
        pairs = textops.mix(shapes[:-1] * np.uint64(31) + shapes[1:] + np.uint64(1 << 40))
        places, times = np.unique(np.concatenate([mine, shapes, pairs]) % np.uint64(SIZE), return_counts=True)
        value = np.sqrt(times.astype(np.float32))
        out.append((places.astype(np.int64), value / np.sqrt((value * value).sum())))
    return out


def _shapes(text: bytes) -> np.ndarray:
    """A hash of each word's shape: the kinds of its first and last two bytes and its length in steps."""
    found = []
    for piece in textops._pieces(text, textops.BLOCK_BYTES):
        buf = np.frombuffer(piece, np.uint8)
        a, b = textops.word_spans(buf)
        kind = _KIND[buf]
        size = np.minimum(b - a, 24) // 4
        found.append(textops.mix((kind[a] + 256 * kind[b - 1] + 65536 * kind[np.maximum(b - 2, a)] + (size << 24)).astype(np.uint64)))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for a, b in textops.groups([len(t) for t in texts]):
        counts, words = textops.word_hashes([t.lower() for t in texts[a:b]])
        yield a, b, counts, words


def _distinct(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    stops = np.cumsum(counts)
    return np.array([len(np.unique(words[e - n:e])) for n, e in zip(counts, stops)], dtype=np.int64)


def patterns_of(texts: list[bytes], distinct: np.ndarray) -> list[str]:
    v = votes(texts, measure_texts(texts), distinct)
    return ["".join("+" if x == GOOD else "-" if x == BAD else "." for x in row) for row in v]


def with_votes(docs: DataFrame) -> DataFrame:
    """``docs`` of (doc_id, text) as ``doc_id, votes`` (a character a labeller: + good, - bad, . nothing)."""
    schema = StructType([docs.schema["doc_id"], StructField("votes", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.small(batches):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            found = []
            for a, b, counts, words in _blocks(texts):
                found += patterns_of(texts[a:b], _distinct(counts, words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "votes"])
    return docs.mapInArrow(run, schema)


def label_model(patterns: dict[str, int], rounds: int = 200, tolerance: float = 1e-9) -> tuple[dict[str, float], dict]:
    """Posterior of good by pattern, and the estimates: the prior and per labeller P(vote | class).

    Votes are taken as independent given the class, and whether a labeller votes as independent of it;
    the first posteriors are the shares of good votes.  Counts are smoothed by one of each vote."""
    if not patterns:
        return {}, {"prior": 0.5, "rates": np.zeros((0, 2, 2))}
    names = sorted(patterns)
    n = np.array([patterns[p] for p in names], dtype=float)
    v = np.array([[GOOD if c == "+" else BAD if c == "-" else NONE for c in p] for p in names])
    plus, minus = (v == GOOD).sum(1), (v == BAD).sum(1)
    post = (plus + 1.0) / (plus + minus + 2.0)
    post = np.where(minus > 0, np.minimum(post, 0.5), post)
    said = np.stack([v == BAD, v == GOOD], axis=2).astype(float)
    for _ in range(rounds):
        weight = np.stack([(1 - post) * n, post * n])
        prior = (weight.sum(1) + 1) / (n.sum() + 2)
        rates = np.einsum("cp,plv->lcv", weight, said) + 1
        rates /= rates.sum(2, keepdims=True)
        log = np.log(prior)[:, None] + np.einsum("plv,lcv->cp", said, np.log(rates))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
        change = np.abs(new - post).max()
        post = new
        if change < tolerance:
            break
    return dict(zip(names, post.tolist())), {"prior": float(prior[1]), "rates": rates}


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer on soft labels, by adaptive steps in a fixed order."""
    w, g = np.zeros(SIZE, np.float32), np.full(SIZE, 1e-6, np.float32)
    bias, g_bias = 0.0, 1e-6
    order = np.random.default_rng(11)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            places, values, target = rows[i]
            off = 1 / (1 + np.exp(-np.clip(float(w[places] @ values) + bias, -30, 30))) - target
            step = off * values + L2 * w[places]
            g[places] += step * step
            w[places] -= RATE * step / np.sqrt(g[places])
            g_bias += off * off
            bias -= RATE * off / np.sqrt(g_bias)
    return w, bias


def weak_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
                 threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, votes, posterior, score, kept`` of every document."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counted = {r["votes"]: r["n"] for r in with_votes(src).groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    posterior, _ = label_model(counted)
    key = F.xxhash64("doc_id", "text")
    last = src.select(key.alias("k")).distinct().orderBy("k").limit(sample_docs).agg(F.max("k").alias("k")).first()["k"]
    weights = spark.sparkContext.broadcast(train(_sample(src, key, last, posterior)))
    known = spark.sparkContext.broadcast(posterior)
    schema = StructType([src.schema["doc_id"], StructField("votes", StringType()), StructField("posterior", DoubleType()),
                         StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias = weights.value
        for batch in textops.small(batches):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            votes_, scores = [], []
            for a, b, counts, words in _blocks(texts):
                votes_ += patterns_of(texts[a:b], _distinct(counts, words))
                scores += [1 / (1 + np.exp(-np.clip(float(w[p] @ v) + bias, -700, 700)))
                           for p, v in _features(counts, words, texts[a:b])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(votes_, pa.string()), pa.array([known.value[v] for v in votes_], pa.float64()),
                 pa.array(scores, pa.float64())], names=[f.name for f in schema])
    return src.mapInArrow(run, schema).withColumn("kept", F.col("score") >= threshold)


def _sample(src: DataFrame, key, last: int | None, posterior: dict[str, float]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Features and posterior labels of the documents whose key is at most ``last``, each once."""
    if last is None:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.small(batches):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for a, b, counts, words in _blocks(texts):
                found = _features(counts, words, texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(patterns_of(texts[a:b], _distinct(counts, words)), pa.string()),
                     pa.array([p.astype("<i4").tobytes() for p, _ in found], pa.binary()),
                     pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())], names=["k", "votes", "places", "vals"])
    picked = src.select(key.alias("k"), "text").where(F.col("k") <= last) \
        .mapInArrow(run, "k long, votes string, places binary, vals binary").dropDuplicates(["k"]).orderBy("k")
    return [(np.frombuffer(r["places"], "<i4"), np.frombuffer(r["vals"], "<f4"), posterior[r["votes"]])
            for r in picked.toLocalIterator()]
