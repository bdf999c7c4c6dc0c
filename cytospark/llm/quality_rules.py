"""Host-level quality rules (operator 1).

Every document is measured by a few surface rules.  The failures of each rule are counted per host,
a beta prior is fitted to the hosts' failure rates by moments, and every host's rate is shrunk
towards it: ``(failures + a) / (documents + a + b)``.  A host with a shrunk rate above the limit in
any rule is rejected, and that verdict is joined back to its documents.

Defined results: a null text has no words; a null host has no host verdict, so only the base rules
speak; repeated rows are judged each by itself and count each for their host; an empty table gives
an empty result."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cytospark.llm import textops
from cytospark.llm.common import fresh, salted_join, small_side
from cytospark.session import cut_lineage

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
# The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
# Most that a host's shrunk failure rate may be, per rule.
MAX_RATES = {"short": 0.5, "repeat": 0.5, "symbols": 0.5, "dup_lines": 0.5, "word_length": 0.5}
# The strength of the prior (a + b) stays in this range, also where all hosts have the same rate.
PRIOR_STRENGTH = (1.0, 1000.0)

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(SYMBOLS)] = 1
_SOLID = np.ones(256, dtype=np.int64)
_SOLID[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_SOLID[0x80:0xC0] = 0


def _repeat_words(counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Words in three-word windows that a text has twice or more, per text."""
    doc = np.repeat(np.arange(len(counts)), counts)
    n = len(hashes)
    covered = np.zeros(n + 3, dtype=np.int64)
    if n >= 3:
        inner = np.flatnonzero(doc[2:] == doc[:-2])
        key = textops.mix(hashes[inner] + doc[inner].astype(np.uint64))
        key = textops.mix(key + hashes[inner + 1])
        key = textops.mix(key + hashes[inner + 2])
        order = np.argsort(key, kind="stable")
        same = np.concatenate(([False], key[order][1:] == key[order][:-1], [False]))
        twice = inner[order[same[1:] | same[:-1]]]
        covered[twice] += 1
        covered[twice + 3] -= 1
    return np.bincount(doc, weights=np.cumsum(covered)[:n] > 0, minlength=len(counts)).astype(np.int64)


def _by_table(text: bytes, weights: np.ndarray) -> int:
    total = 0
    for at in range(0, len(text), textops.BLOCK_BYTES):
        total += int(weights[np.frombuffer(text, np.uint8, min(textops.BLOCK_BYTES, len(text) - at), at)].sum())
    return total


def measure_texts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The measures of whole texts."""
    out = {name: np.zeros(len(texts), dtype=np.int64) for name in MEASURES}
    for first, last in textops.groups([len(t) for t in texts]):
        counts, hashes = textops.word_hashes(texts[first:last])
        out["n_words"][first:last] = counts
        out["n_repeat_words"][first:last] = _repeat_words(counts, hashes)
        for i in range(first, last):
            text = texts[i]
            lines = [x for x in text.split(b"\n") if x.strip()]
            out["n_lines"][i], out["n_dup_lines"][i] = len(lines), len(lines) - len(set(lines))
            out["word_chars"][i] = _by_table(text, _SOLID)
            out["n_symbols"][i] = _by_table(text, _SYMBOL)
    return out


def with_measures(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the measures appended as ``prefix + name`` (one pass, no shuffle)."""
    at = docs.columns.index(text_col)
    names = [*docs.columns, *[prefix + m for m in MEASURES]]
    schema = StructType(docs.schema.fields + [StructField(prefix + m, LongType()) for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.small(batches):
            texts = [t or b"" for t in batch.column(at).cast(pa.binary()).to_pylist()]
            found = measure_texts(texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(found[m], pa.int64()) for m in MEASURES]], names=names)
    return docs.mapInArrow(run, schema)


def base_failed(prefix: str = "") -> Column:
    words = F.col(prefix + "n_words")
    return (words < 50) | (F.col(prefix + "n_repeat_words") * 100 > words * 50)


def rule_failures(prefix: str = "") -> dict[str, Column]:
    """The rules whose failures are counted per host."""
    m = {name: F.col(prefix + name) for name in MEASURES}
    return {
        "short": m["n_words"] < 50,
        "repeat": m["n_repeat_words"] * 100 > m["n_words"] * 50,
        "symbols": m["n_symbols"] * 10 > m["n_words"],
        "dup_lines": m["n_dup_lines"] * 10 > m["n_lines"] * 3,
        "word_length": (m["word_chars"] < m["n_words"] * 3) | (m["word_chars"] > m["n_words"] * 10),
    }


def host_verdicts(measured: DataFrame, host_col: str = "source", prefix: str = "",
                  max_rates: dict[str, float] | None = None) -> DataFrame:
    """One row a host: ``(host, n_docs, rate_<rule>…, host_rejected)`` with shrunk failure rates.
    Counting combines on the map side, so a host with a third of all documents is no hot spot; only
    the two moments of each rule come to the driver."""
    rates = max_rates or MAX_RATES
    fails = rule_failures(prefix)
    hosts = cut_lineage(measured.where(F.col(host_col).isNotNull()).groupBy(F.col(host_col).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(fails[r].cast("long")).alias(f"fails_{r}") for r in rates]))
    moments = hosts.agg(*[f(F.col(f"fails_{r}") / F.col("n_docs")).alias(f"{k}_{r}")
                          for r in rates for k, f in (("mean", F.avg), ("var", F.var_pop))]).first()
    shrunk, over = [], F.lit(False)
    for r, limit in rates.items():
        mean, var = moments[f"mean_{r}"] or 0.0, moments[f"var_{r}"] or 0.0
        strength = min(max(mean * (1 - mean) / var - 1 if var > 0 else PRIOR_STRENGTH[1], PRIOR_STRENGTH[0]), PRIOR_STRENGTH[1])
        rate = (F.col(f"fails_{r}") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
        shrunk.append(rate.alias(f"rate_{r}"))
        over = over | (rate > F.lit(limit))
    return hosts.select("host", "n_docs", *shrunk, over.alias("host_rejected"))


def join_verdicts(measured: DataFrame, hosts: DataFrame, out: str, host_col: str = "source") -> DataFrame:
    """``measured`` with the column ``out``: whether the document's host is rejected (null host: no).
    Only rejected hosts are joined: broadcast if they were measured to be small, else by a salted
    join, as one host may hold a third of the rows."""
    key = fresh(measured.columns, "_host")
    bad = cut_lineage(hosts.where("host_rejected").select(F.col("host").alias(key), F.lit(True).alias(out)))
    side, small = small_side(bad, key)
    left = measured.withColumn(key, F.col(host_col))
    joined = left.join(side, key, "left") if small else salted_join(
        left, side, key, F.monotonically_increasing_id())
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(False))).drop(key)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source") -> DataFrame:
    """Measures and verdict of every document: ``doc_id``, the measures, ``base_failed``,
    ``host_rejected`` and ``kept``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(host_col).alias("host"))
    measured = cut_lineage(with_measures(src).drop("text"))
    judged = join_verdicts(measured, host_verdicts(measured, "host"), "host_rejected", "host")
    return judged.withColumn("base_failed", base_failed()) \
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")) \
        .select("doc_id", *MEASURES, "base_failed", "host_rejected", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The documents that neither the base rules nor their host's verdict reject, with the columns
    of ``docs``.  Texts are never shuffled: they are measured once for the hosts' counts and once
    more where they are filtered."""
    prefix = "_qr_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    counted = with_measures(docs.select(text_col, host_col), text_col, prefix).drop(text_col)
    hosts = host_verdicts(counted, host_col, prefix)
    passed = with_measures(docs, text_col, prefix).where(~base_failed(prefix))
    out = fresh(passed.columns, "_rejected")
    return join_verdicts(passed, hosts, out, host_col).where(~F.col(out)).select(*docs.columns)
