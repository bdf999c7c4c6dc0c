"""Language identification by compression (operator 3).

Every language gets a raw-content zstandard dictionary of passages from its training documents.  A
text (lower-cased, like the passages) is compressed whole, block by block, once with each dictionary; the language with the smallest
total is chosen.  ``margin`` is how much smaller it is than the next language, as a share of the
latter; a text with a margin under ``min_margin`` is rejected.

The dictionaries are the only thing learnt, from a bounded sample: the ``docs_per_lang`` training
documents of a language that come first by a hash of their id, one passage of at most
``passage_chars`` from a hashed place of each, equal passages once, up to ``dict_bytes`` (less if
there are so many languages that all dictionaries would pass ``total_bytes``).

Defined results: a text that is null or has no letter is ``und`` with score 0 and rejected; with
one learnt language the margin is 1; with none every text is ``und``; equal sizes go to the language
that sorts first, with margin 0; repeated rows get equal results; an empty table gives an empty one."""
from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cytospark.llm import textops
from cytospark.llm.common import fresh, small_side
from cytospark.session import cut_lineage

DOCS_PER_LANG = 800
PASSAGE_CHARS = 512
DICT_BYTES = 1 << 16
TOTAL_BYTES = 32 << 20
BLOCK = 4096
LEVEL = 6
MIN_MARGIN = 0.002
# Bytes of difference that count as one unit of log-odds in the score.
SCORE_SCALE = 4.0
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def in_training(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) != 2


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          docs_per_lang: int = DOCS_PER_LANG, passage_chars: int = PASSAGE_CHARS, dict_bytes: int = DICT_BYTES,
          total_bytes: int = TOTAL_BYTES) -> dict[str, bytes]:
    """Dictionary contents by language, from the documents given."""
    text, key = F.col(text_col), F.xxhash64(id_col, text_col)
    # Twice the wanted share of each language's documents, by the hash, before they are ranked: what
    # meets in a language's task is bounded however many tasks there are.
    counts = cut_lineage(docs.where(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("lang")).agg(
        F.count(F.lit(1)).alias("n")))
    side, _ = small_side(counts, "lang")
    room = F.greatest(F.length(text) - passage_chars, F.lit(0)) + 1
    src = docs.where(F.col(lang_col).isNotNull() & text.rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), key.alias("key"),
        F.substring(text, (F.pmod(key, room) + 1).cast("int"), F.lit(passage_chars)).alias("passage"))
    first = Window.partitionBy("lang").orderBy("key", "passage")
    share = F.pmod("key", F.lit(1 << 31)) / float(1 << 31)
    rows = src.join(side, "lang").where(share * F.col("n") < 2 * docs_per_lang).withColumn("r", F.row_number().over(first)).where(F.col("r") <= docs_per_lang) \
        .groupBy("lang", "passage").agg(F.min("r").alias("r")).orderBy("lang", "r").select("lang", "passage").collect()
    passages: dict[str, list[bytes]] = {}
    for r in rows:
        passages.setdefault(r["lang"], []).append(r["passage"].lower().encode())
    most = min(dict_bytes, total_bytes // max(1, len(passages)))
    return {lang: b"\n".join(found)[:most] for lang, found in passages.items()}


@lru_cache(maxsize=4)
def _compressors(content: tuple[tuple[str, bytes], ...], level: int):
    import zstandard
    out = []
    for lang, data in content:
        if len(data) >= 8:
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            c = zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        else:
            c = zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False)
        out.append((lang, c.compress))
    return out


def classify(text: str | None, compressors) -> tuple[str, float, float]:
    """(language, score, margin) of one whole text."""
    if not text or not compressors or not _LETTER.search(text):
        return UNKNOWN, 0.0, 0.0
    data = text.lower().encode()
    blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
    sizes = sorted((sum(len(pack(b)) for b in blocks), lang) for lang, pack in compressors)
    best = sizes[0][0]
    score = 1.0 / sum(math.exp((best - n) / SCORE_SCALE) for n, _ in sizes)
    margin = (sizes[1][0] - best) / sizes[1][0] if len(sizes) > 1 else 1.0
    return sizes[0][1], score, margin


def with_language(docs: DataFrame, dictionaries: dict[str, bytes], names: tuple[str, str, str],
                  text_col: str = "text", level: int = LEVEL) -> DataFrame:
    """``docs`` with the language, score and margin of their texts appended under ``names``."""
    content = docs.sparkSession.sparkContext.broadcast(tuple(sorted(dictionaries.items())))
    at, cols = docs.columns.index(text_col), [*docs.columns, *names]
    schema = StructType(docs.schema.fields + [StructField(names[0], StringType()), StructField(names[1], DoubleType()),
                                              StructField(names[2], DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(content.value, level)
        for batch in textops.small(batches):
            found = [classify(t, compressors) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), *[
                    pa.array([f[k] for f in found], pa.float64()) for k in (1, 2)]], names=cols)
    return docs.mapInArrow(run, schema)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                min_margin: float = MIN_MARGIN) -> DataFrame:
    """Language of every document: ``doc_id, held_out, lang_pred, score, margin, rejected``.  Learns
    from the documents that are not held out."""
    training = docs.where(in_training(F.col(id_col)))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = with_language(src, learn(training, id_col, text_col, lang_col), ("lang_pred", "score", "margin"))
    return found.select("doc_id", F.coalesce(~in_training(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred",
                        "score", "margin", ((F.col("lang_pred") == UNKNOWN) | (F.col("margin") < min_margin)).alias("rejected"))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    min_margin: float = MIN_MARGIN) -> DataFrame:
    """The documents whose language is identified with enough margin, with the columns of ``docs``."""
    names = tuple(fresh(docs.columns, n) for n in ("_lang_pred", "_lang_score", "_lang_margin"))
    learnt = learn(docs.where(in_training(F.col(id_col))), id_col, text_col, lang_col)
    found = with_language(docs, learnt, names, text_col)
    return found.where((F.col(names[0]) != UNKNOWN) & (F.col(names[2]) >= min_margin)).select(*docs.columns)
