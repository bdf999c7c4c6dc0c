"""N-best segmentation over a SentencePiece vocabulary (operator 4).

Forward Viterbi scores are the exact heuristic of a backward A-star search over the piece lattice: a
partial path from the end to a position has the score of its pieces plus the best score of any path
from the start to that position, so complete paths come out best first.

No piece of a vocabulary of this kind has a blank mark behind another character, or most punctuation
behind a letter (both are read from the vocabulary), so a text's lattice is a chain of its words' lattices.  Each distinct word is searched once per task; the best combinations
of a text follow exactly from the words' smallest losses.

Scores are the sums of the file's piece scores.  A character that no piece holds is spelt by its byte
pieces, each at ``BYTE_PENALTY`` below the lowest score of an ordinary piece.  Equal scores go to
the path that entered the queue first.

Defined results: null and empty texts have one segmentation, the empty one; texts with fewer
segmentations than asked for give those; repeated rows get equal results; decoding gives back the
text exactly."""
from __future__ import annotations

import heapq
import math
import re
import string
import struct
import zlib
from bisect import insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from cytospark.llm import textops

N_BEST = 4
BYTE_PENALTY = 10.0
CACHE_WORDS = 500_000
BLANK = "▁"


class Vocabulary:
    """Pieces with ids and scores, from a SentencePiece file."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
        self.byte_ids = {int(self.text[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        scores = {i: float(model.get_score(i)) for i in plain}
        self.by_text = {self.text[i]: (i, scores[i]) for i in plain}
        if any(BLANK in t.lstrip(BLANK) for t in self.by_text):
            raise ValueError("a piece has a blank mark behind another character; words can't be searched apart")
        self.unit = self._units()
        usual = [s for s in scores.values() if s > -1e6]
        self.byte_score = min(usual, default=0.0) - BYTE_PENALTY
        # Pieces by their characters: a node is a dict of the next characters, with the piece itself under "".
        self.root: dict = {}
        for t, found in self.by_text.items():
            node = self.root
            for c in t:
                node = node.setdefault(c, {})
            node[""] = found

    def _units(self) -> re.Pattern:
        """What matches the parts of a normalised text that no piece spans: they end before a blank mark, and
        between a Latin letter and such punctuation as no piece holds behind one."""
        letter = "A-Za-zÀ-ÖØ-öø-ɏ"
        behind = {t[k + 1] for t in self.by_text for k in range(len(t) - 1) if re.match(f"[{letter}]", t[k])}
        p = re.escape("".join(sorted(set(string.punctuation) - behind)))
        if not p:
            return re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        return re.compile(f"{BLANK}*[{p}]*(?:[^{BLANK}{p}]+|(?<![{letter}])[{p}])+|{BLANK}+[{p}]*|[{p}]+")

    def arcs(self, word: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """Per end position the arcs that end there: (start, ids, score)."""
        ends: list[list] = [[] for _ in range(len(word) + 1)]
        for i in range(len(word)):
            node, single = self.root, False
            for j in range(i, len(word)):
                node = node.get(word[j])
                if node is None:
                    break
                hit = node.get("")
                if hit is not None:
                    ends[j + 1].append((i, (hit[0],), hit[1]))
                    single = single or j == i
            if not single:
                data = word[i].encode()
                ends[i + 1].append((i, tuple(self.byte_ids[b] for b in data), self.byte_score * len(data)))
        return ends

    def search(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a word, best first: (score, ids).

        The promise of a partial path is its own score plus the best score from the start to where it
        stands; a step keeps the promise if it takes the best arc there and else lowers it by the arc's
        loss.  So a path that leaves the queue is followed along best arcs to the start at once, and
        the arcs it passes enter the queue, unless as many better paths as are still wanted wait there."""
        ends = self.arcs(word)
        best, first = [0.0] * len(ends), [None] * len(ends)
        for j in range(1, len(ends)):
            top = None
            for arc in ends[j]:
                score = best[arc[0]] + arc[2]
                if top is None or score > top:
                    top, first[j] = score, arc
            best[j] = top
        out, waiting, entered = [], [(0.0, 0, len(word), None)], 0
        while waiting and len(out) < n:
            loss, _, j, path = waiting.pop(0)
            wanted = n - len(out) - 1
            bar = waiting[wanted - 1][0] if 0 < wanted <= len(waiting) else math.inf if wanted else -math.inf
            while j:
                chosen = first[j]
                if len(ends[j]) > 1:
                    base = loss + best[j]
                    for arc in ends[j]:
                        worse = base - best[arc[0]] - arc[2]
                        if worse < bar and arc is not chosen:
                            entered += 1
                            insort(waiting, (worse, entered, arc[0], (arc[1], path)))
                            if len(waiting) >= wanted:
                                del waiting[wanted:]
                                bar = waiting[-1][0]
                path = (chosen[1], path)
                j = chosen[0]
            ids: list[int] = []
            while path is not None:
                ids.extend(path[0])
                path = path[1]
            out.append((best[-1] - loss, tuple(ids)))
        return out

    def normalize(self, text: str) -> str:
        return BLANK + text.replace(" ", BLANK) if text else ""

    def spell(self, ids) -> str:
        """The normalised text of pieces."""
        out, raw = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.text[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids) -> str:
        """The text of pieces; the blank that every text starts with goes."""
        return self.spell(ids).replace(BLANK, " ")[1:]


class Segmenter:
    """N-best segmentations of whole texts; remembers the words of its task."""

    def __init__(self, vocabulary: Vocabulary, n_best: int):
        self.vocabulary, self.n_best = vocabulary, n_best
        self.known: dict[str, tuple] = {}

    def word(self, word: str) -> tuple:
        """(score, ids, pieces, loss of the second, all (score, ids) of the word); ids as packed numbers."""
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        found = self.vocabulary.search(word, self.n_best)
        packed = [(score, struct.pack(f"<{len(ids)}I", *ids)) for score, ids in found]
        loss = packed[0][0] - packed[1][0] if len(packed) > 1 else math.inf
        entry = self.known[word] = (packed[0][0], packed[0][1], loss, packed)
        return entry

    def text(self, text: str | None) -> list[tuple[float, bytes]]:
        """The best segmentations of a text: (score, ids as little-endian 32-bit numbers).

        A text's segmentation picks one of the words' lists each; it loses what the picks lose against
        the best.  Only the words with the n-1 smallest first losses can be changed in the n best
        (of equal losses the earlier words), so those alone are combined, by a best-first search."""
        get, word = self.known.get, self.word
        lists = [get(w) or word(w) for w in self.vocabulary.unit.findall(self.vocabulary.normalize(text or ""))]
        total = sum([x[0] for x in lists])
        parts = [x[1] for x in lists]
        losses = [x[2] for x in lists]
        more = heapq.nsmallest(self.n_best - 1, range(len(lists)), key=losses.__getitem__)
        # States: a pick for some of the words in ``more``; successors raise one pick, at or behind the last raised.
        heap, out = [(0.0, (), 0)], []
        while heap and len(out) < self.n_best:
            loss, picks, last = heapq.heappop(heap)
            for k, p in picks:
                parts[k] = lists[k][3][p][1]
            out.append((total - loss, b"".join(parts)))
            for k, _ in picks:
                parts[k] = lists[k][1]
            chosen = dict(picks)
            for m in range(last, len(more)):
                k = more[m]
                p = chosen.get(k, 0) + 1
                every = lists[k][3]
                if p < len(every):
                    step = every[p - 1][0] - every[p][0]
                    heapq.heappush(heap, (loss + step, tuple(sorted((chosen | {k: p}).items())), m))
        return out


@lru_cache(maxsize=2)
def segmenter(path: str, n_best: int) -> Segmenter:
    return Segmenter(Vocabulary(path), n_best)


def piece_path() -> str:
    """The default vocabulary file, where the task runs."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def n_best(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N_BEST, path: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """A row per document and segmentation: ``doc_id, rank`` (from 1), ``score, n_pieces, ids_crc32``
    and, if asked for, ``ids``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fields = [src.schema["doc_id"], StructField("rank", IntegerType()), StructField("score", DoubleType()),
              StructField("n_pieces", LongType()), StructField("ids_crc32", LongType())]
    if with_ids:
        fields.append(StructField("ids", ArrayType(IntegerType())))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = segmenter(path or piece_path(), n)
        for batch in textops.small(batches):
            rows, cols = [], [[], [], [], [], []]
            for i, text in enumerate(batch.column(1).to_pylist()):
                for rank, (score, ids) in enumerate(seg.text(text), 1):
                    rows.append(i)
                    values = (rank, score, len(ids) // 4, zlib.crc32(ids), ids)
                    for col, value in zip(cols, values):
                        col.append(value)
            if with_ids:
                cols[4] = [np.frombuffer(x, "<i4") for x in cols[4]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())),
                 *[pa.array(c, t) for c, t in zip(cols[:len(names) - 1], (pa.int32(), pa.float64(), pa.int64(), pa.int64(),
                                                                         pa.list_(pa.int32())))]], names=names)
    return src.mapInArrow(run, StructType(fields))


def decode(encoded: DataFrame, ids_col: str = "ids", out: str = "text", path: str | None = None) -> DataFrame:
    """``encoded`` with the text that the pieces of ``ids_col`` spell (null ids: null)."""
    @F.pandas_udf("string")
    def spelt(ids: pd.Series) -> pd.Series:
        vocabulary = segmenter(path or piece_path(), 1).vocabulary
        return ids.map(lambda x: None if x is None else vocabulary.decode(list(x)))
    return encoded.withColumn(out, spelt(F.col(ids_col)))
