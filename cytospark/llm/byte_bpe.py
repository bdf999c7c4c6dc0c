"""Byte-level BPE ids of many texts, by the rules of a public ``tokenizers`` file.

Texts of common characters are cut into pre-tokens by array operations, and each distinct pre-token
of a block is encoded once (its merges are applied in rank order, which is what the file's model
does).  Any other text goes through the ``tokenizers`` library whole.  Both give the same ids."""
from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import lru_cache

import numpy as np

from cytospark.llm import textops

BLOCK_CHARS = 1 << 19
CACHE_ENTRIES = 1 << 18

# The pre-token pattern of the byte-level family.  _starts() follows it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_COMMON = re.compile("[\t\n\r -~¡-ſ]*")
_LETTER, _NUMBER, _SPACE, _OTHER, _END = 0, 1, 2, 3, 4
_N = 0x180


def _classes() -> np.ndarray:
    import regex
    kinds = np.full(_N, _OTHER, dtype=np.int8)
    for cp in range(_N):
        ch = chr(cp)
        if regex.fullmatch(r"\p{L}", ch):
            kinds[cp] = _LETTER
        elif regex.fullmatch(r"\p{N}", ch):
            kinds[cp] = _NUMBER
        elif regex.fullmatch(r"\s", ch):
            kinds[cp] = _SPACE
    kinds[0] = _END
    return kinds


_KIND = _classes()
_rng = np.random.Generator(np.random.PCG64(977))
_CODE = _rng.integers(0, 2**64, _N, dtype=np.uint64) | np.uint64(1)


def _starts(cps: np.ndarray) -> np.ndarray:
    """Positions where a pre-token starts.  Texts end with code point 0, a pre-token of its own."""
    kind = _KIND[cps]
    n = len(cps)
    start = np.ones(n + 3, dtype=bool)
    start[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == _END)
    # Of white space before something else, the last character stands apart; a blank goes with what follows.
    after = np.flatnonzero((kind[1:] != _SPACE) & (kind[1:] != _END) & (kind[:-1] == _SPACE)) + 1
    start[after - 1] = True
    start[after[cps[after - 1] == 0x20]] = False
    # Contractions: an apostrophe that starts a pre-token, and the letters it takes along.
    at = np.flatnonzero((cps[:-2] == 0x27) & start[:n - 2])
    one = np.isin(cps[at + 1], [ord(c) for c in "stmd"])
    two = np.zeros(len(at), dtype=bool)
    for pair in ("re", "ve", "ll"):
        two |= (cps[at + 1] == ord(pair[0])) & (cps[at + 2] == ord(pair[1]))
    for taken, size in ((one, 1), (two, 2)):
        start[at[taken] + 1] = False
        start[at[taken] + 1 + size] = True
    return np.flatnonzero(start[:n])


class Encoder:
    """Ids of texts by the tokenizer file at ``path``; special strings are handled as the library does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        ranks = self._ranks(spec)
        self.core = None
        if ranks:
            import tiktoken
            self.core = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._forget()

    def _forget(self) -> None:
        """What has been encoded: sorted hashes of pre-tokens, and for each the number and place of its ids."""
        self.keys = np.zeros(0, dtype=np.uint64)
        self.sizes = np.zeros(0, dtype=np.uint32)
        self.places = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(1 << 18, dtype="<u4")
        self.used = 0

    @staticmethod
    def _ranks(spec: dict) -> dict[bytes, int] | None:
        """Ids by byte string, if the model is plain byte-level BPE whose n-th merge makes the n-th id
        after the bytes; then merging by rank is merging by id."""
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex"), model.get("type")) != ("ByteLevel", False, True, "BPE"):
            return None
        if spec.get("normalizer") or model.get("dropout") or model.get("ignore_merges"):
            return None
        # The printable stand-ins of the bytes: bytes that print stand for themselves, the others follow from 256 on.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}
        vocab = model["vocab"]
        for i, merge in enumerate(model["merges"]):
            if vocab.get("".join(merge.split(" ") if isinstance(merge, str) else merge)) != 256 + i:
                return None
        return {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if all(c in byte_of for c in token)}

    def _common(self, text: str) -> bool:
        return self.core is not None and _COMMON.fullmatch(text) is not None and not any(s in text for s in self.special)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        out: list[np.ndarray | None] = [None] * len(texts)
        fast = [i for i, t in enumerate(texts) if self._common(t)]
        for a, b in textops.groups([len(texts[i]) for i in fast], BLOCK_CHARS):
            group = fast[a:b]
            if len(group) == 1 and len(texts[group[0]]) > 2 * BLOCK_CHARS:
                out[group[0]] = np.concatenate([self._block([p])[0] for p in _cut(texts[group[0]])])
            else:
                for i, ids in zip(group, self._block([texts[i] for i in group])):
                    out[i] = ids
        slow = [i for i, x in enumerate(out) if x is None]
        for a, b in textops.groups([len(texts[i]) for i in slow], BLOCK_CHARS):
            for i, e in zip(slow[a:b], self.library.encode_batch([texts[i] for i in slow[a:b]], add_special_tokens=False)):
                out[i] = np.array(e.ids, dtype="<u4")
        return out

    def _block(self, texts: list[str]) -> list[np.ndarray]:
        joined = "\0".join(texts) + "\0"
        cps = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        starts = _starts(cps)
        ends = np.append(starts[1:], len(cps))
        up, down = textops._power_table(len(cps) + 1)
        sums = np.zeros(len(cps) + 1, dtype=np.uint64)
        np.cumsum(_CODE[cps] * up[:len(cps)], out=sums[1:])
        keys = textops.mix((sums[ends] - sums[starts]) * down[starts])
        uniq, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        index = self._lookup(joined, uniq, starts[first], ends[first])[inverse]
        sizes = self.sizes[index].astype(np.int64)
        stops = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.places[index] - (stops - sizes), sizes) + np.arange(stops[-1])]
        # The end marks have no ids, so the texts' ids lie between them without gaps.
        marks = stops[np.flatnonzero(cps[starts] == 0)]
        return np.split(ids, marks[:-1])

    def _lookup(self, joined: str, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of the (sorted) keys in the tables, after new pre-tokens have been encoded."""
        if len(self.keys) > CACHE_ENTRIES:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), dtype=bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        encode = self.core._encode_single_piece
        found = [encode(token) if (token := joined[s:e]) != "\0" else []
                 for s, e in zip(starts[new].tolist(), ends[new].tolist())]
        sizes = np.array([len(x) for x in found], dtype=np.uint32)
        total = int(sizes.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + total] = [i for x in found for i in x]
        places = self.used + np.cumsum(sizes, dtype=np.int64) - sizes
        self.used += total
        self.sizes = np.insert(self.sizes, at[new], sizes)
        self.places = np.insert(self.places, at[new], places)
        self.keys = np.insert(self.keys, at[new], keys[new])
        return np.searchsorted(self.keys, keys)


def _cut(text: str):
    """Cut a long text before white space that follows something else: no pre-token spans that place."""
    gap, at = re.compile(r"(?<=[^\t\n\r ])[\t\n\r ]"), 0
    while at < len(text):
        hit = gap.search(text, at + BLOCK_CHARS)
        end = hit.start() if hit else len(text)
        yield text[at:end]
        at = end


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process, so that tasks share what it has encoded."""
    return Encoder(path)
