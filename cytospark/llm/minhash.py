"""MinHash near-duplicates by a signature-coordinate inverted join (operator 13).

A document's set holds its distinct word shingles; its signature holds, for each of ``COORDINATES`` hash functions,
the least hash of the set.  Documents with equal sets are one node, so copies never make pairs.

*Posting.*  Every node is posted under each (coordinate, value) pair of its signature.  Pairs that one node alone has
cannot collide and go.  A node with fewer than ``MATCHES`` pairs left has no partner.

*Prefix and skip.*  Two nodes that agree in ``MATCHES`` coordinates share one of the rarest
``left - MATCHES + 1`` pairs of each, in the common order of all pairs by rarity.  Only those lists are merged; the
``MATCHES - 1`` commonest pairs of a node are skipped, and their collisions are counted by looking into the partner's
signature.  Pairs whose sizes rule the similarity out, and pairs that a list has joined already, are not counted.
Lists beyond ``LIST_ROWS`` are compared block by block.  A list returns no pairs but the links that join its members
(a forest), which are merged to candidate groups: two documents above the match threshold are always in one group.

*Confirmation.*  Within a candidate group the full shingle sets are compared (again in bounded blocks, by counting
common shingles), and again only links that join something new are returned.  A link counts if
``100 * intersection >= THRESHOLD * union``.

The threshold of matches is set so far below the similarity that a pair just similar enough is missed with a
probability of 1.2e-6 (binomial with 40 draws); a more similar one with less.  Shingles are compared by 64-bit hashes
and sets by 128-bit digests.

Defined results: a null, empty or wordless text has no shingles and is linked with nothing; fewer words than a shingle
has make one shingle of all; a document with a null id gets the component of the ids that it reaches (null if none has
one), and counts as kept only in the latter case; repeated rows all get a row; an empty table gives an empty result;
other columns are not read, whatever their names."""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytospark.llm import textops
from cytospark.llm.common import join_classes
from cytospark.llm.simhash import components
from cytospark.session import cut_lineage

SHINGLE_WORDS = 3
THRESHOLD = 85
COORDINATES = 40
MATCHES = 22
# Nodes of a posting list that one task compares; longer lists are compared block by block.
LIST_ROWS = 2048
# Documents and shingles of a candidate group that one task compares with as many others.
GROUP_ROWS = 2048
GROUP_SHINGLES = 1 << 20
_BLOCK = 1 << 16

_rng = np.random.Generator(np.random.PCG64(13))
_MUL = _rng.integers(0, 2**64, COORDINATES, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 2**64, COORDINATES, dtype=np.uint64)
_PLACE = _rng.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: bytes, n: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct hashes of the text's word shingles."""
    _, words = textops.word_hashes([text.lower()])
    if len(words) == 0:
        return words
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total += words[k:len(words) - width + 1 + k] * _PLACE[k]
    return np.unique(textops.mix(total))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``COORDINATES`` 32-bit values per non-empty set: the upper halves of the least hashes."""
    out = np.empty((len(sets), COORDINATES), dtype=np.uint32)
    for first, end in textops.groups([len(s) for s in sets], _BLOCK):
        flat = np.concatenate(sets[first:end])
        starts = np.cumsum([0] + [len(s) for s in sets[first:end - 1]])
        for k in range(COORDINATES):
            out[first:end, k] = np.minimum.reduceat(flat * _MUL[k] + _ADD[k], starts) >> np.uint64(32)
    return out


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, text_hash, node, n, sig)`` per document; ``node`` is the digest of its set and null where that is empty."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.small(batches):
            sets = [shingle_set(t, shingle_words) if t else np.zeros(0, np.uint64)
                    for t in batch.column(2).cast(pa.binary()).to_pylist()]
            full = [s for s in sets if len(s)]
            rows = iter(signatures(full).view(np.int32).tolist()) if full else iter(())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int32()))],
                names=["doc_id", "text_hash", "node", "n", "sig"])
    return src.mapInArrow(run, f"doc_id {kind}, text_hash long, node binary, n long, sig array<int>")


def prefix_lists(nodes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """``(node, posting)``: every node under the rarest postings that a partner must share one of."""
    posts = nodes.select("node", F.posexplode("sig").alias("at", "value")).select(
        "node", F.call_function("shiftleft", F.col("at").cast("long"), F.lit(32)).bitwiseOR(
            F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("posting"))
    shared = posts.groupBy("posting").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    held = posts.join(shared, "posting").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("f", "posting"))).alias("held"))
    left = F.size("held") - (matches - 1)
    return held.where(left > 0).select("node", F.explode(F.slice("held", F.lit(1), left)).alias("p")).select("node", "p.posting")


def in_blocks(rows: DataFrame, key: str, blocks: Column, split_by: str) -> DataFrame:
    """Deal the members of every group over ``blocks`` parts and send each pair of parts to one place: adds ``bi`` <= ``bj``
    and ``part``.  A group of one block is compared in itself only."""
    part = F.pmod(F.xxhash64(split_by, F.lit("block")), F.col("_blocks")).cast("int")
    rows = rows.withColumn("_blocks", blocks.cast("int")).withColumn("part", part)
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.withColumn("bi", F.least("part", "_other")).withColumn("bj", F.greatest("part", "_other")).drop("_blocks", "_other")
    return rows.repartition(key, "bi", "bj").sortWithinPartitions(key, "bi", "bj")


def over_runs(df: DataFrame, key: list[str], work: Callable, schema: str) -> DataFrame:
    """``work(table)`` for every run of rows with equal ``key`` in sorted partitions; it gives two lists of nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        a: list = []
        b: list = []

        def close() -> None:
            x, y = work(pa.Table.from_batches(held))
            a.extend(x)
            b.extend(y)
        for batch in batches:
            keys = list(zip(*[batch.column(batch.schema.get_field_index(k)).to_pylist() for k in key]))
            start = 0
            while start < len(keys):
                end = start + 1
                while end < len(keys) and keys[end] == keys[start]:
                    end += 1
                if held and keys[start] != last:
                    close()
                    held.clear()
                held.append(batch.slice(start, end - start))
                last, start = keys[start], end
            if len(a) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
                a.clear()
                b.clear()
        if held:
            close()
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
    return df.mapInArrow(run, schema)


class Joined:
    """Members of a run and which of them hang together already."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def apart(self, one: int, others: np.ndarray) -> np.ndarray:
        return others[self.label[others] != self.label[one]]

    def link(self, one: int, hits: np.ndarray) -> None:
        """Join ``one`` with ``hits``, noting a link to one member of each part."""
        if len(hits):
            roots, first = np.unique(self.label[hits], return_index=True)
            self.links += [(one, int(h)) for h in hits[first]]
            self.label[np.isin(self.label, roots)] = self.label[one]


def _partners(part: np.ndarray, same: bool, one: int, order: np.ndarray) -> np.ndarray:
    """Of ``order`` (members after ``one``) those it is compared with: all within a block, else the other block's."""
    return order if same else order[part[order] != part[one]]


def _match_run(table: pa.Table, matches: int, threshold: int) -> tuple[list, list]:
    m = table.num_rows
    if m < 2:
        return [], []
    node = table.column("node").to_pylist()
    n = table.column("n").to_numpy()
    sig = np.concatenate([c.flatten().to_numpy() for c in table.column("sig").chunks]).reshape(m, -1)
    part, same = table.column("part").to_numpy(), table.column("bi")[0].as_py() == table.column("bj")[0].as_py()
    joined, everyone = Joined(m), np.arange(m)
    for one in range(m - 1):
        rest = joined.apart(one, _partners(part, same, one, everyone[one + 1:]))
        if len(rest):
            rest = rest[(100 * n[rest] >= threshold * n[one]) & (100 * n[one] >= threshold * n[rest])]
            joined.link(one, rest[(sig[rest] == sig[one]).sum(axis=1) >= matches])
    return [node[a] for a, _ in joined.links], [node[b] for _, b in joined.links]


def match_links(nodes: DataFrame, matches: int = MATCHES, threshold: int = THRESHOLD, list_rows: int = LIST_ROWS) -> DataFrame:
    """Pairs ``(a, b)`` of nodes that agree in ``matches`` coordinates; every such pair is joined by these links, if not
    itself among them."""
    lists = cut_lineage(prefix_lists(nodes, matches))
    sizes = lists.groupBy("posting").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = lists.join(sizes, "posting").join(nodes.select("node", "n", "sig"), "node")
    dealt = in_blocks(rows, "posting", F.ceil(F.col("size") / list_rows), "node").select("posting", "bi", "bj", "part", "node", "n", "sig")
    return over_runs(dealt, ["posting", "bi", "bj"], lambda t: _match_run(t, matches, threshold), "a binary, b binary").distinct()


def _confirm_run(table: pa.Table, threshold: int) -> tuple[list, list]:
    m = table.num_rows
    if m < 2:
        return [], []
    size = table.column("n").to_numpy()
    order = np.argsort(size, kind="stable")
    node = table.column("node").to_pylist()
    bodies = table.column("shingles").to_pylist()
    sets = [np.frombuffer(bodies[i], dtype=np.uint64) for i in order]
    n = size[order]
    part, same = table.column("part").to_numpy()[order], table.column("bi")[0].as_py() == table.column("bj")[0].as_py()
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum(n)
    starts = ends - n
    inside = np.zeros(int(ids.max()) + 1, dtype=bool)
    joined, everyone = Joined(m), np.arange(m)
    for one in range(m - 1):
        # Sizes ascend: partners end where the smaller set cannot fill the share of the larger any more.
        last = int(np.searchsorted(n, 100 * n[one] // threshold, side="right"))
        rest = joined.apart(one, _partners(part, same, one, everyone[one + 1:last]))
        if not len(rest):
            continue
        mine = ids[starts[one]:ends[one]]
        inside[mine] = True
        flat = np.concatenate([ids[starts[r]:ends[r]] for r in rest])
        common = np.add.reduceat(inside[flat], np.cumsum(n[rest]) - n[rest], dtype=np.int64)
        inside[mine] = False
        joined.link(one, rest[100 * common >= threshold * (n[one] + n[rest] - common)])
    return [node[order[a]] for a, _ in joined.links], [node[order[b]] for _, b in joined.links]


def confirmed_links(groups: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle_words: int, threshold: int = THRESHOLD,
                    group_rows: int = GROUP_ROWS, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """Links ``(a, b)`` by the full sets.  ``groups``: ``node, n, doc_id, text_hash, rep`` (a row that has the node's set)."""
    texts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("_text"))
    one = texts.join(groups, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash"))) \
        .groupBy("rep", "node", "n").agg(F.first("_text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.small(batches, 64):
            made = [shingle_set(t, shingle_words).tobytes() for t in batch.column(3).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.large_binary()).cast(pa.binary())],
                                             names=["rep", "node", "n", "shingles"])
    sets = cut_lineage(one.mapInArrow(run, "rep binary, node binary, n long, shingles binary"))
    sizes = sets.groupBy("rep").agg(F.greatest(F.ceil(F.count(F.lit(1)) / group_rows), F.ceil(F.sum("n") / group_shingles)).alias("_size"))
    dealt = in_blocks(sets.join(sizes, "rep"), "rep", F.col("_size"), "node").select("rep", "bi", "bj", "part", "node", "n", "shingles")
    return over_runs(dealt, ["rep", "bi", "bj"], lambda t: _confirm_run(t, threshold), "a binary, b binary").distinct()


def minhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
                       threshold: int = THRESHOLD, matches: int = MATCHES) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (the least id that it reaches) and ``kept``."""
    rows = cut_lineage(marked(docs, id_col, text_col, shingle_words))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("at")
    nodes = cut_lineage(rows.where("n > 0").groupBy("node").agg(
        first, F.first("n").alias("n"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("rows")))
    near = cut_lineage(match_links(nodes, matches, threshold))
    groups = cut_lineage(components(near).join(nodes.select("node", "n", "at.doc_id", "at.text_hash"), "node"))
    links = cut_lineage(confirmed_links(groups, docs, id_col, text_col, shingle_words, threshold))
    classes = nodes.select("node", "rows", F.col("at.doc_id").alias("least")).join(components(links), "node", "left") \
        .withColumn("rep", F.coalesce("rep", "node"))
    least = classes.groupBy("rep").agg(F.min("least").alias("component_id"))
    classes = cut_lineage(classes.join(least, "rep").select("node", "rows", "component_id"))
    linked = join_classes(rows.where("n > 0").select("doc_id", "n", "node"), classes, "node", "rows")
    alone = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "n", "component_id").unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
