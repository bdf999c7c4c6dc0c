"""Approximate nearest neighbours by one navigable small-world graph per shard (operator 6).

Vectors of one direction are one node that keeps the k+1 smallest ids, which is all that a list of k neighbours can
show of them: a vector is divided by its largest component's size, which gives the same numbers for all multiples of
it, and the cosine of the smallest id counts for all, so that they tie to the bit.  Nodes are dealt to shards of about ``shard_rows`` by a hash; a shard's graph is
built in one task and stored as flat arrays in a table.  Blocks of queries meet every shard's arrays,
the best found are measured exactly in double precision, and the shards' lists are merged.

Every query visits every shard, so on much larger tables ``shard_rows`` should grow with the memory of
an executor.  Measured recall is in the README; ``ef`` trades it against time.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no
part, nor do rows with a null id; of several vectors under one id the smallest in array order
counts; vectors of different length are never neighbours; a query with fewer than k candidates gets
them all that were found; an empty table gives an empty result."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytospark.llm.hnsw_index import Graph
from cytospark.session import cut_lineage

SHARD_ROWS = 16_384
QUERY_BLOCK = 32_768
EF = 96


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, v)``: one finite, non-zero vector per id."""
    v = F.col(vector_col).cast("array<double>")
    src = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & (F.size("v") > 0))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return src.where(fine).groupBy("vec_id").agg(F.min("v").alias("v"))


def with_direction(rows: DataFrame) -> DataFrame:
    """``rows`` (vec_id, v) with ``way``, a 128-bit digest of the vector over its largest component's size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways = []
            for at in range(0, batch.num_rows, 512):
                part = batch.column(1).slice(at, 512)
                flat, size = part.flatten().to_numpy(), np.diff(part.offsets.to_numpy())
                start = np.cumsum(size) - size
                # Adding zero makes -0.0 the same number as 0.0.
                turned = flat / np.repeat(np.maximum.reduceat(np.abs(flat), start), size) + 0.0
                ways += [hashlib.blake2b(turned[s:s + n].tobytes(), digest_size=16).digest() for s, n in zip(start, size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ways, pa.binary())], names=["vec_id", "v", "way"])
    return rows.mapInArrow(run, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, v array<double>, way binary")


def build_index(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``dim, shard, graph (array<binary>), vectors (binary doubles), ids (array<array<long>>)`` per shard."""
    by_direction = Window.partitionBy("way").orderBy("vec_id")
    nodes = cut_lineage(with_direction(rows).withColumn("r", F.row_number().over(by_direction)).where(F.col("r") <= k + 1)
                        .groupBy("way").agg(F.min_by("v", "vec_id").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"), "v", "ids")

    def build(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        v = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        order = np.lexsort(v.T)
        v = np.ascontiguousarray(v[order])
        graph = Graph((v / _length(v)[:, None]).astype(np.float32))
        ids = group.column("ids").combine_chunks().take(pa.array(order))
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
                         "graph": pa.array([graph.pack()], pa.list_(pa.binary())),
                         "vectors": pa.array([v.astype("<f8").tobytes()], pa.binary()),
                         "ids": pa.array([ids.to_pylist()], pa.list_(pa.list_(pa.int64())))})
    return cut_lineage(dealt.groupBy("dim", "shard").applyInArrow(
        build, "dim int, shard int, graph array<binary>, vectors binary, ids array<array<bigint>>"))


def _length(v: np.ndarray) -> np.ndarray:
    """Lengths, safe from overflow and underflow of the squares."""
    top = np.abs(v).max(axis=1)
    return top * np.sqrt(np.einsum("ij,ij->i", v / top[:, None], v / top[:, None]))


def _exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosines in double precision of queries (n, d) and their candidates (n, c, d)."""
    q = q / _length(q)[:, None]
    v = v / _length(v.reshape(-1, v.shape[2])).reshape(v.shape[:2])[:, :, None]
    return np.einsum("nd,ncd->nc", q, v)


def search(index: DataFrame, queries: DataFrame, k: int, ef: int = EF, block_rows: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, vec_id, score`` of up to k candidates a query and shard.  ``queries``: (query_id, v)."""
    blocks = max(1, -(-queries.count() // block_rows))
    places = index.select(F.col("dim").alias("dim"), F.col("shard").alias("shard"))
    asked = queries.select("query_id", "v", F.size("v").alias("dim"),
                           F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"))
    asked = asked.join(F.broadcast(places), "dim") if places.count() < 100_000 else asked.join(places, "dim")
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def probe(key: tuple[pa.Scalar, ...], shard: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if shard.num_rows and asked.num_rows:
            dim = key[0].as_py()
            graph = Graph.unpack(shard.column("graph")[0].as_py())
            vectors = np.frombuffer(shard.column("vectors")[0].as_py(), "<f8").reshape(-1, dim)
            ids = shard.column("ids")[0].as_py()
            q = asked.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            q_ids = asked.column("query_id").to_pylist()
            found = graph.search((q / _length(q)[:, None]).astype(np.float32), 2 * k + 2, ef)
            for at in range(0, len(q), 1024):
                nodes = found[at:at + 1024]
                scores = _exact(q[at:at + 1024], vectors[np.maximum(nodes, 0)])
                for i, (row, sims) in enumerate(zip(nodes, scores)):
                    own = q_ids[at + i]
                    best = sorted((-s, x) for n, s in zip(row.tolist(), sims.tolist()) if n >= 0 for x in ids[n] if x != own)[:k]
                    out["query_id"] += [own] * len(best)
                    out["vec_id"] += [x for _, x in best]
                    out["score"] += [-s for s, _ in best]
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})
    keys = ["dim", "shard", "block"]
    return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(probe, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, query: str = "vec_id % 50 = 0", k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, ef: int = EF) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that meets ``query`` (over ``vec_id``) the k nearest
    other rows found, ties to the smaller id."""
    rows = cut_lineage(usable(vectors, id_col, vector_col))
    index = build_index(rows, k, shard_rows)
    found = search(index, rows.where(query).select(F.col("vec_id").alias("query_id"), "v"), k, ef)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
