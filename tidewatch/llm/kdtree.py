"""Exact top-k by inner product of whole-number vectors, with a KD-tree per shard.

Vectors become floor(256 x) per component and are dealt evenly into shards. A shard's tree
splits at the median of its widest component; every node keeps the tight box of its vectors.
For a query, the largest inner product any point of a box can have bounds its node, nodes are
visited from the largest bound down, and the search of a shard ends when the bound falls
below the k-th best score so far. That score is carried from shard to shard. Queries are
taken in blocks, each block meets every shard once, and blocks are dealt over tasks together
with groups of shards; the k best of each group are merged at the end.

Vectors that are null or hold a null or non-finite component take no part; a shorter vector
counts as having zeros at its end; rows that repeat a query's id are the query's own; an
empty table gives no rows. Scores outside the range of a long are cut to its ends.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import kept, open_file, partitions_for, write_whole
from tidewatch.session import work_dir

LEAF = 128
SHARD_ROWS = 8192
QUERY_ROWS = 256
SHARD_GROUP = 16  # shards that pass the k-th score on
EXACT = 1 << 53


def usable(embedding: str = "embedding") -> Column:
    """Not null, and all components present and finite."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(embedding).isNotNull() & ~bad


def scaled(embedding: str = "embedding") -> Column:
    """floor(256 x) of every component as a whole double, which holds it exactly."""
    return F.transform(embedding, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("double"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, with zeros after shorter ones."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Tree:
    """Nodes in breadth-first order: children of i are 2i+1 and 2i+2; leaves are row ranges."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        depth = max(0, int(np.ceil(np.log2(max(1, len(ids)) / LEAF))))
        nodes = (2 << depth) - 1
        self.first, self.last = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        self.low, self.high = np.zeros((nodes, x.shape[1])), np.zeros((nodes, x.shape[1]))
        order = np.arange(len(ids))
        self.last[0] = len(ids)
        for i in range(nodes):
            a, b = self.first[i], self.last[i]
            rows = x[order[a:b]]
            if b > a:
                self.low[i], self.high[i] = rows.min(axis=0), rows.max(axis=0)
            if 2 * i + 2 < nodes:
                half = (b - a) // 2
                if b > a:
                    wide = int(np.argmax(self.high[i] - self.low[i]))
                    order[a:b] = order[a:b][np.argpartition(rows[:, wide], half)]
                self.first[2 * i + 1], self.last[2 * i + 1] = a, a + half
                self.first[2 * i + 2], self.last[2 * i + 2] = a + half, b
        self.ids, self.x = ids[order], x[order]

    def save(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: getattr(self, k) for k in ("first", "last", "low", "high", "ids", "x")})
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Tree:
        tree = cls.__new__(cls)
        tree.__dict__ = dict(np.load(io.BytesIO(raw)))
        return tree

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product of every query with a point of every node's box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def exact(self, queries: np.ndarray) -> bool:
        most = max(np.abs(self.low).max(initial=0), np.abs(self.high).max(initial=0))
        return float(most) * np.abs(queries).sum(axis=1).max(initial=0) < EXACT

    def search(self, own: int, query: np.ndarray, bounds: np.ndarray, exact: bool, k: int, best: list) -> None:
        """Improve ``best``, a heap of (score, -id) of at most k entries, from this shard."""
        inner = len(bounds) // 2
        heap = [(-bounds[0], 0)]
        slack = 0.0 if exact else 1e-9 * (1 + np.abs(bounds[0]))
        while heap:
            bound, i = heapq.heappop(heap)
            if len(best) == k and -bound + slack < best[0][0]:
                return
            if i < inner:
                heapq.heappush(heap, (-bounds[2 * i + 1], 2 * i + 1))
                heapq.heappush(heap, (-bounds[2 * i + 2], 2 * i + 2))
                continue
            a, b = self.first[i], self.last[i]
            ids = self.ids[a:b]
            if exact:
                scores = self.x[a:b] @ query
                least = best[0][0] if len(best) == k else -np.inf
                rows = np.flatnonzero(scores >= least)
                if len(rows) > 4 * k:  # the k best, and what ties with the k-th
                    cut = np.partition(scores[rows], len(rows) - k - 1)[len(rows) - k - 1]
                    rows = rows[scores[rows] >= cut]
                found = zip(scores[rows].tolist(), ids[rows].tolist())
            else:
                whole = [int(q) for q in query]
                found = ((sum(int(u) * v for u, v in zip(row, whole)), int(j)) for row, j in zip(self.x[a:b], ids))
            for score, j in found:
                if j == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (int(score), -j))
                elif (score, -j) > best[0]:
                    heapq.heapreplace(best, (int(score), -j))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each query row."""
    spark = vectors.sparkSession
    uri = work_dir(spark, "kdtrees")
    rows = vectors.where(usable() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled().alias("x"), F.coalesce(is_query, F.lit(False)).alias("asked")
    )
    size = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    n, width = size[0], size[1] or 0
    shards = max(1, -(-n // SHARD_ROWS))
    # Dealt by position, so that no id and no repeated vector can fill a shard.
    numbered = rows.withColumn("at", F.monotonically_increasing_id())
    dealt = numbered.withColumn("shard", F.pmod(F.xxhash64("at"), F.lit(shards)).cast("int"))

    def build(key, group):
        tree = Tree(group["vec_id"].to_numpy(), matrix(pa.ListArray.from_pandas(group["x"]), width) if width else np.zeros((len(group), 0)))
        write_whole(uri, f"tree-{key[0]:06d}.npz", [tree.save()])
        return pd_frame({"shard": [key[0]]})

    from pandas import DataFrame as pd_frame

    trees = kept(dealt.groupBy("shard").applyInPandas(build, "shard int"), "shards")
    groups = trees.select((F.col("shard") / SHARD_GROUP).cast("int").alias("g"), "shard").groupBy("g").agg(
        F.sort_array(F.collect_set("shard")).alias("shards")
    )
    asked = numbered.where("asked").select("vec_id", "x", "at")
    blocks_n = max(1, -(-asked.count() // QUERY_ROWS))
    blocks = asked.groupBy(F.pmod(F.xxhash64("at", F.lit("q")), F.lit(blocks_n)).cast("int").alias("block")).agg(
        F.collect_list(F.struct("vec_id", "x")).alias("queries")  # about QUERY_ROWS rows
    )
    # Blocks of queries against groups of shards: every pair is one unit of work.
    keyed = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit((shards - 1) // SHARD_GROUP))).alias("g"))
    work = keyed.join(groups, "g").select("queries", "shards").repartition(partitions_for(spark))

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                asked = batch.column(0)[i].values
                own = asked.field("vec_id").to_numpy()
                q = matrix(asked.field("x"), width) if width else np.zeros((len(own), 0))
                best: list[list] = [[] for _ in own]
                for shard in batch.column(1)[i].as_py():
                    with open_file(uri, f"tree-{shard:06d}.npz") as file:
                        tree = Tree.load(file.read())
                    bounds, exact = tree.bounds(q), tree.exact(q)
                    for j in range(len(own)):
                        tree.search(own[j], q[j], bounds[j], exact, k, best[j])
                clip = lambda v: max(-(1 << 63), min((1 << 63) - 1, v))
                out = [(o, -j, clip(s)) for o, b in zip(own.tolist(), best) for s, j in b]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in out], pa.int64()) for c in range(3)], names=["query_id", "vec_id", "score"]
                )

    found = work.mapInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
