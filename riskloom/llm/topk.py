"""Exact top-k by inner product over KD-trees, one tree per shard.

Components become integers, floor(scale * x), so scores are exact and ties are real. Rows
are dealt into shards by a hash of their id and queries into blocks; every block meets
every shard (a stated query set against all rows, in blocks). A shard collapses equal
vectors, with the ids of each in order, splits at the median of the widest
dimension down to ``LEAF`` vectors, and keeps tight bounding boxes. A query walks the
nodes best first, by the bound of its inner product with any point of the box,
sum(max(q * low, q * high)), and stops when the bound is under its kth best score so far.

The kth score is propagated: each query first searches the shard of its own hash, and takes
the kth score found there into the search of all others. Bounds that equal the kth score
are still opened, since a smaller id wins a tie.

Defined cases: vectors that are null or hold null or non-finite components take no part;
shorter vectors are as if zeros followed; rows with equal ids are rows of their own, but a
query leaves out all rows with its id; null ids take no part; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialise

LEAF = 64
EXACT = 2**53


class Tree:
    """Distinct integer vectors of a shard in median-split order, with boxes."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids, *vectors.T[::-1]))
        vectors, ids = vectors[order], ids[order]
        new = np.ones(len(ids), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(1)
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(ids)))
        self.ids = [ids[a : a + n] for a, n in zip(head, size, strict=True)]
        points = vectors[head]
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, int, int]] = []  # first, end, left child, right child
        low, high = [], []
        pending = [(0, len(points), -1, 0)]
        while pending:
            a, b, parent, side = pending.pop()
            at = len(self.nodes)
            self.nodes.append((a, b, -1, -1))
            if parent >= 0:
                x = self.nodes[parent]
                self.nodes[parent] = (x[0], x[1], at, x[3]) if side == 0 else (x[0], x[1], x[2], at)
            part = points[self.order[a:b]]
            low.append(part.min(0))
            high.append(part.max(0))
            if b - a > LEAF:
                d, mid = int((high[-1] - low[-1]).argmax()), (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(part[:, d], mid)]
                pending += [(a + mid, b, at, 1), (a, a + mid, at, 0)]
        self.points = points[self.order]
        self.ids = [self.ids[i] for i in self.order]
        self.low, self.high = np.array(low), np.array(high)

    def search(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """For each query up to k (score, id), best first; scores under its floor may lack."""
        limit = int(max(np.abs(queries).max(initial=0), 1)) * int(max(np.abs(self.points).max(initial=0), 1)) * max(1, queries.shape[1])
        kind = np.float64 if limit < EXACT else object
        q, points, low, high = (x.astype(kind) for x in (queries, self.points, self.low, self.high))
        zero = q * 0
        bound = np.maximum(q, zero) @ high.T + np.minimum(q, zero) @ low.T
        out = []
        for i in range(len(q)):
            best: list[tuple[int, int]] = []  # heap of (score, -id)
            kth = floor[i]
            nodes = [(-bound[i, 0], 0)]
            while nodes and (kth is None or -nodes[0][0] >= kth):
                _, n = heapq.heappop(nodes)
                a, b, left, right = self.nodes[n]
                if left >= 0:
                    for c in (left, right):
                        if kth is None or bound[i, c] >= kth:
                            heapq.heappush(nodes, (-bound[i, c], c))
                    continue
                score = points[a:b] @ q[i]
                for j in np.flatnonzero(score >= kth) if kth is not None else range(b - a):
                    s = int(score[j])
                    ids, at = self.ids[a + j], 0
                    while at < len(ids):
                        if ids[at] == own[i]:  # all rows of the query's id
                            at = int(ids.searchsorted(own[i], "right"))
                            continue
                        entry = (s, -int(ids[at]))
                        at += 1
                        if len(best) < k:
                            heapq.heappush(best, entry)
                        elif entry > best[0]:
                            heapq.heapreplace(best, entry)
                        else:
                            break  # ids rise
                if len(best) == k and (kth is None or best[0][0] > kth):
                    kth = best[0][0]
            out.append([(s, -x) for s, x in sorted(best, reverse=True)])
        return out


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _search(k: int):
    def run(key: tuple, points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if len(points) and len(queries):
            width = max(1, points["v"].map(len).max(), queries["v"].map(len).max())
            tree = Tree(_matrix(points["v"], width), points["id"].to_numpy(np.int64))
            floor = [None if pd.isna(x) else int(x) for x in queries["floor"]]
            for a in range(0, len(queries), 1024):
                part = queries.iloc[a : a + 1024]
                found = tree.search(_matrix(part["v"], width), part["id"].to_numpy(np.int64), floor[a : a + 1024], k)
                rows += [(u, q, x, s) for u, q, hits in zip(part["u"], part["id"], found, strict=True) for s, x in hits]
        return pd.DataFrame(rows, columns=["u", "query_id", "vec_id", "score"])

    return run


def top_k(rows: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256, shard_rows: int = 16_384, block_rows: int = 16_384) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``is_query`` (a column) picks, the k
    highest inner products with rows of another id, ties to the smaller id."""
    vector = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    fit = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    table = rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("v"), fit.alias("fit"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    table = table.where(F.col("fit") & F.col("id").isNotNull() & F.col("v").isNotNull()).drop("fit")
    counts = table.agg(F.count("*").alias("n"), F.count(F.when(F.col("asks"), 1)).alias("asks")).first()
    shards, blocks = max(1, -(-counts["n"] // shard_rows)), max(1, -(-counts["asks"] // block_rows))
    home = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    table = table.withColumn("home", home).withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
    queries = materialise(table.where("asks").select(F.monotonically_increasing_id().alias("u"), "id", "v", "home", "block"), "queries")
    points = table.select("id", "v", F.col("home").alias("shard"))
    schema = "u long, query_id long, vec_id long, score long"

    def meet(asked: DataFrame) -> DataFrame:
        every = points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return every.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(_search(k), schema)

    near = meet(queries.select("u", "id", "v", F.col("home").alias("shard"), "block", F.lit(None).cast("long").alias("floor")))
    near = materialise(near, "near")
    if shards > 1:
        floors = near.groupBy("u").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
        others = queries.join(floors, "u", "left").select("u", "id", "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "block", "floor", "home").where("shard <> home").drop("home")
        near = near.union(meet(others))
    order = Window.partitionBy("u").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
