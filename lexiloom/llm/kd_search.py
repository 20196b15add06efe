"""Exact top-k inner-product search: a KD-tree per shard of bounded size, searched by blocks of queries.

Vectors become integers, floor(scale * x).  Each shard is split at the median of its widest dimension down to
small leaves; every node keeps a tight bounding box.  The largest inner product a box allows is the sum of the
better of both ends per dimension, so nodes are visited best first, and the search of a query ends at the first
node that cannot reach its kth score.

A block of queries first searches one shard; the kth scores found there go with the block to all other shards,
which return only what can still be among the best.  Shards and blocks are bounded in rows, so a task holds one
of each; their number follows the table.  A stated query set meets all rows in blocks, and hits are at most k
per query and shard.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part; vectors of
different length do not meet; rows with the id of the query are the query's own; ties go to the smaller id;
fewer than k candidates give fewer rows; scores beyond a long are cut to its range; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.scratch import stored

SHARD_ROWS = 8192
BLOCK_ROWS = 2048
LEAF_ROWS = 128
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


class Tree:
    """Nodes as arrays: rows ``start`` to ``end``, children (-1 for a leaf), bounding boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.arange(len(ids))
        self.start, self.end, self.left, self.right = [], [], [], []
        low, high = [], []

        def grow(start: int, end: int) -> int:
            node = len(self.start)
            rows = vectors[order[start:end]]
            low.append(rows.min(axis=0))
            high.append(rows.max(axis=0))
            self.start.append(start)
            self.end.append(end)
            self.left.append(-1)
            self.right.append(-1)
            if end - start > LEAF_ROWS:
                axis = int((high[node] - low[node]).argmax())
                if high[node][axis] > low[node][axis]:
                    middle = (end - start) // 2
                    order[start:end] = order[start:end][np.argpartition(rows[:, axis], middle)]
                    self.left[node] = grow(start, start + middle)
                    self.right[node] = grow(start + middle, end)
            return node

        grow(0, len(ids))
        self.low, self.high = np.array(low), np.array(high)
        self.ids, self.vectors = ids[order], vectors[order]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> list[tuple]:
        """(query, id, score) of what can be among the k best of each query, given its kth score elsewhere."""
        largest = max(np.abs(self.vectors).max(initial=0), 1) * max(np.abs(queries).max(initial=0), 1)
        tree, low, high = self.vectors, self.low, self.high
        if largest * max(1, queries.shape[1]) >= EXACT:  # beyond exact doubles: whole numbers of any size
            tree, low, high, queries = (
                np.array([[int(x) for x in row] for row in part], object).reshape(part.shape)
                for part in (tree, low, high, queries)
            )
        zero = queries * 0
        bounds = np.maximum(queries, zero) @ high.T + np.minimum(queries, zero) @ low.T
        hits = []
        for q in range(len(query_ids)):
            bound, own = bounds[q], query_ids[q]
            best: list[tuple] = []  # heap of (score, -id), the worst first
            floor = floors[q]  # a kth score found elsewhere: lower ones are of no use
            waiting = [(-bound[0], 0)]
            while waiting:
                most, node = heapq.heappop(waiting)
                if -most < floor:
                    break
                if self.left[node] >= 0:
                    for child in (self.left[node], self.right[node]):
                        if bound[child] >= floor:
                            heapq.heappush(waiting, (-bound[child], child))
                    continue
                start, end = self.start[node], self.end[node]
                scores = tree[start:end] @ queries[q]
                for i in np.flatnonzero(scores >= floor):
                    if self.ids[start + i] == own:
                        continue
                    entry = (int(scores[i]), -int(self.ids[start + i]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                    if len(best) == k:
                        floor = max(floor, best[0][0])
            hits += [(int(own), -negative, min(max(score, -LONG - 1), LONG)) for score, negative in best]
        return hits


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``_id``, ``_v`` (whole numbers as doubles) and ``_dim`` of the vectors that take part."""
    v = F.col(f"`{vector}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return (
        df.filter(v.isNotNull() & (F.size(v) > 0))
        .filter(~bad)
        .select(
            F.col(f"`{key}`").alias("_id"),
            F.transform(v, lambda x: _floor(x.cast("double") * scale)).alias("_v"),
            F.size(v).alias("_dim"),
        )
    )


def _floor(x: Column) -> Column:
    """Floor that stays a double, also where a long is too small."""
    return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)


def top_k(
    df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best other rows of each row that ``queries`` marks."""
    rows = whole_vectors(df, key, vector, scale)
    asked = whole_vectors(df.filter(queries), key, vector, scale)
    n_rows, n_asked = rows.count(), asked.count()
    shards, blocks = max(1, -(-n_rows // SHARD_ROWS)), max(1, -(-n_asked // BLOCK_ROWS))
    rows = rows.withColumn("_shard", F.pmod(F.xxhash64(F.lit(1), "_id"), F.lit(shards)).cast("int"))
    asked = asked.withColumn("_block", F.pmod(F.xxhash64(F.lit(2), "_id"), F.lit(blocks)).cast("int"))
    first = F.pmod(F.col("_block"), F.lit(shards)).cast("int")
    # Integers have scores of any sign: no kth score is known at first.
    asked = asked.withColumn("_floor", F.lit(float("-inf")))

    def run(group, tree_rows: pd.DataFrame, query_rows: pd.DataFrame) -> pd.DataFrame:
        hits = []
        if len(tree_rows) and len(query_rows):
            tree = Tree(tree_rows["_id"].to_numpy(), np.stack(tree_rows["_v"].to_list()))
            vectors = np.stack(query_rows["_v"].to_list())
            hits = tree.search(query_rows["_id"].to_numpy(), vectors, query_rows["_floor"].to_numpy(), k)
        return pd.DataFrame(hits, columns=["query_id", "vec_id", "score"]).astype("int64")

    def search(shards_of_blocks: Column, blocks_of_shards: Column, asked: DataFrame) -> DataFrame:
        left = rows.withColumn("_block", F.explode(blocks_of_shards)).groupBy("_dim", "_block", "_shard")
        right = asked.withColumn("_shard", F.explode(shards_of_blocks)).groupBy("_dim", "_block", "_shard")
        return left.cogroup(right).applyInPandas(run, "query_id long, vec_id long, score long")

    every_block = F.sequence(F.lit(0), F.lit(blocks - 1))
    at_home = F.filter(every_block, lambda b: F.pmod(b, F.lit(shards)) == F.col("_shard"))
    found = stored(search(F.array(first), at_home, asked), "first_hits")
    kth = found.groupBy("query_id").agg(F.min("score").cast("double").alias("_kth"), F.count(F.lit(1)).alias("_c"))
    bounded = asked.join(kth, asked["_id"] == kth["query_id"], "left").select(
        "_id", "_v", "_dim", "_block", F.when(F.col("_c") >= k, F.col("_kth")).otherwise(F.col("_floor")).alias("_floor")
    )
    elsewhere = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != first)
    away = F.filter(every_block, lambda b: F.pmod(b, F.lit(shards)) != F.col("_shard"))
    hits = found.unionByName(search(elsewhere, away, bounded))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
