"""Nearest neighbours by a forest of hash prefixes.

Every vector gets one long hash string per tree (signs of random projections); a tree is the sorted array of its strings. A
query descends in all trees to the nodes of its longest matching prefixes, then ascends in all of them together, a bit at a
time, until the nodes hold enough candidates, which are ranked by exact distance.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Trees and bits of a hash string.
TREES, HASH_BITS = 64, 32
#: Candidates of a query, as a share of the vectors of a shard. Without clusters in the data, near vectors share short prefixes
#: only, and recall follows this share.
CANDIDATE_SHARE = 0.65
#: Vectors of a shard and queries of a block, on average; a task holds one of each.
SHARD_ROWS, QUERY_ROWS = 16_384, 4_096
SEED = 11


class Forest:
    """Sorted hash strings of some vectors, one array per tree."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.center = vectors.mean(axis=0)
        self.planes = [rng.standard_normal((vectors.shape[1], HASH_BITS)) for _ in range(trees)]
        codes = [self._codes(vectors, plane) for plane in self.planes]
        self.order = [np.argsort(c, kind="stable") for c in codes]
        self.sorted = [c[o] for c, o in zip(codes, self.order)]
        self.rows = len(vectors)

    def _codes(self, vectors: np.ndarray, plane: np.ndarray) -> np.ndarray:
        bits = (vectors - self.center) @ plane > 0
        return bits @ (np.uint64(1) << np.arange(HASH_BITS - 1, -1, -1, dtype=np.uint64))

    def candidates(self, queries: np.ndarray, wanted: int):
        """For each query the positions of at least ``wanted`` vectors (all, if fewer)."""
        levels = np.arange(HASH_BITS + 1, dtype=np.uint64)
        drop = np.uint64(HASH_BITS) - levels
        low, high = [], []
        for plane, codes in zip(self.planes, self.sorted):
            prefix = self._codes(queries, plane)[:, None] >> drop
            low.append(np.searchsorted(codes, prefix << drop))
            high.append(np.searchsorted(codes, (prefix + np.uint64(1)) << drop))
        low, high = np.stack(low, axis=2), np.stack(high, axis=2)  # query, level, tree
        held = (high - low).sum(axis=2)
        for q in range(len(queries)):
            # Nodes overlap, so the level where their sizes add up to enough is the deepest that can do.
            level = int(np.flatnonzero(held[q] >= min(wanted, self.rows))[-1])
            while True:
                found = np.zeros(self.rows, bool)
                for tree, (a, b) in enumerate(zip(low[q, level], high[q, level])):
                    found[self.order[tree][a:b]] = True
                if level == 0 or found.sum() >= wanted:
                    break
                level -= 1
            yield np.flatnonzero(found)


def _search(k: int, trees: int, share: float):
    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asked):
            rows, asked = rows.sort_values("id", kind="stable"), asked.sort_values("id", kind="stable")
            ids, vectors = rows["id"].to_numpy(), np.stack(rows["vector"].to_list()).astype(np.float64)
            queries = np.stack(asked["vector"].to_list()).astype(np.float64)
            forest = Forest(vectors, trees)
            wanted = max(k + 1, int(np.ceil(share * len(ids))))
            for qid, query, found in zip(asked["id"], queries, forest.candidates(queries, wanted)):
                found = found[ids[found] != qid]
                apart = np.sqrt(((vectors[found] - query) ** 2).sum(axis=1))
                if len(found) > k:
                    near = apart <= np.partition(apart, k - 1)[k - 1]
                    found, apart = found[near], apart[near]
                best = np.lexsort((ids[found], apart))[:k]
                out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[found[best]], "score": apart[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})

    return search


def _usable(vector: Column) -> Column:
    """Not null, not zero, every component finite."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & ok & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    trees: int = TREES,
    share: float = CANDIDATE_SHARE,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The ``k`` nearest found of each query: query_id, rank (from 1), vec_id, score (Euclidean distance in double precision).

    Both tables have vec_id and embedding. Every usable vector is indexed: shards by a hash of the id hold a forest each, every
    block of queries meets every shard, and the best of all shards are merged, nearest first, ties to the smaller id. So a task
    holds one shard and one block whatever the sizes, and no group of equal vectors meets in one. Null, zero and non-finite
    vectors and rows without an id take no part; vectors of another length than the query's are no candidates; of rows that
    repeat an id the nearest counts, and a query never finds its own id. A repeated query id is asked once, with its least
    vector.
    """
    vector = F.col("embedding").cast("array<double>")
    held = vectors.select(F.col("vec_id").cast("bigint").alias("id"), vector.alias("vector")).filter("id IS NOT NULL").filter(_usable(F.col("vector")))
    asked = queries.select(F.col("vec_id").cast("bigint").alias("id"), vector.alias("vector")).filter("id IS NOT NULL").filter(_usable(F.col("vector")))
    asked = asked.groupBy("id").agg(F.min("vector").alias("vector"))
    shards = max(1, -(-held.count() // shard_rows))
    blocks = max(1, -(-asked.count() // query_rows))

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dims = F.size("vector").alias("dims")
    left = held.select("id", "vector", dims, F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), numbers(blocks).alias("block"))
    right = asked.select("id", "vector", dims, F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), numbers(shards).alias("shard"))
    keys = ["dims", "shard", "block"]
    schema = "query_id bigint, vec_id bigint, score double"
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search(k, trees, share), schema)
    each = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
