"""Approximate nearest neighbours with a forest of sorted hash prefixes.

Rows are dealt to shards of a bounded number of rows. In a shard every tree is a sorted
array of 64-bit hash strings: signs of random projections about the shard's mean. A query
descends in each tree, by binary search, to its longest matching prefix, and then all trees
ascend together, one bit at a time, so that the candidates are the rows that share a prefix
of the present length in any tree; it stops at the first length that gives the asked share
of the shard's rows as different candidates. Candidates are ranked by exact Euclidean
distance, and a query's best of all shards are its result.

How many candidates the wanted recall needs depends on the vectors: on directions without
any structure (where the tenth neighbour is nearly as far as the mean row) about half of
the rows; on clustered ones a far smaller ``share`` does. Queries meet shards in blocks,
and a block sends on ``k`` rows a query and shard.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
take no part as query or candidate; vectors of different length are never compared; rows
with the query's id are not its candidates; equal rows of one id are one query; an empty
table, or no query, gives no rows; ties go to the smaller vec_id."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import plain_columns

#: Rows of a shard, queries of a block, trees, share of a shard's rows looked at exactly.
SHARD_ROWS, BLOCK_QUERIES, TREES, SHARE = 16_384, 4_096, 48, 0.6
_U = np.uint64


def _valid(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _prefix(x: np.ndarray) -> np.ndarray:
    """Leading zero bits."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x | (x >> _U(s))
    return 64 - np.bitwise_count(x).astype(np.int64)


class Forest:
    def __init__(self, rows: np.ndarray, trees: int, seed: int):
        self.rows = rows
        self.mean = rows.mean(axis=0)
        self.planes = np.random.default_rng(seed).standard_normal((rows.shape[1], trees * 64))
        self.trees = trees
        codes = self.codes(rows)
        self.order = [np.argsort(codes[:, t], kind="stable") for t in range(trees)]
        self.sorted = [codes[self.order[t], t] for t in range(trees)]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty((len(vectors), self.trees), _U)
        for i in range(0, len(vectors), 1024):
            bits = (vectors[i:i + 1024] - self.mean) @ self.planes > 0
            out[i:i + 1024] = np.packbits(bits.reshape(-1, self.trees, 64), axis=2).view(">u8")[:, :, 0]
        return out

    def candidates(self, queries: np.ndarray, least: int):
        """For each query (its number and) the rows found once ``least`` different ones are."""
        codes = self.codes(queries)
        n = len(self.rows)
        depth = np.zeros(codes.shape, np.int64)
        for t, array in enumerate(self.sorted):
            at = np.searchsorted(array, codes[:, t])
            left = _prefix(array[np.maximum(at - 1, 0)] ^ codes[:, t])
            right = _prefix(array[np.minimum(at, n - 1)] ^ codes[:, t])
            depth[:, t] = np.maximum(left, right)
        level = depth.max(axis=1)
        waiting = np.arange(len(queries))
        low, high = np.zeros(codes.shape, np.int64), np.zeros(codes.shape, np.int64)
        while len(waiting):
            x = level[waiting]
            keep = np.where(x == 0, 0, ~_U(0) << (_U(64) - np.maximum(x, 1).astype(_U))).astype(_U)
            for t, array in enumerate(self.sorted):
                first = codes[waiting, t] & keep
                low[waiting, t] = np.searchsorted(array, first, side="left")
                high[waiting, t] = np.searchsorted(array, first | ~keep, side="right")
            found = (high[waiting] - low[waiting]).sum(axis=1)
            still = []
            for q, total in zip(waiting.tolist(), found.tolist()):
                if total >= least or not level[q]:
                    seen = np.zeros(n, bool)
                    for t in range(self.trees):
                        seen[self.order[t][low[q, t]:high[q, t]]] = True
                    rows = np.flatnonzero(seen)
                    if len(rows) >= least or not level[q]:
                        yield q, rows
                        continue
                level[q] -= 1
                still.append(q)
            waiting = np.array(still, np.int64)


def search(vectors: DataFrame, asked: Column, k: int = 10, trees: int = TREES, share: float = SHARE,
           shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES, seed: int = 7) -> DataFrame:
    """``vectors`` (vec_id, embedding) and the condition ``asked`` on vec_id -> query_id,
    rank, vec_id, score: the ``k`` nearest found of each asked row."""
    frame = plain_columns(vectors, "vec_id", "embedding").withColumn("embedding", F.col("embedding").cast("array<double>"))
    frame = frame.where(F.col("vec_id").isNotNull() & _valid(F.col("embedding"))).withColumn("size", F.size("embedding"))
    queries = frame.where(asked).dropDuplicates(["vec_id", "embedding"])
    shards = max(1, math.ceil(frame.count() / shard_rows))
    blocks = max(1, math.ceil(queries.count() / block_queries))
    every = frame.select("size", F.expr(f"pmod(xxhash64(vec_id), {shards})").alias("shard"),
                         F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "embedding")
    asking = queries.select("size", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                            F.expr(f"cast(pmod(xxhash64(vec_id, 1), {blocks}) as int)").alias("block"),
                            F.col("vec_id").alias("q_id"), F.xxhash64("embedding").alias("q_key"), F.col("embedding").alias("q_point"))

    def meet(rows: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(questions):
            ids, points = rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_numpy())
            keys = questions["q_key"].to_numpy()
            q_ids, q_points = questions["q_id"].to_numpy(), np.stack(questions["q_point"].to_numpy())
            forest = Forest(points, trees, seed)
            for q, found in forest.candidates(q_points, min(len(ids), math.ceil(share * len(ids)) + k)):
                found = found[ids[found] != q_ids[q]]
                if not len(found):
                    continue
                away = np.sqrt(((points[found] - q_points[q]) ** 2).sum(axis=1))
                if len(found) > k:
                    near = away <= np.partition(away, k - 1)[k - 1]
                    found, away = found[near], away[near]
                best = np.lexsort((ids[found], away))[:k]
                out.append(pd.DataFrame({"query_id": q_ids[q], "key": keys[q], "vec_id": ids[found[best]], "score": away[best]}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "key", "vec_id", "score")})

    near = (every.groupBy("size", "shard", "block").cogroup(asking.groupBy("size", "shard", "block"))
            .applyInPandas(meet, "query_id long, key long, vec_id long, score double"))
    order = Window.partitionBy("query_id", "key").orderBy("score", "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
