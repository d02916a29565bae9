"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Each block of candidates has, per dimension, its components in falling order, cut into segments of equal quantised
value. A query weight times the distance of a segment from the dimension's least (for negative weights: greatest)
component is the segment's impact, never negative. Segments of all dimensions are processed by falling impact, adding
exact contributions to accumulators. A candidate can be in the result only while its accumulator plus the most that
unprocessed segments may add reaches the k-th largest accumulator. When few such candidates are left, or no segment is,
all of them are scored exactly.

Queries meet candidates in blocks: every query block meets every candidate block, in one task per pair of blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = 16
_STEPS = (0.6, 0.4, 0.25, 0.15, 0.08, 0.03, 0.0)


class ImpactIndex:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.order = np.ascontiguousarray(np.argsort(-vectors, axis=0, kind="stable").T)
        self.values = np.take_along_axis(vectors.T, self.order, axis=1)
        self.high, self.low = self.values[:, 0], self.values[:, -1]
        self.width = (self.high - self.low) // LEVELS + 1
        rising = (self.values - self.low[:, None]) // self.width[:, None]
        falling = (self.high[:, None] - self.values) // self.width[:, None]
        self.from_top, self.from_end = (
            np.stack([(kind >= level).sum(axis=1) for level in range(LEVELS + 1)], axis=1) for kind in (rising, falling))

    def search(self, query: np.ndarray, own, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates but ``own``, ties to the smaller id."""
        n = len(self.ids)
        other = self.ids != own
        k_here = min(k, int(other.sum()))
        if k_here == 0:
            return self.ids[:0], np.zeros(0, dtype=np.int64)
        dims = np.flatnonzero(query)
        weight = np.abs(query[dims])
        counts = np.where((query[dims] > 0)[:, None], self.from_top[dims], self.from_end[dims])
        largest = int((weight * (self.high - self.low)[dims]).max(initial=0))
        sums, done = np.zeros(n, dtype=np.int64), np.zeros(len(dims), dtype=np.int64)
        possible = other
        for step in _STEPS if len(dims) else ():
            level = np.ceil(step * largest / (weight * self.width[dims])).astype(np.int64)
            target = np.where(level > LEVELS, 0, counts[np.arange(len(dims)), np.minimum(level, LEVELS)])
            for i in np.flatnonzero(target > done):
                d, w = dims[i], weight[i]
                if query[d] > 0:
                    part = slice(done[i], target[i])
                    sums[self.order[d, part]] += w * (self.values[d, part] - self.low[d])
                else:
                    part = slice(n - target[i], n - done[i])
                    sums[self.order[d, part]] += w * (self.high[d] - self.values[d, part])
            done = np.maximum(done, target)
            at_next = np.minimum(done, n - 1)
            ahead = np.where(query[dims] > 0, self.values[dims, at_next] - self.low[dims],
                             self.high[dims] - self.values[dims, n - 1 - at_next])
            rest = int((weight * np.where(done < n, ahead, 0)).sum())
            reached = sums[other]
            bound = np.partition(reached, len(reached) - k_here)[len(reached) - k_here]
            possible = other & (sums + rest >= bound)
            if possible.sum() <= 8 * k:
                break
        members = np.flatnonzero(possible)
        scores = self.vectors[members] @ query
        best = np.lexsort((self.ids[members], -scores))[:k_here]
        return self.ids[members[best]], scores[best]


def quantised(embedding: Column) -> Column:
    """floor(256 * x) of every component; null if the vector, or any component, is null or not finite."""
    wide = F.transform(embedding, lambda x: x.cast("double"))
    usable = F.coalesce(F.forall(wide, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False))
    return F.when(usable, F.transform(wide, lambda x: F.floor(x * 256).cast("bigint")))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def exact_top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, candidate_block: int = 8192,
                query_block: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every query.

    Both sides have vec_id and vector (array of bigint; null takes no part, as does a null id). Candidates with the
    query's id are its own. Repeated rows count once; a query id with several vectors asks with the smallest. Missing
    trailing components count as 0. Without candidates a query has no rows.
    """
    kept = candidates.select("vec_id", "vector").filter("vec_id IS NOT NULL AND vector IS NOT NULL").distinct()
    asked = queries.select("vec_id", "vector").filter("vec_id IS NOT NULL AND vector IS NOT NULL")
    asked = asked.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n_candidates, n_queries = candidates.count(), queries.count()
    blocks, lots = -(-n_candidates // candidate_block) or 1, -(-n_queries // query_block) or 1

    def dealt(rows: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id"), F.lit(n_own)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other)
        return rows.select("vec_id", "vector", mine).select("*", every)

    left = dealt(kept, "block", blocks, "lot", lots)
    right = dealt(asked, "lot", lots, "block", blocks)

    def search(known: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(known) and len(asking):
            width = max(max(map(len, known["vector"])), max(map(len, asking["vector"])), 1)
            index = ImpactIndex(known["vec_id"].to_numpy(), _matrix(known["vector"], width))
            for query_id, vector in zip(asking["vec_id"], _matrix(asking["vector"], width)):
                ids, scores = index.search(vector, query_id, k)
                found += [(query_id, i, s) for i, s in zip(ids.tolist(), scores.tolist())]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    per_block = left.groupBy("block", "lot").cogroup(right.groupBy("block", "lot")).applyInPandas(
        search, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = per_block.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
