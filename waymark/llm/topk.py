"""Exact top-k inner products by an impact-ordered index, score at a time.

Vectors are integer. A posting is (dimension, vector, value); its impact is the magnitude of the value, quantised to
powers of two. A shard of the index keeps its postings in segments of equal quantised impact, highest first. A block of
queries takes the segments in that order and adds each segment's exact scores to its accumulators. Before each segment
the rest is bounded: no vector's score can change by more than |query| times the norm of its postings not yet taken
(Cauchy-Schwarz), nor by more than the sum of |query| times the largest impact left. Queries stop only when this proves
that few vectors can still be among the best k; those, all of them, are then scored exactly.

All queries meet all shards, in blocks: a group of the job is one shard and one block of queries. The best k of each
shard are merged by the window's own limit.

Edge cases: vectors that are null, or hold a null or non-finite component, take no part; shorter vectors count as padded
with zeros; ties go to the smaller id; of rows that repeat a query's id none is its candidate, and the query is the
smallest of their vectors; fewer than k candidates are all given; an empty table gives an empty result; extra columns
are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialise

#: Vectors in a shard and queries in a block, on average.
SHARD = 8192
QUERIES = 2048
#: Queries that share one accumulator table at a time.
BATCH = 256
#: A query stops when at most so many times k vectors of the shard are possible members, or all segments are done.
SLACK = 16


def quantised(vectors: DataFrame, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, v)``: components floor(scale * x) as longs, of the vectors that take part."""
    x = F.col(vector_col)
    good = x.isNotNull() & F.col(id_col).isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.filter(good).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double"))).alias("v"))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for k, v in enumerate(rows):
        out[k, : len(v)] = v
    return out


class ImpactIndex:
    """A shard's postings in segments by quantised impact, highest first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        level = np.frexp(np.abs(vectors).astype(np.float64))[1]  # 0: no posting; l: magnitude in [2 ** (l - 1), 2 ** l)
        vec, dim = np.nonzero(level)
        own = level[vec, dim]
        order = np.argsort(-own, kind="stable")
        self.vec, self.dim, self.value = vec[order], dim[order], vectors[vec[order], dim[order]]
        levels, first = np.unique(-own[order], return_index=True)
        self.levels = (-levels).tolist()
        self.edges = [*first.tolist(), len(own)]

    def segments(self):
        """``(level, vectors, dimensions, values)`` of each segment."""
        for level, lo, hi in zip(self.levels, self.edges[:-1], self.edges[1:], strict=True):
            yield level, self.vec[lo:hi], self.dim[lo:hi], self.value[lo:hi]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """``(query id, vector id, score)`` of each query's best k here, its own id left out."""
        n, width = self.vectors.shape
        most = float(np.abs(queries).max(initial=0)) * float(np.abs(self.vectors).max(initial=0)) * width
        kind = np.float32 if most < 2**23 else np.float64 if most < 2**52 else np.int64
        out = []
        size = np.sqrt((self.vectors.astype(np.float64) ** 2).sum(axis=1))
        for at in range(0, len(queries), BATCH):
            q, q_ids = queries[at : at + BATCH], query_ids[at : at + BATCH]
            qf = q.astype(kind)
            norm, total = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1)), np.abs(q).astype(np.float64).sum(axis=1)
            acc = np.zeros((len(q), n), kind)
            left, live = size**2, np.arange(len(q))
            possible: dict[int, np.ndarray] = {}
            for level, vec, dim, value in self.segments():
                if len(live) == 0:
                    break
                rest = np.sqrt(np.maximum(left, 0)) * (1 + 1e-9)
                slack = np.minimum(norm[live, None] * rest[None, :], (total[live] * float(2**level - 1))[:, None])
                if level <= 4 and n > SLACK * k:  # earlier, the bound says nothing
                    low = acc[live] - slack
                    floor = np.partition(low, n - k - 1, axis=1)[:, n - k - 1]  # k others are at least this good
                    may = acc[live] + slack >= floor[:, None]
                    few = may.sum(axis=1) <= SLACK * k
                    for r in np.flatnonzero(few).tolist():
                        possible[int(live[r])] = np.flatnonzero(may[r])
                    live = live[~few]
                    if len(live) == 0:
                        break
                dense = np.zeros((n, width), kind)
                dense[vec, dim] = value
                acc[live] += qf[live] @ dense.T
                left = left - np.bincount(vec, value.astype(np.float64) ** 2, n)
            for r, own in enumerate(q_ids.tolist()):
                rows = possible.get(r)
                score = self.vectors[rows] @ q[r] if rows is not None else acc[r].astype(np.int64)
                ids = self.ids if rows is None else self.ids[rows]
                other = ids != own
                score, ids = score[other], ids[other]
                if len(score) > k:
                    edge = np.partition(score, len(score) - k)[len(score) - k]
                    near = score >= edge
                    score, ids = score[near], ids[near]
                best = np.lexsort((ids, -score))[:k]
                out += [(own, int(i), int(s)) for i, s in zip(ids[best], score[best], strict=True)]
        return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, id_col, score)``: the best k other rows for every row for which ``is_query`` holds."""
    rows = materialise(quantised(vectors, scale, id_col, vector_col), "vectors")
    asked = rows.filter(is_query).groupBy("id").agg(F.min("v").alias("v"))
    facts = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width")).first()
    n_queries = asked.count()
    shards, blocks, width = max(1, -(-facts.n // SHARD)), max(1, -(-n_queries // QUERIES)), facts.width
    shard, block = F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    numbers = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    left = rows.withColumn("shard", shard).withColumn("block", F.explode(numbers(blocks)))
    right = asked.withColumn("block", block).withColumn("shard", F.explode(numbers(shards)))

    def search(own: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(queries):
            index = ImpactIndex(own["id"].to_numpy(np.int64), _matrix(own["v"], width))
            found = index.search(queries["id"].to_numpy(np.int64), _matrix(queries["v"], width), k)
        return pd.DataFrame(found, columns=["query_id", "id", "score"])

    best = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(search, "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
