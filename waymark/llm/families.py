"""Exact similarity within families of candidates: every pair is compared, by matrices of shared shingles."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import marked, materialise

#: Texts and their bytes on a side of the cells that a family's pairs are dealt by, and shingles that are counted at once.
CELL, CELL_BYTES = 512, 1 << 22
COLUMNS = 4096


class Forest:
    """A spanning forest of links that come in parts: links that join nothing new are left out."""

    def __init__(self, nodes: int) -> None:
        self.label = np.arange(nodes)

    def _root(self, x: int) -> int:
        while self.label[x] != x:
            x = int(self.label[x])
        return x

    def add(self, i: np.ndarray, j: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Places of the links that are kept; those of lower ``order`` are taken first."""
        at = np.flatnonzero(self.label[i] != self.label[j])
        at = at[np.argsort(order[at], kind="stable")]
        _, first = np.unique(self.label[i[at]] * len(self.label) + self.label[j[at]], return_index=True)
        kept = []
        for k in at[np.sort(first)].tolist():
            x, y = self._root(int(i[k])), self._root(int(j[k]))
            if x != y:
                self.label[max(x, y)] = min(x, y)
                kept.append(k)
        while (self.label != (up := self.label[self.label])).any():
            self.label = up
        return np.array(kept, np.int64)


def similar_links(first: list[np.ndarray], second: list[np.ndarray] | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, most similar first, of the pairs of sets (ascending hashes) with a Jaccard similarity that high:
    places in ``first`` and ``second``, or of two places in ``first``. All pairs are compared, by counts of shared hashes."""
    same = second is None
    both = first if same else [*first, *second]
    m, n = len(first), len(both)
    size = np.array([len(x) for x in both], np.int64)
    shared = np.zeros((m, m if same else n - m), np.float32)
    if same and m == 2:  # most families
        shared[0, 1] = len(np.intersect1d(*both, assume_unique=True))
        return _forest(shared, size, m, n, same, similarity)
    hashes, of = np.concatenate([*both, np.zeros(0, np.uint64)]), np.repeat(np.arange(n), size)
    order = np.argsort(hashes, kind="stable")
    hashes, of = hashes[order], of[order]
    new = np.concatenate(([True], hashes[1:] != hashes[:-1]))[: len(hashes)]
    column, times = np.cumsum(new) - 1, np.diff(np.append(np.flatnonzero(new), len(hashes)))
    often = times > 1  # a hash that one set has is shared by none
    column, of = (np.cumsum(often) - 1)[column[often[column]]], of[often[column]]
    for at in range(0, int(often.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        block = np.zeros((n, COLUMNS), np.float32)
        block[of[lo:hi], column[lo:hi] - at] = 1
        shared += block[:m] @ (block[:m] if same else block[m:]).T
    return _forest(shared, size, m, n, same, similarity)


def _forest(shared: np.ndarray, size: np.ndarray, m: int, n: int, same: bool, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    total = size[:m, None] + (size[None, :m] if same else size[None, m:]) - shared
    i, j = np.nonzero((shared >= similarity * total - 1e-4) & (total > 0) | (total == 0))
    if same:
        i, j = i[i < j], j[i < j]
    kept = Forest(n).add(i, j if same else j + m, -shared[i, j] / np.maximum(total[i, j], 1))
    return i[kept], j[kept]


def verified_links(families: DataFrame, texts: DataFrame, shingles: Callable[[str], np.ndarray], similarity: float) -> DataFrame:
    """``(a, b)``: links between similar texts (``node, t``) of one family (``node, family``) that reach whatever all of
    them reach. ``shingles`` gives a text's different shingle hashes, ascending.

    Every pair of a family is compared, in cells of about ``CELL`` texts and ``CELL_BYTES`` a side; families that fit into
    one cell go through several at a time. Texts move, not their hashes, which are longer. What leaves a cell is a forest.
    """

    def sets(group: pd.DataFrame) -> list[np.ndarray]:
        return [shingles(t) for t in group["t"]]

    def within(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, own in group.groupby("family", sort=False):
            node = own["node"].to_numpy()
            i, j = similar_links(sets(own), None, similarity)
            out.append(pd.DataFrame({"a": node[i], "b": node[j]}))
        return pd.concat(out)

    def across(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        first, second = group[group["part"] == key[1]], group[group["part"] == key[2]]
        i, j = similar_links(sets(first), None if key[1] == key[2] else sets(second), similarity)
        return pd.DataFrame({"a": first["node"].to_numpy()[i], "b": second["node"].to_numpy()[j]})

    # an inner join: a semi-join would be moved below the map, and shuffle every text
    own = marked(texts, families, "node").join(families, "node").dropDuplicates(["node"]).select("node", "family", "t")
    own = materialise(own, "members", "zstd")
    weight = F.greatest(F.count("*") / CELL, F.sum(F.octet_length("t")) / CELL_BYTES)
    parts = own.groupBy("family").agg(weight.alias("weight"))
    parts = materialise(parts.select("family", "weight", F.ceil("weight").cast("int").alias("parts")), "families")
    small = own.join(parts.filter("parts = 1").select("family"), "family")
    buckets = max(1, int(np.ceil(parts.filter("parts = 1").agg(F.sum("weight")).first()[0] or 0)))
    found = small.withColumn("bucket", F.pmod(F.xxhash64("family"), F.lit(buckets))).groupBy("bucket").applyInPandas(lambda g: within(g), "a binary, b binary")
    large = own.join(parts.filter("parts > 1").select("family", "parts"), "family").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("family", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "t")
    return found.unionByName(large.groupBy("family", "i", "j").applyInPandas(across, "a binary, b binary"))
