"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted similarity.

A document is contaminated by a benchmark item if some run of as many words as the item has is similar to it: the
weighted Jaccard similarity of the two multisets of word shingles is ``similarity`` or more, each shingle weighing as
often as it occurs. Windows of an item's size are fingerprinted by SimHash; the items' fingerprints are indexed by four
blocks of 16 bits. Two fingerprints within r bits differ in at most r // 4 bits in some block, so looking up all values
that near in every block finds all of them. Candidates are then verified exactly.

Which windows are looked at: those that a shared shingle lines up with an item, and those between two such windows. A
window that shares no shingle has similarity 0, and moving a window past the last such place only loses shared ones. Of
the n shingles of a window between two such places that are ``gap`` apart, at most 2 n - gap are shared; similarity s
takes 2 n s / (1 + s). So gaps of up to 2 n / (1 + s) are looked at, and nothing is left out by that, also where the parts
of an item come in another order. The radius is
wide (``radius_for``): at similarity 0.8 about 10 of 64 bits differ, with a deviation of 3, and 23 may.

Edge cases: null and empty texts and items match nothing; items of fewer words than a shingle have one, the whole
sequence; a document shorter than an item is one window; repeated items are found each, repeated documents too; an
empty table gives an empty result; extra columns are kept or not looked at. Words are maximal runs without ASCII white
space, A-Z in lower case. A word that no item has equals none, wherever it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import materialise, prepare, text_or_empty
from .simhash import _words

WORDS = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS = 4, 16
#: Bytes of benchmark text that one index holds, and indexes that are held at once. A larger benchmark comes to the driver
#: and to the workers by so many, each with its own look at the texts.
INDEX_BYTES, INDEXES = 16 << 20, 4
UNKNOWN = 1 << 32
HIT = "array<struct<item_id:long,start:int,words:int,similarity:double>>"


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit keys over all bits (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(ids: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit key for every run of k words."""
    n = len(ids) - k + 1
    key = np.zeros(max(0, n), np.uint64)
    for j in range(k if n > 0 else 0):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + ids[j : j + n].astype(np.uint64) + np.uint64(1))
    return key


def _simhash(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)).view(">u8").astype(np.uint64)[0]


def radius_for(similarity: float) -> int:
    """The bits that fingerprints may differ in: the mean at that weighted similarity, and 4.6 standard deviations."""
    share = np.arccos(min(1.0, 2 * similarity / (1 + similarity))) / np.pi
    return min(64, int(np.ceil(64 * share + 4.6 * np.sqrt(64 * share * (1 - share)))))


class HammingIndex:
    """All stored fingerprints within ``radius`` bits of a query, by the pigeonhole over blocks."""

    def __init__(self, prints: np.ndarray, radius: int) -> None:
        self.prints, self.radius = prints, radius
        near = radius // BLOCKS
        self.masks = np.array([sum(1 << i for i in x) for r in range(near + 1) for x in combinations(range(BLOCK_BITS), r)], np.int64)
        self.tables = []
        for b in range(BLOCKS):
            value = self._block(prints, b)
            order = np.argsort(value, kind="stable")
            self.tables.append((np.searchsorted(value[order], np.arange((1 << BLOCK_BITS) + 1)), order))

    @staticmethod
    def _block(prints: np.ndarray, b: int) -> np.ndarray:
        return (prints >> np.uint64(BLOCK_BITS * b) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)

    def within(self, print_: np.uint64) -> np.ndarray:
        found = []
        for b, (first, order) in enumerate(self.tables):
            value = int(self._block(np.array([print_], np.uint64), b)[0]) ^ self.masks
            lo, hi = first[value], first[value + 1]
            for x, y in zip(lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                found.append(order[x:y])
        items = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return items[np.bitwise_count(self.prints[items] ^ print_) <= self.radius]


class Benchmark:
    """The items of one index, ready to look for in texts."""

    def __init__(self, items: tuple[tuple[int, str], ...], words: int = WORDS, similarity: float = SIMILARITY, radius: int | None = None) -> None:
        self.similarity = similarity
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.k, self.shingles = [], [], []
        item_ids = []
        for item_id, text in items:
            own = [w for part in _words((text or "").encode("utf-8", "replace").lower()) for w in part]
            if own:
                ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in own], np.int64)
                item_ids.append(item_id)
                self.ids.append(ids)
                self.k.append(min(words, len(ids)))
                self.shingles.append(_keys(ids, self.k[-1]))
        self.item_ids = item_ids
        self.size = np.array([len(x) for x in self.ids], np.int64)
        self.index = HammingIndex(np.array([_simhash(x) for x in self.shingles], np.uint64), radius_for(similarity) if radius is None else radius)
        self.counts = [dict(zip(*(a.tolist() for a in np.unique(x, return_counts=True)), strict=True)) for x in self.shingles]
        self.postings = {}
        for k in set(self.k):
            own = [i for i, x in enumerate(self.k) if x == k]
            key = np.concatenate([self.shingles[i] for i in own])
            item = np.concatenate([np.full(len(self.shingles[i]), i) for i in own])
            at = np.concatenate([np.arange(len(self.shingles[i])) for i in own])
            order = np.argsort(key, kind="stable")
            self.postings[k] = key[order], item[order], at[order]

    def _ids(self, text: str) -> np.ndarray:
        get = self.vocabulary.get
        parts = [np.fromiter(map(get, part, repeat(-1)), np.int64, len(part)) for part in _words(text.encode("utf-8", "replace").lower())]
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        unknown = np.flatnonzero(ids < 0)
        ids[unknown] = UNKNOWN + unknown
        return ids

    def _starts(self, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
        """``(item, starts)``: where windows of an item's size are to be looked at."""
        key, item, at = self.postings[k]
        n = len(ids) - k + 1
        if n <= 0:
            return
        known = np.concatenate(([0], np.cumsum(ids < UNKNOWN)))
        place = np.flatnonzero(known[k:] - known[:-k] == k)
        if not len(place):
            return
        wide = np.concatenate([place + j for j in range(k)]).reshape(k, -1)
        own = np.zeros(len(place), np.uint64)
        for j in range(k):
            own = _mix(own * np.uint64(0x9E3779B97F4A7C15) + ids[wide[j]].astype(np.uint64) + np.uint64(1))
        lo, hi = np.searchsorted(key, own, "left"), np.searchsorted(key, own, "right")
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            return
        n_hit = (hi - lo)[hit]
        post = np.repeat(lo[hit], n_hit) + np.arange(n_hit.sum()) - np.repeat(np.cumsum(n_hit) - n_hit, n_hit)
        start = np.repeat(place[hit], n_hit) - at[post]
        for i in np.unique(item[post]).tolist():
            size = int(self.size[i])
            of = item[post] == i
            line = np.unique(np.clip(start[of], 0, max(0, len(ids) - size)))
            gap, shingles = np.diff(line), size - k + 1
            widest, least = 2 * shingles / (1 + self.similarity) + 1, 2 * shingles * self.similarity / (1 + self.similarity) - 1e-6
            # fewer places with a shared shingle than similar windows share: none is similar
            full = (gap > 1).any() and len(np.unique(start[of] + at[post[of]])) >= least
            fill = [np.arange(a + 1, b) for a, b in zip(line[:-1], line[1:], strict=True) if b - a <= widest] if full else []
            yield i, np.unique(np.concatenate([line, *fill]))

    def hits(self, text: str | None) -> list[dict]:
        """The items found in a text: each item's best window, the first of equals."""
        ids = self._ids(text or "")
        best: dict[int, tuple[float, int, int]] = {}
        for k in self.postings:
            windows = {(int(s), int(min(self.size[i], len(ids)))) for i, starts in self._starts(ids, k) for s in starts}
            keys = None
            for start, size in sorted(windows):
                keys = _keys(ids, k) if keys is None else keys
                own = keys[start : start + size - k + 1]
                if not len(own):
                    continue
                counts = None
                for i in self.index.within(_simhash(own)).tolist():
                    if self.k[i] != k or min(int(self.size[i]), len(ids)) != size:
                        continue
                    if counts is None:
                        counts = dict(zip(*(a.tolist() for a in np.unique(own, return_counts=True)), strict=True))
                    theirs = self.counts[i]
                    both = sum(min(c, theirs.get(x, 0)) for x, c in counts.items())
                    value = both / (len(own) + len(self.shingles[i]) - both)
                    if value >= self.similarity and (i not in best or value > best[i][0]):
                        best[i] = (value, start, size)
        return [{"item_id": self.item_ids[i], "start": s, "words": n, "similarity": v} for i, (v, s, n) in sorted(best.items())]


@lru_cache(maxsize=2 * INDEXES)
def _benchmark(items: tuple[tuple[int, str], ...], words: int, similarity: float, radius: int | None) -> Benchmark:
    return Benchmark(items, words, similarity, radius)


def _indexes(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[tuple[int, str], ...]]]:
    """The items, by lists of at most ``INDEX_BYTES`` of text (or of one item), ``INDEXES`` lists at a time."""
    rows = benchmark.select(F.col(id_col).cast("long"), text_or_empty(text_col)).orderBy(F.col(id_col), F.col(text_col))
    out, size = [[]], 0
    for item_id, text in rows.toLocalIterator():
        own = len(text.encode("utf-8", "replace"))
        if out[-1] and size + own > INDEX_BYTES:
            if len(out) == INDEXES:
                yield [tuple(x) for x in out]
                out = []
            out.append([])
            size = 0
        out[-1].append((item_id, text))
        size += own
    yield [tuple(x) for x in out]


def _hits(lists: list[tuple[tuple[int, str], ...]], text: Column, words: int, similarity: float, radius: int | None) -> Column:
    """A column of the items found in ``text``: an array of ``item_id, start, words, similarity``."""

    def finder(items: tuple[tuple[int, str], ...]):
        @F.pandas_udf(HIT)
        def find(texts: pd.Series) -> pd.Series:
            own = _benchmark(items, words, similarity, radius)
            return pd.Series([own.hits(x) for x in texts])

        return find

    return F.concat(*[finder(items)(text) for items in lists])


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY, radius: int | None = None, item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``(id_col, item_id, start, words, similarity)``: every document and item that is found in it."""
    prepare(docs.sparkSession)
    parts = []
    for lists in _indexes(benchmark, item_col, item_text_col):
        hits = _hits(lists, text_or_empty(text_col), words, similarity, radius)
        found = docs.select(F.col(id_col).alias("id"), F.explode(hits).alias("hit")).select(F.col("id").alias(id_col), "hit.*")
        parts.append(materialise(found, "hits") if len(lists) == INDEXES else found)  # there may be more: one group at a time
    return reduce(DataFrame.unionByName, parts)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY, radius: int | None = None, item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item is found; columns of any name pass through."""
    prepare(docs.sparkSession)
    for lists in _indexes(benchmark, item_col, item_text_col):
        docs = docs.filter(F.size(_hits(lists, text_or_empty(text_col), words, similarity, radius)) == 0)
        docs = materialise(docs, "clean") if len(lists) == INDEXES else docs
    return docs
