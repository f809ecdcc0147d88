"""Mixing sources to target weights: whole passes first, then a subset-sum fit of what is left.

Per source, the documents are counted by exact token length. Targets share a budget by weight, no source above ``cap``
times its size. A source's target is whole passes over all its documents plus a rest; of the rest, all but a few times the
longest length is the same share of the documents of every length, rounded by a seeded systematic draw along the lengths,
so that long and short texts are taken alike. What is still missing is fitted by bounded-knapsack dynamic programming
over the lengths that have documents left, in a seeded order. So the work follows the number of different lengths, not of
documents. Which documents of a length are taken is decided by a seeded hash of id and text.

Edge cases: a null or empty text has length 0 and is never taken; a null source is a source, last in order; rows that
are equal in id and text are told apart by nothing, but as many of them are taken as the plan says, and rows of one id
with other texts are rows of their own; a budget of nothing takes nothing; an empty table gives an empty result; extra
columns are not looked at. One length of one source may hold any share of all rows: ranks are counted in two steps, over
hash ranges; rows of one hash that are more than a thousandth of all are dealt by their number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import HOT_KEYS, materialise, text_or_empty

# Weights by the order of the sources, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
SEED = 42
#: Hash ranges that the documents of a length are counted by.
RANGES = 1024
#: Sums that keep what they came from; where there are more, that is found again by halves.
MOST_SUMS = 1 << 24
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, share: float = 1.0, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``.

    Water filling: every source gets its weight's share of the budget, sources above ``cap`` times their size stop
    there, and the rest is shared again until none is above. Each round is one aggregate of the sources; only sums reach
    the driver. The sources are numbered by one sort of the distinct sources.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = materialise(sizes.withColumn("weight", weight), "weights")
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * share
    limit = F.col("source_size") * F.lit(float(cap))
    level = 0.0
    capped = F.lit(False)
    done = -1
    while True:
        got = rows.agg(F.sum(F.when(capped, limit)).alias("held"), F.sum(F.when(~capped, F.col("weight"))).alias("free"), F.count_if(capped).alias("n")).first()
        if got.n == done or not got.free:
            break
        done = got.n
        level = max(0.0, total - (got.held or 0.0)) / got.free
        capped = F.lit(level) * F.col("weight") > limit
    return rows.withColumn("target", F.when(capped, limit).otherwise(F.lit(level) * F.col("weight")))


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length (positive, ascending) to take so that the tokens come near ``budget``.

    All but four times the longest length is the same share of every length: of the first n documents along the lengths,
    the share times n are taken, give or take one, so that the tokens are within two longest lengths of the share. Then a
    subset sum fits what is missing, over the documents that are left: the sum that comes nearest, of equals the smaller.
    """
    taken = np.zeros(len(lengths), np.int64)
    size = int((lengths * counts).sum())
    if budget <= 0 or not size:
        return taken
    if budget >= size:
        return counts.astype(np.int64)
    rng = np.random.default_rng(seed)
    share = max(0, budget - 4 * int(lengths[-1])) / size
    if share:
        upto = np.floor(np.cumsum(counts) * share + rng.random())
        taken = np.minimum(np.diff(upto, prepend=0).astype(np.int64), counts)
    rest, order = budget - int((lengths * taken).sum()), rng.permutation(len(lengths))
    while rest > 0:
        more = _subset(lengths, counts - taken, rest, order)
        gain = int((more * lengths).sum())
        if abs(rest - gain) >= rest:
            break
        taken, rest = taken + more, rest - gain
    return taken


def _subset(lengths: np.ndarray, left: np.ndarray, rest: int, order: np.ndarray) -> np.ndarray:
    """Of the documents left, some whose lengths' sum comes nearest to ``rest``, of equally near ones the smaller.

    Up to ``MOST_SUMS`` sums, each keeps what it came from; where there are more, what makes up the nearest sum is found
    again by halves of the lengths, with a bit for each sum. Both are exact.
    """
    most = rest + min(rest, int(lengths[-1]))
    reach, traced = 1, most < MOST_SUMS
    came, step = np.zeros(most + 1 if traced else 0, np.int32), np.zeros(most + 1 if traced else 0, np.int64)
    used = []
    for k in order.tolist():
        if reach >> rest & 1:
            break
        used.append(k)
        for n, wider in _added(reach, int(lengths[k]), int(left[k]), most):
            if traced:
                at = _set_bits(wider & ~reach)
                came[at], step[at] = k, n
            reach = wider
    below, above = (reach & ((1 << rest + 1) - 1)).bit_length() - 1, reach >> rest
    at = below
    if above and (gap := (above & -above).bit_length() - 1) < rest - below:
        at = rest + gap
    out = np.zeros(len(lengths), np.int64)
    if traced:
        while at:
            out[came[at]] += step[at]
            at -= int(step[at] * lengths[came[at]])
        return out
    parts = [(used, at)]
    while parts:
        some, total = parts.pop()
        if len(some) == 1:
            out[some[0]] = total // int(lengths[some[0]])
        elif total:
            halves = some[: len(some) // 2], some[len(some) // 2 :]
            one, other = (_sums(lengths, left, half, total) for half in halves)
            both = one & _mirrored(other, total)
            own = (both & -both).bit_length() - 1
            parts += [(halves[0], own), (halves[1], total - own)]
    return out


def _added(reach: int, length: int, count: int, most: int) -> Iterator[tuple[int, int]]:
    """``(n, sums)`` when n more documents of a length may be taken, ``count`` in all; a bit for each sum up to ``most``."""
    full, count, n = (1 << most + 1) - 1, min(count, most // length), 1
    while count > 0:  # binary splitting of the count
        n = min(n, count)
        reach |= (reach << n * length) & full
        yield n, reach
        count, n = count - n, n * 2


def _sums(lengths: np.ndarray, left: np.ndarray, some: list[int], most: int) -> int:
    reach = 1
    for k in some:
        for _, reach in _added(reach, int(lengths[k]), int(left[k]), most):  # noqa: B007
            pass
    return reach


#: Each byte with its bits in the other order.
_TURNED = np.packbits(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little"), axis=1).reshape(-1)


def _mirrored(x: int, most: int) -> int:
    """Bit ``most - i`` for each bit i of x."""
    size = most // 8 + 1
    raw = np.frombuffer(x.to_bytes(size, "little"), np.uint8)
    return int.from_bytes(_TURNED[raw[::-1]].tobytes(), "little") >> (8 * size - 1 - most)


def _set_bits(x: int) -> np.ndarray:
    raw = np.frombuffer(x.to_bytes((x.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little"))


def _plan(lengths: pd.DataFrame, seed: int) -> pd.DataFrame:
    """For one source's lengths: whole passes, and the documents of each length to take besides."""
    rows = lengths.sort_values("size")
    target, size, name = float(rows["target"].iloc[0]), int(rows["source_size"].iloc[0]), rows["source"].iloc[0]
    passes = min(int(target // size), int(1e9)) if size else 0
    plan = rows[["source", "size"]].assign(passes=passes, extra=0)
    own = rows["size"].to_numpy(np.int64) > 0
    seed = zlib.crc32(repr(name).encode("utf-8", "replace"), seed & 0xFFFFFFFF)
    plan.loc[own, "extra"] = fit_counts(rows["size"].to_numpy(np.int64)[own], rows["n"].to_numpy(np.int64)[own], int(round(target - passes * size)), seed)
    return plan


def _mixed(docs: DataFrame, share: float, weights: tuple[float, ...], cap: float, seed: int, id_col: str, text_col: str, source_col: str, row: Column) -> DataFrame:
    """``(id, row, size, source_size, target, copies)`` of every row."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), row.alias("row"), F.col(source_col).alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(F.lit(seed), F.col(id_col), text).alias("draw"))
    rows = rows.withColumn("range", F.shiftrightunsigned("draw", 64 - (RANGES.bit_length() - 1)).cast("int"))
    rows = materialise(rows, "sizes")
    # rows of one hash are alike; where they are many, their numbers deal them to parts, in the order of the hash
    same_draw = rows.groupBy("draw").agg(F.count("*").alias("n")).filter(F.col("n") > max(HOT_KEYS, rows.count() // HOT_KEYS)).select("draw", F.lit(True).alias("hot"))
    rows = rows.join(F.broadcast(same_draw), "draw", "left").withColumn("part", F.when(F.col("hot"), 1 + F.pmod(F.xxhash64("row"), F.lit(RANGES))).otherwise(0).cast("int"))
    cells = ["range", "at", "part"]
    rows = rows.withColumn("at", F.when(F.col("hot"), F.col("draw")).otherwise(F.lit(-(1 << 63)))).drop("hot")
    ranges = rows.groupBy("source", "size", *cells).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy(*cells).rowsBetween(Window.unboundedPreceding, -1))
    ranges = materialise(ranges.withColumn("before", F.coalesce(before, F.lit(0))), "ranges")
    lengths = ranges.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sizes = targets(lengths.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), share, weights, cap).drop("weight")
    named = lengths.join(sizes, lengths["source"].eqNullSafe(sizes["source"])).drop(sizes["source"])
    plan = named.groupBy("source").applyInPandas(lambda own: _plan(own, seed), "source string, size long, passes long, extra long")
    same = lambda a, b, keys: [a[k].eqNullSafe(b[k]) for k in keys]
    whole = named.drop("n").join(plan, same(named, plan, ["source", "size"])).drop(plan["source"]).drop(plan["size"])
    parts = ranges.join(whole, same(ranges, whole, ["source", "size"])).drop(whole["source"]).drop(whole["size"])
    parts = parts.select("source", "size", *cells, "before", "source_size", "target", "passes", "extra")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("source", "size", *cells).orderBy("draw", "row")))
    out = ranked.join(parts, same(ranked, parts, ["source", "size", *cells]))
    copies = F.col("passes") + (F.col("before") + F.col("rank") <= F.col("extra")).cast("long")
    return out.select("id", "row", ranked["size"], "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, share: float = 1.0, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(id_col, size, source_size, target, copies, taken)`` of every row: ``copies`` times the text, ``taken`` tokens.

    Tokens are words here. No document is taken more than ``ceil(cap)`` times.
    """
    out = _mixed(docs, share, weights, cap, seed, id_col, text_col, source_col, F.monotonically_increasing_id())
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, share: float = 1.0, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed documents: the rows of ``docs``, all columns, each as often as the mix takes it. Rows have a number for that."""
    numbered = materialise(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered", "zstd")
    plain = numbered.select(*[F.col("doc")[c].alias(n) for n, c in (("id", id_col), ("text", text_col), ("source", source_col))], "row")
    taken = _mixed(plain, share, weights, cap, seed, "id", "text", "source", F.col("row")).filter("copies > 0").select("row", "copies")
    repeated = numbered.join(taken, "row").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select("doc.*")
