"""How the sources of a language differ in their words: an inverted index of corrections to a baseline.

A group is a language's source. A language keeps the terms that at least ``least`` of its documents hold, V in all. A
group gives each kept term, with ``count`` occurrences there of the N of all kept terms, the share
``p = 1 + floor(10**9 * (count + 5) / (N + 5 * V))``; a term that it lacks has the share z of a count of zero.

The divergence of two groups, the sum of abs(p - q) over all kept terms, starts at V * abs(z - y), as if neither had any
term. Only terms that one of them has - the postings - can add to that, and each adds its correction
abs(p - q) - abs(z - y). Postings are dealt to cells: a cell is a language, two blocks of its sources and a share of its
terms, of some ``CELL_ROWS`` postings; it sums corrections in integers and emits those pairs' that aren't zero. So no
task has a whole language, and a pair costs one row a cell. Shares of terms have a size, whatever a language has.

Terms are counted as they are split, by partial aggregates; nothing is broadcast and nothing is collected but the number
of postings and sources of each language.

Edge cases: null texts, languages and sources are empty ones; a group without terms has all shares of a count of zero;
where V is 0 all pairs' values are 0 and there are no terms; a language of one source has no pairs; repeated rows each
count as a document; an empty table gives an empty result; texts and terms of any length count whole; extra columns are
not looked at.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialise

LEAST, TOP, UNIT, PRIOR = 30, 50, 1_000_000_000, 5
#: Fixed value: letters of ASCII and all characters beyond it.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Sources in a block, and postings in a cell, on average.
BLOCK, CELL_ROWS = 64, 1 << 17
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: Column) -> Column:
    """The terms of a text, in order; only A-Z are lower-cased."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(TERM), F.lit(0))


def share(count: Column, total: Column, kept: Column) -> Column:
    """The share of a term; a decimal product, since counts times 10 ** 9 needn't fit a long."""
    top = (count.cast("decimal(19,0)") + F.lit(PRIOR).cast("decimal(1,0)")) * F.lit(UNIT).cast("decimal(10,0)")
    below = total.cast("decimal(19,0)") + kept.cast("decimal(19,0)") * F.lit(PRIOR).cast("decimal(1,0)")
    return F.call_function("div", top, below) + 1


def counted(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, df)``: occurrences, and documents that hold the term."""
    split = docs.select("lang", "source", terms(F.col("text")).alias("all"))
    both = F.array(F.struct(F.lit(0).alias("df"), F.col("all").alias("terms")), F.struct(F.lit(1).alias("df"), F.array_distinct("all").alias("terms")))
    each = split.select("lang", "source", F.explode(both).alias("b")).select("lang", "source", F.col("b.df").alias("df"), F.explode("b.terms").alias("term"))
    return each.groupBy("lang", "source", "term").agg(F.sum(1 - F.col("df")).alias("n"), F.sum("df").alias("df"))


def _corrections(rows: pd.DataFrame) -> pd.DataFrame:
    """The corrections of one cell, ``(lang, a, b, value)`` with a in the first block and b in the second.

    Rows are postings of either block (``side`` 0 or 1) and, with a null term, every source of the blocks with its share
    of a count of zero. Of a block with itself, each pair is given once.
    """
    mark = rows["term"].isna().to_numpy()
    names = [rows["source"][mark & (rows["side"] == s)].to_numpy() for s in (0, 1)]
    zero = [rows["p"][mark & (rows["side"] == s)].to_numpy(np.int64) for s in (0, 1)]
    flat = np.abs(zero[0][:, None] - zero[1][None, :])
    total = np.zeros_like(flat)
    posts = rows[~mark]
    term = pd.factorize(posts["term"])[0]
    side, p = posts["side"].to_numpy(), posts["p"].to_numpy(np.int64)
    place = np.zeros(len(posts), np.int64)
    for s in (0, 1):
        own = side == s
        place[own] = pd.Index(names[s]).get_indexer(posts["source"][own])
    order = np.lexsort((side, term))
    term, side, p, place = term[order], side[order], p[order], place[order]
    edges = [*np.flatnonzero(np.diff(term, prepend=-1)).tolist(), len(term)]
    for lo, hi in pairwise(edges):
        cut = lo + int(np.searchsorted(side[lo:hi], 1))
        left, right = zero[0].copy(), zero[1].copy()
        left[place[lo:cut]], right[place[cut:hi]] = p[lo:cut], p[cut:hi]
        # pairs that neither has the term of stay at the baseline
        total += np.abs(left[:, None] - right[None, :]) - flat
    if rows["x"].iloc[0] == rows["y"].iloc[0]:  # a block with itself meets each pair twice
        total = np.triu(total, 1)
    a, b = np.nonzero(total)
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "a": names[0][a], "b": names[1][b], "value": total[a, b]})


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: of every group, all other sources of its language by divergence
    (``pair``), and the ``top`` kept terms whose share is most above the language's (``term``)."""
    clean = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = docs.select(clean(text_col).alias("text"), clean(lang_col).alias("lang"), clean(source_col).alias("source"))
    counts = materialise(counted(rows), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("df").alias("df")).filter(F.col("df") >= least).drop("df")
    kept = materialise(kept, "kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("lang_total"))
    postings = materialise(counts.drop("df").join(kept, ["lang", "term"]), "postings")
    sizes = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("posts"))
    groups = rows.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    null0 = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    groups = groups.select("lang", "source", *[null0(c) for c in ("total", "posts", "kept", "lang_total")])
    zero = F.when(F.col("kept") > 0, share(F.lit(0), F.col("total"), F.col("kept"))).otherwise(0)
    # blocks and shares of terms by language: numbers of them, so that each cell has about its size
    cells = groups.groupBy("lang").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.sum("posts").alias("posts"))
    cells = cells.select("lang", "blocks", F.greatest(F.lit(1), F.ceil(2 * F.col("posts") / (F.col("blocks") * CELL_ROWS))).cast("long").alias("shards"))
    groups = materialise(groups.withColumn("z", zero).join(cells, "lang"), "groups")
    known = groups.select("lang", "source", "total", "kept", "lang_total", "blocks", "shards")
    shares = postings.join(known, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
    shares = materialise(shares.withColumn("q", share(F.col("all"), F.col("lang_total"), F.col("kept"))).select("lang", "source", "term", "p", "q", "blocks", "shards"), "shares")

    block = F.pmod(F.xxhash64("source"), "blocks")
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    posts = shares.select("lang", "source", "term", "p", "blocks", F.pmod(F.xxhash64("term"), "shards").alias("shard"), block.alias("own"))
    ends = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("z").alias("p"), "blocks", F.explode(numbers("shards")).alias("shard"), block.alias("own"))
    # a block meets itself and the later ones as the first side, and itself and the earlier ones as the second
    sides = F.concat(
        F.transform(F.sequence(F.col("own"), F.col("blocks") - 1), lambda o: F.struct(F.lit(0).alias("side"), F.col("own").alias("x"), o.alias("y"))),
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("own")), lambda o: F.struct(F.lit(1).alias("side"), o.alias("x"), F.col("own").alias("y"))),
    )
    dealt = posts.unionByName(ends).withColumn("at", F.explode(sides)).select("lang", "source", "term", "p", "shard", "at.*")
    found = dealt.groupBy("lang", "x", "y", "shard").applyInPandas(_corrections, "lang string, a string, b string, value long")
    base = groups.select("lang", F.col("source").alias("a"), "z", "kept").join(groups.select("lang", F.col("source").alias("b"), F.col("z").alias("y")), "lang").filter("a < b")
    base = base.select("lang", "a", "b", (F.col("kept") * F.abs(F.col("z") - F.col("y"))).alias("value"))
    parts = base.unionByName(found.select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "value"))
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    turns = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = sums.select("lang", F.explode(turns).alias("s"), "value")
    best = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pairs.select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value").withColumn("rank", rank)
    return pairs.unionByName(best.withColumn("rank", rank).filter(F.col("rank") <= top))
