"""All pairs of names that are alike, without comparing all: a set-similarity join, then the exact ratio.

The ratio of two names (``text.indel_ratio``) is twice their longest common subsequence by their lengths together. For one
of at least t, of names of n and m characters: the shorter has at least t / (2 - t) of the longer's length; they share
t (n + m) / 2 letters, and (1.5 t - 1) (n + m) - 1 pairs of neighbouring letters, repeats counted, since a letter left out
breaks two pairs and a letter put in one. So if the tokens of all names are sorted alike, rarest first, two names that must
share k of them share one of the first (size - k + 1) of each, and those are what is joined.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import text as K
from waymark.functions.lineage import kept

#: Slack for products of floats: bounds may be lower than they have to be, never higher.
EPS = 1e-9


def _tokens(names: DataFrame, least: float) -> DataFrame:
    """``(key, n, kind, need, token)``: letters of the short names and of those that may pair with them, pairs of the others."""
    t = least / 100
    ratio = t / (2 - t)
    n = F.length("key")
    together = n + F.ceil(n * ratio - EPS)
    pairs = F.ceil((1.5 * t - 1) * together - 1 - EPS)
    letters = F.ceil(t * together / 2 - EPS)
    # the shortest name that surely shares a pair with whatever it is like
    short = next((k for k in range(2, 10_000) if (1.5 * t - 1) * (k + math.ceil(k * ratio - EPS)) - 1 - EPS > 0), None) if t > 2 / 3 else None
    cut = lambda size: F.regexp_extract_all("key", F.lit(f"(?s)(?=(.{{{size}}}))."), F.lit(1))
    kinds = F.array(
        F.struct(F.lit(1).alias("kind"), letters.alias("need"), F.when(F.lit(short is None) | (n * ratio < (short or 0)), cut(1)).otherwise(F.array().cast("array<string>")).alias("tokens")),
        F.struct(F.lit(2).alias("kind"), pairs.alias("need"), F.when(F.lit(short is not None) & (n >= (short or 0)), cut(2)).otherwise(F.array().cast("array<string>")).alias("tokens")),
    )
    each = names.select("key", n.alias("n"), F.explode(kinds).alias("k")).select("key", "n", "k.kind", "k.need", F.explode("k.tokens").alias("token"))
    # repeats are tokens of their own
    nth = F.row_number().over(Window.partitionBy("key", "kind", "token").orderBy("n"))
    return each.withColumn("token", F.concat_ws("\u0000", "token", nth))


def similar_names(left: DataFrame, right: DataFrame, name: str = "name", least: float = 75.0) -> DataFrame:
    """``(left_key, right_key, ratio)``: every pair of a name of ``left`` and one of ``right``, by their match keys, with a
    ratio of at least ``least`` (0 to 100, more than 0). Each pair of keys is once; null and empty names are in no pair.
    """
    keys = lambda df: kept(df.select(K.match_key(F.col(name)).alias("key")).filter("key != ''").distinct())
    mine, theirs = kept(_tokens(keys(left), least)), kept(_tokens(keys(right), least))
    common = theirs.groupBy("kind", "token").agg(F.count("*").alias("df"))

    def firsts(tokens: DataFrame) -> DataFrame:
        # a token that the other side doesn't have comes first, and is no use: it takes a place in the prefix all the same
        rare = Window.partitionBy("key", "kind").orderBy(F.coalesce("df", F.lit(0)), "token")
        ranked = tokens.join(common, ["kind", "token"], "left").withColumn("rank", F.row_number().over(rare)).withColumn("size", F.count("*").over(Window.partitionBy("key", "kind")))
        return ranked.filter(F.col("rank") <= F.col("size") - F.col("need") + 1).select("key", "n", "kind", "token")

    a = firsts(mine).select(F.col("key").alias("left_key"), F.col("n").alias("a"), "kind", "token")
    b = firsts(theirs).select(F.col("key").alias("right_key"), F.col("n").alias("b"), "kind", "token")
    fits = _fits(F.col("a"), F.col("b"), least)
    pairs = kept(a.join(b, ["kind", "token"]).filter(fits).select("left_key", "right_key").distinct())
    return pairs.withColumn("ratio", K.indel_ratio("left_key", "right_key")).filter(F.col("ratio") >= least)


def _fits(a: Column, b: Column, least: float) -> Column:
    return 200 * F.least(a, b) >= (least - EPS) * (a + b)
