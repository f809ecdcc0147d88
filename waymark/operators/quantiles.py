"""Exact quantiles by distributed selection: no aggregate and no task holds all values of a key.

A quantile is between two ranks. For every rank a bracket of values is kept that holds it, as counts prove. A round counts
what is below the bracket's quarter points (approximate percentiles, of any quality) and at them, and keeps the part that
holds the rank; it is a partial aggregate of a few numbers for each key. Brackets with few different values left are
settled by counting each value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.lineage import kept

#: Different values of a key that may be counted one by one.
MOST = 1 << 16
#: Cuts of a bracket in a round, and the accuracy of the percentiles that they are taken from.
CUTS, ACCURACY = 64, 1000


#: A key is hot if it has more than one in so many rows; so there are fewer than this many hot keys.
HOT_KEYS = 1000


def _attach(rows: DataFrame, values: DataFrame, on: Sequence[str]) -> DataFrame:
    """``rows`` with the few ``values`` of their key: those of hot keys are broadcast, so that no task has a key's rows."""
    hot = rows.filter("hot").join(F.broadcast(values.filter("hot")), on)
    return hot.unionByName(rows.filter("not hot").join(values.filter("not hot"), on))


def exact_quantiles(rows: DataFrame, value: str, probabilities: Sequence[float], by: str | None = None) -> DataFrame:
    """``(by, p, value)``: the exact quantiles of each key's values, linear between ranks, as ``median`` is at 0.5.

    Null and NaN values are left out, and keys that have no others; a null key is a key. A bracket narrows to a share of
    about ``1 / CUTS`` in a round; ties are one value, so a round always drops something until one value is left.
    """
    key = F.struct(F.col(by) if by else F.lit(None).cast("string").alias("key"))
    own = kept(rows.select(key.alias("key"), F.col(value).cast("double").alias("v")).filter("v is not null and not isnan(v)"))
    sizes = own.groupBy("key").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    total = F.broadcast(sizes.agg((F.sum("n") / HOT_KEYS).alias("_many")))
    sizes = kept(sizes.join(total).withColumn("hot", F.col("n") > F.col("_many")).drop("_many"))
    hot = F.broadcast(sizes.filter("hot").select("key", "hot"))
    own = own.join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    at = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p")
    places = sizes.select("key", "hot", "n", "lo", "hi", at).withColumn("at", F.col("p") * (F.col("n") - 1))
    ends = F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank")
    # a bracket [lo, hi] holds the values of some ranks; below: values less than lo
    ranks = kept(places.select("key", "hot", ends).distinct())
    open_ = kept(places.select("key", "lo", "hi").distinct().join(ranks, "key").withColumn("below", F.lit(0).cast("long")))
    settled = None
    while not open_.isEmpty():
        brackets = open_.select("key", "hot", "lo", "hi", "below").distinct()
        inside = _attach(own, brackets, ["key", "hot"]).filter(F.col("v").between(F.col("lo"), F.col("hi")))
        group = ["key", "hot", "lo", "hi", "below"]
        shares = F.array(*[F.lit(k / CUTS) for k in range(1, CUTS)])
        cuts = inside.groupBy(*group).agg(F.approx_count_distinct("v").alias("different"), F.percentile_approx("v", shares, ACCURACY).alias("cuts"))
        cuts = kept(cuts.withColumn("cuts", F.array_sort(F.array_distinct("cuts"))))
        # few values: each is counted; a count by approximation may be off by some, not by twice
        few = cuts.filter(F.col("different") <= MOST).select(*group)
        counts = _attach(inside, few, group).groupBy(*group, "v").agg(F.count("*").alias("m"))
        upto = F.sum("m").over(Window.partitionBy(*group).orderBy("v"))
        counts = counts.withColumn("last", F.col("below") + upto - 1).withColumn("first", F.col("last") - F.col("m") + 1)
        found = open_.join(counts, group).filter(F.col("rank").between(F.col("first"), F.col("last"))).select("key", "rank", "v")
        settled = kept(found) if settled is None else kept(settled.unionByName(found))
        # many: the rank is at a cut, which settles it, or between two of them
        many = cuts.filter(F.col("different") > MOST)
        if many.isEmpty():
            break
        marked = _attach(inside, many.select(*group, "cuts"), group)
        part = F.size(F.filter("cuts", lambda c: c < F.col("v")))
        is_cut = F.array_contains("cuts", F.col("v"))
        parts = marked.groupBy(*group, part.alias("part"), is_cut.alias("is_cut")).agg(F.count("*").alias("m"), F.min("v").alias("lo2"), F.max("v").alias("hi2"))
        # in order of value: what is below a cut and not below the one before it, then the cut itself
        upto = F.sum("m").over(Window.partitionBy(*group).orderBy("part", "is_cut"))
        parts = kept(parts.withColumn("last", F.col("below") + upto - 1).withColumn("first", F.col("last") - F.col("m") + 1))
        holds = open_.join(parts, group).filter(F.col("rank").between(F.col("first"), F.col("last")))
        settled = kept(settled.unionByName(holds.filter("is_cut or lo2 = hi2").select("key", "rank", F.col("lo2").alias("v"))))
        open_ = kept(holds.filter("not is_cut and lo2 < hi2").select("key", "hot", F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), "rank", F.col("first").alias("below")))
    if settled is None:
        settled = own.select("key", F.lit(0).cast("long").alias("rank"), "v").limit(0)
    values = lambda name: settled.select("key", F.col("rank").alias(f"{name}_rank"), F.col("v").alias(name))
    both = places.withColumn("low_rank", F.floor("at")).withColumn("high_rank", F.ceil("at")).join(values("low"), ["key", "low_rank"]).join(values("high"), ["key", "high_rank"])
    share = F.col("at") - F.col("low_rank")
    between = F.when(share == 0, F.col("low")).otherwise(F.col("low") + (F.col("high") - F.col("low")) * share)
    return both.select(*([F.col("key")[by].alias(by)] if by else []), "p", between.alias("value"))
