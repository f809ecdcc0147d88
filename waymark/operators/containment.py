"""What contains what, to any depth: pointer jumping over a table of parents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.lineage import kept


def containment(parents: DataFrame, key: str = "key", parent: str = "parent") -> DataFrame:
    """``(key, root, depth, problem)`` of every key: what holds it in the end, and over how many steps.

    A key without a parent is its own root, at depth 0. ``problem`` is ``orphan`` where the chain ends at a parent that the
    table doesn't have (which is then the root), and ``cycle`` where it never ends (root and depth are null).

    Each round doubles the steps that every pointer spans, so a chain of d steps takes about log2(d) rounds, each of them an
    equi-join whose right side has a row a key. A chain that ends has a key at every depth, so some arrive in every round
    that it isn't done; keys on a cycle, or leading to one, are those left when a round lets none arrive. Of rows that repeat a key the smallest parent counts; null keys are left out; an empty table gives an empty
    result.
    """
    rows = parents.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(parent).alias("up"))
    known = rows.select(F.col("key").alias("up"), F.lit(True).alias("_known"))
    rows = rows.join(known, "up", "left").select(
        "key", F.coalesce("up", "key").alias("up"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth"),
        F.when(F.col("up").isNull() | F.col("_known").isNull(), True).otherwise(False).alias("done"), (F.col("up").isNotNull() & F.col("_known").isNull()).alias("orphan"),
    )
    rows = kept(rows)
    left = rows.filter("not done").count()
    while left:
        # where a pointer leads to a key that has arrived, it arrives there too; else it spans twice as much
        ahead = rows.select(F.col("key").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"), F.col("done").alias("done2"), F.col("orphan").alias("orphan2"))
        moved = rows.filter("not done").join(ahead, "up").select("key", F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth"), F.col("done2").alias("done"), F.col("orphan2").alias("orphan"))
        rows = kept(rows.filter("done").unionByName(moved))
        before, left = left, rows.filter("not done").count()
        if left == before:
            break
    problem = F.when(~F.col("done"), "cycle").when(F.col("orphan"), "orphan")
    return rows.select(F.col("key").alias(key), F.when(F.col("done"), F.col("up")).alias("root"), F.when(F.col("done"), F.col("depth")).alias("depth"), problem.alias("problem"))


def inherited(rows: DataFrame, held: DataFrame, values: list[str], key: str = "key") -> DataFrame:
    """``rows`` (with ``root`` of ``containment``) with the values of the root: a place within a place is where that is."""
    own = held.select(F.col(key).alias("root"), *[F.col(v).alias(f"root_{v}") for v in values])
    return rows.join(own, "root", "left").select(*rows.columns, *[f"root_{v}" for v in values])
