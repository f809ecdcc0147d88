"""Review tables: every cell is a string, machines propose, and what a person wrote is kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import text as K

HUMAN = ("confirmed", "note")
CORRECTED = "corrected_"


def _cell(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def merge_rows(existing: DataFrame, proposed: DataFrame, key: str, columns: Sequence[str], human: Sequence[str] = HUMAN) -> DataFrame:
    """A full outer merge: machine columns from the proposal, a person's columns from the existing row.

    Corrections (``corrected_*``) that are filled are the person's; keys that only exist stay as they are. Refuses an
    existing table without the person's columns.
    """
    if lost := [c for c in human if c in columns and c not in existing.columns]:
        raise ValueError(f"merging would lose {', '.join(lost)}")
    old, new = existing.alias("old"), proposed.alias("new")
    has = lambda side, frame, c: F.col(f"{side}.{c}") if c in frame.columns else F.lit(None).cast("string")

    def pick(c: str) -> Column:
        was, now = has("old", existing, c), has("new", proposed, c)
        if c in human:
            value = F.when(F.col(f"old.{key}").isNotNull(), was).otherwise(now)
        elif c.startswith(CORRECTED):
            value = F.when(F.coalesce(was, F.lit("")) != "", was).otherwise(now)
        else:
            value = F.when(F.col(f"new.{key}").isNotNull(), now).otherwise(was)
        return F.coalesce(value, F.lit("")).alias(c)

    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    return joined.select(F.coalesce(f"old.{key}", f"new.{key}").alias(key), *[pick(c) for c in columns if c != key])


def carry_unowned(existing: DataFrame, proposed: DataFrame, key: str, owned: Sequence[str]) -> DataFrame:
    """Proposals laid over existing rows: owned columns always overwrite, other stages' columns survive."""
    extra = [c for c in existing.columns if c not in owned and c != key]
    old = existing.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_old_{c}") for c in extra])
    joined = proposed.join(old, proposed[key] == old["_key"], "left")
    kept = [F.coalesce(F.col(f"_old_{c}"), proposed[c] if c in proposed.columns else F.lit("")).alias(c) for c in extra]
    return joined.select(proposed[key], *[proposed[c] for c in owned if c != key], *kept)


def orphans(existing: DataFrame, proposed: DataFrame, key: str) -> DataFrame:
    """Keys that are no longer proposed."""
    return existing.select(key).join(proposed.select(key), key, "left_anti")


def untouched(columns: Sequence[str], human: Sequence[str] = HUMAN) -> Column:
    own = [c for c in columns if c in human or c.startswith(CORRECTED)]
    return K.strip(F.concat_ws("", *[_cell(c) for c in own])) == "" if own else F.lit(True)


def prune(existing: DataFrame, proposed: DataFrame, key: str, human: Sequence[str] = HUMAN) -> DataFrame:
    """Existing rows without the orphans that no person has touched."""
    gone = orphans(existing, proposed, key).withColumn("_gone", F.lit(True))
    return existing.join(gone, key, "left").filter(~(F.coalesce("_gone", F.lit(False)) & untouched(existing.columns, human))).drop("_gone")


def summarise(table: DataFrame, column: str = "confirmed") -> DataFrame:
    """One row: ``total, confirmed, rejected, unchecked``."""
    status = K.review_status(_cell(column))
    return table.agg(*[F.count("*").alias("total"), F.count_if(status == "confirmed").alias("confirmed"), F.count_if(status == "rejected").alias("rejected"), F.count_if(status == "unconfirmed").alias("unchecked")])
