"""A fold over ordered rows whose state is one of a few, as a segmented scan: no key's rows are in one task.

What a row does is a map of the states: where each of them goes. Maps compose, so a run of rows is one map. Rows are dealt
by ranges of key and order; every range gives one map for each key in it, those are run through in order, and then each
range is folded from the state that it gets.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.lineage import kept


def state_scan(rows: DataFrame, by: str, order: Sequence[str], moves: Column, states: int, first: int = 0) -> DataFrame:
    """``rows`` with ``state``: the state (0 to ``states - 1``) after each row of a key, in order, from ``first`` on.

    ``moves`` is an array of ``states`` numbers: the state that the row leads to from each. ``order`` should tell a key's
    rows apart; rows that it doesn't tell apart are folded in any order. A null key is a key.
    """
    own = rows.columns
    parts = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    dealt = rows.withColumn("_moves", moves.cast("array<int>")).withColumn("_by", F.struct(by)).repartitionByRange(parts, by, *order).sortWithinPartitions(by, *order)
    dealt = kept(dealt.withColumn("_part", F.spark_partition_id()))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows of a key follow one another; at the end of a batch its map so far is given, with the batch's number
        for n, batch in enumerate(batches):
            keys, parts = batch.column("_by").to_pylist(), batch.column("_part").to_pylist()
            found: list[tuple] = []
            for i, (key, part, own_moves) in enumerate(zip(keys, parts, batch.column("_moves").to_pylist(), strict=True)):
                if not found or found[-1][0] != key:
                    found.append((key, i, part, list(range(states))))
                found[-1][3][:] = [own_moves[s] for s in found[-1][3]]
            at = [f[1] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_by").take(pa.array(at, pa.int64())), pa.array([f[2] for f in found], pa.int32()), pa.array([n] * len(found), pa.int32()), pa.array([f[3] for f in found], pa.list_(pa.int32()))],
                names=["_by", "_part", "n", "map"],
            )

    kind = f"_by {dict(dealt.dtypes)['_by']}, _part int"
    maps = dealt.select("_by", "_part", "_moves").mapInArrow(summarise, f"{kind}, n int, map array<int>")
    composed = F.array_sort(F.collect_list(F.struct("_part", "n", "map")))
    # a row a range and key: what is run through here is as long as there are ranges, not rows
    steps = maps.groupBy("_by").agg(composed.alias("steps"))
    start = F.struct(F.lit(first).alias("state"), F.array().cast("array<struct<part:int,state:int>>").alias("entered"))

    def through(s: Column, step: Column) -> Column:
        again = F.try_element_at(s["entered"], F.lit(-1))["part"].eqNullSafe(step["_part"])
        entered = F.when(again, s["entered"]).otherwise(F.array_append(s["entered"], F.struct(step["_part"].alias("part"), s["state"].alias("state"))))
        return F.struct(F.get(step["map"], s["state"]).alias("state"), entered.alias("entered"))

    entered = steps.select("_by", F.explode(F.aggregate("steps", start, through, lambda s: s["entered"])).alias("e")).select("_by", F.col("e.part").alias("_part"), F.col("e.state").alias("_state"))
    same = dealt["_by"].eqNullSafe(entered["_by"]) & (dealt["_part"] == entered["_part"])
    joined = dealt.join(entered, same).select(*[dealt[c] for c in own], dealt["_by"], dealt["_part"], "_moves", "_state")

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in order])
        state, out = table.column("_state")[0].as_py(), []
        for own_moves in table.column("_moves").to_pylist():
            state = own_moves[state]
            out.append(state)
        return table.select(own).append_column("state", pa.array(out, pa.int32()))

    fields = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    return joined.groupBy("_by", "_part").applyInArrow(fold, f"{fields}, state int")
