"""Where everybody is, while chapters arrive: the last stated point carried forward, and steps that look wrong.

A track's state is what was stated in its last ``horizon`` chapters, and the last point before them. Rows may come in any
order: one that isn't older than the horizon is put in its place, and what follows it is given again, so the last row of a
track and chapter is the one that counts. Older rows are refused, and say so.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SERIES = "track string, chapter int, leg int, along double, stated_at int, rule string, version long"
LATE = "late"
#: The state store that processors of this kind need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _rule(point: Column, before: Column) -> Column:
    return F.when(point < before, "moves_backwards").when(point["leg"] - before["leg"] > 1, "jumps_legs")


def carried_series(rows: DataFrame) -> DataFrame:
    """``(track, chapter, leg, along, stated_at, rule)`` of rows ``(track, chapter, leg, along)``, one a track and chapter:
    the point last stated (null where nothing was), the chapter that stated it, and how a stated point moves wrongly."""
    stated = F.when(F.col("leg").isNotNull(), F.struct("leg", F.coalesce("along", F.lit(0.0)).alias("along"), F.col("chapter").alias("stated_at")))
    order = Window.partitionBy("track").orderBy("chapter")
    last = lambda over: F.last("_stated", ignorenulls=True).over(over)
    both = rows.withColumn("_stated", stated).withColumn("_now", last(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_before", last(order.rowsBetween(Window.unboundedPreceding, -1)))
    point = lambda c: F.struct(F.col(c)["leg"].alias("leg"), F.col(c)["along"].alias("along"))
    rule = F.when(F.col("_stated").isNotNull() & F.col("_before").isNotNull(), _rule(point("_stated"), point("_before")))
    return both.select("track", "chapter", "_now.leg", "_now.along", "_now.stated_at", rule.alias("rule"))


class _Carry(StatefulProcessor):
    def __init__(self, horizon: int) -> None:
        self.horizon = horizon

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("track", "state string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = json.loads(self.state.get()[0]) if self.state.exists() else {"base": None, "recent": [], "newest": None, "version": 0}
        recent = {c: p for c, p in held["recent"]}
        out, first = [], None
        new = [r for part in rows for r in zip(part["chapter"].tolist(), part["leg"].tolist(), part["along"].tolist(), strict=True)]
        for chapter, leg, along in sorted(new, key=lambda r: r[0]):
            chapter = int(chapter)
            if held["newest"] is not None and chapter <= held["newest"] - max(self.horizon, 1):
                out.append((key[0], chapter, None, None, None, LATE, held["version"]))
                continue
            point = None if leg is None or pd.isna(leg) else [int(leg), 0.0 if along is None or pd.isna(along) else float(along), chapter]
            if chapter in recent and self.horizon <= 0:
                out.append((key[0], chapter, None, None, None, LATE, held["version"]))
                continue
            recent[chapter] = point
            first = chapter if first is None else min(first, chapter)
            held["newest"] = chapter if held["newest"] is None else max(held["newest"], chapter)
            self.emit(key[0], recent, held, first, out)
            first = None
        self.state.update((json.dumps({**held, "recent": sorted(recent.items())}),))
        yield pd.DataFrame(out, columns=["track", "chapter", "leg", "along", "stated_at", "rule", "version"]).astype({"leg": "Int32", "stated_at": "Int32"})

    def emit(self, track: str, recent: dict, held: dict, first: int, out: list) -> None:
        """Rows from chapter ``first`` on, and what has left the horizon made part of the base."""
        held["version"] += 1
        last = held["base"]
        for chapter in sorted(recent):
            point = recent[chapter]
            if chapter >= first:
                now = point or last
                rule = None
                if point and last:
                    rule = "moves_backwards" if point[:2] < last[:2] else "jumps_legs" if point[0] - last[0] > 1 else None
                out.append((track, chapter, now and now[0], now and now[1], now and now[2], rule, held["version"]))
            last = point or last
        for chapter in sorted(c for c in recent if c <= held["newest"] - max(self.horizon, 1)):
            held["base"] = recent.pop(chapter) or held["base"]

    def close(self) -> None:
        pass


def carry_stream(rows: DataFrame, horizon: int = 0) -> DataFrame:
    """``carried_series`` of a stream, in update mode, with ``version``: of the rows of a track and chapter the one of the
    highest version counts. ``rule`` is ``late`` for rows refused: older than ``horizon`` chapters before the newest, or,
    with a horizon of 0, not newer than it. A row that repeats a chapter within the horizon takes its place.

    The session needs ``spark.sql.streaming.stateStore.providerClass`` to be ``STORE``.
    """
    return rows.groupBy("track").transformWithStateInPandas(_Carry(horizon), SERIES, "update", "none")


def latest(emitted: DataFrame) -> DataFrame:
    """The series that the rows of ``carry_stream`` amount to, without those refused."""
    fields = [c for c in ("leg", "along", "stated_at", "rule")]
    kept = emitted.filter(~F.col("rule").eqNullSafe(F.lit(LATE)))
    best = kept.groupBy("track", "chapter").agg(F.max_by(F.struct(*fields), "version").alias("r"))
    return best.select("track", "chapter", "r.*")
