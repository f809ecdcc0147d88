"""Where everybody is: names resolved to points of a route, carried forward chapter by chapter.

A point is ``(leg, along)``, ordered as such. Resolving a name reads the point carried so far, so a track's chapters are
a fold, done as a segmented scan: blocks of chapters run side by side, and only a summary of each is run through in order.
The containment map and the route are small dimensions of one route, captured by the fold.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waymark.functions import text as K
from waymark.functions.lineage import kept

# Fixed values.
UNDER_WAY = 0.1
LOCAL, UNRESOLVED, ORPHAN, UNCONFIRMED = "local_interior", "unresolved_place", "unresolved_parent", "unconfirmed_place"
AMBIGUOUS, TRANSIT, INFERRED = "ambiguous_cycle_node", "in_transit", "inferred_from_places_visited"
KINDS = ("node", "micro", "local", "waypoint", "off_route", "unknown")
CLASSES = ("past", "here", "future", "cyclic", "off_route", "unknown")
SERIES = "track string, chapter int, leg int, along double, source string, place string, stated_at int, flags array<string>, evidence string"

Point = tuple[int, float]


@dataclass(frozen=True)
class Place:
    """What a key refers to: a node's indices, a parent, or a leg and how far along it."""

    kind: str
    nodes: tuple[int, ...] = ()
    parent: str | None = None
    leg: int | None = None
    along: float | None = None
    confirmed: bool = False


@dataclass(frozen=True)
class Route:
    last_leg: int
    places: dict[str, Place] = field(default_factory=dict)

    def node(self, index: int) -> Point:
        return (self.last_leg, 1.0) if index > self.last_leg else (index, 0.0)

    def resolve(self, key: str | None, held: Point | None) -> tuple[Point | None, list[str]]:
        """A key's point given the one carried so far, and what was noticed."""
        place = self.places.get(key)
        if place is None:
            return None, [UNRESOLVED]
        seen = [] if place.confirmed else [UNCONFIRMED]
        if place.kind == "local":
            return held, [*seen, LOCAL]
        if place.kind == "micro" and place.parent:
            if place.parent not in self.places:
                return None, [*seen, ORPHAN]
            place = self.places[place.parent]
        if place.kind == "waypoint" and place.leg is not None:
            return (place.leg, place.along or 0.0), seen
        points = sorted(map(self.node, place.nodes)) if place.kind == "node" else []
        onward = [p for p in points if held is None or p >= held]
        if onward or len(points) < 2:
            return next(iter(onward or points), None), seen
        return points[-1], [*seen, AMBIGUOUS]

    def appearance(self, at: str | None, start: str | None, end: str | None, held: Point | None) -> tuple[Point | None, list[str]]:
        """The point of somebody on stage: at a place, or between two of which either may be unsaid."""
        if at:
            return self.resolve(at, held)
        a, seen_a = self.resolve(start, held) if start else (None, [])
        b, seen_b = self.resolve(end, a or held) if end else (None, [])
        seen = seen_a + seen_b
        if not start and not end or (a is None and b is None and not (start and end)):
            return None, seen
        if not (start and end and a is None and b is None):
            seen = [x for x in seen if x != LOCAL] if end else seen
        seen = [*seen, TRANSIT]
        if start and end:
            return (middle(a, b) if a and b else b or a), seen
        if end:
            return (middle(held, b) if held else b), seen
        return (a[0], min(a[1] + UNDER_WAY, 1.0)), seen


def middle(a: Point, b: Point) -> Point:
    total = (sum(a) + sum(b)) / 2
    return int(total // 1), round(total - total // 1, 6)


def _chapter(route: Route, rows: list[dict], visited: list[dict], held: Point | None) -> dict | None:
    """A chapter's row for one track: the last real place, else the last interior, else the first place visited."""
    options = []
    for n, r in enumerate(rows):
        point, seen = route.appearance(r["at"], r["start"], r["end"], held)
        if point is not None:
            options.append((LOCAL not in seen, n, point, seen, r))
    if options:
        real, _, point, seen, r = max(options, key=lambda x: x[:2])
        name = r["at_name"] or r["end_name"] or (r["start_name"] if real else None)
        return {"point": point, "source": "stated" if real else "carried", "place": name, "flags": seen, "evidence": r["evidence"]}
    for v in visited if rows else []:
        if v["role"] != "setting":
            point, seen = route.resolve(v["key"], held)
            if point is not None:
                return {"point": point, "source": "inferred", "place": v["name"], "flags": [*seen, INFERRED], "evidence": v["evidence"]}
    return None


#: Chapters of a track that one task folds.
BLOCK = 4096
#: Chapters whose moves a task remembers.
KNOWN = 1 << 14
#: Rows of a batch that a task gives.
GIVEN = 4096
#: Two places within a leg: what only compares the carried point with stops does the same at both.
_WITHIN = (0.137, 0.731)


class Cells:
    """The carried points in cells: none, each stop's point, and what lies between. Resolving a name compares the carried
    point with stops only, so it does the same to all points of a cell: keeps them, or moves them to one place."""

    def __init__(self, route: Route) -> None:
        self.stops = sorted({route.node(i) for p in route.places.values() if p.kind == "node" for i in p.nodes})
        between = lambda leg: [(leg, x) for x in _WITHIN]
        self.members: list[list[Point | None]] = [[None], between(-1)]
        for stop in self.stops:
            self.members += [[stop], between(stop[0] if stop[1] == 0 else stop[0] + 1)]

    def of(self, held: Point | None) -> int:
        if held is None:
            return 0
        i = bisect.bisect_left(self.stops, held)
        return 2 + 2 * i if i < len(self.stops) and self.stops[i] == held else 1 + 2 * i


def _after(route: Route, rows: list[dict], there: list[dict], held: Point | None) -> Point | None:
    found = _chapter(route, rows, there, held)
    return found["point"] if found else held


def _moves(route: Route, cells: Cells, rows: list[dict], there: list[dict], known: dict | None = None) -> list[list] | None:
    """What a chapter does to each cell: ``[]`` keeps it, ``[point]`` moves it there; null if it reckons with the point.

    ``known`` holds what was found for the same names before.
    """
    same = (tuple((r["at"], r["start"], r["end"]) for r in rows), tuple((v["role"], v["key"]) for v in there))
    if known is not None and same in known:
        return known[same]
    out: list[list] | None = []
    for members in cells.members:
        after = [_after(route, rows, there, m) for m in members]
        if all(a is m for a, m in zip(after, members, strict=True)):
            out.append([])
        elif all(a == after[0] for a in after):
            out.append([after[0]])
        else:
            out = None
            break
    if known is not None:
        if len(known) >= KNOWN:
            known.clear()
        known[same] = out
    return out


def _summary(route: Route, cells: Cells, chapters: list[tuple[list[dict], list[dict]]], known: dict | None = None) -> list[dict]:
    """A block as steps from the point carried in to the one carried out.

    Chapters that only compare become one map of the cells, however many they are; a chapter that reckons with the carried
    point is a step of its own. Once a map moves all cells to one place, what was carried in no longer matters, and the rest
    of the block is folded.
    """
    steps: list[dict] = []
    moves: list[list] = [[] for _ in cells.members]
    for n, (rows, there) in enumerate(chapters):
        own = _moves(route, cells, rows, there, known) if rows else [[] for _ in cells.members]
        if own is None:
            steps += [{"moves": moves}, {"rows": rows, "there": there}]
            moves = [[] for _ in cells.members]
            continue
        moves = [own[k] if not m else own[cells.of(m[0])] or m for k, m in enumerate(moves)]
        if all(m and m[0] == moves[0][0] for m in moves):
            held = moves[0][0]
            for rows, there in chapters[n + 1 :]:  # noqa: PLW2901
                held = _after(route, rows, there, held) if rows else held
            return [{"moves": [[held]] * len(cells.members)}]
    return [*steps, {"moves": moves}]


def _through(route: Route, cells: Cells, steps: list[dict], held: Point | None) -> Point | None:
    for step in steps:
        if "moves" in step:
            to = step["moves"][cells.of(held)]
            held = held if not to else None if to[0] is None else (int(to[0][0]), float(to[0][1]))
        else:
            held = _after(route, step["rows"], step["there"], held)
    return held


def _grouped(batches: Iterator[pa.RecordBatch], by: Sequence[str]) -> Iterator[list[dict]]:
    """The rows of each group, where a group's rows follow one another, also from batch to batch."""
    own: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if own and any(own[0][c] != row[c] for c in by):
                yield own
                own = []
            own.append(row)
    if own:
        yield own


def _in_runs(rows: DataFrame, by: Sequence[str], order: str, run: Callable[[list[dict]], Iterable[tuple]], schema: str) -> DataFrame:
    """``run`` over the rows of each group in order, many groups a batch: no group costs a data frame of its own.

    The rows are numbered by a window, as that is what Spark has to keep a group in one task for, and in order. A
    repartition by the same keys as a join below is left out by the planner, and the join may then be read by mappers
    or in parts, so that a group is in several tasks.
    """
    fields = T.StructType.fromDDL(schema)
    kinds = to_arrow_schema(fields)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for own in _grouped(batches, by):
            out += run(own)
            if len(out) >= GIVEN:
                yield _batch(out, kinds)
                out = []
        if out:
            yield _batch(out, kinds)

    number = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    return rows.withColumn("_number", number).mapInArrow(groups, fields)


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)


def resolve_positions(on_stage: DataFrame, visited: DataFrame, chapters: DataFrame, tracks: DataFrame, route: Route, block: int = BLOCK) -> DataFrame:
    """The dense series: a row for every track and chapter.

    ``on_stage``: ``chapter, seq, track, at, start, end`` (keys), ``at_name, start_name, end_name, evidence``;
    ``visited``: ``chapter, seq, key, name, role, evidence``; ``chapters``: ``chapter``; ``tracks``: ``track``.

    A segmented scan: blocks of ``block`` chapters of a track are each summarised as what they do to the point carried in,
    a track's summaries (a row a block) are run through in order, and then each block is folded from the point that it
    gets. So no task has a track whole, however long it is.
    """
    item = F.struct("seq", *[c for c in on_stage.columns if c not in ("chapter", "seq", "track")])
    mine = on_stage.groupBy("track", "chapter").agg(F.sort_array(F.collect_list(item)).alias("rows"))
    seen = visited.groupBy("chapter").agg(F.sort_array(F.collect_list(F.struct("seq", "key", "name", "role", "evidence"))).alias("visited"))
    every = tracks.select("track").crossJoin(F.broadcast(chapters.select("chapter")))
    number = F.floor(F.col("chapter") / block).alias("block")
    grid = every.join(mine, ["track", "chapter"], "left").join(seen, "chapter", "left").select("*", number)
    blocks = chapters.select(number).distinct()
    cells = Cells(route)

    def summarise(known: dict | None, group: list[dict]) -> list[tuple]:
        steps = _summary(route, cells, [(r["rows"] or [], r["visited"] or []) for r in group], known)
        return [(group[0]["track"], group[0]["block"], json.dumps(steps, default=int))]

    def enter(group: list[dict]) -> Iterator[tuple]:
        held = None
        for r in group:
            yield r["track"], r["block"], json.dumps(held)
            held = _through(route, cells, json.loads(r["steps"]), held)

    def fold(group: list[dict]) -> Iterator[tuple]:
        start = json.loads(group[0]["entered"])
        held, since = start and (int(start[0]), float(start[1])), None
        for r in group:
            rows = r["rows"] or []
            found = _chapter(route, rows, r["visited"] or [], held)
            if found is None:
                flags = ["on_stage_unplaced"] if rows and held else []
                found = {"point": held, "source": "carried" if held else "unknown", "place": None, "flags": flags, "evidence": None}
            if found["source"] in ("stated", "inferred"):
                since = r["chapter"]
            held = found["point"]
            yield r["track"], r["chapter"], held and held[0], held and float(held[1]), found["source"], found["place"], since if held else None, found["flags"], found["evidence"], r["block"]

    # a block of chapters in which a track isn't on stage changes nothing, and what the last block does nobody needs
    passed = grid.filter("rows is not null").join(F.broadcast(blocks.agg(F.max("block").alias("_end"))), F.col("block") < F.col("_end")).drop("_end")
    entered = _in_runs(passed, ["track", "block"], "chapter", partial(summarise, {}), "track string, block long, steps string")
    entered = tracks.select("track").distinct().crossJoin(F.broadcast(blocks)).join(entered, ["track", "block"], "left").withColumn("steps", F.coalesce("steps", F.lit("[]")))
    entered = _in_runs(entered, ["track"], "block", enter, "track string, block long, entered string")
    folded = kept(_in_runs(grid.join(entered, ["track", "block"]), ["track", "block"], "chapter", fold, SERIES + ", block long"))
    # when a point was last stated: in the block itself, or else in the last one before that has any
    last = folded.groupBy("track", "block").agg(F.max("stated_at").alias("last"))
    before = Window.partitionBy("track").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = last.select("track", "block", F.max("last").over(before).alias("earlier"))
    out = folded.join(last, ["track", "block"]).withColumn("stated_at", F.when(F.col("leg").isNotNull(), F.coalesce("stated_at", "earlier")))
    return out.drop("block", "earlier")


def temporal_class(points: Column, now: Column, known: Column, local: Column) -> Column:
    """Where a mentioned place is: every point that it may be (an array), against the party's point."""
    return (
        F.when(~known, "unknown")
        .when(local, F.when(now.isNotNull(), "here").otherwise("unknown"))
        .when(F.size(points) <= 0, "off_route")
        .when(now.isNull(), "unknown")
        .when(F.exists(points, lambda p: p == now), "here")
        .when(F.forall(points, lambda p: p < now), "past")
        .when(F.forall(points, lambda p: p > now), "future")
        .otherwise("cyclic")
    )


def step_checks(series: DataFrame, lead: str, last_leg: int, final_chapter: int) -> DataFrame:
    """``(severity, track, chapter, rule)``: how a series moves that it shouldn't, or that is worth a look."""
    point = F.struct("leg", "along")
    stated = series.filter((F.col("source") == "stated") & F.col("leg").isNotNull()).withColumn("point", point)
    order = Window.partitionBy("track").orderBy("chapter")
    steps = stated.withColumn("before", F.lag("point").over(order)).filter("before is not null")
    rule = F.when(F.col("point") < F.col("before"), "moves_backwards").when(F.col("leg") - F.col("before.leg") > 1, "jumps_legs")
    warnings = steps.select("track", "chapter", rule.alias("rule")).filter("rule is not null")
    never = series.select("track").distinct().join(stated.select("track"), "track", "left_anti").select("track", F.lit(None).cast("int").alias("chapter"), F.lit("never_placed").alias("rule"))
    head = series.filter(F.col("track") == lead).select("chapter", point.alias("lead"))
    apart = series.filter((F.col("track") != lead) & F.col("leg").isNotNull()).join(head, "chapter").filter(F.col("lead.leg").isNotNull())
    apart = apart.select("track", "chapter", F.when(point > F.col("lead"), "ahead_of_lead").when(point != F.col("lead"), "apart_from_lead").alias("rule")).filter("rule is not null")
    lost = series.select("track", "chapter", F.explode("flags").alias("rule")).filter(F.col("rule").isin(UNRESOLVED, ORPHAN))
    closing = F.struct(F.lit(last_leg).alias("leg"), F.lit(1.0).alias("along"))
    ends = series.filter((F.col("track") == lead) & (F.col("chapter") == final_chapter) & F.col("leg").isNotNull() & (point != closing)).select("track", "chapter", F.lit("not_at_closing_node").alias("rule"))
    problems = ends.unionByName(lost).withColumn("severity", F.lit("problem"))
    return problems.unionByName(warnings.unionByName(never).unionByName(apart).withColumn("severity", F.lit("warning"))).select("severity", "track", "chapter", "rule")


def coverage(series: DataFrame) -> DataFrame:
    return series.groupBy("track").agg(F.count_if(F.col("source") == "stated").alias("stated"), F.count("*").alias("total"))


def series_rows(series: DataFrame) -> DataFrame:
    """The series as review rows, all strings: key "NN:track", three decimals, evidence cut at 160 characters."""
    return series.select(
        F.format_string("%02d:%s", "chapter", "track").alias("key"), F.col("chapter").cast("string").alias("chapter"), "track", F.coalesce(F.col("leg").cast("string"), F.lit("")).alias("leg"),
        F.when(F.col("along").isNull(), "").otherwise(K.fixed(F.col("along"), 3)).alias("along"), F.coalesce("place", F.lit("")).alias("place_name_in_text"), "source",
        F.coalesce(F.col("stated_at").cast("string"), F.lit("")).alias("stated_at_chapter"), F.array_join("flags", ";").alias("flags"), F.substring(F.coalesce("evidence", F.lit("")), 1, 160).alias("evidence"),
    )


def node_label(leg: Column, along: Column, names: Column) -> Column:
    """The name of the stop that a point lies on exactly, else null; ``names``: the stops' names in order."""
    last = F.size(names) - 2
    return F.when(along == 0, F.get(names, leg)).when((leg == last) & (along == 1), F.get(names, last + 1))


def classify_mentions(mentions: DataFrame, series: DataFrame, lead: str, route: Route) -> DataFrame:
    """``mentions`` (``chapter, key, ...``) with ``class``: where each place that is named lies, seen from the lead's point.

    A stop that the route has twice has two points, an interior its parent's, a waypoint its own.
    """

    def points(place: Place) -> list[Point]:
        if place.kind == "micro" and place.parent in route.places:
            return points(route.places[place.parent])
        if place.kind == "waypoint" and place.leg is not None:
            return [(place.leg, place.along or 0.0)]
        return [route.node(i) for i in place.nodes] if place.kind == "node" else []

    rows = [(k, [(leg, float(along)) for leg, along in points(p)], p.kind == "local") for k, p in route.places.items()]
    known = mentions.sparkSession.createDataFrame(rows, "key string, points array<struct<leg:int,along:double>>, local boolean")
    now = series.filter(F.col("track") == lead).select("chapter", F.when(F.col("leg").isNotNull(), F.struct("leg", "along")).alias("now"))
    both = mentions.join(F.broadcast(known), "key", "left").join(now, "chapter", "left")
    place = temporal_class(F.col("points"), F.col("now"), F.col("local").isNotNull(), F.coalesce("local", F.lit(False)))
    return both.select(*[c for c in mentions.columns], place.alias("class"))


def carried(rows: DataFrame, by: str, order: Sequence[str], values: Sequence[str], stated: Column) -> DataFrame:
    """``rows`` with each value as last stated at or before the row: ``carried_<value>``; for facts that need no fold."""
    over = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("*", *[F.last(F.when(stated, F.col(v)), ignorenulls=True).over(over).alias(f"carried_{v}") for v in values])


def dense(rows: DataFrame, keys: DataFrame, times: DataFrame) -> DataFrame:
    """Every key at every time, with the rows there are; ``times`` is one text's chapters or one calendar, and broadcast."""
    return keys.crossJoin(F.broadcast(times)).join(rows, [*keys.columns, *times.columns], "left")
