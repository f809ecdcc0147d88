"""Place names resolved against candidates: merge of a fan-out, scores, the best and how sure it is."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.functions import text as K
from waymark.functions.lineage import kept

# Fixed values.
HALF_LIFE_KM = 500.0
NOT_A_PLACE = ("Q5", "Q11424", "Q7725634", "Q571", "Q4830453", "Q476028", "Q215380", "Q11446", "Q2235308")
LOW, CONTESTED, FAR_KM = 0.7, 0.85, 1000.0
#: Sides of the cells that pairs are made in, and pairs of a task.
PLACES, CANDIDATES, PAIRS = 1024, 4096, 1 << 21
#: Sides of the cells that are searched on a ring.
RING_PLACES, RING_CANDIDATES = 1 << 16, 1 << 17


def merge_candidates(rows: DataFrame, by: Sequence[str] = ("qid",), seq: str = "seq", alias: str = "alias", type_id: str = "type_id") -> DataFrame:
    """One row per candidate: aliases in first-seen order, each once, joined by " | ".

    The rest is the first row's, or that of the first row with a class if the first has none.
    """
    others = [c for c in rows.columns if c not in (*by, alias)]
    seen = F.sort_array(F.collect_list(F.when(F.coalesce(F.col(alias), F.lit("")) != "", F.struct(seq, alias))))
    row = F.min_by(F.struct(*others), F.struct(F.col(type_id).isNull(), F.col(seq)))
    merged = rows.groupBy(*by).agg(seen.alias("_seen"), row.alias("_row"))
    joined = F.array_join(F.array_distinct(F.transform("_seen", lambda x: x[alias])), " | ")
    return merged.select(*by, joined.alias("aliases"), *[F.col(f"_row.{c}").alias(c) for c in others])


def is_place(type_id: Column) -> Column:
    return ~F.coalesce(type_id.isin(*NOT_A_PLACE), F.lit(False))


def name_score(ratio: Column, exact: Column) -> Column:
    """1 for the same key, then by the best ratio (0 to 100) over label and aliases."""
    return F.when(exact, 1.0).when(ratio >= 90, 0.8).when(ratio >= 75, 0.5).otherwise(0.2)


def route_score(km: Column) -> Column:
    return F.coalesce(F.lit(HALF_LIFE_KM) / (F.lit(HALF_LIFE_KM) + km), F.lit(0.0))


def prominence(sitelinks: Column) -> Column:
    return F.least(F.lit(1.0), F.log10(F.lit(1.0) + F.greatest(F.coalesce(sitelinks, F.lit(0)), F.lit(0))) / 2.5)


def _spellings(labels: Column) -> Column:
    """The match keys of an array of spellings, each once, in one string; null if there is none."""
    keys = F.array_distinct(F.transform(K.nfc_each(F.array_compact(labels)), lambda x: K.match_key(x, nfc=False)))
    return F.when(F.size(keys) > 0, F.array_join(keys, "\u0000"))


def _score(key: Column, spellings: Column) -> Column:
    ratio = K.best_ratio(key, spellings)
    # only equal keys have a ratio of 100
    return name_score(F.coalesce(ratio, F.lit(0.0)), F.coalesce(ratio == 100, F.lit(False)))


def score_names(pairs: DataFrame, name: str = "name", labels: str = "labels") -> DataFrame:
    """``pairs`` with ``name_score`` of a name against an array of spellings."""
    return pairs.withColumn("name_score", _score(K.match_key(F.col(name)), _spellings(F.col(labels))))


def best_candidate(scored: DataFrame, by: Sequence[str], qid: str = "qid", rounded: Callable[[Column], Column] = lambda x: F.bround(x, 2)) -> DataFrame:
    """The best candidate of each group by ``gate, name, route, prominence``, ties to the largest id, with ``confidence``.

    Confidence: a weighted score, lowered where the runner-up is close; 0 where the best is no place. Only the first two
    of a group count: every task keeps those alone of what it has, and nothing else is shuffled.
    """
    order = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in ("gate", "name", "route", "prominence", qid)])
    first = scored.withColumn("_rank", F.row_number().over(order)).filter("_rank <= 2")
    ranked = first.withColumn("_name", F.lead("name").over(order)).withColumn("_route", F.lead("route").over(order))
    margin = F.when(F.col("_name").isNull(), 1.0).otherwise((F.col("name") - F.col("_name")) + 0.5 * (F.col("route") - F.col("_route")))
    base = 0.70 * F.col("name") + 0.20 * F.col("route") + 0.10 * F.col("prominence")
    sure = base * (0.55 + 0.45 * F.least(F.lit(1.0), 4 * F.greatest(F.lit(0.0), margin)))
    confidence = F.when(F.col("gate") == 0, 0.0).otherwise(rounded(F.least(F.lit(1.0), F.greatest(F.lit(0.0), sure))))
    return ranked.filter("_rank = 1").withColumn("confidence", confidence).drop("_rank", "_name", "_route")


def pairs_in_cells(places: DataFrame, candidates: DataFrame, by: str, key: str) -> DataFrame:
    """Every place with every candidate of the same ``by``, made in cells of at most about ``PLACES`` by ``CANDIDATES``.

    A ``by`` that very many share is in many cells, and a task has some ``PAIRS`` pairs, so what it sorts or counts fits its
    memory. Pairs of a place follow one another, places in order of ``key``. Only the rows of both sides are shuffled.
    """
    own, theirs, sizes = _in_cells(places, candidates, [by], key, PLACES, CANDIDATES)
    total = sizes.agg(F.sum(F.col("_n") * F.col("_m"))).first()[0] or 0
    parts = max(places.sparkSession.sparkContext.defaultParallelism, math.ceil(total / PAIRS))
    cell = [by, "_i", "_j"]
    own = own.repartition(parts, *cell).sortWithinPartitions(key)
    theirs = theirs.repartition(parts, *cell)
    return own.join(theirs.hint("shuffle_hash"), cell).drop("_i", "_j")


def _in_cells(places: DataFrame, candidates: DataFrame, by: Sequence[str], key: str, most: int, most_candidates: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both sides with the cells (``by, _i, _j``) that they are in, and the sizes of every ``by``."""
    many = places.groupBy(*by).agg(F.count("*").alias("_n")).join(candidates.groupBy(*by).agg(F.count("*").alias("_m")), [*by])
    sizes = kept(many.select(*by, "_n", "_m", F.ceil(F.col("_n") / most).cast("int").alias("_p"), F.ceil(F.col("_m") / most_candidates).cast("int").alias("_c")))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = places.join(sizes, [*by]).withColumn("_i", F.pmod(F.xxhash64(key), F.col("_p")).cast("int")).withColumn("_j", upto("_c"))
    theirs = candidates.join(sizes, [*by]).withColumn("_j", F.pmod(F.xxhash64(*candidates.columns), F.col("_c")).cast("int")).withColumn("_i", upto("_p"))
    size = ["_n", "_m", "_p", "_c"]
    return own.drop(*size), theirs.drop(*size), sizes


def leading(candidates: DataFrame, by: Sequence[str], levels: Sequence[str], enough: int = 2) -> DataFrame:
    """The candidates of each ``by`` that can be among its first ``enough`` in order of ``levels``, descending, with ``level``,
    from 1: those of levels before which there are fewer than ``enough``."""
    order = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in levels])
    before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = candidates.groupBy(*by, *levels).agg(F.count("*").alias("_n"))
    wanted = sizes.select(*by, *levels, F.row_number().over(order).alias("level"), before.alias("_before")).filter(F.col("_before") < enough)
    return candidates.join(wanted.drop("_before"), [*by, *levels])


def two_nearest_on_ring(places: DataFrame, candidates: DataFrame, by: Sequence[str], key: str, qid: str, ring: int) -> DataFrame:
    """``(key, qid)``: of each ``level`` of the candidates (``by, level, qid, at``) at least the two that are nearest to a place
    (``by, key, at``), by ``abs(at - at) % ring``, ties to the larger ``qid``. All numbers are whole; without ``at``, no row.

    Places and candidates of a ``by`` are in cells, of which each gives its own two. In a cell candidates are in order of
    ``at``, and those at or before a place are some of 2, 4, 8 ... neighbours; of each of these, in order of the ring,
    the nearest two are found by bisection, and likewise those after it. So no pairs are made: it takes as long as both
    sides have rows, by the square of a logarithm.
    """
    long = lambda c: F.col(c).cast("long").alias(c)
    own, theirs, _ = _in_cells(places.filter("at is not null").select(*by, long(key), long("at")), candidates.filter("at is not null").select(*by, "level", long(qid), long("at")), by, key, RING_PLACES, RING_CANDIDATES)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        here, u = (left.column(c).to_numpy() for c in (key, "at"))
        level, ids, v = (right.column(c).to_numpy() for c in ("level", qid, "at"))
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for one in np.unique(level) if len(here) else []:
            at = np.flatnonzero(level == one)
            for found in nearest_on_ring(u, v[at], ids[at], ring):
                out.append((here[found >= 0], ids[at][found[found >= 0]]))
        columns = [np.concatenate([*(x[k] for x in out), np.zeros(0, np.int64)]) for k in (0, 1)]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[key, qid])

    cell = [*by, "_i", "_j"]
    return own.groupBy(*cell).cogroup(theirs.groupBy(*cell)).applyInArrow(search, f"`{key}` long, `{qid}` long")


def nearest_on_ring(u: np.ndarray, v: np.ndarray, ids: np.ndarray, ring: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``u`` the places in ``v`` of the nearest and the next by ``abs(u - v) % ring``, ties to the larger id; -1 if there is none."""
    best = np.full((2, len(u)), -1, np.int64)
    far = np.full((2, len(u)), ring, np.int64)

    def offer(rows: np.ndarray, at: np.ndarray) -> None:
        km = np.abs(u[rows] - v[at]) % ring
        for k in (0, 1):  # what is displaced as the first is offered as the second
            old, old_km = best[k, rows], far[k, rows]
            nearer = (km < old_km) | ((km == old_km) & (ids[at] > ids[old]))
            best[k, rows], far[k, rows] = np.where(nearer, at, old), np.where(nearer, km, old_km)
            at, km = np.where(nearer, old, at), np.where(nearer, old_km, km)
            rows, at, km = rows[at >= 0], at[at >= 0], km[at >= 0]

    def before(u: np.ndarray, v: np.ndarray, side: str) -> None:
        """Offers the nearest two of each run of neighbours that makes up what lies before."""
        order = np.lexsort((ids, v))
        count = np.searchsorted(v[order], u, side)
        turn, turned = v[order] % ring, u % ring
        for h in range(len(v).bit_length()):
            rows = np.flatnonzero(count >> h & 1)
            if not len(rows):
                continue
            run = np.arange(len(v)) >> h
            own = np.lexsort((ids[order], turn, run))
            mine = (count[rows] >> h) - 1
            at = np.searchsorted(run[own] * ring + turn[own], mine * ring + turned[rows], "right") - 1
            first, last = mine << h, (mine + 1 << h) - 1
            at = np.where(at < first, last, at)
            offer(rows, order[own[at]])
            if h:
                offer(rows, order[own[np.where(at == first, last, at - 1)]])

    before(u, v, "right")
    before(-u, -v, "left")
    return best[0], best[1]


def resolve(places: DataFrame, candidates: DataFrame, anchors: DataFrame, key: str = "key", by: str | None = None) -> DataFrame:
    """Each place (``key, name, hint``) with its best candidate's columns and a ``why``; without candidates, nulls.

    ``candidates``: ``key, qid, label, aliases, lat, lon, type_id, sitelinks``; with ``by``, a column that places and
    candidates have, instead of the key: places that share it have the same candidates. ``anchors``: ``lat, lon``, few: they
    are the located stops of one route, and come as one array.

    What a candidate is worth is made once for each of them, and a name among the same candidates is resolved once, however
    many places have it.
    """
    by = by or key
    near = anchors.agg(F.collect_list(F.array("lat", "lon")).alias("_near"))
    own = candidates.join(F.broadcast(near)).withColumn("labels", F.concat(F.array("label"), F.filter(F.split(F.coalesce("aliases", F.lit("")), r" \| "), lambda x: x != "")))
    own = own.withColumn("route", route_score(geo.nearest_km(F.col("lat"), F.col("lon"), F.col("_near")))).withColumn("gate", is_place(F.col("type_id")).cast("double"))
    own = own.select(F.col(by).alias("_by"), F.monotonically_increasing_id().alias("_candidate"), "qid", "label", "lat", "lon", "gate", "route", prominence(F.col("sitelinks")).alias("prominence"), _spellings(F.col("labels")).alias("_spellings"))
    own = kept(own)
    wanted_name = F.coalesce(F.nullif("hint", F.lit("")), "name")
    names = places.select(F.col(by).alias("_by"), wanted_name.alias("_wanted")).filter("_by is not null").distinct()
    names = kept(names.select("_by", "_wanted", F.monotonically_increasing_id().alias("_place"), K.match_key(F.col("_wanted")).alias("_key")))
    pairs = pairs_in_cells(names.select("_by", "_place", "_key"), own.select("_by", "_candidate", "qid", "gate", "route", "prominence", "_spellings"), "_by", "_place")
    scored = pairs.withColumn("name", _score(F.col("_key"), F.col("_spellings"))).drop("_by", "_key", "_spellings")
    best = best_candidate(scored, ["_place"]).select("_place", "_candidate", "confidence")
    best = best.join(own.select("_candidate", "qid", "label", "lat", "lon"), "_candidate").join(names.drop("_key"), "_place").drop("_candidate", "_place")
    same = (places[by] == F.col("_by")) & wanted_name.eqNullSafe(F.col("_wanted"))
    why = F.when(F.col("qid").isNull(), "no candidate").otherwise(F.format_string("%s, confidence %s", "label", K.fixed(F.col("confidence"), 2)))
    return places.join(best, same, "left").drop("_by", "_wanted").withColumn("why", why)


def reasons_to_check(confirmed: Column, positional: Column, queried: Column, resolved: Column, confidence: Column, candidates: Column, km: Column, renamed: Column) -> Column:
    """Why a person should look at a place: an array, in order; empty for what is confirmed."""
    when = lambda c, text: F.when(c, text)
    reasons = F.array_compact(F.array(
        when(confidence < LOW, F.concat(F.lit("low confidence ("), K.fixed(confidence, 2), F.lit(")"))),
        when((confidence >= LOW) & (candidates > 1) & (confidence < CONTESTED), F.format_string("%d candidates, %s confidence", candidates, K.fixed(confidence, 2))),
        when(positional & (km > FAR_KM), F.format_string("%,.0f km from the route, but the party goes there", F.rint(km))),
        when(renamed != "", F.concat(F.lit("reported as renamed to "), renamed)),
    ))
    none = F.array().cast("array<string>")
    return F.when(confirmed, none).when(queried & ~resolved & positional, F.array(F.lit("nothing found, and the party is placed by it"))).when(~resolved, none).otherwise(reasons)


def rank_doubts(doubts: DataFrame, reason: str = "reason", positional: str = "positional", name: str = "name") -> DataFrame:
    rank = F.when(F.col(reason).startswith("nothing found"), 0).when(F.col(reason).contains("km from the route"), 1).when(F.col(reason).startswith("low"), 2).when(F.col(reason).contains("candidates"), 3).otherwise(4)
    return doubts.orderBy(F.desc(positional), rank, name)


def propose_kind(rules: Sequence[tuple[str, Column]], default: str = "unknown") -> Column:
    """The kind of the first rule that holds."""
    out = F
    for kind, condition in rules:
        out = out.when(condition, kind)
    return out.otherwise(default)


def held_back(status: Column, kind: Column, located: Column, queried: Column, strayed_km: Column, leg_km: Column, ratio: float = 1.0) -> Column:
    """Why a place gets no pin, or null; the order matters."""
    return (
        F.when(status == "rejected", "rejected")
        .when(kind == "local", "floating_interior")
        .when(kind == "off_route", "off_route")
        .when(~located & queried, "none_found")
        .when(~located, "not_queried")
        .when((leg_km > 0) & (strayed_km / leg_km > ratio), "contradicts_its_leg")
    )


# The curated lists in the order in which they decide, and the kind that each gives.
CURATED = ("local", "micro", "waypoints", "via", "blocked", "invented", "aliases")
CURATED_KINDS = {"local": "local", "micro": "micro", "waypoints": "waypoint", "via": "waypoint", "blocked": "off_route", "invented": "unknown", "aliases": "unknown"}


def propose(uses: DataFrame, nodes: DataFrame, curated: DataFrame, legs: DataFrame) -> DataFrame:
    """``uses`` (``key, ...``) with ``kind, node_indices, parent_key, leg, along, candidates, modern_hint, why``.

    A key is what the first of these says: a stop of the route (``nodes``: ``index, key``), the curated lists (``list,
    seq, name, parent, leg, along, modern, why``) in the order of ``CURATED``, in which the legs' own via clauses
    (``index, via``) stand, or nothing: unknown, for the gazetteer. All of them are small dimensions of one route: they
    are one row a key before they are joined.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    named = nodes.groupBy("key").agg(F.array_sort(F.collect_list("index")).alias("_at"))
    several = F.format_string("names route nodes %s, the route is a cycle", F.array_join("_at", " and "))
    stops = named.select(
        "key", F.lit(-1).alias("rank"), F.lit(0).alias("seq"), F.lit("node").alias("kind"), F.array_join("_at", ";").alias("node_indices"), F.lit("").alias("parent_key"), F.lit("").alias("leg"), F.lit("").alias("along"),
        F.size("_at").alias("candidates"), F.lit("").alias("modern_hint"), F.when(F.size("_at") == 1, F.format_string("names route node %s", F.get("_at", F.lit(0)).cast("string"))).otherwise(several).alias("why"),
    )
    share = F.round((F.col("pos") + 1) / (F.col("n") + 1), 3)
    via = legs.select("index", F.size("via").alias("n"), F.posexplode("via").alias("pos", "name"))
    via = via.select(F.lit("via").alias("list"), (F.col("index") * 1000 + F.col("pos")).alias("seq"), "name", F.lit(None).cast("string").alias("parent"), F.col("index").cast("int").alias("leg"), share.cast("double").alias("along"), F.lit(None).cast("string").alias("modern"), F.format_string("named by the via clause of leg %d", F.col("index").cast("int")).alias("why"))
    own = curated.select("list", "seq", "name", "parent", F.col("leg").cast("int").alias("leg"), F.col("along").cast("double").alias("along"), "modern", "why").unionByName(via)
    rank = F.array_position(F.array(*[F.lit(x) for x in CURATED]), F.col("list"))
    kinds = F.create_map(*[F.lit(x) for pair in CURATED_KINDS.items() for x in pair])
    at_leg = F.col("list").isin("waypoints", "via")
    why = F.when(F.col("list") == "invented", F.concat(F.lit("no modern referent: "), text("why"))).when(F.col("list") == "aliases", F.concat(F.lit("1872 spelling of "), text("modern"), F.lit(": "), text("why"))).otherwise(text("why"))
    listed = own.select(
        K.place_key(F.col("name")).alias("key"), rank.cast("int").alias("rank"), F.col("seq").cast("int").alias("seq"), F.element_at(kinds, F.col("list")).alias("kind"), F.lit("").alias("node_indices"),
        F.when(F.col("list") == "micro", K.place_key(F.col("parent"))).otherwise("").alias("parent_key"), F.when(at_leg, text("leg")).otherwise("").alias("leg"), F.when(at_leg, F.coalesce("along", F.lit(0.5)).cast("string")).otherwise("").alias("along"),
        F.lit(0).alias("candidates"), F.when(F.col("list") == "aliases", text("modern")).otherwise("").alias("modern_hint"), why.alias("why"),
    )
    out = ["kind", "node_indices", "parent_key", "leg", "along", "candidates", "modern_hint", "why"]
    first = stops.unionByName(listed).groupBy("key").agg(F.min_by(F.struct(*out), F.struct("rank", "seq")).alias("_p"))
    empty = {"kind": "unknown", "candidates": 0, "why": "not on the route and on no list, for the gazetteer"}
    return uses.join(first, "key", "left").select(*uses.columns, *[F.coalesce(F.col(f"_p.{c}"), F.lit(empty.get(c, ""))).alias(c) for c in out])


def is_positional(used_as: Column) -> Column:
    """Whether somebody is placed by a name: it is used on stage or visited."""
    return used_as.contains("on_stage") | used_as.contains("visited")


def wanted(table: DataFrame, only: Sequence[str] = (), nodes_only: bool = False) -> DataFrame:
    """The review rows (``key, kind``) to resolve: those named, the stops only, or all that may have a place."""
    if only:
        return table.join(F.broadcast(table.sparkSession.createDataFrame([(x,) for x in only], "_n string").select(K.place_key(F.col("_n")).alias("key"))), "key", "left_semi")
    return table.filter(F.col("kind") == "node") if nodes_only else table.filter(~F.col("kind").isin("local", "off_route"))


def anchors(table: DataFrame) -> DataFrame:
    """``lat, lon`` of the located stops and waypoints."""
    return table.filter(F.col("kind").isin("node", "waypoint") & F.col("lat").isNotNull() & F.col("lon").isNotNull()).select("lat", "lon")
