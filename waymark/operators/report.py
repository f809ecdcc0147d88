"""Reports over verdicts and doubts: counts, distributions, and text lines for people."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import text as K

from . import payload
from .evidence import KINDS, SHOW_CLOSEST

PASSING = ("exact", "normalised")


def summary(checks: DataFrame) -> DataFrame:
    """``ord, kind, n`` for every kind of match, zeros included."""
    return payload.zero_filled(checks.select("kind"), "kind", list(KINDS))


def per_chapter(checks: DataFrame, chapter: str = "number") -> DataFrame:
    """One row per chapter with a column per kind."""
    return payload.pivot_counts(checks, chapter, "kind", list(KINDS))


def failing_ratios(checks: DataFrame) -> DataFrame:
    """One row: the ratios of what didn't match, to 3 decimals, in order."""
    odd = checks.filter(F.col("kind").isin("near_miss", "missing"))
    return odd.agg(F.array_sort(F.collect_list(F.bround("ratio", 3))).alias("ratios"))


def blocks(strict: bool) -> Column:
    """Whether a verdict stops a build: what is missing, and when strict whatever didn't pass."""
    return ~F.col("kind").isin(*PASSING) if strict else F.col("kind") == "missing"


def count_blocking(checks: DataFrame, strict: bool) -> DataFrame:
    return checks.agg(F.count_if(blocks(strict)).alias("blocking"))


def markdown_items(checks: DataFrame, chapter: str = "number", path: str = "path") -> DataFrame:
    """``chapter, item``: a Markdown item for every verdict that didn't pass; the closest text where it is close enough."""
    head = F.format_string("- **chapter %02d** `%s` %s: %s", F.col(chapter), F.col(path), F.col("kind"), F.regexp_replace("quote", r"\s+", " "))
    close = F.when(F.col("ratio").between(SHOW_CLOSEST, 0.9999) & F.col("closest").isNotNull(), F.format_string("\n  closest (%s): %s", K.fixed(F.col("ratio"), 2), F.regexp_replace("closest", r"\s+", " ")))
    return checks.filter(~F.col("kind").isin(*PASSING)).select(F.col(chapter).alias("chapter"), F.concat(head, F.coalesce(close, F.lit(""))).alias("item"))


def checklist_items(doubts: DataFrame, candidates: DataFrame, key: str = "key", most: int = 5) -> DataFrame:
    """``key, item``: what to look at for each place (``key, name, reasons, evidence, chapter``), with at most ``most`` runners-up.

    ``candidates``: ``key, rank, label, qid``, the best first.
    """
    rows = candidates.filter(F.col("rank") <= most + 1).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "label", "qid"))).alias("_c"))
    others = F.array_join(F.transform(F.slice("_c", F.lit(2), F.lit(most)), lambda c: F.format_string("\n  - or %s (%s)", c["label"], c["qid"])), "")
    quote = F.when(F.coalesce("evidence", F.lit("")) != "", F.format_string("\n  > %s (chapter %d)", F.regexp_replace("evidence", r"\s+", " "), "chapter")).otherwise("")
    item = F.concat(F.lit("- [ ] **"), "name", F.lit("**: "), F.array_join("reasons", "; "), quote, F.coalesce(others, F.lit("")))
    return doubts.join(rows, key, "left").select(key, item.alias("item"))


def route_document(nodes: DataFrame, legs: DataFrame) -> DataFrame:
    """One row of JSON: the route's nodes and legs in order, the running days and their total."""
    n = nodes.agg(F.array_sort(F.collect_list(F.struct("index", "name", "key", "printed_forms"))).alias("nodes"), F.transform(F.array_sort(F.collect_list(F.struct("index", "day"))), lambda x: x["day"]).alias("cumulative_days"))
    g = legs.agg(F.array_sort(F.collect_list(F.struct("index", "origin", "destination", "days", "modes", "via"))).alias("legs"), F.sum("days").alias("total_days"))
    return n.join(g).select(F.to_json(F.struct("nodes", "legs", "cumulative_days", "total_days")).alias("json"))


def positions_document(series: DataFrame) -> DataFrame:
    """One JSON document per chapter: its tracks in order of name."""
    track = F.struct("track", "leg", "along", "source", "place", "stated_at", "flags")
    rows = series.groupBy("chapter").agg(F.array_sort(F.collect_list(F.struct(F.col("track").alias("k"), track.alias("t")))).alias("_t"))
    return rows.select("chapter", F.to_json(F.struct("chapter", F.transform("_t", lambda x: x["t"]).alias("tracks"))).alias("json"))


def sniff_indent(text: str, default: int = 2) -> int:
    """The indentation that a JSON text uses."""
    found = re.search(r"[{\[]\n( +)\S", text)
    return len(found[1]) if found else default


def render_json(value: object, indent: int = 2) -> str:
    return json.dumps(value, indent=indent, ensure_ascii=False) + "\n"


def blocking(nodes: DataFrame, last_leg: int, series: DataFrame, places: DataFrame) -> DataFrame:
    """``ord, subject, problem``: what makes a build wrong. ``nodes``: ``journey_nodes``; ``series``: ``chapter, track, leg,
    along``; ``places``: ``key, leg, corrected_leg``, as text."""
    facts = nodes.agg(F.count_if(F.col("lat").isNotNull()).alias("located"), F.count("*").alias("n"))
    problem = lambda order, subject, text: [F.lit(order).alias("ord"), subject.alias("subject"), text.alias("problem")]
    none = facts.filter("located < 2").select(*problem(0, F.lit("route"), F.format_string("only %d of %d stops have coordinates", "located", "n")))
    holes = nodes.filter("status = 'rejected'").select(*problem(1, F.col("index").cast("string"), F.concat(F.lit("stop is marked rejected: "), "name")))
    spot = F.format_string("%02d:%s", "chapter", "track")
    off = series.filter(~F.col("leg").between(0, last_leg)).select(*problem(2, spot, F.format_string(f"leg %d is outside 0..{last_leg}", "leg")))
    past = series.filter(~F.col("along").between(0.0, 1.0)).select(*problem(3, spot, F.concat(F.lit("along is outside 0..1: "), F.col("along").cast("string"))))
    leg = F.trim(F.coalesce(F.nullif("corrected_leg", F.lit("")), "leg"))
    typed = places.filter((leg != "") & ~leg.rlike("^-*[0-9]+$")).select(*problem(4, F.col("key"), F.concat(F.lit("leg is not a number: "), leg)))
    return none.unionByName(holes).unionByName(off).unionByName(past).unionByName(typed)


def warnings(payload: DataFrame, drawn_legs: DataFrame) -> DataFrame:
    """``ord, warning``: what a reader has to be told of ``places_payload``, and of the legs (``arc``) that are drawn."""
    reason = lambda *r: F.count_if(F.col("reason").isin(*r))
    counts = payload.agg(F.count("*").alias("total"), F.count_if(F.col("reason").isNull()).alias("plotted"), F.count_if(F.col("status") == "confirmed").alias("confirmed"), F.count_if("doubtful").alias("doubtful"), reason("none_found", "not_queried").alias("unlocated"))
    line = lambda order, text, *columns: F.struct(F.lit(order).alias("ord"), F.format_string(text, *columns).alias("warning"))
    of = F.array_compact(F.array(
        F.when(F.col("confirmed") == 0, line(0, "none of the %d place rows has been confirmed by a person", "total")).when(F.col("confirmed") < F.col("plotted"), line(0, "%d of the %d drawn places are unchecked", F.col("plotted") - F.col("confirmed"), F.col("plotted"))),
        F.when(F.col("doubtful") > 0, line(1, "%d of the %d drawn places are below the confidence that is trusted", "doubtful", "plotted")),
        F.when(F.col("unlocated") > 0, line(2, "%d names have no coordinate", "unlocated")),
    ))
    strayed = payload.filter("reason = 'contradicts_its_leg'").select(F.lit(3).alias("ord"), F.concat(F.col("name"), F.lit(" is not drawn: it is "), F.coalesce("detail", F.lit(""))).alias("warning"))
    arcs = drawn_legs.agg(F.count_if(F.col("arc").isNotNull()).alias("n")).filter("n > 0").select(F.lit(4).alias("ord"), F.lit("the arcs are great circles between the stops, not the ways that were taken").alias("warning"))
    return counts.select(F.explode(of).alias("w")).select("w.*").unionByName(strayed).unionByName(arcs)


def route_log(legs: DataFrame, printed_total: int) -> DataFrame:
    """``ord, line``: one line per leg (``index, origin, destination, days, modes, via``), and a summary."""
    wide = legs.agg(F.greatest(F.max(F.length("origin")), F.max(F.length("destination"))).alias("w"), F.count("*").alias("n"), F.sum("days").alias("total"), F.min_by("origin", "index").alias("first"), F.max_by("destination", "index").alias("last"))
    pad = lambda c: F.rpad(c, F.col("w"), F.lit(" "))
    via = F.when(F.size("via") > 0, F.concat(F.lit("  via "), F.array_join("via", ", "))).otherwise("")
    line = F.concat(F.format_string("leg %d  ", F.col("index").cast("int")), pad("origin"), F.lit(" -> "), pad("destination"), F.format_string("  %2d days  ", F.col("days").cast("int")), F.array_join("modes", "+"), via)
    rows = legs.join(F.broadcast(wide.select("w"))).select(F.col("index").cast("int").alias("ord"), line.alias("line"))
    ends = F.when(K.node_key(F.col("first")) == K.node_key(F.col("last")), F.concat(F.lit(", begins and ends at "), "first")).otherwise("")
    last = wide.select(F.lit(1 << 30).alias("ord"), F.concat(F.format_string(f"%d legs, %d nodes, %d days (printed {printed_total})", "n", F.col("n") + 1, "total"), ends).alias("line"))
    return rows.unionByName(last)


def positions_log(series: DataFrame, tracks: Sequence[str]) -> DataFrame:
    """``chapter, line``: where each track is in each chapter, tracks in the given order; a dash where it is nowhere."""
    since = F.when(F.col("source") == "carried", F.format_string("carried from %02d", "stated_at"))
    where = F.concat_ws(" ", F.nullif("place", F.lit("")), F.when(F.coalesce("place", F.lit("")) != "", F.concat(F.lit("("), since, F.lit(")"))).otherwise(since))
    cell = F.when(F.col("leg").isNull(), F.concat("track", F.lit(" —"))).otherwise(F.rtrim(F.concat("track", F.format_string(" leg %d@%s ", "leg", K.fixed(F.col("along"), 2)), where)))
    cells = series.groupBy("chapter").pivot("track", list(tracks)).agg(F.first(cell))
    return cells.select("chapter", F.concat(F.format_string("ch %02d   ", "chapter"), F.concat_ws("   ", *[F.coalesce(F.col(f"`{t}`"), F.lit(f"{t} —")) for t in tracks])).alias("line"))
