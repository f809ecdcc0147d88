"""Nested documents for readers: the journey, its places, its chapters, counts and provenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.functions import text as K

from . import resolve


def tally(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """``(*by, tally)``: a map of counts by value, its keys sorted."""
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(value, "_n")))).alias("tally"))


def zero_filled(rows: DataFrame, value: str, values: list[str]) -> DataFrame:
    """``(value, n)`` for given values in their order, zeros included."""
    all_ = rows.sparkSession.createDataFrame(list(enumerate(values)), f"ord int, {value} string")
    return all_.join(rows.groupBy(value).agg(F.count("*").alias("n")), value, "left").select("ord", value, F.coalesce("n", F.lit(0)).alias("n"))


def pivot_counts(rows: DataFrame, by: str, value: str, values: list[str]) -> DataFrame:
    return rows.groupBy(by).pivot(value, values).agg(F.count(F.lit(1))).na.fill(0, values)


def journey_legs(legs: DataFrame, nodes: DataFrame, samples: int = geo.ARC_SAMPLES) -> DataFrame:
    """Legs (``index, days, modes``) with their ends' points and arcs; a leg without two located ends has none."""
    point = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), geo.geojson_point(F.col("lat"), F.col("lon")))
    ends = nodes.select("index", "name", point.alias("point"), "day")
    origin = ends.select("index", F.col("name").alias("origin"), F.col("point").alias("start"), F.col("day").alias("day_from"))
    to = ends.select((F.col("index") - 1).alias("index"), F.col("name").alias("destination"), F.col("point").alias("end"), F.col("day").alias("day_to"))
    rows = legs.select("index", "days", "modes").join(origin, "index").join(to, "index")
    return rows.withColumn("arc", F.when(F.col("start").isNotNull() & F.col("end").isNotNull(), geo.great_circle(F.col("start"), F.col("end"), samples)))


def waypoints(places: DataFrame) -> DataFrame:
    """``leg, waypoints``: those of each leg in order along it."""
    own = places.filter((F.col("kind") == "waypoint") & F.col("leg").isNotNull())
    return own.groupBy("leg").agg(F.array_sort(F.collect_list(F.struct("along", "key", "name"))).alias("waypoints"))


def drift(places: DataFrame, legs: DataFrame) -> DataFrame:
    """``key, strayed_km, leg_km``: how far each located waypoint is from its place on its leg's arc."""
    arcs = legs.filter("arc is not null").select(F.col("index").alias("leg"), "start", "end")
    rows = places.filter((F.col("kind") == "waypoint") & F.col("lat").isNotNull() & F.col("lon").isNotNull()).join(arcs, "leg")
    claimed = geo.interpolate(F.col("start"), F.col("end"), F.coalesce("along", F.lit(0.0)))
    return rows.select("key", geo.great_circle_km(claimed, F.array("lon", "lat")).alias("strayed_km"), geo.great_circle_km(F.col("start"), F.col("end")).alias("leg_km"))


def drift_detail(km: Column, leg_km: Column) -> Column:
    return F.when(km.isNull(), "").otherwise(F.format_string("%,.0f km from the leg it is placed on, which is only %,.0f km long", km, leg_km))


def places_payload(places: DataFrame, legs: DataFrame, chapters: DataFrame | None = None) -> DataFrame:
    """Every place drawn or listed, once: ``key, name, kind, status, tier, reason, point, doubtful, chapters, detail``."""
    rows = places.join(drift(places, legs), "key", "left").withColumn("status", K.review_status(F.coalesce("confirmed", F.lit(""))))
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    reason = resolve.held_back(F.col("status"), F.col("kind"), located, F.coalesce("gazetteer_source", F.lit("")) != "", F.col("strayed_km"), F.col("leg_km"))
    tier = F.when(F.col("kind") == "node", "itinerary").when(F.col("kind") == "waypoint", "waypoint").when(F.col("kind") == "micro", "interior").otherwise("mentioned")
    rows = rows.withColumn("reason", reason).withColumn("tier", tier)
    doubtful = F.col("reason").isNull() & (F.col("status") != "confirmed") & (F.coalesce("confidence", F.lit(0.0)) < resolve.LOW)
    rows = rows.join(chapters, "key", "left") if chapters is not None else rows.withColumn("chapters", F.array().cast("array<int>"))
    point = F.when(F.col("reason").isNull() & located, geo.geojson_point(F.col("lat"), F.col("lon")))
    return rows.select("key", "name", "kind", "status", "tier", "reason", point.alias("point"), doubtful.alias("doubtful"), "chapters", F.when(F.col("reason") == "contradicts_its_leg", drift_detail(F.col("strayed_km"), F.col("leg_km"))).alias("detail"))


def payload_counts(payload: DataFrame) -> DataFrame:
    """One row of totals."""
    return payload.agg(F.count("*").alias("total"), F.count_if(F.col("reason").isNull()).alias("drawn"), F.count_if(F.col("reason").isNotNull()).alias("listed"), F.count_if(F.col("status") == "confirmed").alias("confirmed"), F.count_if("doubtful").alias("doubtful"))


def folded_names(names: DataFrame, by: list[str], person: str = "person", name: str = "name", seq: str = "seq") -> DataFrame:
    """Printed names folded by identity: the first one shown, the other spellings in first-seen order."""
    spelled = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(seq, name))), lambda x: x[name]))
    rows = names.groupBy(*by, person).agg(F.min(seq).alias("seq"), spelled.alias("_n"))
    return rows.select(*by, person, "seq", F.get("_n", F.lit(0)).alias("printed"), F.slice("_n", F.lit(2), F.size("_n")).alias("others"))


def index_document(chapters: DataFrame) -> DataFrame:
    """The index of chapters ``number, title, body``: file, title, counts, SHA-256 and first line of each."""
    whole = K.chapter_text(F.col("number"), F.col("title"), F.col("body"))
    return chapters.select("number", F.format_string("chapter_%02d.txt", "number").alias("file"), "title", K.word_count(F.col("body")).alias("word_count"), F.length(whole).alias("char_count"), K.fingerprint(whole).alias("sha256"), K.first_line(F.col("body")).alias("first_line"))


def merge_repeats(nodes: DataFrame) -> DataFrame:
    """Nodes of one key as one, with all their days."""
    return nodes.groupBy("key").agg(F.min_by("name", "index").alias("name"), F.array_sort(F.collect_list("day")).alias("days"))


def map_segments(nodes: DataFrame) -> DataFrame:
    """``piece, points``: the route line in node order, unwrapped eastward and cut at the antimeridian."""
    line = nodes.filter("lat is not null and lon is not null").agg(F.array_sort(F.collect_list(F.struct("index", "lon", "lat"))).alias("n"))
    line = line.withColumn("east", geo.unwrap_eastward(F.transform("n", lambda x: x["lon"].cast("double"))))
    pairs = line.select(F.posexplode(F.zip_with("n", "east", lambda n, e: F.struct(e.alias("lon"), n["lat"].alias("lat")))).alias("i", "p"), "n", "east")
    ahead = pairs.withColumn("q_lon", F.get("east", F.col("i") + 1)).withColumn("q_lat", F.get("n", F.col("i") + 1)["lat"]).filter("q_lon is not null")
    world = lambda x: F.floor((x + 180) / 360)
    lo, hi = world(F.least("p.lon", "q_lon")), world(F.greatest("p.lon", "q_lon"))
    cuts = F.when(hi > lo, F.transform(F.sequence(lo + 1, hi), lambda k: k * 360.0 - 180)).otherwise(F.array().cast("array<double>"))
    lat = lambda x: F.col("p.lat") + (F.col("q_lat") - F.col("p.lat")) * (x - F.col("p.lon")) / (F.col("q_lon") - F.col("p.lon"))
    stops = F.concat(F.array(F.struct(F.col("p.lon").alias("lon"), F.col("p.lat").alias("lat"))), F.transform(F.when(F.col("q_lon") >= F.col("p.lon"), cuts).otherwise(F.reverse(cuts)), lambda x: F.struct(x.alias("lon"), lat(x).alias("lat"))), F.array(F.struct(F.col("q_lon").alias("lon"), F.col("q_lat").alias("lat"))))
    each = ahead.withColumn("s", stops).select("i", F.posexplode(F.zip_with(F.slice("s", F.lit(1), F.size("s") - 1), F.slice("s", F.lit(2), F.size("s") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("j", "ab"))
    centre = world((F.col("ab.a.lon") + F.col("ab.b.lon")) / 2)
    each = each.withColumn("world", centre).filter("ab.a != ab.b")
    shift = lambda p: F.array(p["lon"] - 360 * F.col("world"), p["lat"])
    return each.select("world", "i", "j", shift(F.col("ab.a")).alias("a"), shift(F.col("ab.b")).alias("b"))


def outline(features: DataFrame, places: int = 2, drop_unnamed: bool = False) -> DataFrame:
    """Features (``name, polygons`` as multipolygons) as one: unnamed dropped, rounded, flat rings dropped, wound."""
    rows = features.filter(F.trim(F.coalesce("name", F.lit(""))) != "") if drop_unnamed else features
    each = rows.select(F.explode("polygons").alias("p")).withColumn("p", F.filter(geo.round_coords(F.col("p"), places), geo.is_drawable)).filter(F.size("p") > 0)
    return each.select(geo.normalise_winding(F.col("p")).alias("polygon"))


def provenance(files: DataFrame) -> DataFrame:
    """``path, bytes, sha256`` of ``binaryFile`` rows."""
    return files.select("path", F.length("content").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def to_json_lines(payload: DataFrame, key: str) -> DataFrame:
    """Rows as compact JSON, in key order, so that rebuilding unchanged data writes equal files."""
    return payload.select(key, F.to_json(F.struct(*payload.columns)).alias("json")).orderBy(key)


def journey_nodes(nodes: DataFrame, places: DataFrame) -> DataFrame:
    """Stops (``index, key, name, day``) joined to their review rows (``key, modern_name, name_changed, lat, lon, qid,
    confidence, confirmed, first_chapter``). A rejected row keeps no coordinates; a stop without a row stays."""
    rows = nodes.join(places.select("key", "modern_name", "name_changed", "lat", "lon", "qid", "confidence", "confirmed", "first_chapter"), "key", "left")
    status = K.review_status(F.coalesce("confirmed", F.lit("")))
    shown = lambda c: F.when((status != "rejected") & F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.col(c))
    return rows.select(
        "index", "key", "name", F.coalesce(F.nullif(F.trim("modern_name"), F.lit("")), "name").alias("modern_name"), (F.trim(F.coalesce("name_changed", F.lit(""))) != "").alias("name_changed"),
        shown("lon").alias("lon"), shown("lat").alias("lat"), F.coalesce("qid", F.lit("")).alias("qid"), "confidence", status.alias("status"), "day", "first_chapter",
    )


def chapter_places(mentions: DataFrame, payload: DataFrame, nodes: DataFrame) -> DataFrame:
    """``chapter, seq, key, name, class, plotted, on_route, reason`` of every place that a chapter names, drawn or not.

    ``mentions``: ``chapter, seq, name, class``; ``payload``: ``places_payload``; a place that it doesn't have is not
    drawn, for no stated reason."""
    keyed = mentions.withColumn("key", K.place_key(F.col("name")))
    known = payload.select("key", F.col("reason").alias("_reason"), F.lit(True).alias("_known"))
    route = nodes.select("key").distinct().withColumn("_route", F.lit(True))
    rows = keyed.join(known, "key", "left").join(F.broadcast(route), "key", "left")
    return rows.select("chapter", "seq", "key", "name", "class", (F.col("_known").isNotNull() & F.col("_reason").isNull()).alias("plotted"), F.col("_route").isNotNull().alias("on_route"), F.col("_reason").alias("reason"))


def place_counts(places: DataFrame, by: str = "chapter", value: str = "class") -> DataFrame:
    """``by, named, plotted, by_class``: counts of ``chapter_places``; the map's keys are sorted."""
    return places.groupBy(by).agg(F.count("*").alias("named"), F.count_if("plotted").alias("plotted")).join(tally(places, value, by).withColumnRenamed("tally", "by_class"), by)


def places_by_class(places: DataFrame, classes: Sequence[str], by: str = "chapter") -> DataFrame:
    """``by, ord, class, names``: the names of each class, sorted, classes in the given order."""
    rank = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("class")).cast("int")
    return places.groupBy(by, rank.alias("ord"), "class").agg(F.array_sort(F.collect_set("name")).alias("names"))


def track_pins(series: DataFrame, legs: DataFrame) -> DataFrame:
    """The position series with ``lon, lat``: the point along its leg's arc (``index, start, end``), where there is one."""
    arcs = legs.filter("start is not null and end is not null").select(F.col("index").alias("leg"), "start", "end")
    point = F.when(F.col("start").isNotNull() & F.col("along").isNotNull(), geo.interpolate(F.col("start"), F.col("end"), F.col("along")))
    return series.join(arcs, "leg", "left").withColumn("_p", point).select(*series.columns, F.get("_p", F.lit(0)).alias("lon"), F.get("_p", F.lit(1)).alias("lat"))


def focus(pins: DataFrame, lead: str) -> DataFrame:
    """``chapter, focus``: the lead track's own point, or null; never a mean of the chapter's places."""
    own = F.when((F.col("track") == lead) & F.col("lon").isNotNull(), F.struct("lon", "lat", F.lit(lead).alias("from")))
    return pins.groupBy("chapter").agg(F.first(own, ignorenulls=True).alias("focus"))


def chapters_payload(records: DataFrame, places: DataFrame, people: DataFrame, pins: DataFrame, lead: str) -> DataFrame:
    """One document per chapter: ``chapter, title, summary, focus, transport, schedule, places, place_counts, present,
    named_elsewhere, people_counts, tracks``.

    ``records``: ``number, record``; ``places``: ``chapter_places``; ``people``: ``chapter, present, seq, person, display,
    name, is_role``, one row a printed name; ``pins``: ``track_pins``. Each part is one row a chapter before it is joined.
    """
    rows = records.select(
        F.col("number").alias("chapter"), F.col("record.title").alias("title"), F.struct(F.col("record.summary_hover").alias("hover"), F.col("record.summary_detail").alias("detail")).alias("summary"),
        F.transform("record.transport", lambda t: F.struct(t["mode"].alias("mode"), t["vessel_or_line_name"].alias("vessel"), t["from"].alias("from"), t["to"].alias("to"))).alias("transport"),
        F.struct(F.col("record.time.schedule_status").alias("status"), F.col("record.time.schedule_detail").alias("detail")).alias("schedule"),
    )
    item = F.struct("seq", "key", "name", "class", "plotted", "on_route", "reason")
    named = places.groupBy("chapter").agg(F.array_sort(F.collect_list(item)).alias("places")).join(place_counts(places).select("chapter", F.struct("named", "plotted", "by_class").alias("place_counts")), "chapter")
    cast = people.groupBy("chapter", "present", "person").agg(F.min_by(F.struct("display", "is_role"), "seq").alias("_one"))
    folded = folded_names(people, ["chapter", "present"]).join(cast, ["chapter", "present", "person"])
    one = F.struct("seq", F.col("person").alias("key"), F.col("_one.display").alias("display"), F.col("printed").alias("name"), F.when(F.col("_one.is_role"), "role").otherwise("person").alias("kind"), F.col("others").alias("also_printed"))
    lists = folded.groupBy("chapter").agg(F.array_sort(F.collect_list(F.when(F.col("present"), one))).alias("present"), F.array_sort(F.collect_list(F.when(~F.col("present"), one))).alias("named_elsewhere"))
    of_kind = lambda k: F.size(F.filter("present", lambda p: p["kind"] == k))
    lists = lists.withColumn("people_counts", F.struct(F.size("present").alias("present"), of_kind("person").alias("present_named"), of_kind("role").alias("present_roles"), F.size("named_elsewhere").alias("named_elsewhere")))
    tracks = pins.groupBy("chapter").agg(F.array_sort(F.collect_list(F.struct(*["track", *[c for c in pins.columns if c not in ("chapter", "track")]]))).alias("tracks"))
    out = rows.join(focus(pins, lead), "chapter", "left").join(named, "chapter", "left").join(lists, "chapter", "left").join(tracks, "chapter", "left")
    return out.select("chapter", "title", "summary", "focus", "transport", "schedule", "places", "place_counts", "present", "named_elsewhere", "people_counts", "tracks")


def chapters_by_place(uses: DataFrame, key: str = "key", chapter: str = "chapter") -> DataFrame:
    """``key, chapters, first_chapter``: the chapters that name each place, ascending, each once."""
    return uses.groupBy(key).agg(F.array_sort(F.collect_set(chapter)).alias("chapters"), F.min(chapter).alias("first_chapter"))


def earliest(rows: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """``key, value, first``: each key's first value that isn't empty, and where it is."""
    return rows.filter(F.coalesce(value, F.lit("")) != "").groupBy(key).agg(F.min_by(value, at).alias(value), F.min(at).alias("first"))
