"""Queries over points that are made from keys: distances, arcs, rings, nearest anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.functions import text as K
from waymark.operators import nearest as near
from waymark.operators import payload

from ._declare import Declared, declare

QUERIES: dict[str, Declared] = {}

LAT, LON = "({0} * 37 % 180 - 89.5)", "({0} * 73 % 360 - 179.5)"


def _lat(key: str) -> Column:
    return F.expr(LAT.format(key)).cast("double")


def _lon(key: str) -> Column:
    return F.expr(LON.format(key)).cast("double")


def _hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"2 * 6371.0088 * asin(sqrt(least(1.0::double, pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))))"


@declare(QUERIES, f"select s_suppkey, n_nationkey, round({_hav('a', 'b', 'c', 'd')}, 6) km from (select s_suppkey, n_nationkey, {LAT.format('s_suppkey')}::double a, {LON.format('s_suppkey')}::double b, {LAT.format('(n_nationkey + 7)')}::double c, {LON.format('(n_nationkey + 7)')}::double d from supplier join nation on s_nationkey = n_nationkey)")
def haversine(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    rows = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    km = geo.haversine_km(_lat("s_suppkey"), _lon("s_suppkey"), _lat("(n_nationkey + 7)"), _lon("(n_nationkey + 7)"))
    return rows.select("s_suppkey", "n_nationkey", F.round(km, 6).alias("km"))


@declare(QUERIES, f"with a as (select {LAT.format('(n_nationkey + 7)')}::double c, {LON.format('(n_nationkey + 7)')}::double d from nation), s as (select s_suppkey, {LAT.format('s_suppkey')}::double a, {LON.format('s_suppkey')}::double b from supplier) select s_suppkey, round(min({_hav('a', 'b', 'c', 'd')}), 6) km from s, a group by 1")
def nearest_anchor(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    # the anchors are the stops of one route: a few, held in one array
    anchors = nation.agg(F.collect_list(F.array(_lat("(n_nationkey + 7)"), _lon("(n_nationkey + 7)"))).alias("anchors"))
    rows = supplier.join(F.broadcast(anchors))
    return rows.select("s_suppkey", F.round(geo.nearest_km(_lat("s_suppkey"), _lon("s_suppkey"), F.col("anchors")), 6).alias("km"))


@declare(QUERIES, "select c_custkey, round(((t - f + 540) - 360 * floor((t - f + 540) / 360)) - 180, 6) turn from (select c_custkey, (c_custkey * 73 % 360 - 179.5)::double f, (c_custkey * 131 % 360 - 179.5)::double t from customer)")
def shortest_rotations(customer: DataFrame) -> DataFrame:
    return customer.select("c_custkey", F.round(geo.shortest_rotation(_lon("c_custkey"), F.expr("c_custkey * 131 % 360 - 179.5").cast("double")), 6).alias("turn"))


ARC_SQL = f"""
with p as (select n_nationkey, {LAT.format('n_nationkey')}::double a, {LON.format('n_nationkey')}::double b, {LAT.format('(n_nationkey + 5)')}::double c, {LON.format('(n_nationkey + 5)')}::double d from nation),
v as (select *, cos(radians(a)) * cos(radians(b)) x1, cos(radians(a)) * sin(radians(b)) y1, sin(radians(a)) z1, cos(radians(c)) * cos(radians(d)) x2, cos(radians(c)) * sin(radians(d)) y2, sin(radians(c)) z2 from p),
o as (select *, acos(greatest(-1.0::double, least(1.0::double, x1 * x2 + y1 * y2 + z1 * z2))) w from v),
k as (select *, unnest(range(16)) k from o),
s as (select *, sin((1 - k / 15.0::double) * w) / sin(w) f, sin(k / 15.0::double * w) / sin(w) g from k)
select n_nationkey, k::int k, round(round(case when k = 0 then b when k = 15 then d else degrees(atan2(f * y1 + g * y2, f * x1 + g * x2)) end, 6), 4) lon, round(round(case when k = 0 then a when k = 15 then c else degrees(atan2(f * z1 + g * z2, sqrt(pow(f * x1 + g * x2, 2) + pow(f * y1 + g * y2, 2)))) end, 6), 4) lat from s
"""


@declare(QUERIES, ARC_SQL)
def great_circle_points(nation: DataFrame) -> DataFrame:
    start, end = F.array(_lon("n_nationkey"), _lat("n_nationkey")), F.array(_lon("(n_nationkey + 5)"), _lat("(n_nationkey + 5)"))
    each = nation.select("n_nationkey", F.posexplode(geo.great_circle(start, end, 16)).alias("k", "p"))
    return each.select("n_nationkey", "k", F.round(F.col("p")[0], 4).alias("lon"), F.round(F.col("p")[1], 4).alias("lat"))


@declare(QUERIES, "select s_suppkey, round(radians(1.0::double + s_suppkey % 5) * (sin(radians(lat + 1.0 + s_suppkey % 3)) - sin(radians(lat))) * 0 + radians(1.0::double + s_suppkey % 5) * ((2 + 2 * sin(radians(lat + 1.0 + s_suppkey % 3))) - (2 + 2 * sin(radians(lat)))) / 2, 9) area, true drawable from (select s_suppkey, (s_suppkey * 37 % 100 - 50.0)::double lat from supplier)")
def ring_areas(supplier: DataFrame) -> DataFrame:
    lat, lon = F.expr("s_suppkey * 37 % 100 - 50.0D"), F.expr("s_suppkey * 73 % 300 - 150.0D")
    wide, high = F.expr("1.0D + s_suppkey % 5"), F.expr("1.0D + s_suppkey % 3")
    ring = F.array(F.array(lon, lat), F.array(lon, lat + high), F.array(lon + wide, lat + high), F.array(lon + wide, lat), F.array(lon, lat))
    return supplier.select("s_suppkey", F.round(geo.ring_area(ring), 9).alias("area"), geo.is_drawable(ring).alias("drawable"))


@declare(QUERIES, "with recursive s as (select s_suppkey, k, ((s_suppkey * 50 + k * 97) % 360 - 180)::double lon from supplier, range(6) t(k)), w as (select s_suppkey, k, lon as east from s where k = 0 union all select s.s_suppkey, s.k, s.lon + 360 * greatest(0, ceil((w.east - 180 - s.lon) / 360)) from w join s on s.s_suppkey = w.s_suppkey and s.k = w.k + 1) select s_suppkey, k::int k, east from w")
def unwrapped_longitudes(supplier: DataFrame) -> DataFrame:
    lons = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda k: ((F.col("s_suppkey") * 50 + k * 97) % 360 - 180).cast("double"))
    return supplier.select("s_suppkey", F.posexplode(geo.unwrap_eastward(lons)).alias("k", "east"))


@declare(QUERIES, "select p_partkey, floor(m)::int leg, round(m - floor(m), 6) along from (select p_partkey, ((p_partkey % 8) + (p_partkey % 10) / 10.0::double + (p_partkey % 5) + (p_partkey % 4) / 4.0::double) / 2 m from part)")
def route_midpoints(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    mid = geo.midpoint(geo.route_point(k % 8, (k % 10) / 10.0), geo.route_point(k % 5, (k % 4) / 4.0))
    return part.select("p_partkey", mid["leg"].alias("leg"), mid["along"].alias("along"))


@declare(QUERIES, "select c_custkey, case when c_custkey % 4 < 2 then (c_custkey % 100)::int end whole, case when c_custkey % 4 < 3 then case when c_custkey % 4 = 2 then c_custkey % 100 + 0.5 else c_custkey % 100 end end::double number from customer")
def tolerant_cells(customer: DataFrame) -> DataFrame:
    cell = F.expr("case c_custkey % 4 when 0 then ' ' || (c_custkey % 100) || ' ' when 1 then '' || (c_custkey % 100) when 2 then (c_custkey % 100) || '.5' else 'n/a' end")
    return customer.select("c_custkey", K.number_or_null(cell, "int").alias("whole"), K.number_or_null(cell).alias("number"))


@declare(
    QUERIES,
    f"with a as (select distinct {LAT.format('s_suppkey')}::double + s_suppkey % 7 * 0.01 c, {LON.format('s_suppkey')}::double d from supplier), p as (select c_custkey, ({LAT.format('(c_custkey + 11)')} * 0.99)::double a, ({LON.format('(c_custkey * 3)')} + 0.25)::double b from customer)"
    f" select c_custkey, round(min({_hav('a', 'b', 'c', 'd')}), 6) km from p, a group by 1",
)
def nearest_of_many(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """Every customer's nearest supplier, by cubes that widen until the nearest is proven."""
    anchors = supplier.select((_lat("s_suppkey") + F.col("s_suppkey") % 7 * 0.01).alias("lat"), _lon("s_suppkey").alias("lon"))
    points = customer.select("c_custkey", (F.expr(LAT.format("(c_custkey + 11)")) * 0.99).cast("double").alias("lat"), (F.expr(LON.format("(c_custkey * 3)")) + 0.25).cast("double").alias("lon"))
    return near.nearest(points, anchors).select("c_custkey", F.round("nearest_km", 6).alias("km"))


DRIFT_SQL = f"""
with n as (select n_nationkey i, n_name as name, {LAT.format('n_nationkey')}::double a, {LON.format('n_nationkey')}::double b from nation),
l as (select x.i, x.name origin, y.name destination, x.a, x.b, y.a c, y.b d from n x join n y on y.i = x.i + 1),
p as (select s_suppkey, s_suppkey % 24 leg, s_suppkey % 11 / 10.0::double t, {LAT.format('s_suppkey')}::double lat, {LON.format('s_suppkey')}::double lon from supplier),
v as (select *, cos(radians(a)) * cos(radians(b)) x1, cos(radians(a)) * sin(radians(b)) y1, sin(radians(a)) z1, cos(radians(c)) * cos(radians(d)) x2, cos(radians(c)) * sin(radians(d)) y2, sin(radians(c)) z2 from p join l on leg = i),
o as (select *, acos(greatest(-1.0::double, least(1.0::double, x1 * x2 + y1 * y2 + z1 * z2))) w from v),
f as (select *, sin((1 - t) * w) / sin(w) f, sin(t * w) / sin(w) g from o),
m as (select *, case when t <= 0 then b when t >= 1 then d else round(degrees(atan2(f * y1 + g * y2, f * x1 + g * x2)), 6) end mlon, case when t <= 0 then a when t >= 1 then c else round(degrees(atan2(f * z1 + g * z2, sqrt(pow(f * x1 + g * x2, 2) + pow(f * y1 + g * y2, 2)))), 6) end mlat from f)
select s_suppkey::varchar as key, leg::int leg, origin, destination, row_number() over (partition by leg order by t, s_suppkey::varchar)::int place, round({_hav('mlat', 'mlon', 'lat', 'lon')}, 3) strayed_km, round({_hav('a', 'b', 'c', 'd')}, 3) leg_km from m
"""


@declare(QUERIES, DRIFT_SQL)
def waypoint_drift(nation: DataFrame, supplier: DataFrame) -> DataFrame:
    """Nations as the stops of a journey, suppliers as places on its legs: their order, and how far each is from its leg."""
    nodes = nation.select(F.col("n_nationkey").cast("int").alias("index"), F.col("n_name").alias("name"), _lat("n_nationkey").alias("lat"), _lon("n_nationkey").alias("lon"), F.lit(0).alias("day"))
    legs = payload.journey_legs(nation.select(F.col("n_nationkey").cast("int").alias("index"), F.lit(1).alias("days"), F.array(F.lit("railway")).alias("modes")), nodes, samples=8)
    places = supplier.select(
        F.col("s_suppkey").cast("string").alias("key"), F.col("s_name").alias("name"), F.lit("waypoint").alias("kind"), (F.col("s_suppkey") % 24).cast("int").alias("leg"), (F.col("s_suppkey") % 11 / 10).alias("along"),
        _lat("s_suppkey").alias("lat"), _lon("s_suppkey").alias("lon"),
    )
    order = payload.waypoints(places).select("leg", F.posexplode("waypoints").alias("at", "w")).select("leg", (F.col("at") + 1).alias("place"), F.col("w.key").alias("key"))
    strayed = payload.drift(places, legs).join(order, "key").join(legs.select(F.col("index").alias("leg"), "origin", "destination"), "leg")
    return strayed.select("key", "leg", "origin", "destination", "place", F.round("strayed_km", 3).alias("strayed_km"), F.round("leg_km", 3).alias("leg_km"))
