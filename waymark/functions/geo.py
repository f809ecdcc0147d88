"""Points, arcs and rings as Columns. Points are ``(lon, lat)`` in degrees; rings are arrays of ``[lon, lat]``."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_KM = 6371.0088
ARC_SAMPLES = 64
FLAT_RING = 1e-12


def _number(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    a1, o1, a2, o2 = (F.radians(_number(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((a2 - a1) / 2), 2.0) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2.0)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), h))))


def nearest_km(lat: Column, lon: Column, anchors: Column) -> Column:
    """Kilometres to the nearest of an array of ``[lat, lon]``; null if it is empty."""
    return F.array_min(F.transform(anchors, lambda p: haversine_km(lat, lon, p[0], p[1])))


def unit_vector(lat: Column, lon: Column) -> list[Column]:
    """x, y, z of a place on the unit sphere."""
    return _vector(F.array(_number(lon), _number(lat)))


def _vector(point: Column) -> list[Column]:
    lon, lat = F.radians(point[0]), F.radians(point[1])
    return [F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)]


def _let(values: dict[str, Column], body) -> Column:
    """``body`` of values that are made once, however often it names them."""
    return F.get(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body), F.lit(0))


def interpolate(start: Column, end: Column, fraction: Column) -> Column:
    """The point at a fraction of the great circle between two points, to 6 decimals.

    Ends are exact; equal points give that point; between antipodes the circle goes through a point at right angles.
    """
    vectors = {f"a{i}": x for i, x in enumerate(_vector(start))} | {f"b{i}": x for i, x in enumerate(_vector(end))}

    def turn(v: Column) -> Column:
        dot = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), v["a0"] * v["b0"] + v["a1"] * v["b1"] + v["a2"] * v["b2"]))
        return _let({"v": v, "omega": F.acos(dot), "fraction": fraction}, between)

    def between(s: Column) -> Column:
        a, b = [s["v"][f"a{i}"] for i in range(3)], [s["v"][f"b{i}"] for i in range(3)]
        flat = F.sin(s["omega"]) < 1e-9
        far = flat & (s["omega"] > 1)
        # at right angles to the start and to the x axis if the start leans least on that, else to the start and the z axis
        least_x = (F.abs(a[0]) <= F.abs(a[1])) & (F.abs(a[0]) <= F.abs(a[2]))
        raw = [F.when(least_x, 0.0).otherwise(a[1]), F.when(least_x, a[2]).otherwise(-a[0]), F.when(least_x, -a[1]).otherwise(0.0)]
        size = F.when(least_x, F.sqrt(a[1] * a[1] + a[2] * a[2])).otherwise(F.sqrt(a[0] * a[0] + a[1] * a[1]))
        angle, share = F.when(far, F.lit(math.pi / 2)).otherwise(s["omega"]), F.when(far, s["fraction"] * 2).otherwise(s["fraction"])
        weights = {"f": F.sin((1 - share) * angle) / F.sin(angle), "g": F.sin(share * angle) / F.sin(angle)}
        target = {f"t{i}": F.when(far, raw[i] / size).otherwise(b[i]) for i in range(3)}
        point = _let(weights | target | {f"a{i}": a[i] for i in range(3)}, lambda w: F.struct(*[(w["f"] * w[f"a{i}"] + w["g"] * w[f"t{i}"]).alias(n) for i, n in enumerate("xyz")]))
        return F.when(flat & ~far, start).otherwise(_let({"p": point}, degrees))

    def degrees(s: Column) -> Column:
        p = s["p"]
        lat = F.degrees(F.atan2(p["z"], F.sqrt(p["x"] * p["x"] + p["y"] * p["y"])))
        return F.array(F.bround(F.degrees(F.atan2(p["y"], p["x"])), 6), F.bround(lat, 6))

    return F.when(fraction <= 0, start).when(fraction >= 1, end).otherwise(_let(vectors, turn))


def great_circle(start: Column, end: Column, samples: int = ARC_SAMPLES) -> Column:
    """``samples`` points from start to end, both included."""
    return F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), lambda k: interpolate(start, end, k / F.lit(float(samples - 1))))


def great_circle_km(start: Column, end: Column) -> Column:
    return haversine_km(start[1], start[0], end[1], end[0])


def geojson_point(lat: Column, lon: Column) -> Column:
    return F.array(lon.cast("double"), lat.cast("double"))


def shortest_rotation(current: Column, target: Column) -> Column:
    """The turn from one longitude to another that is shorter, -180 to 180."""
    return F.pmod(target - current + 540, F.lit(360.0)) - 180


def unwrap_eastward(lons: Column) -> Column:
    """Longitudes with 360 added whenever a step would go over 180 degrees west of the last one given out."""
    empty = F.array().cast("array<double>")

    def step(done: Column, lon: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        turns = F.greatest(F.lit(0.0), F.ceil((last - 180 - lon) / 360).cast("double"))
        return F.array_append(done, F.when(F.size(done) == 0, lon).otherwise(lon + 360 * turns))

    return F.aggregate(lons, empty, step)


def wrap(lon: Column) -> Column:
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def ring_area(ring: Column) -> Column:
    """The signed spherical excess of a closed ring in steradians, positive clockwise; edges go the short way round."""
    nexts = F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0)))
    starts = F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0)))

    def edge(p: Column, q: Column) -> Column:
        step = F.radians(q[0] - p[0])
        turned = F.pmod(step + math.pi, F.lit(2 * math.pi)) - math.pi
        turned = F.when((turned == -math.pi) & (step > 0), F.lit(math.pi)).otherwise(turned)
        return turned * (2 + F.sin(F.radians(p[1])) + F.sin(F.radians(q[1])))

    total = F.aggregate(F.zip_with(starts, nexts, edge), F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(ring) < 2, 0.0).otherwise(total / 2)


def normalise_winding(polygon: Column) -> Column:
    """The outer ring with a positive area, holes with a negative one; flat rings stay."""
    def turn(ring: Column, i: Column) -> Column:
        area = ring_area(ring)
        return F.when((F.abs(area) > FLAT_RING) & ((i == 0) == (area < 0)), F.reverse(ring)).otherwise(ring)

    return F.transform(polygon, turn)


def round_ring(ring: Column, places: int = 2) -> Column:
    """Rounded, without repeats in a row, and closed again."""
    rounded = F.transform(ring, lambda p: F.array(F.bround(p[0], places), F.bround(p[1], places)))
    kept = F.filter(rounded, lambda p, i: (i == 0) | (p != F.get(rounded, i - 1)))
    open_end = (F.size(kept) > 1) & (F.get(kept, F.lit(0)) != F.try_element_at(kept, F.lit(-1)))
    return F.when(open_end, F.array_append(kept, F.get(kept, F.lit(0)))).otherwise(kept)


def round_coords(polygon: Column, places: int = 2) -> Column:
    return F.transform(polygon, lambda ring: round_ring(ring, places))


def is_drawable(ring: Column) -> Column:
    """At least four points, closed, and not flat."""
    return (F.size(ring) >= 4) & (F.get(ring, F.lit(0)) == F.try_element_at(ring, F.lit(-1))) & (F.abs(ring_area(ring)) > FLAT_RING)


def route_point(leg: Column, along: Column) -> Column:
    return F.struct(leg.cast("int").alias("leg"), along.cast("double").alias("along"))


def at_node(index: Column, last_leg: Column) -> Column:
    """A node's place on the route; the closing node is the end of the last leg."""
    return F.when(index > last_leg, route_point(last_leg, F.lit(1.0))).otherwise(route_point(index, F.lit(0.0)))


def midpoint(a: Column, b: Column) -> Column:
    """Halfway between two route points; a whole leg is the next leg's beginning."""
    middle = (a["leg"] + a["along"] + b["leg"] + b["along"]) / 2
    leg = F.floor(middle)
    return route_point(leg, F.bround(middle - leg, 6))
