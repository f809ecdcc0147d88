"""The nearest of many anchors on the sphere, without looking at all of them.

Points and anchors are unit vectors in a grid of cubes, so poles and the antimeridian are places like others. An anchor that
isn't in the 27 cubes around a point's own is further than a cube's side: a nearest one found within that distance is
proven. The rounds go from small cubes to large ones, and each is only for the points that the one before left open.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.functions.lineage import kept

#: Sides grow by this factor from round to round.
WIDER = 4.0
#: The sides of the first round's cubes: so small that no cube has more anchors than this, if there is such a side.
CROWD = 32
LEAST_SIDE = 1e-6


def _cube(at: list[Column], side: float) -> list[Column]:
    return [F.floor(c / side).cast("long") for c in at]


def _placed(rows: DataFrame, lat: str, lon: str) -> DataFrame:
    x, y, z = geo.unit_vector(F.col(lat), F.col(lon))
    return rows.withColumn("_x", x).withColumn("_y", y).withColumn("_z", z)


def first_side(anchors: DataFrame) -> float:
    """The largest side, of those that halve, at which no cube has more than ``CROWD`` anchors."""
    side = 2.0
    xyz = [F.col("_x"), F.col("_y"), F.col("_z")]
    while side > LEAST_SIDE:
        cubes = anchors.groupBy(*[c.alias(n) for c, n in zip(_cube(xyz, side), "ijk", strict=True)]).count()
        if (cubes.agg(F.max("count")).first()[0] or 0) <= CROWD:
            return side
        side /= WIDER
    return side


def nearest(points: DataFrame, anchors: DataFrame, lat: str = "lat", lon: str = "lon", anchor_lat: str = "lat", anchor_lon: str = "lon") -> DataFrame:
    """``points`` with ``nearest_km``: kilometres to the nearest anchor by ``geo.haversine_km``; null if there are none, or
    where a coordinate is null.

    Anchors count by their place: repeated ones are one. In rounds of larger cubes, anchors are first told apart by the
    cubes of the round before: of those around a point only the ones are opened that can hold the nearest, since another's
    farthest corner is nearer than their nearest one. So a crowd far away is a cube, not its members.
    """
    places = anchors.select(F.col(anchor_lat).cast("double").alias("a"), F.col(anchor_lon).cast("double").alias("o")).dropna().distinct()
    places = kept(_placed(places, "a", "o"))
    number = F.monotonically_increasing_id()
    rows = kept(_placed(points.withColumn("_row", number), lat, lon))
    open_ = rows.filter(F.col("_x").isNotNull()).select("_row", F.col(lat).alias("lat"), F.col(lon).alias("lon"), "_x", "_y", "_z")
    done = None
    if places.isEmpty():
        return rows.withColumn("nearest_km", F.lit(None).cast("double")).drop("_row", "_x", "_y", "_z")
    side, fine = first_side(places), None
    own = [F.col("_x"), F.col("_y"), F.col("_z")]
    while True:
        near = [F.explode(F.sequence(c - 1, c + 1)) for c in _cube(own, side)]
        around = open_
        for name, steps in zip(("i", "j", "k"), near, strict=True):
            around = around.withColumn(name, steps)
        ijk = ["i", "j", "k"]
        cube = [c.alias(n) for c, n in zip(_cube(own, side), ijk, strict=True)]
        if fine is None:
            pairs = around.join(places.select("a", "o", *cube), ijk)
        else:
            small = [c.alias(n) for c, n in zip(_cube(own, fine), ("u", "v", "w"), strict=True)]
            crowds = places.select(*cube, *small).distinct()
            gap = [F.greatest(F.lit(0.0), F.col(n) * fine - c, c - (F.col(n) + 1) * fine) for c, n in zip(own, ("u", "v", "w"), strict=True)]
            reach = [F.greatest(F.abs(F.col(n) * fine - c), F.abs((F.col(n) + 1) * fine - c)) for c, n in zip(own, ("u", "v", "w"), strict=True)]
            met = around.join(crowds, ijk).withColumn("low", sum(g * g for g in gap)).withColumn("high", sum(r * r for r in reach))
            bound = met.groupBy("_row").agg(F.min("high").alias("bound"))
            opened = met.join(bound, "_row").filter(F.col("low") <= F.col("bound") * (1 + 1e-9) + 1e-15)
            pairs = opened.select("_row", "lat", "lon", "u", "v", "w").join(places.select("a", "o", *small), ["u", "v", "w"])
        best = pairs.groupBy("_row").agg(F.min(geo.haversine_km(F.col("lat"), F.col("lon"), F.col("a"), F.col("o"))).alias("km"))
        # a chord of a side is so many kilometres; a little less, for rounding
        sure = 2 * geo.EARTH_RADIUS_KM * math.asin(min(1.0, side / 2)) * (1 - 1e-9)
        found = kept(best.filter(F.lit(True) if side >= 2 else F.col("km") <= sure))
        done = found if done is None else done.unionByName(found)
        open_ = kept(open_.join(found.select("_row"), "_row", "left_anti"))
        if side >= 2 or open_.isEmpty():
            break
        side, fine = min(2.0, side * WIDER), side
    return rows.join(done.withColumnRenamed("km", "nearest_km"), "_row", "left").drop("_row", "_x", "_y", "_z")
