"""Land polygons brought to scenes: footprints in longitude and latitude, clips, and projection to pixels.

Polygons and scenes meet on the cells of a grid of degrees, by equality; rings are cut in Arrow batches, all else is DataFrame
expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilescan.functions import geometry as G
from tilescan.functions.workers import ship
from tilescan.operators import polygons

CELL = 2.0


def _zone(epsg: Column) -> tuple[Column, Column]:
    """UTM zone and whether it is a southern one, of the WGS84 codes 32601 to 32660 and 32701 to 32760."""
    return F.when(epsg.between(32601, 32660) | epsg.between(32701, 32760), epsg % 100), epsg.between(32701, 32760)


def to_lonlat(epsg: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude of UTM coordinates; other coordinates are taken for degrees."""
    zone, south = _zone(epsg)
    lon, lat = G.utm_to_lonlat(x, y, zone, south)
    return F.when(zone.isNotNull(), lon).otherwise(x), F.when(zone.isNotNull(), lat).otherwise(y)


def from_lonlat(epsg: Column, lon: Column, lat: Column) -> tuple[Column, Column]:
    zone, south = _zone(epsg)
    x, y = G.lonlat_to_utm(lon, lat, zone, south)
    return F.when(zone.isNotNull(), x).otherwise(lon), F.when(zone.isNotNull(), y).otherwise(lat)


def footprints(scenes: DataFrame, points: int = 21) -> DataFrame:
    """``scenes`` (scene_id, width, height, transform, epsg) with lon0, lat0, lon1, lat1: the bounds of ``points`` + 1 points a side."""
    k = F.explode(F.sequence(F.lit(0), F.lit(points))).alias("k")
    at = F.col("k") / F.lit(points)
    corner = lambda u, v: F.struct((F.col("width") * u).alias("u"), (F.col("height") * v).alias("v"))
    edge = scenes.select("scene_id", "width", "height", "transform", "epsg", k).select("*", F.explode(F.array(corner(at, F.lit(0.0)), corner(at, F.lit(1.0)), corner(F.lit(0.0), at), corner(F.lit(1.0), at))).alias("p"))
    t = lambda i: F.col("transform")[i]
    lon, lat = to_lonlat(F.col("epsg"), t(2) + t(0) * F.col("p.u") + t(1) * F.col("p.v"), t(5) + t(3) * F.col("p.u") + t(4) * F.col("p.v"))
    bounds = edge.select("scene_id", lon.alias("lon"), lat.alias("lat")).groupBy("scene_id").agg(F.min("lon").alias("lon0"), F.min("lat").alias("lat0"), F.max("lon").alias("lon1"), F.max("lat").alias("lat1"))
    return scenes.join(bounds, "scene_id")


def cut_ring(x: np.ndarray, y: np.ndarray, bound: float, above: bool) -> tuple[np.ndarray, np.ndarray]:
    """The part of a closed ring on one side of the line x = ``bound``; where a side crosses it, a corner is put in."""
    if not len(x):
        return x, y
    inside = x >= bound if above else x <= bound
    x1, y1 = np.roll(x, -1), np.roll(y, -1)
    crosses = inside != np.roll(inside, -1)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = y + (y1 - y) * (bound - x) / (x1 - x)
    # after each corner comes the crossing of the side that it begins
    keep = np.stack([inside, crosses], 1).ravel()
    return np.stack([x, np.full(len(x), bound)], 1).ravel()[keep], np.stack([y, at], 1).ravel()[keep]


def clipped(rings: DataFrame, scenes: DataFrame) -> DataFrame:
    """scene_id, polygon, ring, points in longitude and latitude: the rings (polygon, ring, points) cut to each scene's bounds
    (``footprints``).  Rings that leave no area are left out, so a scene at sea has no row."""
    cell = lambda c: F.floor(c / CELL).cast("int")
    over = lambda df, x0, y0, x1, y1: df.select("*", F.explode(F.sequence(cell(x0), cell(x1))).alias("gx")).select("*", F.explode(F.sequence(cell(y0), cell(y1))).alias("gy"))
    reach = rings.where(F.size("points") >= 3).select("*", *(f(F.transform("points", lambda p: p[a])).alias(n) for n, f, a in (("px0", F.array_min, "x"), ("py0", F.array_min, "y"), ("px1", F.array_max, "x"), ("py1", F.array_max, "y"))))
    land = over(reach, F.col("px0"), F.col("py0"), F.col("px1"), F.col("py1"))
    near = over(scenes.select("scene_id", "lon0", "lat0", "lon1", "lat1"), F.col("lon0"), F.col("lat0"), F.col("lon1"), F.col("lat1"))
    met = land.join(near, ["gx", "gy"]).where("px0 < lon1 and lon0 < px1 and py0 < lat1 and lat0 < py1")
    # a pair counts in the cell of its overlap's lower left corner
    first = (F.col("gx") == cell(F.greatest("px0", "lon0"))) & (F.col("gy") == cell(F.greatest("py0", "lat0")))
    out = met.where(first).select("scene_id", "polygon", "ring", "points", "lon0", "lat0", "lon1", "lat1")

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                x, y = (np.array([p[a] for p in r.points], float) for a in "xy")
                for bound, above in ((r.lon0, True), (r.lon1, False)):
                    x, y = cut_ring(x, y, bound, above)
                for bound, above in ((r.lat0, True), (r.lat1, False)):
                    y, x = cut_ring(y, x, bound, above)
                if len(x) >= 3:
                    rows.append((r.scene_id, r.polygon, r.ring, [{"x": a, "y": b} for a, b in zip(x.tolist(), y.tolist())]))
            yield pd.DataFrame(rows, columns=["scene_id", "polygon", "ring", "points"])

    kinds = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    ship(rings.sparkSession)
    return out.mapInPandas(walk, f"scene_id {kinds['scene_id']}, polygon {kinds['polygon']}, ring {kinds['ring']}, points array<struct<x: double, y: double>>")


def pixel_edges(rings: DataFrame, scenes: DataFrame) -> DataFrame:
    """The sides (scene_id, polygon, x0, y0, x1, y1 in pixels) of clipped rings, by each scene's projection and transform (north up)."""
    joined = rings.join(scenes.select("scene_id", "epsg", "transform"), "scene_id")
    t = lambda i: F.col("transform")[i]

    def place(p: Column) -> Column:
        x, y = from_lonlat(F.col("epsg"), p["x"], p["y"])
        return F.struct(((x - t(2)) / t(0)).alias("x"), ((y - t(5)) / t(4)).alias("y"))

    return polygons.sides(joined.select("scene_id", "polygon", F.transform("points", place).alias("points")))


def edges_of(land: DataFrame, scenes: DataFrame) -> DataFrame:
    """Land (polygon, ring, points in longitude and latitude) as the sides of its clips to the scenes, in their pixels."""
    bounded = footprints(scenes)
    return pixel_edges(clipped(land, bounded), bounded)
