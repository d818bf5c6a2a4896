import math

import numpy as np
from pyspark.sql import functions as F

from tilescan.operators import land
from tilescan.sources import files


def test_known_places_in_utm(spark):
    # Toronto's tower and a point of the south: published coordinates
    rows = [(32617, -79.387139, 43.642567, 630084.0, 4833438.0), (32756, 151.215, -33.857, 334873.0, 6252266.0)]
    df = spark.createDataFrame(rows, "epsg int, lon double, lat double, e double, n double")
    x, y = land.from_lonlat(F.col("epsg"), F.col("lon"), F.col("lat"))
    a = df.select(x.alias("x"), y.alias("y"), "e", "n").collect()
    assert all(abs(r["x"] - r["e"]) < 60 and abs(r["y"] - r["n"]) < 60 for r in a)
    lon, lat = land.to_lonlat(F.col("epsg"), x, y)
    assert all(abs(r["u"] - r["lon"]) < 1e-8 and abs(r["v"] - r["lat"]) < 1e-8 for r in df.select(lon.alias("u"), lat.alias("v"), "lon", "lat").collect())


def inside(x, y, ring):
    hit = False
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
        if (y0 <= y) != (y1 <= y) and x < x0 + (y - y0) * (x1 - x0) / (y1 - y0):
            hit = not hit
    return hit


def test_clip_keeps_what_is_within(spark):
    rng = np.random.default_rng(2)
    rings = []
    for k in range(12):
        cx, cy, turns = rng.uniform(-4, 4), rng.uniform(-4, 4), sorted(rng.uniform(0, 2 * math.pi, 9))
        rings.append((f"p{k}", 0, [(cx + math.cos(t) * rng.uniform(0.5, 3), cy + math.sin(t) * rng.uniform(0.5, 3)) for t in turns]))
    rings.append(("line", 0, [(0.0, 0.0), (1.0, 1.0)]))
    df = spark.createDataFrame(rings, "polygon string, ring int, points array<struct<x: double, y: double>>")
    scenes = spark.createDataFrame([(1, 100, 80, [0.02, 0.0, -1.0, 0.0, -0.02, 0.6], 4326), (2, 50, 50, [0.1, 0.0, 60.0, 0.0, -0.1, 40.0], 4326)], "scene_id int, width int, height int, transform array<double>, epsg int")
    bounds = {r["scene_id"]: r for r in land.footprints(scenes).collect()}
    assert abs(bounds[1]["lon1"] - 1.0) < 1e-9 and abs(bounds[1]["lat0"] + 1.0) < 1e-9
    got = {r["polygon"]: [(p["x"], p["y"]) for p in r["points"]] for r in land.clipped(df, land.footprints(scenes)).collect()}
    assert "line" not in got and got
    for x, y in rng.uniform((-0.99, -0.99), (0.99, 0.59), (400, 2)):
        for name, _, ring in rings[:-1]:
            assert inside(x, y, ring) == (name in got and inside(x, y, got[name]))
    assert all(-1 - 1e-9 <= x <= 1 + 1e-9 and -1 - 1e-9 <= y <= 0.6 + 1e-9 for ring in got.values() for x, y in ring)
    edges = land.edges_of(df, scenes)
    assert edges.where("scene_id = 2").count() == 0 and edges.agg(F.min("x0"), F.max("y1")).first()[0] >= -1e-9


def shp(polygons):
    import struct

    body = b""
    for k, rings in enumerate(polygons, 1):
        points = [p for ring in rings for p in ring]
        starts = [sum(map(len, rings[:i])) for i in range(len(rings))]
        record = struct.pack("<i4dii", 5, *[0.0] * 4, len(rings), len(points)) + struct.pack(f"<{len(starts)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        body += struct.pack(">ii", k, len(record) // 2) + record
    return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<ii8d", 1000, 5, *[0.0] * 8) + body


def test_shapefile(spark, tmp_path):
    square = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0), (0.0, 0.0)]
    hole = [(0.5, 0.5), (1.0, 0.5), (1.0, 1.0), (0.5, 0.5)]
    (tmp_path / "land.shp").write_bytes(shp([[square, hole], [[(5.0, 5.0), (6.0, 5.0), (6.0, 6.0)]]]))
    got = files.read_land(spark, str(tmp_path / "land.shp")).orderBy("polygon", "ring").collect()
    assert [(r["polygon"], r["ring"], len(r["points"])) for r in got] == [("land.shp.1", 0, 5), ("land.shp.1", 1, 4), ("land.shp.2", 0, 3)]
    assert (got[1]["points"][1]["x"], got[1]["points"][1]["y"]) == (1.0, 0.5)
