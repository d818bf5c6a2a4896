import json
import random

from pyspark.sql import functions as F

from tilescan.operators import polygons
from tilescan.sources import files


def inside(x, y, rings):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay <= y) != (by <= y) and x >= ax + (y - ay) * (bx - ax) / (by - ay):
                odd = not odd
    return odd


def test_polygon_mask_against_every_pixel(spark):
    rng = random.Random(3)
    shapes = [(rng.randrange(2), [[(rng.uniform(-3, 23), rng.uniform(-3, 23)) for _ in range(rng.randrange(3, 8))] for _ in range(rng.randrange(1, 3))]) for _ in range(6)]
    rings = [(s, str(k), [{"x": x, "y": y} for x, y in ring]) for k, (s, rs) in enumerate(shapes) for ring in rs]
    table = spark.createDataFrame(rings, "scene_id int, polygon string, points array<struct<x:double,y:double>>")
    px = spark.createDataFrame([(s, r, c, 7) for s in range(3) for r in range(20) for c in range(20)], "scene_id int, r int, c int, dn int")
    got = {(r["scene_id"], r["r"], r["c"]): r["dn"] for r in polygons.polygons_masked(px, polygons.sides(table)).collect()}
    assert len(got) == 1200
    for (s, r, c), v in got.items():
        assert (v is None) == any(s == t and inside(c + 0.5, r + 0.5, rs) for t, rs in shapes)


def meets(c, r, ring):
    """A side of the ring runs through the pixel: it is cut to the pixel's square and something is left."""
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        t0, t1 = 0.0, 1.0
        for start, delta, low in ((ax, bx - ax, c), (ay, by - ay, r)):
            if delta == 0:
                if not low <= start < low + 1:
                    t0 = 2.0
                continue
            u, v = sorted(((low - start) / delta, (low + 1 - start) / delta))
            t0, t1 = max(t0, u), min(t1, v)
        if t0 <= t1:
            return True
    return False


def test_mask_of_touched_pixels_against_every_pixel(spark):
    rng = random.Random(8)
    shapes = [(rng.randrange(2), [(rng.uniform(-3, 23), rng.uniform(-3, 23)) for _ in range(rng.randrange(3, 8))]) for _ in range(4)]
    shapes.append((2, [(1.25, 2.5), (7.5, 2.5), (7.5, 2.75), (1.25, 2.75)]))  # level and upright sides, no centre but on a side
    table = spark.createDataFrame([(s, str(k), [{"x": x, "y": y} for x, y in ring]) for k, (s, ring) in enumerate(shapes)], "scene_id int, polygon string, points array<struct<x:double,y:double>>")
    px = spark.createDataFrame([(s, r, c, 7) for s in range(4) for r in range(20) for c in range(20)], "scene_id int, r int, c int, dn int")
    got = {(x["scene_id"], x["r"], x["c"]): x["dn"] for x in polygons.polygons_masked(px, polygons.sides(table), all_touched=True).collect()}
    assert len(got) == 1600
    for (s, r, c), v in got.items():
        assert (v is None) == any(s == t and (inside(c + 0.5, r + 0.5, [ring]) or meets(c, r, ring)) for t, ring in shapes), (s, r, c)


def test_tags_of_sidecars(spark, tmp_path):
    item = "<PAMDataset><Metadata>{}</Metadata><Metadata domain='d' format='xml'><g:A xmlns:g='u'><g:b>1</g:b></g:A></Metadata></PAMDataset>"
    (tmp_path / "a.jp2.aux.xml").write_text(item.format("<MDI key='max_val'>0.25</MDI>\n<MDI key='min_val'>-1.5</MDI><MDI key='note'>x y</MDI>"))
    (tmp_path / "b.jp2.aux.xml").write_text(item.format("<MDI key='max_val'>none</MDI>"))
    (tmp_path / "c.xml").write_text(item.format("<MDI key='max_val'>9</MDI>"))
    tags = files.raster_tags(spark, str(tmp_path))
    assert sorted((r["path"].rsplit("/", 1)[1], r["tags"]) for r in tags.collect()) == [("a.jp2.aux.xml", {"max_val": "0.25", "min_val": "-1.5", "note": "x y"}), ("b.jp2.aux.xml", {"max_val": "none"})]
    assert sorted((r["lo"], r["hi"]) for r in files.value_range(tags).collect()) == [(-1.5, 0.25), (0.0, 1.0)]


def test_no_polygons_and_level_sides(spark):
    px = spark.createDataFrame([(1, 0, 0, 5)], "scene_id int, r int, c int, dn int")
    none = spark.createDataFrame([(1, "a", 0.0, 0.5, 9.0, 0.5)], "scene_id int, polygon string, x0 double, y0 double, x1 double, y1 double")
    assert polygons.polygons_masked(px, none).first()["dn"] == 5
    assert polygons.polygons_masked(px, none.where("false")).first()["dn"] == 5


def test_detections_as_csv(spark, tmp_path):
    rows = [("b.tif", 1.5, 2.0, 3.25, 4.0, 0.25), ("a.tif", -1.0, 0.0, 1.0, 2.0, 0.5)]
    df = spark.createDataFrame(rows, "filename string, x0 double, y0 double, x1 double, y1 double, confidence double")
    files.write_detections(df, str(tmp_path / "d"))
    assert [tuple(r) for r in files.read_detections(spark, str(tmp_path / "d")).collect()] == sorted(rows)
    files.write_detections(df.where("false"), str(tmp_path / "e"))
    assert [p.read_text() for p in (tmp_path / "e").glob("*.csv")] == ["filename,bbox,confidence\n"]
    (tmp_path / "f.csv").write_text('filename,bbox,confidence\nx,"[ 1 2   3 4 ]",0.5\nx,1 2 3,0.5\nx,,0.5\n')
    assert [tuple(r) for r in files.read_detections(spark, str(tmp_path / "f.csv")).collect()] == [("x", 1.0, 2.0, 3.0, 4.0, 0.5)]


def test_list_of_rasters(spark, tmp_path):
    for name in ("b.tif", "a.jp2", "c.tiff", "d.TIF", "e.png"):
        (tmp_path / name).write_bytes(b"xy")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "z.tif").write_bytes(b"")
    assert [r["path"].rsplit("/", 1)[1] for r in files.rasters(spark, str(tmp_path)).collect()] == ["a.jp2", "b.tif", "c.tiff"]


def test_polygons_of_geojson(spark, tmp_path):
    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]
    features = [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [square, hole]}}, {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[hole], [square]]}}]
    (tmp_path / "land.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    rows = files.read_polygons(spark, str(tmp_path / "land.json")).orderBy("polygon", "ring").collect()
    assert [(r["polygon"], r["ring"], len(r["points"])) for r in rows] == [("0.0", 0, 5), ("0.0", 1, 5), ("1.0", 0, 5), ("1.1", 0, 5)]
    assert rows[1]["points"][2]["x"] == 2.0
    px = spark.range(25).select(F.lit(1).alias("scene_id"), (F.col("id") / 5).cast("int").alias("r"), (F.col("id") % 5).cast("int").alias("c"), F.lit(1).alias("dn"))
    land = files.read_polygons(spark, str(tmp_path / "land.json")).where("polygon = '0.0'").withColumn("scene_id", F.lit(1))
    left = polygons.polygons_masked(px, polygons.sides(land)).where("dn is not null")
    assert {(r["r"], r["c"]) for r in left.collect()} == {(1, 1)} | {(4, k) for k in range(5)} | {(k, 4) for k in range(5)}
