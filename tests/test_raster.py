import random

import numpy as np
from pyspark.sql import functions as F

from tilescan.functions import pixels as P
from tilescan.operators import jobs, pixels, scoring, windows


def scene(spark, h, w, seed=0):
    rng = random.Random(seed)
    rows = [(1, r, c, None if rng.random() < 0.2 else rng.randrange(1000), 0) for r in range(h) for c in range(w)]
    rows = [(s, r, c, v, int(v is None)) for s, r, c, v, _ in rows]
    df = spark.createDataFrame(rows, "scene_id int, r int, c int, dn long, nodata int")
    a = np.array([np.nan if x[3] is None else x[3] for x in rows], float).reshape(h, w)
    return df, a


def test_windows_and_nodata_counts(spark):
    df, a = scene(spark, 30, 22)
    scenes = spark.createDataFrame([(1, 30, 22), (2, 3, 3)], "scene_id int, height int, width int")
    for win, stride in ((6, 4), (5, 5), (4, 6)):
        got = {(r["row_off"], r["col_off"]): r["n_nodata"] for r in windows.nodata_counts(df, scenes, win, stride).collect()}
        want = {(r, c): int(np.isnan(a[r : r + win, c : c + win]).sum()) for r in range(0, 30 - win + 1, stride) for c in range(0, 22 - win + 1, stride)}
        assert got == want


def test_dilation(spark):
    df, a = scene(spark, 12, 9)
    got = {(r["r"], r["c"]): r["masked"] for r in pixels.dilated(df, 1).collect()}
    m = np.isnan(a)
    assert all(got[r, c] == int(m[max(0, r - 1) : r + 2, max(0, c - 1) : c + 2].any()) for r in range(12) for c in range(9))


def test_clip_and_scales(spark):
    df, a = scene(spark, 10, 10)
    v = a[~np.isnan(a)]
    clip = {(r["r"], r["c"]): r["dn"] for r in pixels.percentile_clipped(df, 5, 90).collect()}
    lo, hi = np.percentile(v, [5, 90])
    assert all((clip[r, c] is None) if np.isnan(a[r, c]) else abs(clip[r, c] - min(max(a[r, c], lo), hi)) < 1e-9 for r in range(10) for c in range(10))
    back = pixels.expanded(pixels.in_uint16(df)).where("dn is not null").collect()
    step = (v.max() - v.min()) / 65535
    assert all(r["value"] is None if r["dn"] == v.min() else abs(r["value"] - r["dn"]) <= step for r in back)
    flat = df.withColumn("dn", F.when(F.col("dn").isNotNull(), F.lit(5)))
    assert {r["dn"] for r in pixels.stretched(flat).collect()} == {0, 1}


def test_tiles(spark):
    df, a = scene(spark, 8, 8)
    t = pixels.tiles_to_uint8(pixels.tiles(df, 4)).collect()
    for r in t:
        x = a[4 * r["tr"] : 4 * r["tr"] + 4, 4 * r["tc"] : 4 * r["tc"] + 4].ravel()
        hi, lo = np.nanpercentile(x, 99), np.nanmin(x)
        want = np.nan_to_num((np.clip(x, lo, hi) - lo) / (hi - lo) * 254 + 1, nan=0).astype(int)
        assert np.abs(np.array(r["tile8"]) - want).max() <= 1
    one = spark.createDataFrame([([1.0, float("nan")],), ([3.0, 3.0],), ([-9999.0, 2.0, 4.0],)], "t array<double>")
    got = [r[0] for r in one.select(P.filled(P.tile_normalised(F.col("t")))).collect()]
    assert got == [[0.0, 0.0], [3.0, 3.0], [-9999.0, 0.0, 1.0]]


def test_jobs_and_files(spark):
    table = spark.createDataFrame([(1, "A", True, False, {"x": "1"}), (2, "A", False, False, {"x": "1", "y": "2"}), (3, "A", False, False, {"x": "1"}), (4, "B", False, True, {"x": "1"}), (5, "C", False, False, {"x": "9"})], "job_id long, granule string, failed boolean, expired boolean, params map<string,string>")
    asked = spark.createDataFrame([("A",), ("B",), ("C",)], "granule string")
    assert {r["granule"]: r["job_id"] for r in jobs.first_match(asked, table, {"x": "1"}).collect()} == {"A": 2, "B": None, "C": None}
    assert jobs.plan(asked, table, {"x": "1"}, None).first().asDict() == {"requested": 3, "existing": 1, "new": 2, "cost": None}
    f = spark.createDataFrame([("G", m) for m in ("d/X_VV.TIF", "d/x_vv.tif", "a_rgb.png", "b.png", "c.xml")], "granule string, member string")
    assert sorted((r["new_name"], r["folder"]) for r in jobs.chosen_files(f).collect()) == [("G.TIF", "png"), ("G.tif", "tif"), ("G_browse.png", "png")]


def test_detector_reports_failures(spark):
    tiles = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, image array<double>")
    got = {r["id"]: r["prediction"] for r in scoring.inferred(tiles, scoring.detector("linear", weights=[[2.0, 0.0], [0.0, 2.0]])).collect()}
    assert got == {1: 0, 2: 1}
    bad = scoring.inferred(tiles, scoring.detector("linear", weights=[[1.0]])).collect()
    assert len(bad) == 2 and all(r["error"] for r in bad)
