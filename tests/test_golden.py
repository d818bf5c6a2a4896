"""The detections of the sample scene, and growing unions against areas counted on a fine grid."""

import itertools
import random

import pytest

from tilescan.operators import boxes

# fixed values: column and row on the grid of windows, and confidence, of the sample scene's detections
DETECTIONS = """
11 16 0.7093630433082581, 12 18 0.9916138648986816, 7 19 0.5304350256919861, 11 19 0.967114269733429, 22 19 0.9670708179473877, 9 20 0.9998217225074768,
10 20 0.9588093757629395, 11 21 0.9995167255401611, 22 21 0.9999558925628662, 19 22 0.6646398901939392, 21 22 0.8825351595878601, 11 23 0.5256954431533813,
16 26 0.9999940395355225, 17 26 0.879409670829773, 25 26 0.9999923706054688, 16 27 0.7718402743339539, 14 28 0.935135543346405, 19 28 0.8256447315216064,
12 29 0.9771844744682312, 15 29 0.9928281903266907, 18 29 0.9926605224609375, 12 30 0.9906545281410217, 16 30 0.6537629961967468, 17 30 0.9235793352127075,
20 30 0.9873191118240356, 22 30 0.9816085696220398, 10 31 0.9649704694747925, 12 31 0.9435703158378601, 14 31 0.9976027607917786, 16 31 0.8775959610939026,
11 32 0.8150664567947388, 11 34 0.6807278394699097, 13 35 0.9117515087127686, 14 35 0.999964714050293, 16 35 0.9990580677986145, 13 36 0.7325563430786133,
21 36 0.9749488234519958, 11 37 0.9972773194313049, 12 37 0.991177499294281, 13 37 0.9998093247413635, 12 40 0.7675047516822815
"""
WEST, NORTH, PIXEL = -118.79701057395, 34.1688213687152, 0.000269494585235856
SCHEMA = "filename string, confidence double, ordinal long, x0 double, y0 double, x1 double, y1 double"


def sample():
    rows = []
    for k, part in enumerate(DETECTIONS.replace("\n", " ").split(",")):
        c, r, confidence = part.split()
        x, y = WEST + PIXEL * 175 * int(c), NORTH - PIXEL * 175 * int(r)
        rows.append(("scene.tif", float(confidence), k, x, y - 700 * PIXEL, x + 700 * PIXEL, y))
    return rows


def test_sample_scene(spark):
    df = spark.createDataFrame(sample(), SCHEMA).cache()
    kept = boxes.suppressed(df, 0.05).orderBy("rank").collect()
    assert [r["ordinal"] for r in kept] == [12, 14, 33, 8, 5, 28, 37, 1, 24, 36, 26, 9]
    assert [boxes.suppressed(df, t).count() for t in (0.1, 0.3, 0.5, 0.9)] == [15, 24, 32, 41]
    out = boxes.merged(df).orderBy("rank").collect()
    assert [round(r["confidence"], 9) for r in out] == [round(r["confidence"], 9) for r in kept]


@pytest.mark.parametrize("thresholds,stages,first", [((0.9, 0.3, 0.1), (41, 24, 14), (-117.61797, 32.753975, -117.42933, 32.94262, 0.999992371)), ((0.5, 0.2, 0.1), (32, 16, 9), (-118.04243, 32.753975, -117.85378, 32.94262, 0.999994040))])
def test_sample_scene_with_thresholds_that_merge(spark, thresholds, stages, first):
    df = spark.createDataFrame(sample(), SCHEMA)
    nms, merge, post = thresholds
    one = boxes.suppressed(df, nms)
    two = boxes.united(one, merge)
    out = boxes.merged(df, *thresholds).orderBy("rank").collect()
    assert (one.count(), two.count(), len(out)) == stages
    assert all(abs(a - b) < 2e-4 for a, b in zip((out[0][c] for c in ("x0", "y0", "x1", "y1", "confidence")), first))


def cells(shape):
    return {(x, y) for x0, y0, x1, y1 in shape for x in range(x0, x1) for y in range(y0, y1)}


def counted(a, b):
    """Overlap of unions of whole-numbered boxes at the equator-like scale 1: counts of unit cells."""
    p, q = cells(a), cells(b)
    return len(p & q) / len(p | q)


def test_unions_against_counted_cells(monkeypatch):
    """With the scale held at 1, areas are counts of cells; order, growth and passes are written out plainly here."""
    monkeypatch.setattr(boxes, "cos", lambda _: 1.0)
    rng = random.Random(3)
    for _ in range(60):
        raw = [(x, y, x + rng.randint(2, 6), y + rng.randint(2, 6)) for x, y in ((rng.randrange(14), rng.randrange(14)) for _ in range(9))]
        got = boxes.unite([boxes.Shape([tuple(map(float, b))], [float(k)], k) for k, b in enumerate(raw)], 0.15)
        groups = [[k] for k in range(len(raw))]
        while True:
            joined = False
            k = 0
            while k < len(groups):
                for other in list(groups[k + 1 :]):
                    if counted([raw[i] for i in groups[k]], [raw[i] for i in other]) > 0.15:
                        groups[k] = groups[k] + other
                        groups.remove(other)
                        joined = True
                k += 1
            if not joined:
                break
        assert [sorted(int(c) for c in s.confidences) for s in got] == [sorted(g) for g in groups]
        assert all(s.area == len(cells([raw[i] for i in g])) for s, g in zip(got, groups))


def test_parts_of_a_scene_are_apart(spark):
    rng = random.Random(7)
    rows = [("s", rng.random(), k, x, y, x + 1, y + 1) for k, (x, y) in enumerate((rng.uniform(0, 40), rng.uniform(0, 40)) for _ in range(80))]
    found = {r["ordinal"]: r["part"] for r in boxes.parted(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(set(found.values())) > 3
    for a, b in itertools.combinations(rows, 2):
        if min(a[5], b[5]) > max(a[3], b[3]) and min(a[6], b[6]) > max(a[4], b[4]):
            assert found[a[2]] == found[b[2]]
    assert len(found) == 80
