import random

from pyspark.sql import functions as F

from tilescan.functions.geometry import iou, parse_box
from tilescan.operators import boxes

SCHEMA = "filename string, confidence double, ordinal long, x0 double, y0 double, x1 double, y1 double"


def made(n, seed=1):
    rng, rows = random.Random(seed), []
    for k in range(n):
        x, y = rng.randrange(40) / 8, 30 + rng.randrange(40) / 8
        rows.append((f"s{k % 2}.tif", rng.randrange(10) / 10, k, x, y, x + 1, y + 1))
    return rows


def shapes(rows):
    return [boxes.Shape([r[3:7]], [r[1]]) for r in rows]


def brute_nms(rows, t):
    out = []
    for r in sorted(rows, key=lambda r: (-r[1], -r[2])):
        if all(boxes.Shape([k[3:7]], [0]).overlap(boxes.Shape([r[3:7]], [0])) <= t for k in out):
            out.append(r)
    return out


def test_suppression_equals_brute_force(spark):
    rows = made(60)
    got = boxes.suppressed(spark.createDataFrame(rows, SCHEMA), 0.2).orderBy("filename", "rank").collect()
    for name in ("s0.tif", "s1.tif"):
        assert [r["ordinal"] for r in got if r["filename"] == name] == [r[2] for r in brute_nms([r for r in rows if r[0] == name], 0.2)]


def test_merge_stages(spark):
    rows = made(40, 3)
    got = boxes.merged(spark.createDataFrame(rows, SCHEMA), 0.9, 0.2, 0.1).collect()
    for name in ("s0.tif", "s1.tif"):
        done = boxes.unite(shapes(brute_nms([r for r in rows if r[0] == name], 0.9)), 0.2)
        envelopes = [(name, sum(s.confidences) / len(s.confidences), k, s.x0, s.y0, s.x1, s.y1) for k, s in enumerate(done)]
        assert sorted((round(r["confidence"], 9), r["x0"], r["y1"]) for r in got if r["filename"] == name) == sorted((round(e[1], 9), e[3], e[6]) for e in brute_nms(envelopes, 0.1))


def test_threshold_itself_stays_and_empty_boxes_do_not_meet(spark):
    a, b = boxes.Shape([(0, 0, 2, 1)], [1.0]), boxes.Shape([(1, 0, 3, 1)], [0.5])
    t = a.overlap(b)
    rows = [("f", 1.0, 0, 0.0, 0.0, 2.0, 1.0), ("f", 0.5, 1, 1.0, 0.0, 3.0, 1.0), ("f", 0.4, 2, 1.0, 1.0, 1.0, 1.0), (None, 0.4, 3, 1.0, 1.0, 1.0, 1.0), ("f", None, 4, 0.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert boxes.suppressed(df, t + 1e-12).count() == 3
    assert boxes.suppressed(df, t - 1e-9).count() == 2
    assert len(boxes.unite([a, b], t)) == 2
    assert df.limit(0).transform(lambda d: boxes.merged(d)).count() == 0


def test_united_area_is_that_of_the_union():
    s = boxes.Shape([(0, 0, 2, 2)], [1]).united(boxes.Shape([(1, 1, 3, 3)], [1]))
    assert s.area == 7 and (s.x0, s.y1) == (0, 3) and len(s.confidences) == 2


def test_pairs_equal_the_join_of_all(spark):
    df = spark.createDataFrame(made(50, 5), SCHEMA)
    a, b = df.alias("a"), df.alias("b")
    box = lambda s: F.struct(*(F.col(f"{s}.{c}").alias(c) for c in boxes.BOX))
    every = a.join(b, (F.col("a.filename") == F.col("b.filename")) & (F.col("a.ordinal") < F.col("b.ordinal"))).where(iou(box("a"), box("b")) > 0)
    assert boxes.pairwise_iou(df).count() == every.count() > 0


def test_parse_box(spark):
    given = ["1 2 3", "a b c d", None, "", "[ 1 2 3 4 ]", "1  2 3 4", "[1 2 3 4 5]", "[33.5 -1 2.25 0 ]"]
    got = spark.createDataFrame([(x,) for x in given], "s string").select(parse_box(F.col("s"))).collect()
    assert [r[0] for r in got] == [None] * 4 + [[1, 2, 3, 4]] * 2 + [None, [33.5, -1, 2.25, 0]]
