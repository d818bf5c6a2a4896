"""Masks, percentile clips, rescaling and round trips of scenes, on pixel tables (scene_id, r, c, dn: null is nodata)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilescan.functions import pixels as P


def nodata_value(pixels: DataFrame, sample: int = 128, metadata: Column | None = None) -> DataFrame:
    """By scene: the metadata's value, else -9999 if the upper left sample has a value below -9000, else 0."""
    low = F.coalesce(F.max(F.when((F.col("r") < sample) & (F.col("c") < sample), (F.col("dn") < -9000).cast("int"))), F.lit(0))
    found = F.when(low > 0, -9999.0).otherwise(0.0)
    return pixels.groupBy("scene_id").agg((found if metadata is None else F.coalesce(F.max(metadata), found)).alias("nodata"))


def dilated(pixels: DataFrame, n: int) -> DataFrame:
    """``masked``: whether a masked pixel (nodata 1) lies within n rows and n columns.  One direction, then the other."""
    row = W.partitionBy("scene_id", "r").orderBy("c").rangeBetween(-n, n)
    return _columns(pixels.withColumn("across", F.max("nodata").over(row)), n)


def _columns(pixels: DataFrame, n: int) -> DataFrame:
    # where the pixel of a column is absent, its row's neighbours count through their own columns only if present
    column = W.partitionBy("scene_id", "c").orderBy("r").rangeBetween(-n, n)
    return pixels.withColumn("masked", F.max("across").over(column)).drop("across")


def scene_percentiles(pixels: DataFrame, ps: list[float], value: str = "dn", accuracy: int = 10_000) -> DataFrame:
    """(scene_id, p: array of the exact percentiles, in 0 to 100, between neighbours by distance; nulls do not count).

    Two passes, as a scene has some hundred million pixels: a sketch whose ranks are right to n / ``accuracy`` brackets each
    percentile; the values within a bracket are counted by value, those below it as a number, and the neighbours are picked
    by their running count.  What one task holds is a sketch, or the distinct values of a bracket.
    """
    x = F.col(value).cast("double")
    points = sorted({min(1.0, max(0.0, p / 100 + d)) for p in ps for d in (-2 / accuracy, 2 / accuracy)} | {0.0, 1.0})
    at = {q: k for k, q in enumerate(points)}
    sketch = pixels.where(x.isNotNull()).groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(x, points, F.lit(accuracy)).alias("q"), F.min(x).alias("least"), F.max(x).alias("most"))

    def edge(p: float, side: int) -> Column:
        q, end = p / 100 + side * 2 / accuracy, F.col("least") if side < 0 else F.col("most")
        # of few values all are counted, as the sketch's margin would be less than a rank
        return end if not 0 < q < 1 else F.when(F.col("n") <= 10 * accuracy, end).otherwise(F.col("q")[at[q]])

    place = lambda p: (F.col("n") - 1) * F.lit(p / 100)
    brackets = sketch.select("scene_id", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), place(p).alias("place"), edge(p, -1).alias("lo"), edge(p, 1).alias("hi")) for k, p in enumerate(ps)))).alias("e")).select("scene_id", "e.*")
    by_scene = brackets.groupBy("scene_id").agg(F.collect_list(F.struct("k", "place", "lo", "hi")).alias("e"))  # len(ps) each
    met = pixels.where(x.isNotNull()).select("scene_id", x.alias("x")).join(by_scene, "scene_id").select("scene_id", "x", F.explode("e").alias("e")).where("x <= e.hi")
    counts = met.groupBy("scene_id", "e.k", "e.place", F.when(F.col("x") >= F.col("e.lo"), F.col("x")).alias("x")).agg(F.count(F.lit(1)).alias("n"))
    upto = counts.withColumn("upto", F.sum("n").over(W.partitionBy("scene_id", "k").orderBy(F.col("x").asc_nulls_first())))
    pick = lambda rank: F.min(F.when(F.col("x").isNotNull() & (F.col("upto") > rank), F.col("x")))
    low, high = F.floor("place"), F.ceil("place")
    picked = upto.groupBy("scene_id", "k", "place").agg(pick(low).alias("a"), pick(high).alias("b"), F.max(F.when(F.col("x").isNull(), F.col("n"))).alias("below"))
    sure = F.when((F.coalesce("below", F.lit(0)) <= low) & F.col("b").isNotNull(), F.col("a") + (F.col("place") - low) * (F.col("b") - F.col("a"))).otherwise(F.raise_error(F.lit("the sketch did not bracket a percentile")).cast("double"))
    found = picked.select("scene_id", F.struct("k", sure.alias("v")).alias("e")).groupBy("scene_id").agg(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["v"]).alias("p"))
    return found


def _with(pixels: DataFrame, stats: DataFrame) -> DataFrame:
    """``pixels`` with the figures of their scene (null where it has none)."""
    return pixels.join(stats, "scene_id", "left")


def percentile_clipped(pixels: DataFrame, low: float = 0.0, high: float = 99.9) -> DataFrame:
    joined = _with(pixels, scene_percentiles(pixels, [low, high]))
    return joined.withColumn("dn", P.clipped(F.col("dn").cast("double"), F.col("p")[0], F.col("p")[1])).drop("p")


def top_clamped(pixels: DataFrame, high: float) -> DataFrame:
    joined = _with(pixels, scene_percentiles(pixels, [high]))
    return joined.withColumn("dn", F.when(F.col("dn").isNotNull(), F.least(F.col("dn").cast("double"), F.col("p")[0]))).drop("p")


def outliers_removed(pixels: DataFrame, high: float) -> DataFrame:
    if not 0 < high < 100:
        return pixels
    joined = _with(pixels, scene_percentiles(pixels, [high]))
    return joined.withColumn("dn", F.when(F.col("dn") <= F.col("p")[0], F.col("dn"))).drop("p")


def in_decibels(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("dn", P.decibels(F.col("dn").cast("double")))


def stretched(pixels: DataFrame, top: int = 255, low: float = 0.0, high: float = 99.0) -> DataFrame:
    joined = _with(pixels, scene_percentiles(pixels, [low, high]))
    return joined.withColumn("dn", P.stretched(F.col("dn").cast("double"), F.col("p")[0], F.col("p")[1], top)).drop("p")


def in_uint16(pixels: DataFrame) -> DataFrame:
    """16-bit numbers with the scene's range (min_val, max_val)."""
    span = pixels.groupBy("scene_id").agg(F.min(F.col("dn").cast("double")).alias("min_val"), F.max(F.col("dn").cast("double")).alias("max_val"))
    return _with(pixels, span).withColumn("dn16", P.to_uint16(F.col("dn").cast("double"), F.col("min_val"), F.col("max_val")))


def expanded(packed: DataFrame) -> DataFrame:
    return packed.withColumn("value", P.from_uint16(F.col("dn16"), F.col("min_val"), F.col("max_val")))


def agreement(both: DataFrame, a: str, b: str) -> DataFrame:
    """By scene: pixels valid in both, correlation and root mean square error."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    return both.where(x.isNotNull() & y.isNotNull()).groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("correlation"), F.sqrt(F.avg((x - y) * (x - y))).alias("rmse"))


def divergence(both: DataFrame, a: str, b: str, bins: int = 50) -> DataFrame:
    """By scene the divergence of b's histogram density from a's, on ``bins`` equal bins over a's range; densities are at
    least 1e-12, values of b outside the range do not count, and fewer than two values on a side give 0."""
    span = both.groupBy("scene_id").agg(F.min(a).cast("double").alias("lo"), F.max(a).cast("double").alias("hi"), F.count(a).alias("na"), F.count(b).alias("nb"))
    joined = _with(both, span).withColumn("width", F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / bins).otherwise(F.lit(1.0) / bins))
    low = F.when(F.col("hi") > F.col("lo"), F.col("lo")).otherwise(F.col("lo") - 0.5)
    place = lambda c: F.least(F.lit(bins - 1), F.floor((F.col(c) - low) / F.col("width")))
    inside = lambda c: F.col(c).isNotNull() & (F.col(c) >= F.col("lo")) & (F.col(c) <= F.col("hi"))
    long = joined.select("scene_id", "width", "na", "nb", F.explode(F.array(F.struct(F.when(inside(a), place(a)).alias("bin"), F.lit(1).alias("ca"), F.lit(0).alias("cb")), F.struct(F.when(inside(b), place(b)).alias("bin"), F.lit(0).alias("ca"), F.lit(1).alias("cb")))).alias("e")).where("e.bin is not null")
    counts = long.groupBy("scene_id", "e.bin").agg(F.sum("e.ca").alias("ca"), F.sum("e.cb").alias("cb"), F.first("width").alias("width"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    all_bins = W.partitionBy("scene_id")
    tiny = F.lit(1e-12)
    dens = counts.withColumn("da", F.greatest(tiny, F.col("ca") / (F.sum("ca").over(all_bins) * F.col("width")))).withColumn("db", F.greatest(tiny, F.coalesce(F.try_divide(F.col("cb"), F.sum("cb").over(all_bins) * F.col("width")), F.lit(0.0))))
    # bins that are empty on both sides add 1e-12 * ln(1) = 0
    return dens.groupBy("scene_id").agg(F.when((F.first("na") < 2) | (F.first("nb") < 2), 0.0).otherwise(F.sum(F.col("da") * F.log(F.col("da") / F.col("db")))).alias("kl"))


def tiles(pixels: DataFrame, side: int) -> DataFrame:
    """Whole tiles of side x side pixels as arrays in row order; missing pixels are null."""
    at = F.expr(f"cast((r % {side}) * {side} + c % {side} as int)")
    got = pixels.groupBy("scene_id", F.expr(f"r div {side}").alias("tr"), F.expr(f"c div {side}").alias("tc")).agg(F.map_from_entries(F.collect_list(F.struct(at.alias("k"), F.col("dn").cast("double").alias("v")))).alias("m"))
    return got.select("scene_id", "tr", "tc", F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)), lambda k: F.try_element_at("m", k)).alias("tile"))


def tiles_to_uint8(tiled: DataFrame, percent: float = 99.0) -> DataFrame:
    """Tiles clipped to their least value and percentile and scaled to 1 to 255, cut to whole numbers; nodata 0; without a
    range 128 everywhere, without a value 0 everywhere."""
    valid = F.array_sort(F.filter("tile", lambda x: x.isNotNull()))
    withv = tiled.withColumn("v", valid).withColumn("n", F.size("v"))
    pos = (F.col("n") - 1) * (percent / 100)
    k = F.floor(pos).cast("int")
    high = F.expr("try_element_at(v, {0})".format("n")) if percent == 100 else F.try_element_at("v", k + 1) + (pos - k) * (F.coalesce(F.try_element_at("v", k + 2), F.try_element_at("v", k + 1)) - F.try_element_at("v", k + 1))
    out = withv.withColumn("lo", F.try_element_at("v", F.lit(1))).withColumn("hi", F.when(F.col("n") > 0, high))
    scaled = F.transform("tile", lambda x: F.when(x.isNull(), 0).otherwise(F.floor((F.least(x, F.col("hi")) - F.col("lo")) / (F.col("hi") - F.col("lo")) * 254 + 1).cast("int")))
    return out.withColumn("tile8", F.when(F.col("n") == 0, F.transform("tile", lambda x: F.lit(0))).when(F.col("hi") == F.col("lo"), F.transform("tile", lambda x: F.lit(128))).otherwise(scaled)).drop("v", "n", "lo", "hi")


def resized(tiled: DataFrame, side: int, to: int) -> DataFrame:
    """Nearest neighbour: row i of the result is row floor(i * side / to)."""
    k = F.sequence(F.lit(0), F.lit(to * to - 1))
    at = lambda i: F.floor(F.floor(i / to) * side / to) * side + F.floor((i % to) * side / to) + 1
    return tiled.withColumn("tile", F.transform(k, lambda i: F.element_at("tile", at(i).cast("int"))))


def rectangles_masked(pixels: DataFrame, land: DataFrame) -> DataFrame:
    """Pixels whose centre lies in a rectangle (scene_id, x0, y0, x1, y1 in pixels) become nodata.  Rectangles become spans of
    rows, which meet pixels by equality of scene and row."""
    first, last = F.ceil(F.col("y0") - 0.5).cast("int"), (F.ceil(F.col("y1") - 0.5) - 1).cast("int")
    lines = land.where(first <= last).select("scene_id", F.explode(F.sequence(first, last)).alias("r"), F.struct(F.col("x0").alias("from"), F.col("x1").alias("to")).alias("span"))
    return hidden(pixels, lines.groupBy("scene_id", "r").agg(F.collect_list("span").alias("spans")))


def hidden(pixels: DataFrame, rows: DataFrame) -> DataFrame:
    """Pixels whose centre lies in a span (scene_id, r, spans: array of from, to) become nodata."""
    x = F.col("c") + F.lit(0.5)
    inside = F.exists("spans", lambda s: (x >= s["from"]) & (x < s["to"]))
    return pixels.join(rows, ["scene_id", "r"], "left").withColumn("dn", F.when(~F.coalesce(inside, F.lit(False)), F.col("dn"))).select(*pixels.columns)
