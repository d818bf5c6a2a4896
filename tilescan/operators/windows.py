"""Sliding windows over scenes, and how much of them is nodata."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilescan.functions.geometry import window_transform


def grid(scenes: DataFrame, win: int, stride: int) -> DataFrame:
    """(scene_id, col_off, row_off) of all windows that lie within the scenes (scene_id, height, width), and their index ``i``."""
    fit = scenes.where((F.col("height") >= win) & (F.col("width") >= win))
    rows = fit.withColumn("row_off", F.explode(F.sequence(F.lit(0), F.col("height") - win, F.lit(stride))))
    out = rows.withColumn("col_off", F.explode(F.sequence(F.lit(0), F.col("width") - win, F.lit(stride))))
    across = F.floor((F.col("width") - win) / stride) + 1
    return out.select("scene_id", F.col("row_off").cast("int"), F.col("col_off").cast("int"), (F.col("row_off") / stride * across + F.col("col_off") / stride).cast("long").alias("i"))


def nodata_counts(pixels: DataFrame, scenes: DataFrame, win: int, stride: int) -> DataFrame:
    """Windows with their exact number of nodata pixels.  Pixels (scene_id, r, c, nodata) are summed by cells of side
    gcd(win, stride), of which every window is a whole number; a cell meets its windows by equality.  Missing pixels are nodata."""
    g = gcd(win, stride)
    n, step = win // g, stride // g
    cells = pixels.groupBy("scene_id", F.expr(f"r div {g}").alias("gr"), F.expr(f"c div {g}").alias("gc")).agg(F.sum(1 - F.col("nodata")).alias("valid"))
    # the windows that cover a cell start at most n - 1 cells before it
    start = lambda c: F.sequence(F.greatest(F.lit(0), F.ceil((F.col(c) - n + 1) / step)).cast("long"), F.floor(F.col(c) / step).cast("long"))
    some = (F.ceil((F.col("gr") - n + 1) / step) <= F.floor(F.col("gr") / step)) & (F.ceil((F.col("gc") - n + 1) / step) <= F.floor(F.col("gc") / step))
    dealt = cells.where(some).withColumn("wr", F.explode(start("gr"))).withColumn("wc", F.explode(start("gc")))
    sums = dealt.groupBy("scene_id", (F.col("wr") * stride).cast("int").alias("row_off"), (F.col("wc") * stride).cast("int").alias("col_off")).agg(F.sum("valid").alias("valid"))
    return grid(scenes, win, stride).join(sums, ["scene_id", "row_off", "col_off"], "left").select("scene_id", "row_off", "col_off", "i", (F.lit(win * win) - F.coalesce("valid", F.lit(0))).cast("long").alias("n_nodata"))


def mostly_valid(counted: DataFrame, win: int, threshold: float) -> DataFrame:
    return counted.where(F.col("n_nodata") < threshold * win * win)


def named(windows: DataFrame) -> DataFrame:
    """Windows with names: the scene and the place among its windows that remain."""
    i = F.row_number().over(W.partitionBy("scene_id").orderBy("row_off", "col_off")) - 1
    return windows.withColumn("name", F.concat(F.col("scene_id").cast("string"), F.lit("_win"), i.cast("string")))


def geo_boxes(windows: DataFrame, transform: list[float], win: int) -> DataFrame:
    """Pixel boxes, lon/lat boxes as floats (north up) and affine transforms of windows."""
    a, _, c, _, e, f = transform
    lon0, lat1 = F.lit(c) + F.lit(a) * F.col("col_off"), F.lit(f) + F.lit(e) * F.col("row_off")
    return windows.select(
        "*",
        F.array("col_off", "row_off", F.col("col_off") + win, F.col("row_off") + win).alias("bbox"),
        F.array(*(x.cast("float") for x in (lon0, lat1 + F.lit(e) * win, lon0 + F.lit(a) * win, lat1))).alias("bbox_geo"),
        window_transform(transform, F.col("col_off"), F.col("row_off")).alias("transform"),
    )


def geo_boxes_of(windows: DataFrame, win: int) -> DataFrame:
    """``bbox``, ``bbox_geo`` and the window's ``transform`` for windows with the scene's ``transform`` and ``epsg``.  Of the
    bounds in the scene's projection the corners (left, bottom) and (right, top) alone are brought to longitude and latitude."""
    from tilescan.operators.land import to_lonlat

    t = lambda k: F.col("transform")[k]
    col, row = F.col("col_off"), F.col("row_off")
    left, top = t(2) + t(0) * col, t(5) + t(4) * row
    (lon0, lat0), (lon1, lat1) = to_lonlat(F.col("epsg"), left, top + t(4) * win), to_lonlat(F.col("epsg"), left + t(0) * win, top)
    own = F.array(t(0), t(1), t(2) + t(0) * col + t(1) * row, t(3), t(4), t(5) + t(3) * col + t(4) * row)
    placed = windows.withColumn("bbox", F.array("col_off", "row_off", F.col("col_off") + win, F.col("row_off") + win))
    return placed.withColumn("bbox_geo", F.array(*(x.cast("float") for x in (lon0, lat0, lon1, lat1)))).withColumn("transform", own)


def varied(kept: DataFrame, pixels: DataFrame, win: int, stride: int, least: float) -> DataFrame:
    """Of the windows ``kept`` those whose valid pixels have a variance of ``least`` or more.  An extension; sums of cells as in
    ``nodata_counts``."""
    g = gcd(win, stride)
    n, step = win // g, stride // g
    x = F.col("dn").cast("double")
    cells = pixels.groupBy("scene_id", F.expr(f"r div {g}").alias("gr"), F.expr(f"c div {g}").alias("gc")).agg(F.count(x).alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q"))
    start = lambda c: F.sequence(F.greatest(F.lit(0), F.ceil((F.col(c) - n + 1) / step)).cast("long"), F.floor(F.col(c) / step).cast("long"))
    some = (F.ceil((F.col("gr") - n + 1) / step) <= F.floor(F.col("gr") / step)) & (F.ceil((F.col("gc") - n + 1) / step) <= F.floor(F.col("gc") / step))
    dealt = cells.where(some).withColumn("wr", F.explode(start("gr"))).withColumn("wc", F.explode(start("gc")))
    sums = dealt.groupBy("scene_id", (F.col("wr") * stride).cast("int").alias("row_off"), (F.col("wc") * stride).cast("int").alias("col_off")).agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    good = sums.where((F.col("n") > 0) & (F.col("q") / F.col("n") - (F.col("s") / F.col("n")) * (F.col("s") / F.col("n")) >= least))
    return kept.join(good.select("scene_id", "row_off", "col_off"), ["scene_id", "row_off", "col_off"], "left_semi")


def _grown(start: Column, end: Column, least: int, size: Column) -> tuple[Column, Column]:
    """[start, end) as it is if it has ``least`` pixels; else moved back by half of what lacks, and then of ``least`` pixels,
    of which the last lies within ``size``: a full patch wherever the scene has one."""
    short = F.lit(float(least)) - (end - start)
    low = F.greatest(F.lit(0.0), start - F.floor(short / 2))
    high = F.least(size, low + least)
    return F.when(short > 0, F.greatest(F.lit(0.0), high - least)).otherwise(start), F.when(short > 0, high).otherwise(end)


def preview_windows(boxes: DataFrame, transform: list[float], buffer: int = 32, patch: int = 128) -> DataFrame:
    """``preview_windows_of`` for scenes of one transform (width and height are columns), in longitude and latitude."""
    with_transform = boxes.withColumn("transform", F.array(*(F.lit(float(x)) for x in transform))).withColumn("epsg", F.lit(None).cast("int"))
    return preview_windows_of(with_transform, buffer, patch).drop("transform", "epsg")


def preview_windows_of(boxes: DataFrame, buffer: int = 32, patch: int = 128) -> DataFrame:
    """Pixel windows (col_off, row_off, win_w, win_h) of lon/lat boxes (x0..y1, and the scene's width, height, transform, epsg).

    Corners are put in order and brought to the scene's projection by their corners' bounds; offsets are rounded down (within
    a tenth of a pixel up) and sizes to the nearest, as the customary raster library does; then windows are widened by
    ``buffer``, cut to the scene, and grown to ``patch``.  The offset is clamped at 0 while the size is not, so windows at the
    upper left reach further.  Boxes outside the scene have no row."""
    from tilescan.operators.land import from_lonlat

    def within(df: DataFrame, **columns: Column) -> DataFrame:
        return df.select("*", *(c.alias(f"__{n}") for n, c in columns.items()))

    c = lambda name: F.col(f"__{name}")
    t = lambda k: F.col("transform")[k]
    size = {"x": F.col("width").cast("double"), "y": F.col("height").cast("double")}
    # each step has names of its own, so that no expression is written out where it is used
    out = within(boxes, west=F.least("x0", "x1"), east=F.greatest("x0", "x1"), south=F.least("y0", "y1"), north=F.greatest("y0", "y1"))
    corners = F.array(*(F.struct(c(u).alias("lon"), c(v).alias("lat")) for u in ("west", "east") for v in ("south", "north")))
    placed = F.transform(corners, lambda p: F.struct(*(v.alias(n) for n, v in zip("xy", from_lonlat(F.col("epsg"), p["lon"], p["lat"])))))
    out = within(within(out, p=placed), **{f"{a}{k}": f(c("p")[a]) for a in "xy" for k, f in ((0, F.array_min), (1, F.array_max))})
    out = within(out, ox=F.floor((c("x0") - t(2)) / t(0) + 0.1).cast("double"), oy=F.floor((c("y1") - t(5)) / t(4) + 0.1).cast("double"), wx=F.floor((c("x1") - c("x0")) / t(0) + 0.5), wy=F.floor((c("y0") - c("y1")) / t(4) + 0.5))
    out = within(out, **{f"a{k}": F.greatest(F.lit(0.0), c(f"o{k}") - buffer) for k in "xy"})
    out = within(out, **{f"b{k}": F.least(size[k], c(f"a{k}") + c(f"w{k}") + 2 * buffer) for k in "xy"}).where((c("bx") > c("ax")) & (c("by") > c("ay")))
    grown = {k: _grown(c(f"a{k}"), c(f"b{k}"), patch, size[k]) for k in "xy"}
    out = within(out, **{f"{n}{k}": grown[k][i] for k in "xy" for i, n in enumerate("se")})
    return out.select(*boxes.columns, *(v.cast("long").alias(n) for n, v in (("col_off", c("sx")), ("row_off", c("sy")), ("win_w", c("ex") - c("sx")), ("win_h", c("ey") - c("sy")))))
