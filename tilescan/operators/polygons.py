"""Masks of polygons on pixel tables, by scan lines: only DataFrame functions, joined by equality of scene and row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilescan.operators.pixels import hidden


def spans(edges: DataFrame) -> DataFrame:
    """scene_id, r, spans (array of from, to): where row r's centre line runs inside a polygon, by the even-odd rule.

    ``edges`` has scene_id, polygon, x0, y0, x1, y1 in pixels, one row for each side of a ring (holes are further rings of the
    same polygon).  A side holds its upper end and not its lower one, so a corner counts once; level sides count nowhere.
    """
    y, low, high = F.col("r") + F.lit(0.5), F.least("y0", "y1"), F.greatest("y0", "y1")
    first, last = F.ceil(low - 0.5).cast("int"), (F.ceil(high - 0.5) - 1).cast("int")
    crossing = F.col("x0") + (y - F.col("y0")) * (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
    lines = edges.where(first <= last).withColumn("r", F.explode(F.sequence(first, last))).select("scene_id", "polygon", "r", crossing.alias("x"))
    line = lines.groupBy("scene_id", "polygon", "r").agg(F.array_sort(F.collect_list("x")).alias("x"))
    pairs = F.transform(F.sequence(F.lit(0), F.size("x") - 2, F.lit(2)), lambda k: F.struct(F.get("x", k).alias("from"), F.get("x", k + 1).alias("to")))
    return line.where(F.size("x") >= 2).withColumn("span", F.explode(pairs)).groupBy("scene_id", "r").agg(F.collect_list("span").alias("spans"))


def crossed(edges: DataFrame) -> DataFrame:
    """scene_id, r, spans: the columns through which sides of polygons run in row r.

    A pixel holds its upper and left border and not the others; a side counts with both its ends.
    """
    low, high, r = F.least("y0", "y1"), F.greatest("y0", "y1"), F.col("r")
    lines = edges.withColumn("r", F.explode(F.sequence(F.floor(low).cast("int"), F.floor(high).cast("int"))))

    def at(y: Column) -> Column:
        x = F.col("x0") + (y - F.col("y0")) * (F.col("x1") - F.col("x0")) / F.nullif(F.col("y1") - F.col("y0"), F.lit(0.0))
        # rounding must not carry the crossing past the side's ends
        return F.greatest(F.least("x0", "x1"), F.least(F.greatest("x0", "x1"), x))

    a, b = at(F.greatest(low, r.cast("double"))), at(F.least(high, r + F.lit(1.0)))
    level = F.col("y0") == F.col("y1")
    left = F.when(level, F.least("x0", "x1")).otherwise(F.least(a, b))
    right = F.when(level, F.greatest("x0", "x1")).otherwise(F.greatest(a, b))
    span = F.struct(F.floor(left).cast("double").alias("from"), (F.floor(right) + 1).cast("double").alias("to"))
    return lines.groupBy("scene_id", "r").agg(F.collect_set(span).alias("spans"))


def polygons_masked(pixels: DataFrame, edges: DataFrame, all_touched: bool = False) -> DataFrame:
    """Pixels (scene_id, r, c, dn) whose centre lies in a polygon become nodata, with ``all_touched`` also those through
    which a side runs; without polygons nothing changes."""
    rows = spans(edges)
    if all_touched:
        rows = rows.unionByName(crossed(edges)).groupBy("scene_id", "r").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return hidden(pixels, rows)


def sides(rings: DataFrame) -> DataFrame:
    """The sides of rings (scene_id, polygon, points: array of x, y); an open ring is closed."""
    n, p = F.size("points"), F.col("points")
    pair = F.transform(p, lambda q, k: F.struct(q["x"].alias("x0"), q["y"].alias("y0"), F.get(p, (k + 1) % n)["x"].alias("x1"), F.get(p, (k + 1) % n)["y"].alias("y1")))
    return rings.select("scene_id", "polygon", F.explode(pair).alias("s")).select("scene_id", "polygon", "s.*")
