"""Files: lists of rasters, tables of detections as CSV, land polygons as GeoJSON or shapefiles."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilescan.functions import geometry as G
from tilescan.functions.workers import ship
from tilescan.operators import boxes

# fixed values: columns and patterns
COLUMNS = "filename string, bbox string, confidence double"
RASTERS = "*.{tif,tiff,jp2}"


def rasters(spark: SparkSession, path: str) -> DataFrame:
    """path and length of the rasters of a folder (not of its subfolders), or of one file; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", RASTERS).option("recursiveFileLookup", "false").load(path)
    return files.select("path", "length").orderBy("path")


def _detection_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The three columns of a CSV file or folder, or nothing if it is not there, empty, or lacks one of them."""
    try:
        whole = spark.read.option("header", True).csv(path)
    except AnalysisException as failure:
        if failure.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    if not {"filename", "bbox", "confidence"} <= set(whole.columns):
        return None
    return whole.select("filename", "bbox", F.col("confidence").try_cast("double").alias("confidence"))


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """filename, x0, y0, x1, y1, confidence; rows whose box is not four numbers are left out.  A file that is not there, is empty
    or lacks a column has no rows."""
    rows = _detection_rows(spark, path)
    return with_boxes(spark.createDataFrame([], COLUMNS) if rows is None else rows)


def numbered_detections(spark: SparkSession, path: str) -> DataFrame:
    """``read_detections`` with ``i``, the row's place in the file, before rows without a box are left out."""
    rows = _detection_rows(spark, path)
    rows = (spark.createDataFrame([], COLUMNS) if rows is None else rows).withColumn("at", F.monotonically_increasing_id())
    # the upper bits name the partition, the lower 33 count its rows
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = rows.groupBy(part.alias("part")).count()
    before = counts.select("part", F.coalesce(F.sum("count").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # one row a partition
    placed = rows.withColumn("part", part).join(F.broadcast(before), "part").withColumn("i", (F.col("before") + within).cast("int"))
    b = placed.withColumn("b", G.parse_box(F.col("bbox"))).where("b is not null")
    return b.select("i", "filename", *(F.col("b")[k].alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))), "confidence")


def with_boxes(table: DataFrame) -> DataFrame:
    """filename, bbox, confidence with the box as numbers; of a table or a stream."""
    parsed = table.withColumn("b", G.parse_box(F.col("bbox"))).where("b is not null")
    return parsed.select("filename", *(F.col("b")[k].alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))), "confidence")


def write_detections(found: DataFrame, path: str, single: bool = True) -> None:
    """Writes filename, bbox, confidence with a header, also when there are no rows.  ``single``: one file, in the order of
    filename and descending confidence (detections are few beside pixels; switch it off where they are not)."""
    table = found.select("filename", G.box_text(F.array("x0", "y0", "x1", "y1")).alias("bbox"), "confidence")
    if single:
        table = table.coalesce(1).sortWithinPartitions("filename", F.desc("confidence"), "bbox")
    table.write.mode("overwrite").option("header", True).csv(path)


def write_merged(spark: SparkSession, source: str, path: str, nms: float = 0.05, merge: float = 0.3, post: float = 0.1) -> None:
    """Reads written detections and writes what suppression and merging leave of them, by scene in the order of confidence."""
    rows = numbered_detections(spark, source).withColumnRenamed("i", "ordinal")
    write_detections(boxes.merged(rows.withColumn("ordinal", F.col("ordinal").cast("long")), nms, merge, post), path)


def raster_tags(spark: SparkSession, path: str) -> DataFrame:
    """path and tags (a map) of the XML sidecars of rasters; of a repeated tag the largest value stays."""
    items = spark.read.format("xml").option("rowTag", "MDI").option("pathGlobFilter", "*.aux.xml").schema("_key string, _VALUE string").load(path)
    tag = items.select(F.col("_metadata.file_path").alias("path"), F.col("_key").alias("key"), F.col("_VALUE").alias("value")).where("key is not null")
    single = tag.groupBy("path", "key").agg(F.max("value").alias("value"))
    return single.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("tags"))


def value_range(tags: DataFrame) -> DataFrame:
    """path, lo, hi of ``raster_tags``: the range that 16-bit numbers stand for, 0 to 1 where a tag is absent or no number."""
    number = lambda key, default: F.coalesce(F.col("tags")[key].try_cast("double"), F.lit(default))
    return tags.select("path", number("min_val", 0.0).alias("lo"), number("max_val", 1.0).alias("hi"))


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """polygon, ring, points (array of x, y) of the Polygon and MultiPolygon features of a GeoJSON collection."""
    shape = "features array<struct<geometry:struct<type:string,coordinates:string>>>"
    found = spark.read.option("multiLine", True).schema(shape).json(path).select(F.posexplode("features").alias("feature", "f"))
    single = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    many = F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>")
    parts = F.when(F.col("f.geometry.type") == "Polygon", F.array(single)).when(F.col("f.geometry.type") == "MultiPolygon", many)
    part = found.select("feature", F.posexplode(parts).alias("part", "rings"))
    polygon = F.concat_ws(".", F.col("feature").cast("string"), F.col("part").cast("string")).alias("polygon")
    ring = part.select(polygon, F.posexplode("rings").alias("ring", "p"))
    return ring.select("polygon", "ring", F.transform("p", lambda q: F.struct(q[0].alias("x"), q[1].alias("y"))).alias("points"))


def shapes(data: bytes) -> Iterator[tuple[int, list[list[tuple[float, float]]]]]:
    """(number, rings) of the polygons of a .shp file; other kinds of shapes are passed over."""
    if struct.unpack(">i", data[:4])[0] != 9994:
        raise ValueError("not a shapefile")
    at = 100
    while at + 8 <= len(data):
        number, words = struct.unpack(">ii", data[at : at + 8])
        kind = struct.unpack_from("<i", data, at + 8)[0]
        if kind in (5, 15, 25):
            n_parts, n_points = struct.unpack_from("<ii", data, at + 44)
            starts = [*struct.unpack_from(f"<{n_parts}i", data, at + 52), n_points]
            flat = struct.unpack_from(f"<{2 * n_points}d", data, at + 52 + 4 * n_parts)
            points = list(zip(flat[::2], flat[1::2]))
            yield number, [points[a:b] for a, b in zip(starts, starts[1:])]
        at += 8 + 2 * words


def read_shapefile(spark: SparkSession, path: str) -> DataFrame:
    """polygon, ring, points (array of x, y) of the polygons of .shp files, taken for longitude and latitude."""

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, data in zip(frame["path"], frame["content"]):
                rows = [(f"{name.rsplit('/', 1)[-1]}.{number}", k, [{"x": x, "y": y} for x, y in ring]) for number, rings in shapes(bytes(data)) for k, ring in enumerate(rings)]
                yield pd.DataFrame(rows, columns=["polygon", "ring", "points"])

    ship(spark)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.shp").load(path).select("path", "content")
    return found.mapInPandas(walk, "polygon string, ring int, points array<struct<x: double, y: double>>")


def read_land(spark: SparkSession, path: str) -> DataFrame:
    """Land polygons of a shapefile or of GeoJSON, by the path's ending."""
    return read_shapefile(spark, path) if path.lower().endswith(".shp") else read_polygons(spark, path)
