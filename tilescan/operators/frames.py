"""The frame pipeline: a raw scene's pixels masked, dilated, clipped and converted, as tables (scene_id, r, c, dn: null is nodata)."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescan.operators import pixels as X
from tilescan.operators import polygons
from tilescan.sources import raster

KEYS = ("clip_percentile", "dilate_px", "convert_to_db", "save_masked", "masked_dtype", "compress")


def setting(config: Any, name: str) -> Any:
    """A setting by attribute or by key; one that is not there is an error."""
    if not isinstance(config, Mapping) and hasattr(config, name):
        return getattr(config, name)
    if isinstance(config, Mapping) and name in config:
        return config[name]
    raise KeyError(f"configuration key {name!r} not found")


def percentile_range(clip: Any) -> tuple[float, float]:
    """A number p stands for (0, p); a pair for itself; anything else, a list too, is an error."""
    if isinstance(clip, tuple) and len(clip) == 2:
        return float(clip[0]), float(clip[1])
    if isinstance(clip, (int, float)) and not isinstance(clip, bool):
        return 0.0, float(clip)
    raise TypeError("clip_percentile must be a number or a pair of numbers")


def grown(pixels: DataFrame, n: int) -> DataFrame:
    """Nodata grown by n pixels in both directions; as it is for n = 0."""
    if n <= 0:
        return pixels
    marked = X.dilated(pixels.withColumn("nodata", F.col("dn").isNull().cast("int")), n)
    return marked.withColumn("dn", F.when(F.col("masked") == 0, F.col("dn"))).select(*pixels.columns)


def masked_and_clipped(pixels: DataFrame, edges: DataFrame | None = None, clip: Any = 99.9, dilate: int = 0) -> DataFrame:
    """Pixels on land (sides of polygons, ``land.edges_of``) become nodata, nodata grows, and what is left is clipped."""
    low, high = percentile_range(clip)
    sea = pixels if edges is None else polygons.polygons_masked(pixels, edges)
    return X.percentile_clipped(grown(sea, dilate), low, high)


def preprocessed(pixels: DataFrame, config: Any, edges: DataFrame | None = None) -> DataFrame:
    """The whole chain: land mask, dilation, percentile clip, decibels if ``convert_to_db``.  All settings of KEYS must be there."""
    given = {k: setting(config, k) for k in KEYS}
    out = masked_and_clipped(pixels, edges, given["clip_percentile"], given["dilate_px"])
    return X.in_decibels(out) if given["convert_to_db"] else out


def as_type(pixels: DataFrame, dtype: str) -> DataFrame:
    """The numbers that a file of ``dtype`` holds, nodata as 0: floats as they are (a real 0 becomes nodata, too), integers stretched."""
    if dtype == "float32":
        return pixels.withColumn("dn", F.coalesce(F.col("dn").cast("float"), F.lit(0.0).cast("float")))
    tops = {"uint8": 255, "uint16": 65535}
    if dtype not in tops:
        raise ValueError(f"dtype must be float32, uint16 or uint8, not {dtype!r}")
    return X.stretched(pixels, tops[dtype])


def preprocess_files(headers: DataFrame, config: Any, folder: str, land: DataFrame | None = None, suffix: str = "") -> DataFrame:
    """Rasters (``raster.profiles``) through the chain to files in ``folder``; scene_id, path, n_bytes of each file."""
    from tilescan.operators.land import edges_of

    scenes = headers.where("error is null").select("scene_id", "width", "height", "transform", "epsg", "geographic")
    table = raster.pixels(raster.blocks(headers))
    out = as_type(preprocessed(table, config, None if land is None else edges_of(land, scenes)), setting(config, "masked_dtype"))
    return raster.write(raster.from_pixels(out, scenes), scenes, folder, setting(config, "masked_dtype"), setting(config, "compress"), suffix=suffix)


def compressed_16_bit(pixels: DataFrame, percentile: float | None = None) -> DataFrame:
    """Pixels as 16-bit numbers (``dn16``) with the range (min_val, max_val) that they stand for; ``percentile`` clamps the top
    first.  A scene without a valid pixel is an error."""
    clamped = X.top_clamped(pixels, percentile) if percentile is not None else pixels
    out = X.in_uint16(clamped)
    empty = F.when(F.col("min_val").isNull(), F.raise_error(F.concat(F.lit("no valid pixel in scene "), F.col("scene_id").cast("string"))).cast("int"))
    return out.withColumn("dn16", F.coalesce(empty, F.col("dn16")))


def write_16_bit(pixels: DataFrame, scenes: DataFrame, folder: str, percentile: float | None = None, suffix: str = "_compressed_lossless") -> DataFrame:
    """Files of 16-bit numbers with their range in the tags ``min_val`` and ``max_val``; lossless Deflate, as there is no JPEG 2000
    codec.  ``raster.blocks`` expands them when it reads them."""
    packed = compressed_16_bit(pixels, percentile)
    span = packed.groupBy("scene_id").agg(F.create_map(F.lit("min_val"), F.max("min_val").cast("string"), F.lit("max_val"), F.max("max_val").cast("string")).alias("tags"))
    blocked = raster.from_pixels(packed.select("scene_id", "r", "c", F.col("dn16").alias("dn")), scenes)
    return raster.write(blocked, scenes.drop("tags").join(span, "scene_id"), folder, "uint16", "DEFLATE", suffix=suffix)


def write_masked_float(pixels: DataFrame, scenes: DataFrame, folder: str, nodata: float = -9999.0, suffix: str = "_masked") -> DataFrame:
    """Float files in which nodata is -9999."""
    return raster.write(raster.from_pixels(pixels, scenes), scenes, folder, "float32", "DEFLATE", nodata, suffix=suffix)
