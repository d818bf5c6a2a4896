"""Pictures of scenes and of detections.  Scenes are shrunk and crops are read by tasks, one picture a row; each picture is
written by the task that made it, under its final name only once it is whole."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilescan.functions import png
from tilescan.functions.workers import ship
from tilescan.operators import boxes, windows
from tilescan.sources import raster

WRITTEN = "scene_id string, path string, width int, height int, n_boxes int, error string"


def stem(name: Column) -> Column:
    """A file's name without folders and the last ending."""
    return F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"\.[^.]*$", "")


def processed_path(folder: str, name: Column, suffix: str = "") -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), stem(name), F.lit(suffix + ".tif"))


def preview_path(folder: str, name: Column) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), stem(name), F.lit("_preview.png"))


def preview_folder(threshold: float, merged: bool) -> str:
    return f"full_scene_previews{'_merged_bbox' if merged else ''}_{threshold}"


def with_sources(detections: DataFrame, files: DataFrame) -> DataFrame:
    """The detections whose file is among ``files`` (path), by base name."""
    return detections.join(files.select(F.element_at(F.split("path", "/"), -1).alias("filename")).distinct(), "filename", "left_semi")


def without_sources(detections: DataFrame, files: DataFrame) -> DataFrame:
    """The file names of detections that are not among ``files``, with the number of detections that this skips."""
    there = files.select(F.element_at(F.split("path", "/"), -1).alias("filename")).distinct()
    return detections.join(there, "filename", "left_anti").groupBy("filename").agg(F.count(F.lit(1)).alias("n"))


def distinct_files(detections: DataFrame) -> DataFrame:
    """Each file name once, with its number of detections."""
    return detections.where("filename is not null").groupBy("filename").agg(F.count(F.lit(1)).alias("n"))


def grey(rows: np.ndarray, top: float = 98.0) -> np.ndarray:
    """Bytes from the least valid value to the percentile ``top``; nodata is 0."""
    known = rows[~np.isnan(rows)]
    if not known.size:
        return np.zeros(rows.shape, np.uint8)
    low, high = float(known.min()), float(np.percentile(known, top))
    scaled = np.clip((rows - low) / ((high - low) or 1.0), 0, 1) * 254 + 1
    return np.where(np.isnan(rows), 0, scaled).astype(np.uint8)


def _put(path: str, data: bytes) -> None:
    fs, at = raster.store(path)
    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
    other = f"{at.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    with fs.open_output_stream(other) as f:
        f.write(data)
    fs.move(other, at)


def scene_previews(headers: DataFrame, folder: str, detections: DataFrame | None = None, threshold: float = 0.99, rows: int | None = None, scale: float | None = 0.1) -> DataFrame:
    """A PNG of each scene, shrunk to ``rows`` rows or by ``scale``, with the boxes of confidence ``threshold`` or more in red.

    With detections only the scenes that have some; a shrunk scene is small (a hundredth of it at the default).  Longitude and
    latitude of the edges are in the file's notes.  Returns WRITTEN; the files are written when it is evaluated.
    """
    small = raster.decimated(headers, rows, None if rows is not None else scale)
    picture = small.groupBy("scene_id").agg(F.first("width").alias("w"), F.first("height").alias("h"), F.array_sort(F.collect_list(F.struct("r", "data"))).alias("rows"))
    facts = headers.where("error is null").select("scene_id", "width", "height", "transform", preview_path(folder, F.col("scene_id")).alias("target"))
    whole = picture.join(facts, "scene_id")
    if detections is None:
        whole = whole.withColumn("boxes", F.lit(None).cast("array<array<double>>"))
    else:
        per = boxes.confident(detections, threshold).groupBy(F.col("filename").alias("scene_id")).agg(F.collect_list(F.array(*boxes.BOX)).alias("boxes"))
        whole = whole.join(per, "scene_id")

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for x in frame.itertuples():
                try:
                    image = grey(np.array([[np.nan if v is None else v for v in row["data"]] for row in x.rows], float))
                    t, notes, drawn = x.transform, {}, [] if x.boxes is None else list(x.boxes)
                    if t is not None:
                        u, v = x.w / x.width, x.h / x.height
                        at = [((b[0] - t[2]) / t[0] * u, (b[3] - t[5]) / t[4] * v, (b[2] - t[2]) / t[0] * u, (b[1] - t[5]) / t[4] * v) for b in drawn]
                        notes = {"Extent": f"{t[2]} {t[5] + t[4] * x.height} {t[2] + t[0] * x.width} {t[5]}"}
                        image = png.with_boxes(image, at) if drawn else image
                    _put(x.target, png.encoded(image, notes))
                    out.append((x.scene_id, x.target, x.w, x.h, len(drawn), None))
                except Exception as failure:  # noqa: BLE001
                    out.append((x.scene_id, x.target, None, None, None, str(failure)))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in WRITTEN.split(", ")])

    ship(headers.sparkSession)
    return whole.mapInPandas(draw, WRITTEN)


def to_uint8(x: np.ndarray, percent: float = 99.0) -> np.ndarray:
    """Values from the least to the percentile as 1 to 255, cut to whole numbers; nodata 0; without a range 128 everywhere."""
    known = x[~np.isnan(x)]
    if not known.size:
        return np.zeros(x.shape, np.uint8)
    low, high = float(known.min()), float(np.percentile(known, percent))
    if low == high:
        return np.full(x.shape, 128, np.uint8)
    return np.nan_to_num((np.clip(x, low, high) - low) / (high - low) * 254 + 1, nan=0).astype(np.uint8)


def detection_tiles(headers: DataFrame, detections: DataFrame, folder: str, threshold: float = 0.9, buffer: int = 32, patch: int = 128, split: bool = True) -> DataFrame:
    """A PNG of the surroundings of each detection of confidence ``threshold`` or more, normalised to bytes, in a folder for each
    scene unless ``split`` is off.  Names carry the row's place ``i`` before the filter.  A detection that fails has its error."""
    numbered = boxes.crop_names(boxes.confident(detections, threshold), F.col("i")).withColumnRenamed("filename", "scene_id")
    placed = windows.preview_windows_of(numbered.join(headers.where("error is null").select("scene_id", "width", "height", "transform", "epsg"), "scene_id"), buffer, patch)
    top = f"{folder.rstrip('/')}/positive_detection_tiles_{threshold}"
    target = F.concat(F.lit(top + "/"), stem(F.col("scene_id")), F.lit("/"), F.col("crop")) if split else F.concat(F.lit(top + "/"), F.col("crop"))
    images = raster.window_images(headers, placed.select("scene_id", "i", "row_off", "col_off", "win_h", "win_w", target.alias("target")))

    def save(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for x in frame.itertuples():
                try:
                    _put(x.target, png.encoded(to_uint8(np.array(x.image, float).reshape(x.shape))))
                    out.append((x.scene_id, x.target, x.shape[1], x.shape[0], 1, None))
                except Exception as failure:  # noqa: BLE001
                    out.append((x.scene_id, x.target, None, None, None, str(failure)))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in WRITTEN.split(", ")])

    ship(headers.sparkSession)
    return images.mapInPandas(save, WRITTEN)


def histogram_chart(both: DataFrame, a: str, b: str, folder: str, bins: int = 50) -> DataFrame:
    """A PNG by scene with the histograms of two columns over the range of the first, and of their difference: scene_id, path,
    and the counts (na, nb, residual).  The counts are aggregated by Spark."""
    span = both.groupBy("scene_id").agg(F.min(F.col(a).cast("double")).alias("lo"), F.max(F.col(a).cast("double")).alias("hi"), F.max(F.abs(F.col(a).cast("double") - F.col(b).cast("double"))).alias("far"))
    joined = both.join(span, "scene_id")
    place = lambda x, low, high: F.when(x.isNotNull() & (x >= low) & (x <= high), F.least(F.lit(bins - 1), F.coalesce(F.floor((x - low) / F.nullif(high - low, F.lit(0.0)) * bins), F.lit(0))))
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    three = F.array(F.struct(F.lit(0).alias("s"), place(x, F.col("lo"), F.col("hi")).alias("bin")), F.struct(F.lit(1).alias("s"), place(y, F.col("lo"), F.col("hi")).alias("bin")), F.struct(F.lit(2).alias("s"), place(x - y, -F.col("far"), F.col("far")).alias("bin")))
    counts = joined.select("scene_id", F.explode(three).alias("e")).where("e.bin is not null").groupBy("scene_id", "e.s", "e.bin").agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy("scene_id").agg(F.collect_list(F.struct("s", "bin", "n")).alias("counts"))

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples():
                table = np.zeros((3, bins), np.int64)
                for e in r.counts:
                    table[e["s"], int(e["bin"])] = e["n"]
                path = f"{folder.rstrip('/')}/{r.scene_id}_histogram.png"
                _put(path, png.encoded(np.concatenate([png.bars([table[0], table[1]]), png.bars([table[2], table[2] * 0])])))
                out.append((str(r.scene_id), path, *(x.tolist() for x in table)))
            yield pd.DataFrame(out, columns=["scene_id", "path", "na", "nb", "residual"])

    ship(both.sparkSession)
    return per.mapInPandas(draw, "scene_id string, path string, na array<long>, nb array<long>, residual array<long>")
