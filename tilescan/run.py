"""The inference workflow on DataFrames: set up, score the windows of all rasters, write detections, make pictures."""

from __future__ import annotations

import logging
import os
import sys
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilescan.operators import boxes, previews, scoring, windows
from tilescan.operators import networks as N
from tilescan.sources import files, raster

Dataset = Callable[[SparkSession, Mapping[str, Any]], tuple[DataFrame, DataFrame]]
DATASETS: dict[str, Dataset] = {}


def dataset(name: str) -> Callable[[Dataset], Dataset]:
    """Puts a function on the list of datasets: settings to (headers, windows)."""

    def put(f: Dataset) -> Dataset:
        DATASETS[name] = f
        return f

    return put


@dataset("tiles")
def tiles(spark: SparkSession, config: Mapping[str, Any]) -> tuple[DataFrame, DataFrame]:
    """The rasters of a folder, and the windows of which less than a share is nodata; none is an error."""
    if not config.get("geotiff_dir"):
        raise ValueError("geotiff_dir must name a folder or a file")
    win, stride = int(config["window_size"]), int(config["stride_factor"] * config["window_size"])
    headers = raster.profiles(spark, config["geotiff_dir"])
    scenes = headers.where("error is null").select("scene_id", "height", "width")
    table = raster.pixels(raster.blocks(headers)).withColumn("nodata", F.col("dn").isNull().cast("int"))
    kept = windows.mostly_valid(windows.nodata_counts(table, scenes, win, stride), win, config["nodata_threshold"])
    if config.get("var_threshold"):
        kept = windows.varied(kept, table, win, stride, config["var_threshold"])
    found = kept.withColumn("win_h", F.lit(win)).withColumn("win_w", F.lit(win))
    return headers, found


def logs(folder: str | None = None, level: int = logging.INFO) -> None:
    """Messages to the standard output and, with a folder, to a file there; failed jobs to a file of their own."""
    form = "%(asctime)s %(levelname)s %(message)s"
    logging.basicConfig(level=level, format=form, handlers=[logging.StreamHandler(sys.stdout)], force=True)
    if folder:
        os.makedirs(folder, exist_ok=True)
        for name, file in ((None, "workflow.log"), ("failed_jobs", "failed_jobs.log")):
            handler = logging.FileHandler(os.path.join(folder, file))
            handler.setFormatter(logging.Formatter(form))
            logging.getLogger(name).addHandler(handler)


class Detection:
    """A configured run.  ``setup`` raises where a part cannot be had; nothing is computed before ``run_inference``."""

    def __init__(self, spark: SparkSession, config: Mapping[str, Any], detector: scoring.Detector | None = None, transform: Callable[[DataFrame, int], DataFrame] | None = None):
        self.spark, self.config, self.detector, self.transform = spark, config, detector, transform
        self.headers: DataFrame | None = None
        self.windows: DataFrame | None = None
        stem, ending = os.path.splitext(config["identification_table_path"])
        self.raw, self.merged = config["identification_table_path"], f"{stem}_merged{ending}"

    def setup(self) -> bool:
        if self.detector is None:
            name = self.config["detector_class_name"]
            self.detector = scoring.detector(name, weights=N.load(self.config)[0]) if name == "residual" else scoring.detector(name, **self.config.get("detector_params", {}))
        name = self.config["dataset_params"]["dataset_class_name"]
        if name not in DATASETS:
            raise ValueError(f"no dataset {name!r}; there are {sorted(DATASETS)}")
        self.headers, self.windows = DATASETS[name](self.spark, {"geotiff_dir": self.config.get("geotiff_dir"), **self.config["dataset_params"]})
        if not self.windows.head(1):
            raise ValueError("no valid windows")
        return True

    def scored(self) -> DataFrame:
        """Every window with its box, prediction and confidence, or the error of its batch."""
        facts = self.headers.where("error is null").select("scene_id", "transform", "epsg")
        placed = raster.numbered(self.windows).join(facts, "scene_id")
        win = int(self.config["dataset_params"]["window_size"])
        boxed = windows.geo_boxes_of(placed, win).select("n", "scene_id", "row_off", "col_off", "win_h", "win_w", "bbox_geo")
        images = raster.zero_images(raster.window_images(self.headers, boxed)).where(~F.col("all_zero"))
        tiles_ = images.select(F.col("n").alias("id"), "scene_id", "bbox_geo", F.transform("image", lambda x: x.cast("double")).alias("tile"))
        shaped = self.transform(tiles_, win) if self.transform else tiles_.withColumn("tile", F.transform("tile", lambda x: F.coalesce(x, F.lit(0.0))))
        batch = int(self.config.get("batch_size", 128))
        return scoring.inferred(shaped.withColumnRenamed("tile", "image"), self.detector, batch, keep=("scene_id", "bbox_geo"))

    def run_inference(self) -> tuple[str, str]:
        """Writes the positive windows and what suppression and merging leave of them; the two paths."""
        found = self.scored()
        hits = scoring.positives(found.withColumn("path", F.col("scene_id")), int(self.config["positive_class_index"]))
        boxed = hits.select("filename", "confidence", F.col("id").alias("ordinal"), *(F.col("bbox_geo")[k].cast("double").alias(c) for k, c in enumerate(boxes.BOX)))
        files.write_detections(boxed, self.raw)
        t = self.config["bbox_merging"]
        files.write_merged(self.spark, self.raw, self.merged, t["nms_iou_threshold"], t["merge_iou_threshold"], t["post_nms_iou_threshold"])
        return self.raw, self.merged

    def detections(self, merged: bool) -> DataFrame:
        """The written detections with their place ``i`` in the file."""
        return files.numbered_detections(self.spark, self.merged if merged else self.raw)

    def create_scene_previews_with_bbox(self, confidence_threshold: float = 0.99, merged: bool = False) -> DataFrame:
        folder = os.path.join(self.config["output_dir"], previews.preview_folder(confidence_threshold, merged))
        return previews.scene_previews(self.headers, folder, self.detections(merged), confidence_threshold)

    def save_positive_detection_tiles(self, confidence_threshold: float = 0.9, merged: bool = True, patch_size: int = 128, bbox_buffer_pixels: int = 32, split_scenes_into_folders: bool = True) -> DataFrame:
        return previews.detection_tiles(self.headers, self.detections(merged), self.config["output_dir"], confidence_threshold, bbox_buffer_pixels, patch_size, split_scenes_into_folders)


def inference(spark: SparkSession, config: Mapping[str, Any], **parts: Any) -> Detection:
    """The whole run: detections, then previews and crops of the merged ones at 0.5."""
    run = Detection(spark, config, **parts)
    run.setup()
    run.run_inference()
    for made in (run.create_scene_previews_with_bbox(0.5, True), run.save_positive_detection_tiles(0.5, True, 256)):
        failed = made.where("error is not null").count()
        if failed:
            logging.warning("%d pictures were not made", failed)
    return run
