"""python -m tilescan [mode=full|hyp3_only|inference_only] [key.sub=value ...]
python -m tilescan preprocess|check|compress INPUT [OUTPUT] [key=value ...]"""

from __future__ import annotations

import importlib
import os
import sys

from pyspark.sql import SparkSession

from tilescan import config as C
from tilescan import run as R
from tilescan.operators import frames, jobs, previews
from tilescan.sources import files, raster, remote

TOOLS = ("preprocess", "check", "compress")


def session() -> SparkSession:
    return SparkSession.builder.appName("tilescan").getOrCreate()


def service_of(settings: C.Settings):
    """The maker of the remote service that ``hyp3.service`` names (module:function, of a module that is installed)."""
    name = settings.hyp3.get("service")
    if not name:
        raise ValueError("hyp3.service must name the maker of a service (module:function); none is built in")
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def ingest(spark: SparkSession, settings: C.Settings) -> list[str]:
    """Granules from the service, preprocessed, with previews; the granules that failed."""
    granules = list(settings.hyp3.granules)
    if not granules:
        return []
    retry = remote.Retry(connections=int(settings.hyp3.connection_pool_maxsize))
    result = remote.run(spark, granules, service_of(settings), settings.paths.download_dir, int(settings.hyp3.max_parallel_jobs), wanted=dict(settings.hyp3.job_parameters) or None, keep_zip=settings.hyp3.keep_zip, temp=settings.paths.temp_dir, retry=retry)
    told = result.collect()  # one row a granule of the request
    preprocess(spark, f"{settings.paths.download_dir.rstrip('/')}/tif", settings.paths.processed_dir, settings)
    previews.scene_previews(raster.profiles(spark, settings.paths.processed_dir), settings.paths.preview_dir, rows=2048).count()
    return [r["granule"] for r in told if r["status"] != "done"]


def preprocess(spark: SparkSession, source: str, folder: str, settings: C.Settings) -> None:
    given = settings.preprocessing
    land = files.read_land(spark, given.land_shapefile) if given.land_shapefile else None
    frames.preprocess_files(raster.profiles(spark, source), given, folder, land, given.processed_suffix).count()


def check(spark: SparkSession, source: str, strict: bool = False) -> None:
    jobs.preprocessed_files(raster.profiles(spark, source), strict).select("path", "score", "preprocessed", "error").show(1000, False)


def compress(spark: SparkSession, source: str, folder: str, percentile: float | None = 99.0) -> None:
    headers = raster.profiles(spark, source)
    scenes = headers.where("error is null").select("scene_id", "width", "height", "transform", "epsg", "geographic")
    frames.write_16_bit(raster.pixels(raster.blocks(headers)), scenes, folder, percentile).show(1000, False)


def main(argv: list[str]) -> int:
    if argv and argv[0] in TOOLS:
        tool, source, *rest = argv
        pairs = [a for a in rest if "=" in a]
        folder = next((a for a in rest if "=" not in a), os.path.dirname(source) or ".")
        settings = C.compose([p for p in pairs if not p.startswith(("strict=", "percentile="))])
        options = dict(p.split("=", 1) for p in pairs)
        if tool == "preprocess":
            preprocess(session(), source, folder, settings)
        elif tool == "check":
            check(session(), source, options.get("strict", "") == "true")
        else:
            compress(session(), source, folder, float(options["percentile"]) if "percentile" in options else 99.0)
        return 0
    if argv and argv[0] in ("-h", "--help"):
        print(__doc__)
        return 0
    settings = C.compose(argv)
    R.logs(settings.paths.log_dir)
    spark, failed = session(), []
    if settings.mode in ("full", "hyp3_only"):
        failed = ingest(spark, settings)
    if settings.mode in ("full", "inference_only"):
        given = C.Settings(settings.inference)
        if settings.mode == "full":
            given = C.Settings({**given, "geotiff_dir": settings.paths.processed_dir, "dataset_params": {**given.dataset_params, "geotiff_dir": settings.paths.processed_dir}})
        R.inference(spark, given)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
