"""Georeferenced rasters as tables, and tables as rasters.

Files are listed by Spark; headers and blocks are read by the tasks that need them, from any file system that pyarrow opens,
and only the blocks that a window touches.  Inside the engine nodata is null.  A scene is named by the base name of its file.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilescan.functions.workers import ship
from tilescan.sources import files, tiff

BLOCK = 512
PROFILE = (
    "path string, scene_id string, width int, height int, dtype string, bx int, b_y int, tiled boolean, compress string, predictor int, meta_nodata double, nodata double, "
    "transform array<double>, epsg int, geographic boolean, is_cog boolean, tags map<string,string>, vmin double, vmax double, jp2 boolean, error string"
)


def store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path else "file://" + path)


@lru_cache(maxsize=32)
def opened(path: str) -> tuple[pyarrow.NativeFile, tiff.Profile]:
    """An open file and its header; a worker keeps the last ones open."""
    fs, at = store(path)
    f = fs.open_input_file(at)
    return f, tiff.profile(f)


def is_jp2(path: Column) -> Column:
    return F.lower(path).endswith(".jp2")


def _nodata(f, p: tiff.Profile) -> float:
    if p.nodata is not None:
        return p.nodata
    return -9999.0 if bool((tiff.window(f, p, 0, 0, 128, 128) < -9000).any()) else 0.0


def profiles(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """The headers of the rasters at ``path`` (a folder, a pattern or a file): see PROFILE; vmin and vmax are of the valid pixels
    of the upper left 256 x 256.  A file that cannot be read has its ``error``; with ``strict`` it raises."""

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name in frame["path"]:
                row = {"path": name, "scene_id": name.rsplit("/", 1)[-1], "jp2": name.lower().endswith(".jp2")}
                try:
                    if row["jp2"]:
                        raise ValueError("JPEG 2000 files need a codec that is not there")
                    f, p = opened(name)
                    nodata = _nodata(f, p)
                    sample = tiff.window(f, p, 0, 0, 256, 256).astype(float)
                    sample = sample[sample != nodata]
                    low, high = (float(sample.min()), float(sample.max())) if sample.size else (None, None)
                    row |= dict(width=p.width, height=p.height, dtype=np.dtype(p.dtype).name, bx=p.block_w, b_y=p.block_h, tiled=p.tiled, compress=p.compress, predictor=p.predictor, meta_nodata=p.nodata, nodata=nodata, transform=p.transform, epsg=p.epsg, geographic=p.geographic, is_cog=p.overviews > 0 or p.tags.get("LAYOUT") == "COG", tags=p.tags, vmin=low, vmax=high)
                except Exception as failure:  # noqa: BLE001
                    if strict:
                        raise
                    row["error"] = str(failure)
                out.append(row)
            yield pd.DataFrame({c: pd.Series([row.get(c) for row in out], dtype=object) for c in (f.split()[0] for f in PROFILE.split(", "))})

    ship(spark)
    return files.rasters(spark, path).select("path").mapInPandas(walk, PROFILE)


def _pixels(f, p: tiff.Profile, nodata: float, row: int, col: int, h: int, w: int) -> np.ndarray:
    """A window as floats, NaN for nodata; 16-bit numbers with a range in the tags are expanded to it."""
    x = tiff.window(f, p, row, col, h, w)
    if np.dtype(p.dtype).kind == "u" and "min_val" in p.tags and "max_val" in p.tags:
        low, high = float(p.tags["min_val"]), float(p.tags["max_val"])
        out = x / 65535.0 * (1.0 if high == low else high - low) + low
        return np.where(x > 0, out, np.nan)
    out = x.astype(np.float64 if np.dtype(p.dtype).itemsize > 4 else np.float32)
    out[out == nodata] = np.nan
    return out


def _listed(x: np.ndarray) -> list:
    flat = x.ravel().tolist()
    return [None if v != v else v for v in flat]


def blocks(headers: DataFrame, side: int = BLOCK) -> DataFrame:
    """scene_id, block_r, block_c, h, w, data (array of floats in row order; null is nodata) of the scenes of ``profiles``.

    Each block is a row of its own before it is read, so a scene is spread over all tasks."""
    good = headers.where("error is null").select("path", "scene_id", "nodata", "width", "height")
    asked = good.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("height") - 1) / side).cast("int"))).alias("block_r")).select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("width") - 1) / side).cast("int"))).alias("block_c"))

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), 8):
                rows = frame.iloc[k : k + 8]
                found = [_pixels(*opened(r.path), r.nodata, r.block_r * side, r.block_c * side, side, side) for r in rows.itertuples()]
                yield pd.DataFrame({"scene_id": rows["scene_id"], "block_r": rows["block_r"], "block_c": rows["block_c"], "h": [x.shape[0] for x in found], "w": [x.shape[1] for x in found], "data": [_listed(x) for x in found]})

    ship(headers.sparkSession)
    spread = asked.repartition("scene_id", "block_r", "block_c")
    return spread.mapInPandas(walk, "scene_id string, block_r int, block_c int, h int, w int, data array<float>")


def pixels(blocked: DataFrame, side: int = BLOCK) -> DataFrame:
    """scene_id, r, c, dn of each pixel of ``blocks``."""
    each = blocked.select("scene_id", "block_r", "block_c", "w", F.posexplode("data").alias("k", "dn"))
    return each.select("scene_id", (F.col("block_r") * side + F.expr("k div w")).cast("int").alias("r"), (F.col("block_c") * side + F.expr("k % w")).cast("int").alias("c"), "dn")


def from_pixels(table: DataFrame, scenes: DataFrame, side: int = BLOCK) -> DataFrame:
    """``blocks`` of pixels (scene_id, r, c, dn) of scenes (scene_id, width, height); pixels that are not there are nodata."""
    got = table.groupBy("scene_id", F.expr(f"r div {side}").cast("int").alias("block_r"), F.expr(f"c div {side}").cast("int").alias("block_c")).agg(F.map_from_entries(F.collect_list(F.struct(F.expr(f"(r % {side}) * {side} + c % {side}").cast("int"), F.col("dn").cast("float")))).alias("m"))
    grid = scenes.select("scene_id", "width", "height", F.explode(F.sequence(F.lit(0), F.floor((F.col("height") - 1) / side).cast("int"))).alias("block_r")).select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("width") - 1) / side).cast("int"))).alias("block_c"))
    sized = grid.select("scene_id", "block_r", "block_c", F.least(F.lit(side), F.col("height") - F.col("block_r") * side).alias("h"), F.least(F.lit(side), F.col("width") - F.col("block_c") * side).alias("w"))
    at = lambda k: (F.floor(k / F.col("w")) * side + k % F.col("w")).cast("int")
    data = F.transform(F.sequence(F.lit(0), F.col("h") * F.col("w") - 1), lambda k: F.try_element_at("m", at(k)))
    return sized.join(got, ["scene_id", "block_r", "block_c"], "left").select("scene_id", "block_r", "block_c", "h", "w", data.alias("data"))


def window_images(headers: DataFrame, windows: DataFrame) -> DataFrame:
    """``windows`` (scene_id, row_off, col_off, win_h, win_w, other columns) with ``image`` (floats in row order, null is nodata),
    and the ``shape`` read (rows, columns); only the blocks that a window touches are read."""
    joined = windows.join(headers.where("error is null").select("scene_id", F.col("path").alias("__path"), F.col("nodata").alias("__nodata")), "scene_id")
    names = windows.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in windows.schema.fields), "image array<float>, shape array<int>"])

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), 16):
                rows = frame.iloc[k : k + 16]
                found = [_pixels(*opened(a), b, r, c, h, w) for a, b, r, c, h, w in zip(*(rows[x] for x in ("__path", "__nodata", "row_off", "col_off", "win_h", "win_w")))]
                yield rows[names].assign(image=[_listed(x) for x in found], shape=[list(x.shape) for x in found])

    ship(headers.sparkSession)
    return joined.mapInPandas(walk, schema)


def zero_images(images: DataFrame, strict: bool = False) -> DataFrame:
    """``images`` with ``all_zero``: whether every pixel is 0 (nodata is not 0); with ``strict`` such an image raises."""
    zero = F.forall("image", lambda x: F.coalesce(x == 0, F.lit(False)))
    if strict:
        zero = F.when(zero, F.raise_error(F.concat(F.lit("all pixels are zero: "), F.col("scene_id").cast("string"))).cast("boolean")).otherwise(F.lit(False))
    return images.withColumn("all_zero", zero)


def triangle(n: int, to: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of ``to`` cells over ``n`` pixels the pixels and weights of bilinear resampling; a cell larger than a pixel is
    weighted over its own width on either side, as raster libraries do when they shrink."""
    scale = n / to
    reach = max(1.0, scale)
    out = []
    for k in range(to):
        centre = (k + 0.5) * scale
        at = np.arange(max(0, int(np.floor(centre - reach))), min(n, int(np.ceil(centre + reach))))
        weight = np.maximum(0.0, 1 - np.abs(at + 0.5 - centre) / reach)
        if not weight.any():
            at, weight = np.array([min(n - 1, int(centre))]), np.ones(1)
        out.append((at, weight / weight.sum()))
    return out


def decimated(headers: DataFrame, rows: int | None = None, scale: float | None = None, band: int = 64) -> DataFrame:
    """scene_id, r, width, height, data: the rows of each scene shrunk to ``rows`` rows (columns in proportion) or by ``scale``,
    bilinear over the valid pixels.  Bands of ``band`` rows are read by themselves."""
    high = F.lit(rows) if rows is not None else F.greatest(F.lit(1), F.floor(F.col("height") * scale))
    wide = F.greatest(F.lit(1), F.floor(F.col("width") * F.lit(rows) / F.col("height"))) if rows is not None else F.greatest(F.lit(1), F.floor(F.col("width") * scale))
    asked = headers.where("error is null").select("path", "scene_id", "nodata", high.cast("int").alias("to_h"), wide.cast("int").alias("to_w"))
    bands = asked.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("to_h") - 1) / band).cast("int"))).alias("band"))

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for x in frame.itertuples():
                f, p = opened(x.path)
                down, across = triangle(p.height, x.to_h)[x.band * band : (x.band + 1) * band], triangle(p.width, x.to_w)
                first, last = int(down[0][0][0]), int(down[-1][0][-1]) + 1
                part = _pixels(f, p, x.nodata, first, 0, last - first, p.width).astype(float)
                known = ~np.isnan(part)
                part = np.where(known, part, 0.0)
                # columns first: sums of weights and of weighted values
                sums = np.stack([part[:, at] @ w for at, w in across], 1)
                weights = np.stack([known[:, at] @ w for at, w in across], 1)
                rows_out = []
                for at, w in down:
                    total, share = w @ sums[at - first], w @ weights[at - first]
                    rows_out.append(_listed(np.where(share > 1e-9, total / np.maximum(share, 1e-9), np.nan)))
                n = len(rows_out)
                yield pd.DataFrame({"scene_id": [x.scene_id] * n, "r": range(x.band * band, x.band * band + n), "width": [x.to_w] * n, "height": [x.to_h] * n, "data": rows_out})

    ship(headers.sparkSession)
    return bands.repartition("scene_id", "band").mapInPandas(walk, "scene_id string, r int, width int, height int, data array<double>")


def write(blocked: DataFrame, scenes: DataFrame, folder: str, dtype: str = "float32", compress: str = "DEFLATE", nodata: float = 0.0, side: int = BLOCK, suffix: str = "") -> DataFrame:
    """Writes each scene of ``blocked`` (``blocks``) as ``folder``/stem + suffix + .tif: one band, tiles of ``side``, null as
    ``nodata``, horizontal differencing with Deflate and ZSTD.  ``scenes`` has scene_id, width, height and, if known, transform,
    epsg, geographic, tags.  Returns scene_id, path, n_bytes; files are written when it is evaluated, and by renaming, so a task
    that runs again leaves the same file.

    Blocks are compressed where they are; the task that writes a scene gets its compressed blocks in order, keeps them in a
    file of its own beside the target, and copies them behind the header once their sizes are known; it holds one at a time.
    """
    kind = {"float32": "<f4", "uint16": "<u2", "uint8": "u1"}[dtype]
    predictor = 2 if compress in ("DEFLATE", "ZSTD") else 1
    base = dict(dtype=kind, block_w=side, block_h=side, compress=compress, predictor=predictor, nodata=float(nodata))

    def squeeze(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = tiff.Profile(side, side, **base)
        for frame in frames:
            packed = []
            for h, w, data in zip(frame["h"], frame["w"], frame["data"]):
                x = np.array(data, float).reshape(h, w)
                x = np.where(np.isnan(x), nodata, x)
                packed.append(tiff.encoded(x if kind == "<f4" else np.clip(np.rint(x), 0, np.iinfo(kind).max), p))
            yield pd.DataFrame({"scene_id": frame["scene_id"], "block_r": frame["block_r"], "block_c": frame["block_c"], "blob": packed})

    packed = blocked.select(F.col("scene_id").cast("string"), "block_r", "block_c", "h", "w", "data").mapInPandas(squeeze, "scene_id string, block_r int, block_c int, blob binary")
    known = [c for c in ("transform", "epsg", "geographic", "tags") if c in scenes.columns]
    kinds = {"transform": "array<double>", "epsg": "int", "geographic": "boolean", "tags": "map<string,string>"}
    facts = scenes.select(F.col("scene_id").cast("string").alias("scene_id"), "width", "height", *(F.col(c) if c in known else F.lit(None).cast(kinds[c]).alias(c) for c in kinds))
    lead = facts.select("scene_id", F.lit(-1).alias("block_r"), F.lit(-1).alias("block_c"), F.lit(None).cast("binary").alias("blob"), "width", "height", "transform", "epsg", "geographic", F.map_entries("tags").alias("tags"))
    body = packed.select("*", *(F.lit(None).cast(t).alias(n) for n, t in (("width", "int"), ("height", "int"), ("transform", "array<double>"), ("epsg", "int"), ("geographic", "boolean"), ("tags", "array<struct<key:string,value:string>>"))))
    ordered = lead.unionByName(body).repartition("scene_id").sortWithinPartitions("scene_id", "block_r", "block_c")

    def put(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, top = store(folder)
        fs.create_dir(top, recursive=True)
        scene = p = stream = held = None
        sizes: list[int] = []
        done: list[tuple[str, str, int]] = []

        def finish() -> None:
            stream.close()
            stem = scene.rsplit("/", 1)[-1]
            target = f"{top}/{stem[: stem.rindex('.')] if '.' in stem else stem}{suffix}.tif"
            if len(sizes) == p.across * p.down:
                start, whole = tiff.head(p, sizes), f"{held}-whole"
                with fs.open_input_stream(held) as blocks_file, fs.open_output_stream(whole) as out:
                    out.write(start)
                    while part := blocks_file.read(1 << 22):
                        out.write(part)
                fs.move(whole, target)
                done.append((scene, target, len(start) + sum(sizes)))
            fs.delete_file(held)
            if sizes and len(sizes) != p.across * p.down:
                raise ValueError(f"{scene}: {len(sizes)} blocks of {p.across * p.down}")

        for frame in frames:
            for r in frame.itertuples():
                if r.block_r < 0:
                    if stream:
                        finish()
                    tags = {x["key"]: x["value"] for x in r.tags} if r.tags is not None else {}
                    p = tiff.Profile(int(r.width), int(r.height), **base, transform=None if r.transform is None else list(r.transform), epsg=None if pd.isna(r.epsg) else int(r.epsg), geographic=None if pd.isna(r.geographic) else bool(r.geographic), tags=tags)
                    scene, held, sizes = r.scene_id, f"{top}/.{uuid.uuid4().hex}", []
                    stream = fs.open_output_stream(held)
                elif scene == r.scene_id:
                    stream.write(r.blob)
                    sizes.append(len(r.blob))
        if stream:
            finish()
        yield pd.DataFrame(done, columns=["scene_id", "path", "n_bytes"])

    ship(blocked.sparkSession)
    return ordered.mapInPandas(put, "scene_id string, path string, n_bytes long")


def through_files(blocked: DataFrame, compress: str = "DEFLATE", nodata: float = 0.0, side: int = BLOCK) -> DataFrame:
    """``blocked`` as it comes back from files: each block is encoded as a file of its own and read again, in memory."""

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            back = []
            for h, w, data in zip(frame["h"], frame["w"], frame["data"]):
                x = np.array(data, float).reshape(h, w)
                p = tiff.Profile(int(w), int(h), "<f4", side, side, compress=compress, predictor=2 if compress != "NONE" else 1, nodata=nodata)
                part = tiff.encoded(np.where(np.isnan(x), nodata, x), p)
                f = io.BytesIO(tiff.head(p, [len(part)]) + part)
                back.append(_listed(_pixels(f, tiff.profile(f), nodata, 0, 0, int(h), int(w))))
            yield frame.assign(data=back)

    ship(blocked.sparkSession)
    return blocked.mapInPandas(walk, blocked.schema)


def numbered(windows: DataFrame) -> DataFrame:
    """Windows of all scenes in the order of scene and place, with their number ``n`` and name; scenes are numbered from
    counts by scene, so no task sorts all windows."""
    counts = windows.groupBy("scene_id").count()
    before = F.coalesce(F.sum("count").over(W.orderBy("scene_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # one row a scene
    start = counts.select("scene_id", before.alias("before"))
    own = F.row_number().over(W.partitionBy("scene_id").orderBy("row_off", "col_off")) - 1
    stem = F.regexp_replace(F.col("scene_id").cast("string"), r"\.[^.]*$", "")
    return windows.withColumn("own", own).join(start, "scene_id").withColumn("n", (F.col("before") + F.col("own")).cast("long")).withColumn("name", F.concat(stem, F.lit("_win"), F.col("n").cast("string"))).drop("own", "before")
