"""The chains that turn window images into the input of a detector, on tables with a square ``tile`` (array in row order)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilescan.functions import pixels as P
from tilescan.operators import pixels as X


def contrastive_input(tiles: DataFrame, side: int, to: int = 224, nan_policy: str = "propagate") -> DataFrame:
    """Nearest resize, global range, the tile's own range, boost of dark tiles; then nodata is 0.  One channel."""
    out = X.resized(tiles, side, to)
    scaled = F.transform("tile", lambda x: P.global_normalised(x))
    out = out.withColumn("tile", scaled).withColumn("tile", P.tile_normalised(F.col("tile"), nan_policy=nan_policy))
    return out.withColumn("tile", P.filled(P.boosted(F.col("tile"))))


def grey_channels(tile: Column, n: int = 3) -> Column:
    """A channel repeated, channel after channel."""
    return F.flatten(F.array(*[tile] * n))


def standardised(tile: Column, size: int, mean: list[float], std: list[float]) -> Column:
    """Bytes as 0 to 1, less the channel's mean, over its deviation; ``size`` pixels a channel."""
    m, s = F.array(*map(F.lit, map(float, mean))), F.array(*map(F.lit, map(float, std)))
    channel = lambda k: F.floor(k / size).cast("int")
    return F.transform(tile, lambda x, k: (x / 255.0 - F.get(m, channel(k))) / F.get(s, channel(k)))


def feature_input(tiles: DataFrame, side: int, to: int, nodata: float = 0.0, mean: list[float] = (0.485, 0.456, 0.406), std: list[float] = (0.229, 0.224, 0.225)) -> DataFrame:
    """Clip to bytes, three equal channels, resize, standardise; then the places that were nodata (null, NaN or ``nodata``)
    before, resized by nearest, hold ``nodata`` again in every channel."""
    gone = lambda x: (x.isNull() | F.isnan(x) | (x == nodata)).cast("double")
    withmask = tiles.withColumn("__mask", F.transform("tile", gone))
    masks = X.resized(withmask.withColumn("__tile", F.col("tile")).withColumn("tile", F.col("__mask")), side, to).withColumn("__mask", F.col("tile")).withColumn("tile", F.col("__tile"))
    bytes_ = X.tiles_to_uint8(masks.drop("__tile")).withColumn("tile", F.transform("tile8", lambda x: x.cast("double"))).drop("tile8")
    small = X.resized(bytes_, side, to)
    channels = len(mean)
    image = standardised(grey_channels(F.col("tile"), channels), to * to, list(mean), list(std))
    return small.withColumn("tile", P.remasked(image, grey_channels(F.col("__mask"), channels), nodata)).drop("__mask")
