"""Column expressions on pixel values.  Null is nodata; every clip guards it, as ``greatest`` and ``least`` skip nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the range that global normalisation maps to 0 to 1
GLOBAL_MIN, GLOBAL_MAX = 2.341661e-09, 1123.6694


def clipped(x: Column, low: Column, high: Column) -> Column:
    return F.when(x.isNotNull(), F.greatest(low, F.least(x, high)))


def decibels(x: Column, floor: float = -35.0) -> Column:
    db = 10 * F.log10(x + F.lit(1e-10))
    return F.when(db.isNotNull(), F.greatest(F.lit(floor), db))


def stretched(x: Column, low: Column, high: Column, top: int) -> Column:
    """1 to ``top`` of the range low to high; equal ends give 1, nodata 0; values above the range are clamped."""
    scaled = F.rint((x - low) / F.nullif(high - low, F.lit(0.0)) * (top - 1)) + 1
    return F.when(x.isNull(), 0).when(high == low, 1).otherwise(F.least(F.lit(top), F.greatest(F.lit(0), scaled.cast("long")))).cast("int")


def to_uint16(x: Column, low: Column, high: Column) -> Column:
    """0 to 65535 of the range low to high, 0 for nodata; so the least valid value reads back as nodata."""
    width = F.when(high == low, 1.0).otherwise(high - low)
    return F.coalesce(F.rint((x - low) / width * 65535).cast("int"), F.lit(0))


def from_uint16(dn: Column, low: Column, high: Column) -> Column:
    """The value of a 16-bit number; null for 0.  An empty range counts as 1."""
    return F.when(dn > 0, dn / 65535.0 * F.when(high == low, 1.0).otherwise(high - low) + low)


def global_normalised(x: Column) -> Column:
    return (x - GLOBAL_MIN) / (GLOBAL_MAX - GLOBAL_MIN)


def tile_normalised(tile: Column, nodata: float = -9999.0, nan_policy: str = "propagate") -> Column:
    """A tile (array) scaled to 0 to 1 over its values that are not nodata; without a range as it is.  ``propagate``: a null
    or NaN makes the whole tile null values (zeros after ``filled``); ``ignore`` skips them."""
    bad = lambda x: x.isNull() | F.isnan(x)
    valid = F.filter(tile, lambda x: (x != nodata) & ~bad(x))
    low, high = F.array_min(valid), F.array_max(valid)
    scaled = F.transform(tile, lambda x: F.when(x == nodata, x).otherwise((x - low) / (high - low)))
    out = F.when((F.size(valid) == 0) | (low == high), tile).otherwise(scaled)
    if nan_policy == "propagate":
        out = F.when(F.exists(tile, bad), F.transform(tile, lambda x: F.lit(None).cast("double"))).otherwise(out)
    return out


def boosted(tile: Column, below: float = 1e-5, factor: float = 10.0) -> Column:
    mean = F.aggregate(tile, F.lit(0.0), lambda s, x: s + x) / F.size(tile)
    return F.when(mean < below, F.transform(tile, lambda x: x * factor)).otherwise(tile)


def filled(tile: Column, value: float = 0.0) -> Column:
    return F.transform(tile, lambda x: F.coalesce(F.nanvl(x, F.lit(value)), F.lit(value)))


def remasked(tile: Column, mask: Column, nodata: float) -> Column:
    return F.zip_with(tile, mask, lambda x, m: F.when(m > 0, F.lit(nodata)).otherwise(x))


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda s, y: s + y))


def argmax(values: Column) -> Column:
    """Place of the first largest value, from 0."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
