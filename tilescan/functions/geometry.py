"""Column expressions on boxes and affine grids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_box(text: Column) -> Column:
    """Four doubles of ``"a b c d"`` or ``"[a b c d]"``; null unless there are exactly four numbers."""
    parts = F.split(F.trim(F.regexp_replace(F.trim(text), r"^[\[\]]+|[\[\]]+$", "")), r"\s+")
    numbers = F.transform(parts, lambda x: x.try_cast("double"))
    return F.when((F.size(numbers) == 4) & F.forall(numbers, lambda x: x.isNotNull()), numbers)


def box_text(box: Column) -> Column:
    return F.concat_ws(" ", F.transform(box, lambda x: x.cast("string")))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes (structs x0, y0, x1, y1 in degrees), each shrunk in longitude about its own
    centre by the cosine of the mean latitude of both; 0 if the union has no area."""
    scale = F.cos(F.radians(((a["y0"] + a["y1"]) / 2 + (b["y0"] + b["y1"]) / 2) / 2))

    def side(box: Column) -> tuple[Column, Column]:
        centre, half = (box["x0"] + box["x1"]) / 2, (box["x1"] - box["x0"]) / 2 * scale
        return centre - half, centre + half

    (a0, a1), (b0, b1) = side(a), side(b)
    zero = F.lit(0.0)
    shared = F.greatest(zero, F.least(a1, b1) - F.greatest(a0, b0)) * F.greatest(zero, F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    union = scale * ((a["x1"] - a["x0"]) * (a["y1"] - a["y0"]) + (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])) - shared
    return F.when(union > 0, shared / union).otherwise(0.0)


def window_transform(transform: list[float], col: Column, row: Column) -> Column:
    """The affine six-tuple of a window at (col, row)."""
    a, b, c, d, e, f = (F.lit(float(x)) for x in transform)
    return F.array(a, b, c + a * col + b * row, d, e, f + d * col + e * row)


def _series() -> tuple[float, float]:
    """The third flattening and the rectifying radius of WGS84."""
    n = 1 / 298.257223563 / (2 - 1 / 298.257223563)
    return n, 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)


def _given(value: Column | int | bool) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def utm_to_lonlat(easting: Column, northing: Column, zone: Column | int, south: Column | bool = False) -> tuple[Column, Column]:
    """Longitude and latitude (degrees) of UTM coordinates on WGS84, by the Krueger series to third order."""
    n, radius = _series()
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    xi = (northing - F.when(_given(south), 1e7).otherwise(0.0)) / (0.9996 * radius)
    eta = (easting - 500000.0) / (0.9996 * radius)
    xi1, eta1 = xi, eta
    for k, b in enumerate(beta, 1):
        xi1 = xi1 - b * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        eta1 = eta1 - b * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for k, d in enumerate(delta, 1):
        lat = lat + d * F.sin(2 * k * chi)
    lon = (_given(zone) * 6 - 183).cast("double") + F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1)))
    return lon, F.degrees(lat)


def lonlat_to_utm(lon: Column, lat: Column, zone: Column | int, south: Column | bool = False) -> tuple[Column, Column]:
    """Easting and northing on WGS84 of longitude and latitude (degrees), by the same series."""
    n, radius = _series()
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * n**0.5 / (1 + n)
    sine, away = F.sin(F.radians(lat)), F.radians(lon - (_given(zone) * 6 - 183).cast("double"))
    t = F.sinh(F.atanh(sine) - e * F.atanh(e * sine))
    xi, eta = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for k, a in enumerate(alpha, 1):
        x = x + a * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
        y = y + a * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
    return 500000.0 + 0.9996 * radius * x, F.when(_given(south), 1e7).otherwise(0.0) + 0.9996 * radius * y
