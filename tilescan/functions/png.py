"""PNG files from arrays of bytes, boxes drawn on them, and simple charts."""

from __future__ import annotations

import struct
import zlib

import numpy as np

RED = (255, 0, 0)


def encoded(image: np.ndarray, texts: dict[str, str] | None = None) -> bytes:
    """The file of an image (rows, columns) or (rows, columns, 1, 3 or 4) of bytes; channels may come first."""
    if image.ndim == 3 and image.shape[0] in (1, 3, 4) and image.shape[2] not in (1, 3, 4):
        image = np.moveaxis(image, 0, -1)
    if image.ndim == 3 and image.shape[2] not in (3, 4):
        image = image[..., 0]
    if image.dtype != np.uint8:
        raise ValueError("an image of bytes is needed")
    h, w = image.shape[:2]
    kind = 0 if image.ndim == 2 else {3: 2, 4: 6}[image.shape[2]]

    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    lines = np.concatenate([np.zeros((h, 1), np.uint8), image.reshape(h, -1)], 1).tobytes()
    notes = b"".join(chunk(b"tEXt", k.encode("latin-1", "replace") + b"\0" + v.encode("latin-1", "replace")) for k, v in (texts or {}).items())
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + notes + chunk(b"IDAT", zlib.compress(lines, 6)) + chunk(b"IEND", b"")


def size(data: bytes) -> tuple[int, int]:
    """Width and height that a file states."""
    return struct.unpack(">II", data[16:24])


def with_boxes(grey: np.ndarray, boxes: list[tuple[float, float, float, float]], colour: tuple[int, int, int] = RED) -> np.ndarray:
    """A grey image in colour with the outlines of boxes (columns and rows: x0, y0, x1, y1)."""
    out = np.repeat(grey[..., None], 3, 2)
    h, w = grey.shape
    for x0, y0, x1, y1 in boxes:
        a, b = (int(np.clip(round(v), 0, w - 1)) for v in (x0, x1))
        c, d = (int(np.clip(round(v), 0, h - 1)) for v in (y0, y1))
        out[c, a : b + 1] = out[d, a : b + 1] = colour
        out[c : d + 1, a] = out[c : d + 1, b] = colour
    return out


def bars(series: list[np.ndarray], height: int = 120, width: int = 6, colours: tuple = ((31, 119, 180), (255, 127, 14))) -> np.ndarray:
    """A chart of up to two series of numbers side by side, scaled to the largest."""
    n = max(map(len, series))
    out = np.full((height, n * width * len(series), 3), 255, np.uint8)
    top = max((float(s.max()) for s in series if len(s)), default=0.0) or 1.0
    for k, s in enumerate(series):
        for i, v in enumerate(s):
            x = (i * len(series) + k) * width
            out[height - int(round(height * float(v) / top)) :, x : x + width - 1] = colours[k % len(colours)]
    return out
