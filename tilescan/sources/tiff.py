"""TIFF files of one band in numpy: headers, blocks, windows, and whole files from compressed blocks.

Classic and Big TIFF, tiles or strips, without compression or with Deflate, ZSTD or LZW, predictors 1 to 3.  Of files of several
interleaved bands the first is read.  ``f`` is a seekable binary file of any file system.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable
from dataclasses import dataclass, field
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import numpy as np
import zstandard

# fixed values: numbers of the TIFF and GeoTIFF formats
SIZES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 7: "s", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
COMPRESSION = {1: "NONE", 5: "LZW", 8: "DEFLATE", 32946: "DEFLATE", 50000: "ZSTD"}
SAMPLE = {1: "u", 2: "i", 3: "f"}
GEO_MODEL, GEO_RASTER, GEO_GEOGRAPHIC, GEO_PROJECTED = 1024, 1025, 2048, 3072


@dataclass
class Profile:
    """What a file's header says."""

    width: int
    height: int
    dtype: str
    block_w: int = 512
    block_h: int = 512
    tiled: bool = True
    compress: str = "NONE"
    predictor: int = 1
    nodata: float | None = None
    transform: list[float] | None = None
    epsg: int | None = None
    geographic: bool | None = None
    tags: dict[str, str] = field(default_factory=dict)
    overviews: int = 0
    bands: int = 1
    order: str = "<"
    offsets: tuple[int, ...] = ()
    counts: tuple[int, ...] = ()

    @property
    def across(self) -> int:
        return -(-self.width // self.block_w)

    @property
    def down(self) -> int:
        return -(-self.height // self.block_h)


def _at(f, offset: int, n: int) -> bytes:
    f.seek(offset)
    out = f.read(n)
    if len(out) != n:
        raise ValueError("the TIFF file ends early")
    return out


def _directory(f, order: str, big: bool, at: int) -> tuple[dict[int, tuple], int]:
    """The tags of the directory at ``at``, and where the next one is (0: nowhere)."""
    n = struct.unpack(order + ("Q" if big else "H"), _at(f, at, 8 if big else 2))[0]
    entry, head, word = (20, 8, "Q") if big else (12, 2, "I")
    raw = _at(f, at + head, n * entry + struct.calcsize(word))
    out: dict[int, tuple] = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(order + "HH" + word, raw, k * entry)
        if kind not in SIZES:
            continue
        code = f"{count}s" if SIZES[kind] == "s" else SIZES[kind] * count if len(SIZES[kind]) > 1 else f"{count}{SIZES[kind]}"
        size, room = struct.calcsize(order + code), 8 if big else 4
        place = k * entry + entry - room
        data = raw[place : place + size] if size <= room else _at(f, struct.unpack_from(order + word, raw, place)[0], size)
        out[tag] = struct.unpack(order + code, data)
    return out, struct.unpack_from(order + word, raw, n * entry)[0]


def profile(f) -> Profile:
    start = _at(f, 0, 8)
    if start[:2] not in (b"II", b"MM"):
        raise ValueError("not a TIFF file")
    order = "<" if start[:2] == b"II" else ">"
    magic = struct.unpack(order + "H", start[2:4])[0]
    if magic not in (42, 43):
        raise ValueError("not a TIFF file")
    big = magic == 43
    first = struct.unpack(order + "Q", _at(f, 8, 8))[0] if big else struct.unpack(order + "I", start[4:8])[0]
    tags, following = _directory(f, order, big, first)
    overviews, seen = 0, {first}
    while following and following not in seen:
        seen.add(following)
        more, following = _directory(f, order, big, following)
        overviews += more.get(254, (0,))[0] & 1
    one = lambda tag, default: tags.get(tag, (default,))[0]
    text = lambda tag: tags[tag][0].split(b"\0")[0].decode("utf-8", "replace") if tag in tags else None
    code = one(259, 1)
    if code not in COMPRESSION:
        raise ValueError(f"TIFF compression {code} is not supported")
    if one(277, 1) > 1 and one(284, 1) != 1:
        raise ValueError("TIFF files with separate planes are not supported")
    tiled = 324 in tags
    width, height = one(256, 0), one(257, 0)
    transform = None
    if 33550 in tags and 33922 in tags:
        (sx, sy, *_), (i, j, _, x, y, *_) = tags[33550], tags[33922]
        transform = [sx, 0.0, x - i * sx, 0.0, -sy, y + j * sy]
    elif 34264 in tags:
        m = tags[34264]
        transform = [m[0], m[1], m[3], m[4], m[5], m[7]]
    keys = tags.get(34735, ())
    geo = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
    meta = {}
    if (xml := text(42112)) is not None:
        for item in ElementTree.fromstring(xml).iter("Item"):
            meta[item.get("name", "")] = item.text or ""
    nodata = text(42113)
    return Profile(
        width, height, order + SAMPLE[one(339, 1)] + str(one(258, 1) // 8),
        one(322, width) if tiled else width, one(323, height) if tiled else min(one(278, height), height), tiled,
        COMPRESSION[code], one(317, 1), float(nodata) if nodata and nodata.strip() else None, transform,
        geo.get(GEO_PROJECTED, geo.get(GEO_GEOGRAPHIC)), {1: False, 2: True}.get(geo.get(GEO_MODEL)), meta, overviews,
        one(277, 1), order, tags[324 if tiled else 273], tags[325 if tiled else 279],
    )


def _lzw(data: bytes) -> bytes:
    """Variable-width codes from the high bit on; the width grows one code early."""
    out, table, last = bytearray(), [], b""
    held = n_held = place = 0
    width = 9
    while True:
        while n_held < width and place < len(data):
            part = data[place : place + 64]
            held, n_held, place = held << 8 * len(part) | int.from_bytes(part, "big"), n_held + 8 * len(part), place + len(part)
        if n_held < width:
            return bytes(out)
        n_held -= width
        code, held = held >> n_held, held & (1 << n_held) - 1
        if code == 256:
            table, width, last = [*(bytes([k]) for k in range(256)), b"", b""], 9, b""
            continue
        if code == 257:
            return bytes(out)
        if not table or code > len(table):
            raise ValueError("broken LZW data")
        piece = table[code] if code < len(table) else last + last[:1]
        out += piece
        if last:
            table.append(last + piece[:1])
        last = piece
        width = min(12, max(9, (len(table) + 1).bit_length()))


def decoded(raw: bytes, p: Profile, rows: int) -> np.ndarray:
    """One block's pixels (rows, block_w)."""
    if p.compress == "DEFLATE":
        raw = zlib.decompress(raw)
    elif p.compress == "ZSTD":
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    elif p.compress == "LZW":
        raw = _lzw(raw)
    kind = np.dtype(p.dtype)
    width = p.block_w * p.bands
    if p.predictor == 3:
        planes = np.frombuffer(raw, np.uint8, rows * width * kind.itemsize).reshape(rows, -1)
        planes = planes.reshape(rows, -1, p.bands).cumsum(1, dtype=np.uint8).reshape(rows, kind.itemsize, width)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(kind.newbyteorder(">")).reshape(rows, p.block_w, p.bands)[..., 0].astype(kind.newbyteorder("="))
    values = np.frombuffer(raw, kind, rows * width).reshape(rows, p.block_w, p.bands).astype(kind.newbyteorder("="))
    if p.predictor == 2:
        values = values.view(f"u{kind.itemsize}").cumsum(1, dtype=f"u{kind.itemsize}").view(kind.newbyteorder("="))
    return values[..., 0]


def block(f, p: Profile, br: int, bc: int) -> np.ndarray:
    """The pixels of a block that lie within the image."""
    k = br * p.across + bc
    h, w = min(p.block_h, p.height - br * p.block_h), min(p.block_w, p.width - bc * p.block_w)
    if not p.counts[k]:  # a block that the file leaves out
        return np.full((h, w), 0 if p.nodata is None else p.nodata, np.dtype(p.dtype).newbyteorder("="))
    return decoded(_at(f, p.offsets[k], p.counts[k]), p, p.block_h if p.tiled else h)[:h, :w]


def window(f, p: Profile, row: int, col: int, h: int, w: int) -> np.ndarray:
    """The pixels of a window; only the blocks that it touches are read."""
    row1, col1 = min(p.height, row + h), min(p.width, col + w)
    row, col = max(0, row), max(0, col)
    out = np.zeros((max(0, row1 - row), max(0, col1 - col)), np.dtype(p.dtype).newbyteorder("="))
    if not out.size:
        return out
    for br in range(row // p.block_h, (row1 - 1) // p.block_h + 1):
        for bc in range(col // p.block_w, (col1 - 1) // p.block_w + 1):
            part = block(f, p, br, bc)
            r0, c0 = br * p.block_h, bc * p.block_w
            a, b = max(row, r0), min(row1, r0 + part.shape[0])
            x, y = max(col, c0), min(col1, c0 + part.shape[1])
            out[a - row : b - row, x - col : y - col] = part[a - r0 : b - r0, x - c0 : y - c0]
    return out


def encoded(pixels: np.ndarray, p: Profile) -> bytes:
    """A block's compressed bytes; pixels beyond the image's edges are 0."""
    full = np.zeros((p.block_h, p.block_w), p.dtype)
    full[: pixels.shape[0], : pixels.shape[1]] = pixels
    if p.predictor == 2:
        whole = full.view(f"<u{full.dtype.itemsize}")
        whole[:, 1:] = np.diff(whole, axis=1)
    raw = full.tobytes()
    if p.compress == "DEFLATE":
        return zlib.compress(raw, 9)
    if p.compress == "ZSTD":
        return zstandard.ZstdCompressor(level=9).compress(raw)
    if p.compress == "NONE":
        return raw
    raise ValueError(f"TIFF files are not written with {p.compress}")


def head(p: Profile, sizes: Iterable[int]) -> bytes:
    """All that stands before the blocks, whose sizes are known, in a tiled little-endian file; Big TIFF from 4 GB on."""
    sizes = list(sizes)
    big = sum(sizes) > 4_000_000_000
    kind = np.dtype(p.dtype)
    entries: list[tuple[int, str, tuple]] = [
        (256, "I", (p.width,)), (257, "I", (p.height,)), (258, "H", (8 * kind.itemsize,)),
        (259, "H", ({"NONE": 1, "DEFLATE": 8, "ZSTD": 50000}[p.compress],)), (262, "H", (1,)), (277, "H", (1,)), (284, "H", (1,)), (317, "H", (p.predictor,)),
        (322, "I", (p.block_w,)), (323, "I", (p.block_h,)), (324, "Q" if big else "I", tuple(sizes)), (325, "I", tuple(sizes)),
        (339, "H", ({v: k for k, v in SAMPLE.items()}[kind.kind],)),
    ]
    if p.transform:
        a, b, c, d, e, g = p.transform
        entries += [(33550, "d", (a, -e, 0.0)), (33922, "d", (0.0, 0.0, 0.0, c, g, 0.0))] if b == d == 0 and e < 0 else [(34264, "d", (a, b, 0.0, c, d, e, 0.0, g, *[0.0] * 7, 1.0))]
    if p.geographic is not None:
        keys = [(GEO_MODEL, 2 if p.geographic else 1), (GEO_RASTER, 1)] + ([(GEO_GEOGRAPHIC if p.geographic else GEO_PROJECTED, p.epsg)] if p.epsg else [])
        entries.append((34735, "H", (1, 1, 0, len(keys), *(v for k, x in keys for v in (k, 0, 1, x)))))
    if p.tags:
        xml = "<GDALMetadata>" + "".join(f"<Item name={quoteattr(k)}>{escape(v)}</Item>" for k, v in sorted(p.tags.items())) + "</GDALMetadata>"
        entries.append((42112, "s", (xml.encode() + b"\0",)))
    if p.nodata is not None:
        entries.append((42113, "s", (f"{p.nodata:.17g}".encode() + b"\0",)))
    codes = {"H": 3, "I": 4, "Q": 16, "d": 12, "s": 2}
    word, entry, lead, room = ("Q", 20, 16, 8) if big else ("I", 12, 8, 4)
    after = lead + (8 if big else 2) + len(entries) * entry + struct.calcsize(word)
    lengths = [len(v[0]) if c == "s" else struct.calcsize("<" + c) * len(v) for _, c, v in entries]
    places, at = [], after
    for n in lengths:
        places.append(at)
        at += (n + 7) // 8 * 8 if n > room else 0
    starts = tuple(int(at + x) for x in np.r_[0, np.cumsum(sizes, dtype=np.int64)[:-1]]) if sizes else ()
    out = struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16) if big else struct.pack("<2sHI", b"II", 42, 8)
    out += struct.pack("<Q" if big else "<H", len(entries))
    late = b""
    for (tag, code, values), n, place in zip(entries, lengths, places):
        if tag == 324:
            values = starts
        data = values[0] if code == "s" else struct.pack(f"<{len(values)}{code}", *values)
        out += struct.pack(f"<HH{word}", tag, codes[code], n if code == "s" else len(values))
        if n <= room:
            out += data.ljust(room, b"\0")
        else:
            out += struct.pack(f"<{word}", place)
            late += data.ljust((n + 7) // 8 * 8, b"\0")
    return out + struct.pack(f"<{word}", 0) + late
