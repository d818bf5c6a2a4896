"""TIFF files against plain arrays, and the tables, writers and pictures made of them."""

import io
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilescan.functions import png
from tilescan.operators import frames, jobs, previews
from tilescan.sources import files, raster, tiff

T = [0.001, 0.0, -118.0, 0.0, -0.001, 34.0]


def written(x, **how):
    p = tiff.Profile(x.shape[1], x.shape[0], x.dtype.str, **{"block_w": 64, "block_h": 32, **how})
    parts = [tiff.encoded(x[r : r + p.block_h, c : c + p.block_w], p) for r in range(0, x.shape[0], p.block_h) for c in range(0, x.shape[1], p.block_w)]
    return tiff.head(p, [len(b) for b in parts]) + b"".join(parts)


def lzw(data):
    """Codes of 9 bits and more, high bit first, as the format's own description gives them."""
    table, bits, width, held = {bytes([k]): k for k in range(256)}, "", 9, b""
    out = [(256, 9)]
    for b in data:
        if held + bytes([b]) in table:
            held += bytes([b])
            continue
        out.append((table[held], width))
        table[held + bytes([b])] = len(table) + 2
        if len(table) + 2 > (1 << width) - 1:
            width += 1
        if width > 12 or len(table) + 2 >= 4094:
            out.append((256, min(12, width)))
            table, width = {bytes([k]): k for k in range(256)}, 9
        held = bytes([b])
    out += [(table[held], width), (257, 9 if width < 9 else width)]
    bits = "".join(format(code, f"0{w}b") for code, w in out)
    return int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")


@pytest.mark.parametrize("dtype", ["<f4", "<u2", "u1", "<f8", "<i2"])
@pytest.mark.parametrize("compress,predictor", [("NONE", 1), ("DEFLATE", 2), ("ZSTD", 2), ("DEFLATE", 1)])
def test_round_trip(dtype, compress, predictor):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(100, 150)) * 50 + 100).astype(dtype)
    f = io.BytesIO(written(x, compress=compress, predictor=predictor, nodata=-9999.0, transform=T, epsg=4326, geographic=True, tags={"min_val": "1 <&", "b": "2"}))
    p = tiff.profile(f)
    assert (p.width, p.height, p.compress, p.predictor, p.nodata, p.epsg, p.geographic, p.tags) == (150, 100, compress, predictor, -9999.0, 4326, True, {"min_val": "1 <&", "b": "2"})
    assert np.allclose(p.transform, T)
    assert (tiff.window(f, p, 0, 0, 100, 150) == x).all()
    assert (tiff.window(f, p, 20, 50, 40, 40) == x[20:60, 50:90]).all()
    assert (tiff.window(f, p, 90, 140, 40, 40) == x[90:, 140:]).all()
    assert tiff.window(f, p, 200, 0, 4, 4).size == 0


def test_strips_big_endian_lzw_and_float_predictor():
    x = (np.arange(12) * 1000).astype(">u2").reshape(3, 4)
    strips = [x[:2].tobytes(), x[2:].tobytes()]
    entries = [(256, 3, 1, 4), (257, 3, 1, 3), (258, 3, 1, 16), (259, 3, 1, 1), (277, 3, 1, 1), (278, 3, 1, 2)]
    lead = 8 + 2 + 8 * 12 + 4
    body = b"".join(strips)
    tables = lead + len(body)


    out = struct.pack(">2sHI", b"MM", 42, 8) + struct.pack(">H", 8)
    out += b"".join(struct.pack(">HHIHH", t, k, n, v, 0) for t, k, n, v in entries)
    out += struct.pack(">HHII", 273, 4, 2, tables) + struct.pack(">HHII", 279, 4, 2, tables + 8) + struct.pack(">I", 0)
    out += body + struct.pack(">II", lead, lead + 16) + struct.pack(">II", 16, 8)
    f = io.BytesIO(out)
    p = tiff.profile(f)
    assert not p.tiled and p.nodata is None and (tiff.window(f, p, 0, 0, 3, 4) == x).all()
    data = bytes(np.random.default_rng(2).integers(0, 7, 40_000, np.uint8))
    assert tiff._lzw(lzw(data)) == data
    y = np.random.default_rng(3).normal(size=(4, 8)).astype("<f4")
    planes = np.ascontiguousarray(y.astype(">f4")).view(np.uint8).reshape(4, 8, 4).transpose(0, 2, 1).reshape(4, 32)
    diff = np.concatenate([planes[:, :1], np.diff(planes, axis=1)], 1)
    p = tiff.Profile(8, 4, "<f4", 8, 4, compress="DEFLATE", predictor=3)
    assert (tiff.decoded(zlib.compress(diff.tobytes()), p, 4) == y).all()
    with pytest.raises(ValueError):
        tiff.profile(io.BytesIO(b"no tiff at all"))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("scenes")
    rng = np.random.default_rng(5)
    a = rng.gamma(2.0, 0.1, (130, 90)).astype("<f4")
    a[:10, :20] = 0.0
    b = rng.integers(1, 65535, (70, 200)).astype("<u2")
    b[5:9, :] = 0
    (top / "a.tif").write_bytes(written(a, compress="DEFLATE", predictor=2, transform=T, epsg=4326, geographic=True))
    (top / "b.tif").write_bytes(written(b, nodata=0.0, tags={"min_val": "-2.0", "max_val": "4.5"}))
    (top / "c.jp2").write_bytes(b"codec")
    (top / "d.tiff").write_bytes(b"broken")
    (top / "notes.txt").write_text("x")
    return str(top), a, b


def test_profiles_blocks_and_windows(spark, folder):
    top, a, b = folder
    heads = {r["scene_id"]: r for r in raster.profiles(spark, top).collect()}
    assert sorted(heads) == ["a.tif", "b.tif", "c.jp2", "d.tiff"]
    assert heads["a.tif"]["nodata"] == 0.0 and heads["a.tif"]["epsg"] == 4326 and heads["a.tif"]["error"] is None
    assert heads["c.jp2"]["jp2"] and "codec" in heads["c.jp2"]["error"] and heads["d.tiff"]["error"]
    with pytest.raises(Exception, match="codec"):
        raster.profiles(spark, top, strict=True).collect()
    headers = raster.profiles(spark, top)
    table = raster.pixels(raster.blocks(headers, 64), 64).toPandas()
    for name, x in (("a.tif", a.astype(float)), ("b.tif", np.where(b > 0, b / 65535.0 * 6.5 - 2.0, 0.0))):
        part = table[table.scene_id == name]
        got = np.full(x.shape, -1.0)
        got[part.r, part.c] = part.dn
        raw = a if name == "a.tif" else b
        assert len(part) == x.size and np.isnan(got[raw == 0]).all() and np.allclose(got[raw != 0], x[raw != 0], rtol=1e-6)
    wins = spark.createDataFrame([("a.tif", 100, 60, 40, 40, "w"), ("b.tif", 0, 0, 3, 2, "v")], "scene_id string, row_off int, col_off int, win_h int, win_w int, tag string")
    got = {r["tag"]: r for r in raster.window_images(headers, wins).collect()}
    assert got["w"]["shape"] == [30, 30] and np.allclose(np.array(got["w"]["image"], float), a[100:, 60:].ravel())
    blank = raster.zero_images(spark.createDataFrame([("x", [0.0, 0.0]), ("y", [0.0, None]), ("z", [0.0, 1.0])], "scene_id string, image array<float>"))
    assert {r["scene_id"]: r["all_zero"] for r in blank.collect()} == {"x": True, "y": False, "z": False}
    with pytest.raises(Exception, match="zero: x"):
        raster.zero_images(blank.drop("all_zero"), strict=True).collect()


def test_decimation(spark, folder):
    top, a, _ = folder
    small = raster.decimated(raster.profiles(spark, top), scale=0.1, band=4).where("scene_id = 'a.tif'").orderBy("r").collect()
    assert len(small) == 13 and {(r["width"], r["height"]) for r in small} == {(9, 13)}
    got = np.array([r["data"] for r in small], float)
    assert abs(np.nanmean(got) - a[a > 0].mean()) < 0.02
    # a plane stays a plane, but at the edges
    assert all(np.isclose(w.sum(), 1) for _, w in raster.triangle(100, 7))
    assert np.allclose([at @ w for at, w in raster.triangle(100, 10)][1:-1], [(k + 0.5) * 10 - 0.5 for k in range(1, 9)])
    assert [at.tolist() for at, _ in raster.triangle(3, 3)] == [[0], [1], [2]] or all(abs(w.max() - 1) < 1e-9 for _, w in raster.triangle(3, 3))


CONFIG = {"clip_percentile": 99, "dilate_px": 1, "convert_to_db": True, "save_masked": True, "masked_dtype": "float32", "compress": "DEFLATE"}


@pytest.mark.parametrize("dtype", ["float32", "uint8", "uint16"])
def test_preprocessed_files(spark, folder, tmp_path, dtype):
    top, a, _ = folder
    headers = raster.profiles(spark, top + "/a.tif")
    told = frames.preprocess_files(headers, CONFIG | {"masked_dtype": dtype, "dilate_px": 0}, str(tmp_path), suffix="_processed").collect()
    assert [r["path"].rsplit("/", 1)[1] for r in told] == ["a_processed.tif"] and [x.name for x in tmp_path.iterdir()] == ["a_processed.tif"]
    with open(told[0]["path"], "rb") as f:
        p = tiff.profile(f)
        got = tiff.window(f, p, 0, 0, 130, 90)
    assert (p.block_w, p.predictor, p.nodata, p.epsg) == (512, 2, 0.0, 4326) and np.allclose(p.transform, T)
    v = a[a != 0].astype(float)
    db = np.maximum(-35, 10 * np.log10(np.clip(a.astype(float), v.min(), np.percentile(v, 99)) + 1e-10))
    if dtype == "float32":
        assert np.allclose(got[a != 0], db[a != 0], atol=1e-4) and (got[a == 0] == 0).all()
    else:
        limit = np.iinfo(dtype).max
        lo, hi = np.percentile(db[a != 0], [0, 99])
        want = np.clip(np.rint((db - lo) / (hi - lo) * (limit - 1)) + 1, 0, limit)
        assert np.abs(got[a != 0] - want[a != 0]).max() <= 1 and (got[a == 0] == 0).all()


def test_16_bit_files_and_sentinels(spark, folder, tmp_path):
    top, a, _ = folder
    headers = raster.profiles(spark, top + "/a.tif")
    scenes = headers.select("scene_id", "width", "height", "transform", "epsg", "geographic")
    table = raster.pixels(raster.blocks(headers))
    path = frames.write_16_bit(table, scenes, str(tmp_path)).collect()[0]["path"]
    back = raster.pixels(raster.blocks(raster.profiles(spark, path))).toPandas()
    got = np.zeros(a.shape)
    got[back.r, back.c] = back.dn.astype(float)
    v = a[a != 0]
    assert path.endswith("a_compressed_lossless.tif") and np.isnan(got[a == 0]).all()
    ok = (a != 0) & (a != v.min())
    assert np.abs(got[ok] - a[ok]).max() <= (v.max() - v.min()) / 65535
    masked = frames.write_masked_float(table, scenes, str(tmp_path)).collect()[0]["path"]
    with open(masked, "rb") as f:
        p = tiff.profile(f)
        x = tiff.window(f, p, 0, 0, 130, 90)
    assert p.nodata == -9999.0 and (x[a == 0] == -9999).all() and (x[a != 0] == a[a != 0]).all()
    with pytest.raises(Exception, match="no valid pixel"):
        frames.compressed_16_bit(table.withColumn("dn", F.lit(None).cast("float"))).collect()


def test_settings_of_the_frame_pipeline(spark):
    with pytest.raises(KeyError):
        frames.preprocessed(spark.createDataFrame([], "scene_id int, r int, c int, dn float"), {k: v for k, v in CONFIG.items() if k != "compress"})
    assert frames.percentile_range(99.9) == (0.0, 99.9) and frames.percentile_range((1, 99)) == (1.0, 99.0)
    with pytest.raises(TypeError):
        frames.percentile_range([1, 99])

    class Named:
        dilate_px = 3

    assert frames.setting(Named(), "dilate_px") == 3


def test_checked_files(spark, folder):
    top, *_ = folder
    got = {r["scene_id"]: r for r in jobs.preprocessed_files(raster.profiles(spark, top)).collect()}
    # Deflate 2, no 512 blocks 0, geographic 1, float of 0 to 255 1
    assert got["a.tif"]["score"] == 4 and got["a.tif"]["preprocessed"] and got["b.tif"]["score"] == 2
    assert got["d.tiff"]["score"] is None and not got["d.tiff"]["preprocessed"]
    with pytest.raises(Exception, match="codec|TIFF|preprocessed"):
        jobs.preprocessed_files(raster.profiles(spark, top), strict=True).collect()


def test_pictures(spark, folder, tmp_path):
    top, a, _ = folder
    headers = raster.profiles(spark, top)
    found = spark.createDataFrame([(0, "a.tif", 0.95, -117.98, 33.90, -117.96, 33.93), (1, "a.tif", 0.2, -117.98, 33.90, -117.96, 33.93), (2, "gone.tif", 0.99, 0.0, 0.0, 1.0, 1.0), (3, "a.tif", 0.97, -117.94, 33.88, -117.91, 33.87)], "i int, filename string, confidence double, x0 double, y0 double, x1 double, y1 double")
    made = previews.scene_previews(headers, str(tmp_path / "p"), found, 0.9).collect()
    assert [(r["scene_id"], r["n_boxes"], r["error"]) for r in made] == [("a.tif", 2, None)]
    assert png.size((tmp_path / "p" / "a_preview.png").read_bytes()) == (9, 13)
    tiles = previews.detection_tiles(headers, found, str(tmp_path), 0.9, 2, 40).collect()
    names = sorted(x.name for x in (tmp_path / "positive_detection_tiles_0.9" / "a").iterdir())
    assert names == ["a_detection_000_conf_0.950.png", "a_detection_003_conf_0.970.png"] and all(r["error"] is None for r in tiles)
    assert {png.size((tmp_path / "positive_detection_tiles_0.9" / "a" / n).read_bytes()) for n in names} == {(40, 40)}
    assert (previews.to_uint8(np.array([[np.nan, 1.0], [1.0, 1.0]])) == 128).all() and (previews.to_uint8(np.full((2, 2), np.nan)) == 0).all()
    both = raster.pixels(raster.blocks(headers)).where("scene_id = 'a.tif'").withColumn("b", F.col("dn") * 0.9)
    chart = previews.histogram_chart(both, "dn", "b", str(tmp_path)).collect()[0]
    assert sum(chart["na"]) == int((a != 0).sum()) and (tmp_path / "a.tif_histogram.png").exists()
    with_sources = previews.with_sources(found, files.rasters(spark, top))
    assert with_sources.count() == 3 and previews.without_sources(found, files.rasters(spark, top)).first()["filename"] == "gone.tif"


def test_png_is_what_its_reader_expects():
    x = np.arange(6, dtype=np.uint8).reshape(2, 3)
    data = png.encoded(x, {"Extent": "1 2"})
    at = data.index(b"IDAT")
    n = int.from_bytes(data[at - 4 : at], "big")
    assert zlib.decompress(data[at + 4 : at + 4 + n]) == b"\0\0\1\2\0\3\4\5" and png.size(data) == (3, 2)
    assert png.with_boxes(x, [(0, 0, 2, 1)]).shape == (2, 3, 3)
    assert png.size(png.encoded(np.zeros((3, 5, 7), np.uint8))) == (7, 5)
    with pytest.raises(ValueError):
        png.encoded(np.zeros((2, 2)))
