"""Settings, commands, networks, the remote service, and a whole run over made scenes."""

import io
import sys
import zipfile

import numpy as np
import pytest
from pyspark import cloudpickle

from tilescan import __main__ as commands
from tilescan import config as C
from tilescan import run as R
from tilescan.operators import networks as N
from tilescan.operators import scoring
from tilescan.sources import files, raster, remote, tiff

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests


def test_compose():
    c = C.compose(["mode=inference_only", "paths.output_dir=/x", "inference.batch_size=7", "inference.dataset_params.stride_factor=0.5", "hyp3.granules=[a, b]", "inference=features", "debug=true"])
    assert c.mode == "inference_only" and c.inference.batch_size == 7 and c.hyp3.granules == ["a", "b"] and c.debug is True
    assert c.inference.num_channels == 3 and c.inference.identification_table_path == "output/features/positive_identifications.csv"
    assert c.inference.dataset_params.geotiff_dir == c.paths.processed_dir == c.preprocessing.processed_dir and c.inference.dataset_params.stride_factor == 0.5
    for bad in (["mode=other"], ["inference=none"], ["debug"]):
        with pytest.raises(ValueError):
            C.compose(bad)
    with pytest.raises(ValueError, match="refer to each other"):
        C.resolved({"a": "${b}", "b": "${a}"})
    with pytest.raises(KeyError):
        C.resolved({"a": "${none.b}"})
    assert C.resolved({"a": {"b": 3}, "c": "${a.b}", "d": "x${a.b}"}) == {"a": {"b": 3}, "c": 3, "d": "x3"}
    with pytest.raises(AttributeError):
        c.nothing


def test_yaml_and_arguments(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "one.yaml").write_text("a: 1\nb: 2\n")
    (tmp_path / "top.yaml").write_text("defaults:\n  - g: one\n  - _self_\nb: 3\n")
    assert C.from_yaml(str(tmp_path / "top.yaml")) == {"a": 1, "b": 3}
    got = C.arguments({"a": 1, "flag": "no", "seed": 3, "name": None, "rate": 0.5}, ["--a", "5", "--flag", "yes", "--other", "x"], booleans=["flag"])
    assert (got.a, got.flag, got.seed, got.name, got.rate) == (5, True, 3, None, 0.5)


def test_convolutions_and_the_network():
    rng = np.random.default_rng(1)
    x, w = rng.normal(size=(2, 3, 7, 6)), rng.normal(size=(4, 3, 3, 3))
    for stride in (1, 2):
        got = N.convolved(x, w, stride)
        padded = np.pad(x, ((0, 0), (0, 0), (1, 1), (1, 1)))
        want = np.zeros_like(got)
        for i in range(got.shape[2]):
            for j in range(got.shape[3]):
                want[:, :, i, j] = np.einsum("ncij,ocij->no", padded[:, :, i * stride : i * stride + 3, j * stride : j * stride + 3], w)
        assert np.allclose(got, want)
    assert N.pooled(np.arange(16.0).reshape(1, 1, 4, 4)).tolist() == [[[[5.0, 7.0], [13.0, 15.0]]]]
    weights = N.empty_weights(channels=1, classes=2, seed=3)
    assert len(N.plan()) == 16 and N.plan()[-1][2] == 512 and weights["fc.weight"].shape == (2, 2048)
    p = N.ResidualDetector(weights).probabilities(rng.normal(size=(2, 32 * 32)))
    assert p.shape == (2, 2) and np.allclose(p.sum(1), 1) and not np.allclose(p[0], p[1])
    head = {f"head.{k}.{n}": v for k in range(2) for n, v in (("weight", np.eye(3)), ("norm.weight", np.ones(3)), ("norm.bias", np.zeros(3)), ("norm.running_mean", np.zeros(3)), ("norm.running_var", np.ones(3) - N.EPS))}
    assert np.allclose(N.contrastive_head(np.array([[1.0, -2.0, 3.0]]), head, 2), [[1, 0, 3]])
    assert [N.kind_of(n) for n in ("fc.weight", "net.0.conv.weight", "net.0.norm.weight", "fc.bias")] == ["linear", "convolution", "norm", "bias"]


def test_loaders(spark, tmp_path):
    weights = N.empty_weights(channels=3, classes=2, seed=1)
    np.savez(tmp_path / "w.npz", **weights)
    model, size, how = N.load({"model_loader_class": "arrays", "pretrain": str(tmp_path / "w.npz"), "num_channels": 1})
    assert size == (1, 224, 224) and how == "nearest" and model["net.0.conv.weight"].shape[1] == 1
    with pytest.raises(ValueError, match="do not fit"):
        N.load({"model_loader_class": "arrays", "pretrain": str(tmp_path / "w.npz"), "num_channels": 1, "num_classes": 5})
    for bad in ({"model_loader_class": "none"}, {"model_loader_class": "arrays", "pretrain": None}, {"model_loader_class": "arrays", "arch": "x", "pretrain": "y"}):
        with pytest.raises(ValueError):
            N.load(bad)
    with pytest.raises(ValueError):
        N.read_weights("checkpoint.tar")
    with pytest.raises(RuntimeError, match="package"):
        N.load({"model_loader_class": "external", "arch": "x"})
    header = b'{"a":{"dtype":"F32","shape":[2],"data_offsets":[0,8]}}'
    (tmp_path / "w.safetensors").write_bytes(len(header).to_bytes(8, "little") + header + np.array([1, 2], "<f4").tobytes())
    assert N.read_weights(str(tmp_path / "w.safetensors"))["a"].tolist() == [1, 2]
    assert N.payload({"model": {"x": 1}, "resnet": {"y": 2}}) == {"y": 2} and N.payload({"z": 1}) == {"z": 1}
    told = N.loaded({"a": np.zeros(2), "b": np.zeros(3), "c": np.zeros(1)}, {"a": np.ones(2), "b": np.ones(4)})[1]
    assert told == {"loaded": ["a"], "absent": ["c"], "mismatched": ["b"]}
    table = scoring.matched_weights(N.shapes(spark, {"a": np.ones(2), "b": np.ones(4)}), N.shapes(spark, {"a": np.zeros(2), "b": np.zeros(3), "c": np.zeros(1)}))
    assert {r["status"]: r["n"] for r in table.collect()} == {"loaded": 1, "mismatched": 1, "absent": 1}


class Plain:
    """A classifier with predict alone."""

    def predict(self, x):
        return (x[:, 0] > 0).astype(int)


class Likely(Plain):
    def predict_proba(self, x):
        p = 1 / (1 + np.exp(-x[:, 0]))
        return np.stack([1 - p, p], 1)


def test_features_into_a_classifier(spark):
    tiles = spark.createDataFrame([(1, [2.0, 0.0]), (2, [-1.0, 0.0])], "id long, image array<double>")
    for classifier, want in ((Plain(), 1.0), (Likely(), 1 / (1 + np.exp(-2)))):
        model = scoring.detector("features", extract=lambda x: x, classifier=classifier)
        got = {r["id"]: r for r in scoring.inferred(tiles, model).collect()}
        assert (got[1]["prediction"], got[2]["prediction"]) == (1, 0) and abs(got[1]["confidence"] - want) < 1e-9
    assert scoring.passed(scoring.inferred(tiles, model), [1]).count() == 1


class FakeJob:
    def __init__(self, job_id, granule, params, polls=1, failed=False, expired=False, ok=True):
        self.job_id, self.granules, self.params, self.polls, self.failed, self.expired, self.ok = job_id, [granule], params, polls, failed, expired, ok

    @property
    def complete(self):
        return self.polls <= 0

    @property
    def succeeded(self):
        return self.complete and self.ok


class FakeService:
    def __init__(self):
        p = remote.default_parameters()
        self.known = [FakeJob("old", "GA", p | {"extra": 1}, 0), FakeJob("exp", "GB", p, 0, expired=True), FakeJob("bad", "GD", p, 0, ok=False)]
        self.calls = 0

    def jobs(self):
        self.calls += 1
        if self.calls == 1:
            raise remote.Unavailable(503)
        return self.known

    def submit(self, granule, name, params):
        if granule == "GX":
            raise remote.NoCoverage("no DEM coverage")
        assert name == "RTC_" + granule[-8:]
        return FakeJob("new-" + granule, granule, params, 1)

    def refreshed(self, job):
        job.polls -= 1
        return job

    def archives(self, job):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            for member in ("d/x_VV.tif", "d/x_VH.tif", "d/x.png", "d/x_rgb.png", "d/x.xml") if job.granules[0] != "GE" else ("a.xml",):
                z.writestr(member, job.granules[0] + member)
        return [("a.zip", data.getvalue()), ("b.txt", b"")]

    def credits(self):
        return 10.0

    def costs(self):
        return {}


def test_remote_workflow(spark, tmp_path):
    got = {r["granule"]: r for r in remote.run(spark, ["GA", "GB", "GX", "GD", "GE", "GA"], FakeService, str(tmp_path), 2, interval=0, timeout=5, sleep=lambda s: None).collect()}
    assert {g: r["status"] for g, r in got.items()} == {"GA": "done", "GB": "done", "GX": "no coverage", "GD": "failed", "GE": "failed"}
    assert got["GA"]["job_id"] == "old" and got["GB"]["job_id"] == "new-GB" and "no raster" in got["GE"]["error"]
    assert sorted(x.name for x in (tmp_path / "tif").iterdir()) == ["GA.tif", "GB.tif"] and sorted(x.name for x in (tmp_path / "png").iterdir()) == ["GA_browse.png", "GB_browse.png"]
    assert (tmp_path / "tif" / "GA.tif").read_text() == "GAd/x_VV.tif"
    service = FakeService()
    assert remote.downloaded(service, service.known[0], str(tmp_path)) == [str(tmp_path / "tif" / "GA.tif")]
    table = remote.failures(spark.createDataFrame([tuple(r) for r in got.values()], remote.RESULT))
    assert {r["granule"] for r in table.collect()} == {"GX", "GD", "GE"}
    service.calls = 1
    jobs = {r["name"]: r for r in remote.catalogue(spark, service).collect()}
    assert jobs["old"]["params"]["speckle_filter"] == "true" and jobs["exp"]["expired"]


def test_retry_timeout_and_credentials(tmp_path):
    waits, tries = [], []

    def flaky():
        tries.append(1)
        if len(tries) < 4:
            raise remote.Unavailable(429)
        return "ok"

    assert remote.Retry(backoff=2).call(flaky, waits.append) == "ok" and len(waits) == 3 and waits[0] == 0 and waits[2] > waits[1] / 2
    with pytest.raises(remote.Unavailable):
        remote.Retry(times=1).call(lambda: (_ for _ in ()).throw(remote.Unavailable(500)), waits.append)
    with pytest.raises(remote.Unavailable):
        remote.Retry().call(lambda: (_ for _ in ()).throw(remote.Unavailable(404)), waits.append)
    ticks = iter(range(0, 1000, 40))
    assert remote.awaited(FakeService(), FakeJob("j", "G", {}, 99), timeout=100, clock=lambda: next(ticks), sleep=lambda s: None) is None
    (tmp_path / "n").write_text("machine host login a password b\n")
    assert remote.credentials(None, None, "host", str(tmp_path / "n")) == ("a", "b") == remote.credentials("a", "b", "x")
    assert remote.credentials(None, None, "x", str(tmp_path / "none"), lambda what: what) == ("username", "password")
    with pytest.raises(ValueError):
        remote.credentials(None, None, "x", str(tmp_path / "none"))


@scoring.register("bright")
class Bright:
    """Class 1 where the middle of a tile is brighter than its mean."""

    def probabilities(self, tiles):
        side = int(tiles.shape[1] ** 0.5)
        x = tiles.reshape(-1, side, side)
        q = side // 4
        z = (x[:, q:-q, q:-q].mean((1, 2)) - x.mean((1, 2))) * 10
        p = 1 / (1 + np.exp(-z))
        return np.stack([1 - p, p], 1)


def test_whole_run(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.uniform(0.1, 0.2, (120, 160)).astype("<f4")
    x[40:60, 70:90] = 3.0
    x[:, :10] = 0
    x[100:, 120:] = 0
    p = tiff.Profile(160, 120, "<f4", 64, 64, compress="DEFLATE", predictor=2, transform=[0.01, 0, -118.0, 0, -0.01, 34.0], epsg=4326, geographic=True)
    parts = [tiff.encoded(x[r : r + 64, c : c + 64], p) for r in range(0, 120, 64) for c in range(0, 160, 64)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "s.tif").write_bytes(tiff.head(p, [len(b) for b in parts]) + b"".join(parts))
    settings = C.compose([f"paths.output_dir={tmp_path}/out", f"paths.processed_dir={tmp_path}/in", "inference.dataset_params.window_size=40", "inference.dataset_params.nodata_threshold=0.5", "inference.detector_class_name=bright", "inference.batch_size=16"])
    done = R.inference(spark, settings.inference)
    raw, merged = files.numbered_detections(spark, done.raw).collect(), files.numbered_detections(spark, done.merged).collect()
    assert raw and 0 < len(merged) < len(raw) and {r["filename"] for r in raw} == {"s.tif"}
    best = max(merged, key=lambda r: r["confidence"])
    assert best["x0"] <= -118 + 0.8 <= best["x1"] and best["y0"] <= 34 - 0.5 <= best["y1"]
    wins = done.windows.collect()
    assert all((x[r["row_off"] : r["row_off"] + 40, r["col_off"] : r["col_off"] + 40] == 0).mean() < 0.5 for r in wins)
    assert (tmp_path / "out" / "full_scene_previews_merged_bbox_0.5" / "s_preview.png").exists()
    assert len(list((tmp_path / "out" / "positive_detection_tiles_0.5" / "s").iterdir())) == sum(r["confidence"] >= 0.5 for r in merged)
    with pytest.raises(ValueError, match="no valid windows"):
        R.Detection(spark, C.compose([f"paths.processed_dir={tmp_path}/in"]).inference, Bright()).setup()
    with pytest.raises(ValueError, match="no dataset"):
        R.Detection(spark, C.compose(["inference.dataset_params.dataset_class_name=none"]).inference, Bright()).setup()


def test_commands(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(commands, "session", lambda: spark)
    x = np.random.default_rng(4).gamma(2, 0.1, (50, 40)).astype("<f4")
    p = tiff.Profile(40, 50, "<f4", 64, 64, transform=[0.01, 0, -118.0, 0, -0.01, 34.0], epsg=4326, geographic=True)
    (tmp_path / "in").mkdir()
    part = tiff.encoded(x, p)
    (tmp_path / "in" / "s.tif").write_bytes(tiff.head(p, [len(part)]) + part)
    assert commands.main(["preprocess", str(tmp_path / "in"), str(tmp_path / "out"), "preprocessing.dilate_px=0", "preprocessing.processed_suffix=_p"]) == 0
    assert (tmp_path / "out" / "s_p.tif").exists()
    assert commands.main(["check", str(tmp_path / "out")]) == 0 and "true" in capsys.readouterr().out
    assert commands.main(["compress", str(tmp_path / "in"), str(tmp_path / "out"), "percentile=99"]) == 0
    assert (tmp_path / "out" / "s_compressed_lossless.tif").exists()
    assert commands.main(["--help"]) == 0
    with pytest.raises(ValueError, match="hyp3.service"):
        commands.ingest(spark, C.compose(["hyp3.granules=[a]"]))
    assert commands.ingest(spark, C.compose()) == []


def test_detections_that_are_not_there(spark, tmp_path):
    assert files.read_detections(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "other.csv").write_text("filename,confidence\na,1\n")
    (tmp_path / "some.csv").write_text('confidence,filename,bbox\n0.5,a.tif,1 2 3 4\nx,a.tif,[ 1 2 3 5 ]\n0.7,b.tif,1 2\n0.9,c.tif,0 0 1 1\n')
    assert files.read_detections(spark, str(tmp_path / "empty.csv")).count() == files.read_detections(spark, str(tmp_path / "other.csv")).count() == 0
    got = files.numbered_detections(spark, str(tmp_path / "some.csv")).orderBy("i").collect()
    assert [(r["i"], r["filename"], r["confidence"]) for r in got] == [(0, "a.tif", 0.5), (1, "a.tif", None), (3, "c.tif", 0.9)]
    files.write_merged(spark, str(tmp_path / "none.csv"), str(tmp_path / "m"))
    assert files.read_detections(spark, str(tmp_path / "m")).count() == 0 and spark.read.option("header", True).csv(str(tmp_path / "m")).columns == ["filename", "bbox", "confidence"]


def test_numbers_of_windows(spark):
    w = spark.createDataFrame([("b.tif", 0, 0), ("a.tif", 5, 0), ("a.tif", 0, 5), ("a.tif", 0, 0)], "scene_id string, row_off int, col_off int")
    assert [r["name"] for r in raster.numbered(w).orderBy("n").collect()] == ["a_win0", "a_win1", "a_win2", "b_win3"]
