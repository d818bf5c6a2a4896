"""Image networks in numpy, from weights by name: a residual network of bottlenecks, its contrastive head, a classifier on
features; and the loaders that a configuration names."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tilescan.operators.scoring import register

Weights = Mapping[str, np.ndarray]
# fixed values: depth, width and selective-kernel share that an architecture's name states
ARCHITECTURES = {"r50_1x_sk0": {"blocks": (3, 4, 6, 3), "width": 1}}
PAYLOADS = ("state_dict", "resnet", "head", "model")
EPS = 1e-5


def read_weights(path: str) -> dict[str, np.ndarray]:
    """The arrays of an .npz file, or of a .safetensors file; formats that run code when read are refused."""
    if path.endswith(".npz"):
        with np.load(path, allow_pickle=False) as z:
            return {k: z[k] for k in z.files}
    if path.endswith(".safetensors"):
        kinds = {"F64": "<f8", "F32": "<f4", "F16": "<f2", "I64": "<i8", "I32": "<i4", "U8": "u1"}
        with open(path, "rb") as f:
            header = json.loads(f.read(int.from_bytes(f.read(8), "little")))
            data = f.read()
        return {k: np.frombuffer(data[v["data_offsets"][0] : v["data_offsets"][1]], kinds[v["dtype"]]).reshape(v["shape"]) for k, v in header.items() if k != "__metadata__"}
    raise ValueError(f"{path}: weights are read from .npz and .safetensors files only")


def payload(stored: Mapping[str, Any]) -> Mapping[str, Any]:
    """The tensors of a checkpoint: under the first of PAYLOADS that it has, or itself."""
    for name in PAYLOADS:
        if isinstance(stored.get(name), Mapping):
            return stored[name]
    return stored


def shapes(spark: SparkSession, weights: Weights) -> DataFrame:
    """(name, shape) of tensors, for ``scoring.matched_weights``."""
    return spark.createDataFrame([(k, list(map(int, v.shape))) for k, v in sorted(weights.items())], "name string, shape array<int>")


def loaded(model: Weights, stored: Weights) -> tuple[dict[str, np.ndarray], dict[str, list[str]]]:
    """``model`` with the stored tensors of equal name and shape; and the names loaded, absent from the store, of another shape."""
    out, told = dict(model), {"loaded": [], "absent": [], "mismatched": []}
    for name, value in model.items():
        kind = "absent" if name not in stored else "loaded" if stored[name].shape == value.shape else "mismatched"
        told[kind].append(name)
        if kind == "loaded":
            out[name] = stored[name]
    return out, told


def convolved(x: np.ndarray, w: np.ndarray, stride: int = 1, pad: int | None = None) -> np.ndarray:
    """Images (n, channels, rows, columns) by kernels (out, in, k, k); half the kernel is padded unless ``pad`` says otherwise."""
    k = w.shape[-1]
    pad = k // 2 if pad is None else pad
    x = np.pad(x, ((0, 0), (0, 0), (pad, pad), (pad, pad)))
    seen = np.lib.stride_tricks.sliding_window_view(x, (k, k), (2, 3))[:, :, ::stride, ::stride]
    return np.einsum("nchwij,ocij->nohw", seen, w, optimize=True)


def normed(x: np.ndarray, weights: Weights, name: str) -> np.ndarray:
    """Batch normalisation with the stored mean and variance."""
    g, b, m, v = (weights[f"{name}.{p}"][:, None, None] for p in ("weight", "bias", "running_mean", "running_var"))
    return (x - m) / np.sqrt(v + EPS) * g + b


def pooled(x: np.ndarray, k: int = 3, stride: int = 2) -> np.ndarray:
    """The largest value of each k x k window, one pixel of padding."""
    x = np.pad(x, ((0, 0), (0, 0), (1, 1), (1, 1)), constant_values=-np.inf)
    return np.lib.stride_tricks.sliding_window_view(x, (k, k), (2, 3))[:, :, ::stride, ::stride].max((-1, -2))


def plan(arch: str = "r50_1x_sk0") -> list[tuple[str, int, int, int, bool]]:
    """(name, channels in, middle channels, stride, whether projected) of each bottleneck."""
    if arch not in ARCHITECTURES:
        raise ValueError(f"no architecture {arch!r}; there are {sorted(ARCHITECTURES)}")
    found, given = ARCHITECTURES[arch], 64 * ARCHITECTURES[arch]["width"]
    out = []
    for g, n in enumerate(found["blocks"]):
        middle = (64 << g) * found["width"]
        for k in range(n):
            out.append((f"net.{g + 1}.blocks.{k}", given, middle, 2 if g and not k else 1, not k))
            given = 4 * middle
    return out


def empty_weights(arch: str = "r50_1x_sk0", channels: int = 3, classes: int = 2, seed: int | None = None) -> dict[str, np.ndarray]:
    """Tensors of the right names and shapes: zeros, or scaled noise of a seed."""
    rng = np.random.default_rng(seed)
    make = (lambda *s: np.zeros(s, np.float32)) if seed is None else lambda *s: (rng.normal(size=s) / np.sqrt(max(1, np.prod(s[1:])))).astype(np.float32)
    out: dict[str, np.ndarray] = {}

    def norm(name: str, n: int) -> None:
        out.update({f"{name}.weight": np.ones(n, np.float32), f"{name}.bias": np.zeros(n, np.float32), f"{name}.running_mean": np.zeros(n, np.float32), f"{name}.running_var": np.ones(n, np.float32)})

    first = 64 * ARCHITECTURES[arch]["width"]
    out["net.0.conv.weight"] = make(first, channels, 7, 7)
    norm("net.0.norm", first)
    last = first
    for name, given, middle, _, projected in plan(arch):
        for part, shape in (("conv1", (middle, given, 1, 1)), ("conv2", (middle, middle, 3, 3)), ("conv3", (4 * middle, middle, 1, 1))):
            out[f"{name}.{part}.weight"] = make(*shape)
            norm(f"{name}.norm{part[-1]}", shape[0])
        if projected:
            out[f"{name}.projection.weight"] = make(4 * middle, given, 1, 1)
            norm(f"{name}.projection_norm", 4 * middle)
        last = 4 * middle
    out["fc.weight"], out["fc.bias"] = make(classes, last), np.zeros(classes, np.float32)
    return out


def residual_features(x: np.ndarray, weights: Weights, arch: str = "r50_1x_sk0") -> np.ndarray:
    """(n, features) of images (n, channels, rows, columns): stem, bottlenecks, mean over the image."""
    x = pooled(np.maximum(0, normed(convolved(x, weights["net.0.conv.weight"], 2), weights, "net.0.norm")))
    for name, _, _, stride, projected in plan(arch):
        short = normed(convolved(x, weights[f"{name}.projection.weight"], stride), weights, f"{name}.projection_norm") if projected else x
        y = np.maximum(0, normed(convolved(x, weights[f"{name}.conv1.weight"]), weights, f"{name}.norm1"))
        y = np.maximum(0, normed(convolved(y, weights[f"{name}.conv2.weight"], stride), weights, f"{name}.norm2"))
        x = np.maximum(0, normed(convolved(y, weights[f"{name}.conv3.weight"]), weights, f"{name}.norm3") + short)
    return x.mean((2, 3))


def contrastive_head(h: np.ndarray, weights: Weights, layers: int = 3) -> np.ndarray:
    """The projection that training compares: linear layers with normalisation, rectified but for the last.  Inference does not use it."""
    for k in range(layers):
        h = h @ weights[f"head.{k}.weight"].T
        g, b, m, v = (weights.get(f"head.{k}.norm.{p}") for p in ("weight", "bias", "running_mean", "running_var"))
        h = (h - m) / np.sqrt(v + EPS) * g + (0 if b is None else b)
        h = np.maximum(0, h) if k < layers - 1 else h
    return h


def kind_of(name: str) -> str:
    """Which part of a tensor's layer its name tells: bias, norm, convolution, linear or other."""
    low = name.lower()
    return "bias" if low.endswith("bias") else "norm" if "norm" in low or "bn" in low else "convolution" if "conv" in low or "projection" in low else "linear" if "fc" in low or "head" in low else "other"


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@register("residual")
class ResidualDetector:
    """Class probabilities of the residual network, of square tiles of one channel."""

    def __init__(self, weights: Weights | str, arch: str = "r50_1x_sk0"):
        self.weights = read_weights(weights) if isinstance(weights, str) else dict(weights)
        self.arch = arch

    def probabilities(self, tiles: np.ndarray) -> np.ndarray:
        channels = self.weights["net.0.conv.weight"].shape[1]
        side = int(round((tiles.shape[1] / channels) ** 0.5))
        x = tiles.reshape(len(tiles), channels, side, side).astype(np.float32)
        return _softmax(residual_features(x, self.weights, self.arch) @ self.weights["fc.weight"].T + self.weights["fc.bias"])


@register("features")
class FeatureDetector:
    """A feature extractor, then a stored classifier: ``predict`` and, if it has it, ``predict_proba``, whose columns are the
    classes 0 to k - 1; without it the predicted class has probability 1."""

    def __init__(self, extract: Callable[[np.ndarray], np.ndarray], classifier: Any):
        self.extract, self.classifier = extract, classifier

    def probabilities(self, tiles: np.ndarray) -> np.ndarray:
        found = np.asarray(self.extract(tiles))
        found = found.reshape(len(found), -1)
        best = np.asarray(self.classifier.predict(found)).astype(int)
        out = np.asarray(self.classifier.predict_proba(found), float) if hasattr(self.classifier, "predict_proba") else np.eye(max(2, best.max() + 1))[best]
        if best.min() < 0 or best.max() >= out.shape[1]:
            raise ValueError("classes must be numbered from 0 without gaps")
        # the class that the classifier predicts is the one that counts
        return np.where(np.arange(out.shape[1]) == best[:, None], out, np.minimum(out, out[np.arange(len(out)), best][:, None] * (1 - 1e-12)))


LOADERS: dict[str, Callable[[Mapping[str, Any]], tuple[Any, tuple[int, int, int], str]]] = {}


def loader(name: str):
    """Puts a function on the list of loaders: settings to (model, input size, interpolation)."""

    def put(f):
        LOADERS[name] = f
        return f

    return put


def load(config: Mapping[str, Any]) -> tuple[Any, tuple[int, int, int], str]:
    """The model that ``model_loader_class`` loads."""
    name = config.get("model_loader_class")
    if name not in LOADERS:
        raise ValueError(f"no loader {name!r}; there are {sorted(LOADERS)}")
    return LOADERS[name](config)


@loader("arrays")
def load_arrays(config: Mapping[str, Any]) -> tuple[dict[str, np.ndarray], tuple[int, int, int], str]:
    """The residual network from a file of arrays; the first convolution is cut to ``num_channels``."""
    arch, path, channels = config.get("arch", "r50_1x_sk0"), config.get("pretrain"), int(config.get("num_channels", 1))
    if arch not in ARCHITECTURES:
        raise ValueError(f"no architecture {arch!r}; there are {sorted(ARCHITECTURES)}")
    if not path:
        raise ValueError("pretrain must name a file of weights")
    stored = dict(payload(read_weights(path)))
    first = stored.get("net.0.conv.weight")
    if first is not None:
        stored["net.0.conv.weight"] = first[:, :channels]
    weights, told = loaded(empty_weights(arch, channels, int(config.get("num_classes", 2))), stored)
    if told["absent"] or told["mismatched"]:
        raise ValueError(f"weights that do not fit: {told['absent'][:5]} absent, {told['mismatched'][:5]} of another shape")
    return weights, (channels, 224, 224), "nearest"


@loader("external")
def load_external(config: Mapping[str, Any]) -> tuple[Any, tuple[int, int, int], str]:
    """A pretrained model without its classifier, of an image-model library that has to be installed on every worker."""
    try:
        import timm
    except ImportError as missing:
        raise RuntimeError(f"the model {config.get('arch')!r} needs the timm package") from missing
    model = timm.create_model(config["arch"], pretrained=True, num_classes=0)
    facts = timm.data.resolve_model_data_config(model)
    return model, tuple(facts["input_size"]), facts.get("interpolation", "bicubic")
