"""Configuration: groups of settings, dotted overrides, ``${a.b}`` references, YAML files with ``defaults``, and arguments."""

from __future__ import annotations

import argparse
import copy
import os
import re
from collections.abc import Iterable, Mapping
from typing import Any

REFERENCE = re.compile(r"\$\{([\w.]+)\}")
# fixed values: names and default settings
ROOT: dict[str, Any] = {
    "mode": "full",
    "paths": {"log_dir": "logs/", "download_dir": "data/downloaded/", "processed_dir": "data/processed/", "preview_dir": "data/previews/", "temp_dir": "data/downloaded/temp", "output_dir": "output/"},
    "debug": False,
}
JOB_PARAMETERS: dict[str, Any] = {"dem_name": "copernicus", "resolution": 30, "radiometry": "sigma0", "scale": "power", "speckle_filter": True, "dem_matching": False, "include_dem": False, "include_inc_map": False, "include_rgb": False, "include_scattering_area": False}
GROUPS: dict[str, dict[str, dict[str, Any]]] = {
    "hyp3": {"default": {"username": None, "password": None, "granules": [], "keep_zip": False, "max_parallel_jobs": 32, "connection_pool_maxsize": 64, "job_parameters": JOB_PARAMETERS}},
    "preprocessing": {
        "default": {
            "land_shapefile": None, "download_dir": "${paths.download_dir}", "processed_dir": "${paths.processed_dir}", "preview_dir": "${paths.preview_dir}", "temp_dir": "${paths.temp_dir}",
            "clip_percentile": 99.9, "dilate_px": 12, "convert_to_db": True, "save_masked": True, "masked_dtype": "float32", "compress": "DEFLATE", "processed_suffix": "",
        }
    },
    "inference": {
        "default": {
            "method": "inference", "num_channels": 1, "detector_class_name": "linear", "output_dir": "${paths.output_dir}", "geotiff_dir": "${paths.processed_dir}",
            "dataset_params": {"dataset_class_name": "tiles", "geotiff_dir": "${inference.geotiff_dir}", "window_size": 700, "stride_factor": 0.25, "nodata_threshold": 0.7, "var_threshold": None},
            "model_loader_class": "arrays", "arch": "r50_1x_sk0", "num_classes": 2, "pretrain": None, "nodata_value": 0,
            "identification_table_path": "${inference.output_dir}/positive_identifications.csv", "positive_class_index": 1,
            "bbox_merging": {"nms_iou_threshold": 0.05, "merge_iou_threshold": 0.3, "post_nms_iou_threshold": 0.1},
            "prefilter": {"enabled": False, "store_results": False, "pass_classes": [2], "model": {"arch": "r50_1x_sk0", "num_classes": 10, "pretrain": None}},
            "device": "cpu", "workers": 2, "batch_size": 128,
        },
        "features": {"method": "inference_features", "num_channels": 3, "detector_class_name": "features", "output_dir": "output/features", "pipeline_path": None},
    },
}
MODES = ("full", "hyp3_only", "inference_only")


class Settings(dict):
    """A tree of settings that are also attributes."""

    def __getattr__(self, name: str) -> Any:
        try:
            return self[name]
        except KeyError:
            raise AttributeError(name) from None


def over(base: Mapping[str, Any], other: Mapping[str, Any]) -> dict[str, Any]:
    """``base`` with the settings of ``other`` put over it, level by level."""
    out = dict(base)
    for key, value in other.items():
        out[key] = over(out[key], value) if isinstance(value, Mapping) and isinstance(out.get(key), Mapping) else value
    return out


def _at(tree: Mapping[str, Any], path: str) -> Any:
    for part in path.split("."):
        tree = tree[part]
    return tree


def resolved(tree: dict[str, Any]) -> Settings:
    """``tree`` with its references filled in; a value that is one reference keeps its type, and a circle is an error."""

    def fill(value: Any, seen: tuple[str, ...]) -> Any:
        if isinstance(value, Mapping):
            return Settings({k: fill(v, seen) for k, v in value.items()})
        if isinstance(value, list):
            return [fill(v, seen) for v in value]
        if not isinstance(value, str):
            return value

        def look(path: str) -> Any:
            if path in seen:
                raise ValueError(f"settings refer to each other: {' -> '.join((*seen, path))}")
            return fill(_at(tree, path), (*seen, path))

        whole = REFERENCE.fullmatch(value)
        return look(whole[1]) if whole else REFERENCE.sub(lambda m: str(look(m[1])), value)

    return fill(tree, ())


def _value(text: str) -> Any:
    """A value as YAML would read it, of the plain kinds; lists in brackets."""
    if text.startswith("[") and text.endswith("]"):
        return [_value(x.strip()) for x in text[1:-1].split(",") if x.strip()]
    low = text.lower()
    if low in ("true", "false"):
        return low == "true"
    if low in ("null", "none", "~", ""):
        return None
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text.strip("'\"")


def compose(arguments: Iterable[str] = (), given: Mapping[str, Any] | None = None) -> Settings:
    """The settings of all groups, with ``given`` over them, then ``key.sub=value`` and ``group=choice`` of ``arguments``."""
    choice, changes = dict.fromkeys(GROUPS, "default"), []
    for argument in arguments:
        key, eq, text = argument.partition("=")
        if not eq:
            raise ValueError(f"an argument is key=value, not {argument!r}")
        key = key.lstrip("+-")
        if key in GROUPS:
            if text not in GROUPS[key]:
                raise ValueError(f"{key} is one of {sorted(GROUPS[key])}, not {text!r}")
            choice[key] = text
        else:
            changes.append((key, _value(text)))
    tree = copy.deepcopy(ROOT)
    for group, name in choice.items():
        tree[group] = over(copy.deepcopy(GROUPS[group]["default"]), copy.deepcopy(GROUPS[group][name]))
    tree = over(tree, given or {})
    for key, value in changes:
        node, *path = tree, *key.split(".")
        for part in path[:-1]:
            node = node.setdefault(part, {})
        node[path[-1]] = value
    if tree["mode"] not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {tree['mode']!r}")
    return resolved(tree)


def from_yaml(path: str) -> dict[str, Any]:
    """A YAML file with the files that its ``defaults`` name (group: file, in the folder of that group); the settings of the
    including file win, whole keys at a time.  Needs a YAML library."""
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("YAML files need the yaml package") from missing

    def load(name: str) -> dict[str, Any]:
        with open(name) as f:
            return yaml.safe_load(f) or {}

    own = load(path)
    out = dict(own)
    for entry in own.get("defaults", []):
        if not isinstance(entry, Mapping):
            continue
        for group, name in entry.items():
            file = os.path.join(os.path.dirname(path), group, name if os.path.splitext(name)[1] else name + ".yaml")
            out = {**load(file), **out}
    out.pop("defaults", None)
    return out


def arguments(settings: Mapping[str, Any], argv: list[str] | None = None, booleans: Iterable[str] = ()) -> argparse.Namespace:
    """An argument for each plain setting, of its type; names among ``booleans`` take yes, no, true, false, none, and ``seed`` a
    whole number.  Unknown arguments are left alone."""
    parser, switches = argparse.ArgumentParser(), set(booleans)

    def truth(text: str) -> Any:
        return {"yes": True, "true": True, "no": False, "false": False, "none": False}.get(str(text).lower(), text)

    for key, value in settings.items():
        kind = truth if key in switches else int if key.lower() in ("seed", "pretrain_epoch_num") else str if value is None else type(value)
        parser.add_argument(f"--{key}", default=value, type=kind)
    return parser.parse_known_args(argv)[0]
