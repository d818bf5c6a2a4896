"""Detectors over tiles, their predictions, and matching of stored weights."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescan.functions.pixels import argmax, softmax
from tilescan.functions.workers import ship


class Detector(Protocol):
    """What a plug-in has to offer: class probabilities of a batch of tiles (n, pixels)."""

    def probabilities(self, tiles: np.ndarray) -> np.ndarray: ...


DETECTORS: dict[str, type] = {}


def register(name: str):
    """Puts a detector class on the list that ``detector`` may load."""

    def put(kind: type) -> type:
        DETECTORS[name] = kind
        return kind

    return put


def detector(name: str, **config) -> Detector:
    if name not in DETECTORS:
        raise ValueError(f"no detector {name!r}; there are {sorted(DETECTORS)}")
    return DETECTORS[name](**config)


@register("linear")
class LinearDetector:
    def __init__(self, weights: list[list[float]], bias: list[float] | None = None):
        self.weights = np.asarray(weights, float)
        self.bias = np.zeros(len(self.weights)) if bias is None else np.asarray(bias, float)

    def probabilities(self, tiles: np.ndarray) -> np.ndarray:
        z = tiles @ self.weights.T + self.bias
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def inferred(tiles: DataFrame, model: Detector, batch: int = 128, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, columns of ``keep``, prediction, confidence, error) of tiles (id, image), in batches; a batch that fails is
    reported, not dropped."""
    ship(tiles.sparkSession)
    kept = ["id", *keep]
    schema = ", ".join([*(f"`{c}` {tiles.schema[c].dataType.simpleString() if c != 'id' else 'bigint'}" for c in kept), "prediction int, confidence double, error string"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), batch):
                part = frame.iloc[k : k + batch]
                try:
                    p = model.probabilities(np.stack(part["image"].to_numpy()))
                    best = p.argmax(1)
                    yield part[kept].assign(prediction=best, confidence=p[np.arange(len(p)), best], error=None)
                except Exception as failure:  # noqa: BLE001
                    yield part[kept].assign(prediction=None, confidence=None, error=str(failure))

    return tiles.select(*kept, "image").mapInPandas(run, schema)


def passed(scored: DataFrame, classes: list[int]) -> DataFrame:
    """The rows whose prediction is among ``classes``: a first detector's choice of what a second one looks at.  An extension."""
    return scored.where(F.col("prediction").isin(list(classes)))


def predicted(logits: DataFrame) -> DataFrame:
    """Prediction and its probability from a column ``logits``."""
    p = logits.withColumn("p", softmax(F.col("logits")))
    return p.withColumn("prediction", argmax(F.col("p"))).withColumn("confidence", F.array_max("p")).drop("p")


def positives(scored: DataFrame, positive: int) -> DataFrame:
    """The rows of class ``positive`` with ``filename``, the base name of ``path``; a row without a path is of ``unknown_file``,
    and one without a box, if there is such a column, has zeros for one."""
    out = scored.where(F.col("prediction") == positive).withColumn("filename", F.element_at(F.split(F.coalesce("path", F.lit("unknown_file")), "/"), -1))
    if "bbox_geo" in scored.columns:
        out = out.withColumn("bbox_geo", F.coalesce("bbox_geo", F.array(*[F.lit(0.0).cast("float")] * 4)))
    return out


def matched_weights(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """By status the tensors (name, shape) that load, are absent from the store, not wanted, or differ in shape."""
    s, w = stored.alias("s"), wanted.alias("w")
    status = F.when(F.col("s.name").isNull(), "absent").when(F.col("w.name").isNull(), "unused").when(F.col("s.shape") == F.col("w.shape"), "loaded").otherwise("mismatched")
    return s.join(w, F.col("s.name") == F.col("w.name"), "full_outer").groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))
