"""Suppression and merging of overlapping detections, scene by scene.

A detection is (filename, confidence, x0, y0, x1, y1, ordinal).  Order among equal confidences is by descending ordinal.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import cos, radians

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilescan.functions.geometry import iou
from tilescan.functions.workers import ship

BOX = ("x0", "y0", "x1", "y1")


def parted(detections: DataFrame) -> DataFrame:
    """``detections`` with ``part``: boxes of different parts of a scene are apart, and so are the envelopes of parts.

    A scene is cut where a line across it meets no box: between columns, then between rows, and so once more.  Each cut is
    a running maximum over the sorted boxes of a part, which Spark spills if need be.
    """
    out = detections.withColumn("part", F.lit(0).cast("long"))
    for low, high in (("x0", "x1"), ("y0", "y1"), ("x0", "x1")):
        line = W.partitionBy("filename", "part").orderBy(low, high)
        apart = (F.col(low) >= F.max(high).over(line.rowsBetween(W.unboundedPreceding, -1))).cast("long")
        out = out.withColumn("apart", F.coalesce(apart, F.lit(0)))
        # a number for the piece of a part; part numbers only need to differ within a scene
        out = out.withColumn("part", F.xxhash64("part", F.sum("apart").over(line.rowsBetween(W.unboundedPreceding, 0)))).drop("apart")
    return out


def overlaps(box: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Intersection over union of a box with each row of ``others``, by the rule of ``geometry.iou``."""
    scale = np.cos(np.radians(((box[1] + box[3]) / 2 + (others[:, 1] + others[:, 3]) / 2) / 2))
    a, b = (box[0] + box[2]) / 2, (others[:, 0] + others[:, 2]) / 2
    half_a, half_b = (box[2] - box[0]) / 2 * scale, (others[:, 2] - others[:, 0]) / 2 * scale
    w = np.maximum(0.0, np.minimum(a + half_a, b + half_b) - np.maximum(a - half_a, b - half_b))
    shared = w * np.maximum(0.0, np.minimum(box[3], others[:, 3]) - np.maximum(box[1], others[:, 1]))
    union = scale * ((box[2] - box[0]) * (box[3] - box[1]) + (others[:, 2] - others[:, 0]) * (others[:, 3] - others[:, 1])) - shared
    return np.where(union > 0, shared / np.where(union > 0, union, 1.0), 0.0)


def survivors(boxes: np.ndarray, threshold: float) -> np.ndarray:
    """Places of the boxes (best first) that greedy suppression leaves."""
    left, kept = np.arange(len(boxes)), []
    while len(left):
        kept.append(left[0])
        rest = left[1:]
        left = rest[overlaps(boxes[left[0]], boxes[rest]) <= threshold]
    return np.array(kept, int)


def runs(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[tuple[int, int]]]]:
    """Rows sorted by filename and part, with the (start, end) of each part that is whole."""
    held: pd.DataFrame | None = None
    for frame in frames:
        rows = frame if held is None else pd.concat([held, frame], ignore_index=True)
        if not len(rows):
            continue
        name, part = rows["filename"].to_numpy(), rows["part"].to_numpy()
        edge = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | (part[1:] != part[:-1])]).tolist()
        if len(edge) > 1:
            yield rows, list(zip(edge, edge[1:]))
        held = rows.iloc[edge[-1] :].reset_index(drop=True)
    if held is not None and len(held):
        yield held, [(0, len(held))]


def suppressed(detections: DataFrame, threshold: float) -> DataFrame:
    """Greedy suppression: a box stays unless its overlap with a better box that stays exceeds ``threshold``.  Rows without
    filename, box or confidence are dropped.  The result has ``rank``, the place among the scene's boxes that stay.

    A task goes through sorted parts of scenes in numpy; it holds one part, whose boxes the raster's windows bound, and a batch.
    """
    if threshold < 0:
        raise ValueError("the threshold must not be negative")
    ship(detections.sparkSession)
    columns = ["filename", "confidence", "ordinal", *BOX]

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, spans in runs(frames):
            box = rows[list(BOX)].to_numpy(float)
            kept = [np.array([a]) if b - a == 1 else a + survivors(box[a:b], threshold) for a, b in spans]
            yield rows.iloc[np.concatenate(kept)][columns]

    clean = detections.dropna(subset=["filename", "confidence", *BOX]).where(~F.isnan("confidence"))
    dealt = parted(clean.select(*columns)).repartition("filename", "part").sortWithinPartitions("filename", "part", F.desc("confidence"), F.desc("ordinal"))
    kept = dealt.mapInPandas(walk, "filename string, confidence double, ordinal long, x0 double, y0 double, x1 double, y1 double")
    rank = F.row_number().over(W.partitionBy("filename").orderBy(F.desc("confidence"), F.desc("ordinal"))) - 1
    return kept.select("filename", rank.cast("long").alias("rank"), "confidence", "ordinal", *BOX)


def pairwise_iou(detections: DataFrame, above: float = 0.0) -> DataFrame:
    """Pairs of one scene whose boxes overlap.  Boxes meet on the cells of a grid, so that only near ones are compared, and
    a pair counts in the cell of its intersection's lower left corner."""
    size = 0.25
    cell = lambda c: F.floor(F.col(c) / size)
    cells = detections.select("filename", "ordinal", *BOX, F.explode(F.sequence(cell("x0"), cell("x1"))).alias("gx")).select("*", F.explode(F.sequence(cell("y0"), cell("y1"))).alias("gy"))
    a, b = cells.alias("a"), cells.alias("b")
    met = a.join(b, (F.col("a.filename") == F.col("b.filename")) & (F.col("a.gx") == F.col("b.gx")) & (F.col("a.gy") == F.col("b.gy")) & (F.col("a.ordinal") < F.col("b.ordinal")))
    first = (F.col("a.gx") == F.floor(F.greatest("a.x0", "b.x0") / size)) & (F.col("a.gy") == F.floor(F.greatest("a.y0", "b.y0") / size))
    boxes = [F.struct(*(F.col(f"{s}.{c}").alias(c) for c in BOX)) for s in "ab"]
    return met.where(first).select(F.col("a.filename").alias("filename"), F.col("a.ordinal").alias("a"), F.col("b.ordinal").alias("b"), iou(*boxes).alias("iou")).where(F.col("iou") > above)


def envelope(detections: DataFrame) -> DataFrame:
    """By scene the envelope of all boxes, their number and mean confidence."""
    return detections.where("filename is not null").groupBy("filename").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.avg("confidence").alias("confidence"), F.count(F.lit(1)).alias("n"))


class Shape:
    """A union of boxes as disjoint rectangles, with the confidences of its members and the rank of the first."""

    def __init__(self, rects: list[tuple[float, float, float, float]], confidences: list[float], first: int = 0):
        self.rects, self.confidences, self.first = rects, confidences, first
        self.x0, self.y0 = min(r[0] for r in rects), min(r[1] for r in rects)
        self.x1, self.y1 = max(r[2] for r in rects), max(r[3] for r in rects)
        sizes = [(r[2] - r[0]) * (r[3] - r[1]) for r in rects]
        self.area = sum(sizes)
        self.lat = sum(s * (r[1] + r[3]) / 2 for s, r in zip(sizes, rects)) / self.area if self.area else (self.y0 + self.y1) / 2

    def overlap(self, other: Shape) -> float:
        if self.x1 <= other.x0 or other.x1 <= self.x0 or self.y1 <= other.y0 or other.y1 <= self.y0:
            return 0.0  # shrunk shapes stay within their bounds
        scale = cos(radians((self.lat + other.lat) / 2))
        a, b = (self.x0 + self.x1) / 2, (other.x0 + other.x1) / 2
        shared = 0.0
        for p in self.rects:
            for q in other.rects:
                w = min(a + (p[2] - a) * scale, b + (q[2] - b) * scale) - max(a + (p[0] - a) * scale, b + (q[0] - b) * scale)
                h = min(p[3], q[3]) - max(p[1], q[1])
                if w > 0 and h > 0:
                    shared += w * h
        union = scale * (self.area + other.area) - shared
        return shared / union if union > 0 else 0.0

    def united(self, other: Shape) -> Shape:
        rest = list(other.rects)
        for p in self.rects:
            cutout = []
            for q in rest:
                x0, y0, x1, y1 = max(p[0], q[0]), max(p[1], q[1]), min(p[2], q[2]), min(p[3], q[3])
                if x0 >= x1 or y0 >= y1:
                    cutout.append(q)
                    continue
                cutout += [r for r in ((q[0], q[1], q[2], y0), (q[0], y1, q[2], q[3]), (q[0], y0, x0, y1), (x1, y0, q[2], y1)) if r[0] < r[2] and r[1] < r[3]]
            rest = cutout
        return Shape(self.rects + rest, self.confidences + other.confidences, self.first)


def absorbed(first: Shape, others: Iterable[Shape], threshold: float) -> tuple[Shape, list[Shape]]:
    """``first`` with those of ``others`` that overlap it by more than ``threshold`` as it grows, and the ones that do not."""
    apart = []
    for other in others:
        if first.overlap(other) > threshold:
            first = first.united(other)
        else:
            apart.append(other)
    return first, apart


def unite(shapes: list[Shape], threshold: float) -> list[Shape]:
    """Each shape in turn absorbs later ones; passes go on until one leaves as many shapes as it found."""
    before = None
    while before != len(shapes):
        before, left, shapes = len(shapes), shapes, []
        while left:
            grown, left = absorbed(left[0], left[1:], threshold)
            shapes.append(grown)
    return shapes


def united(detections: DataFrame, threshold: float) -> DataFrame:
    """Envelopes and mean confidences of merged boxes (filename, ordinal, confidence, n_members, box); ``ordinal`` is the rank
    of the first member.  A task goes through sorted parts of scenes."""
    ship(detections.sparkSession)

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, spans in runs(frames):
            box, confidence, rank, name = list(zip(*(rows[c].tolist() for c in BOX))), rows["confidence"].tolist(), rows["rank"].tolist(), rows["filename"].tolist()
            out = []
            for a, b in spans:
                done = unite([Shape([box[k]], [confidence[k]], rank[k]) for k in range(a, b)], threshold)
                out += [(name[a], s.first, sum(s.confidences) / len(s.confidences), len(s.confidences), s.x0, s.y0, s.x1, s.y1) for s in done]
            yield pd.DataFrame(out, columns=["filename", "ordinal", "confidence", "n_members", *BOX])

    dealt = parted(detections).repartition("filename", "part").sortWithinPartitions("filename", "part", "rank")
    return dealt.mapInPandas(walk, "filename string, ordinal long, confidence double, n_members long, x0 double, y0 double, x1 double, y1 double")


def merged(detections: DataFrame, nms: float = 0.05, merge: float = 0.3, post: float = 0.1) -> DataFrame:
    """Suppression, merging, and suppression of the merged envelopes."""
    return suppressed(united(suppressed(detections, nms), merge).drop("n_members"), post)


def confident(detections: DataFrame, threshold: float = 0.5) -> DataFrame:
    return detections.where(F.col("confidence") >= threshold)


def best_per_scene(detections: DataFrame) -> DataFrame:
    """The first detection in suppression order of each scene."""
    key = F.struct("confidence", "ordinal")
    return detections.where("confidence is not null").groupBy("filename").agg(F.max_by(F.struct("confidence", "ordinal", *BOX), key).alias("b")).select("filename", "b.*")


def crop_names(detections: DataFrame, number: Column) -> DataFrame:
    """Names of detection crops; ``number`` is the row's place before any filter.  Halves of the third decimal round up."""
    stem = F.regexp_replace("filename", r"\.[^.]*$", "")
    return detections.withColumn("crop", F.format_string("%s_detection_%03d_conf_%.3f.png", stem, number, F.col("confidence")))


def scene_windows(detections: DataFrame) -> DataFrame:
    return detections.withColumn("i", F.row_number().over(W.partitionBy("filename").orderBy("ordinal")) - 1)


