"""Rows dealt to ranges of (doc_id, tie), in order, however the ids are distributed.

A bound is a pair of a doc_id and a tie, the hash of the row's text: an id that holds more than a range's share of the rows gets
several ranges, by its ties.  There are ``MOST`` ranges at most, so what the driver and the tasks know of them is bounded; a
range may be of any size, as tasks go through its sorted rows one by one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 1 << 16
LEAST = -(1 << 63)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id (of a null one the least long), tie and text (null is empty) of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))


class Ranges:
    """Bounds in ascending order; range p holds the keys from bound p - 1 on and below bound p."""

    def __init__(self, cuts: list[int]):
        found: list[tuple[int, int]] = []
        ids, counts = np.unique(np.array(cuts, np.int64), return_counts=True)
        for i, n in zip(ids.tolist(), counts.tolist()):
            found += [(i, LEAST + k * ((1 << 64) // n)) for k in range(n)]
            if n > 1 and i < (1 << 63) - 1:
                found.append((i + 1, LEAST))
        found = sorted(set(found))
        self.ids, self.ties = (np.array([x[k] for x in found], np.int64) for k in (0, 1))
        self.count = len(found) + 1

    def place(self, ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """The range of each key."""
        first, last = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
        out = first.copy()
        several = np.flatnonzero(last > first)
        for i in np.unique(ids[several]).tolist():
            at = several[ids[several] == i]
            a, b = first[at[0]], last[at[0]]
            out[at] = a + np.searchsorted(self.ties[a:b], ties[at], "right")
        return out


def ranges_of(rows: DataFrame, weight: Column, per_range: int) -> Ranges:
    """Ranges of some ``per_range`` of ``weight`` each, as far as rows are alike; from a sketch of the ids."""
    row = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(weight), F.lit(0)).alias("w")).first()
    n = int(max(1, min(MOST, -(-row["w"] // per_range))))
    if n == 1 or not row["n"]:
        return Ranges([])
    return Ranges(rows.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], max(1000, 4 * n)).alias("c")).first()["c"] or [])
