"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the k least of the distinct 64-bit hashes of a text's word shingles.  Sketches of parts merge into the
sketch of the whole (the k least of both).  The k least of a union are a sample of it, so the share of them that both
sketches hold estimates the resemblance; with the estimated numbers of distinct shingles it gives containment.  A text
with fewer than k distinct shingles is held whole, and all figures are exact then.

Words are `[^\\x20\\x09-\\x0D]+` with A-Z in lower case; a shingle is five words, or all of them if there are fewer.

``edited`` pairs each document with its edited text: the last floor(n/2) code points give way to the first as many (or
all) of the next document in descending doc_id, the first one following the last.  The texts are dealt out once, to ranges of
doc_id; the one document that a range needs from the next goes to both; a task goes through its sorted rows one by one.

Defined results: a null text is an empty one; an empty text has an empty sketch, alike to another empty one (1.0) and to
no other text (0.0); a null doc_id comes after all others (in descending order); rows that share a doc_id are in
descending order of a hash of their texts and may fill several ranges; a single row is its own next; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescan.llm.common import as_bytes, ship
from tilescan.llm.ranges import LEAST, Ranges, keyed, ranges_of

K = 128
WORDS = 5
FULL = float(1 << 64)


def shingle_hashes(text: bytes, words: int, known: dict[bytes, int]) -> np.ndarray:
    """Hashes of the word shingles of a UTF-8 text, in order.  ``known`` remembers the words' hashes."""
    parts = text.lower().split()
    h64 = xxhash.xxh64_intdigest
    if len(known) > 500_000:
        known.clear()
    for part in parts:
        if part not in known:
            known[part] = h64(part)
    h = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    n = min(words, len(h))
    if not n:
        return h
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = (out ^ h[k : len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k least distinct hashes, ascending."""
    if len(hashes) > 8 * k:
        near = np.partition(hashes, 4 * k)[: 4 * k]
        least = np.unique(near)
        if len(least) >= k:
            return least[:k]
    return np.unique(hashes)[:k]


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of both parts together (of the shingles that lie within either)."""
    return np.unique(np.r_[a, b])[:k]


def distinct(a: np.ndarray, k: int = K) -> float:
    """The estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) * FULL / (float(a[k - 1]) + 1.0)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the shingles of either that both have."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.r_[a, b])
    twice = both[1:] == both[:-1]
    least = np.r_[both[:-1][~twice], both[-1:]] if not twice.all() else both[-1:]
    if len(a) >= k or len(b) >= k:  # else both are whole, and so is their union
        least = least[:k]
    shared = both[:-1][twice]
    return float((shared <= least[-1]).sum()) / len(least)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    r = resemblance(a, b, k)
    return min(1.0, r / (1 + r) * (distinct(a, k) + distinct(b, k)) / distinct(a, k))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u8").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), "<u8")


def fingerprints(docs: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """doc_id, fingerprint, n_distinct of each row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            found = [sketch(shingle_hashes(x, words, known), k) for x in as_bytes(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(list(map(to_text, found)), pa.string()), pa.array([distinct(x, k) for x in found], pa.float64())], names=["doc_id", "fingerprint", "n_distinct"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(walk, "doc_id long, fingerprint string, n_distinct double")


def edited(docs: DataFrame, k: int = K, words: int = WORDS, bytes_per_range: int = 24 << 20) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    rows = keyed(docs)
    ranges = ranges_of(rows, F.octet_length("text"), bytes_per_range)
    tops = _tops(rows, ranges)  # by range its first key in descending order, at most one a range
    order = sorted(tops)
    # the first row of a range also goes to the range before it in descending order; the first of all to the last range
    goes = dict(zip(order, order[1:] + order[:1]))
    top_id, top_tie = (np.array([tops.get(p, (0, 0))[i] for p in range(ranges.count)], np.int64) for i in (0, 1))
    other = np.array([goes.get(p, -1) for p in range(ranges.count)], np.int32)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = batch.column("doc_id").to_numpy(), batch.column("tie").to_numpy()
            part = ranges.place(ids, ties).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.zeros(len(ids), bool)), *batch.columns], names=["p", "halo", "doc_id", "tie", "text"])
            first = np.flatnonzero((ids == top_id[part]) & (ties == top_tie[part]))
            if len(first):
                copies = batch.take(pa.array(first))
                yield pa.RecordBatch.from_arrays([pa.array(other[part[first]]), pa.array(np.ones(len(first), bool)), *copies.columns], names=["p", "halo", "doc_id", "tie", "text"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        now, held, mine = None, None, None  # the range, the row whose next one is awaited, its sketch
        out: list[list] = [[] for _ in range(7)]
        for batch in batches:
            for p, halo, doc_id, data in zip(batch.column("p").to_pylist(), batch.column("halo").to_pylist(), batch.column("doc_id").to_pylist(), as_bytes(batch)):
                if p != now:
                    now, held = p, None
                if held is not None:
                    following = sketch(shingle_hashes(data, words, known), k)
                    _pair(out, held[0], held[1], data, mine, following, known, k, words)
                    mine = following
                elif not halo:
                    mine = sketch(shingle_hashes(data, words, known), k)
                held = None if halo else (doc_id, data)
                if len(out[0]) == 2000:
                    yield _batch(out)
                    out = [[] for _ in range(7)]
        if out[0]:
            yield _batch(out)

    dealt = rows.mapInArrow(deal, "p int, halo boolean, doc_id long, tie long, text string").repartitionById(ranges.count, "p")
    ordered = dealt.sortWithinPartitions("p", "halo", F.desc("doc_id"), F.desc("tie"), F.desc("text"))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(walk, schema)


def _tops(rows: DataFrame, ranges: Ranges) -> dict[int, tuple[int, int]]:
    """The largest key of each range that has rows: one a range."""

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[int, int]] = {}
        for batch in batches:
            ids, ties = batch.column("doc_id").to_numpy(), batch.column("tie").to_numpy()
            part = ranges.place(ids, ties)
            order = np.lexsort((ties, ids, part))
            last = order[np.flatnonzero(np.r_[part[order][1:] != part[order][:-1], True])] if len(order) else order
            for p, i, t in zip(part[last].tolist(), ids[last].tolist(), ties[last].tolist()):
                best[p] = max(best.get(p, (LEAST, LEAST)), (i, t))
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int32()), pa.array([x[0] for x in best.values()], pa.int64()), pa.array([x[1] for x in best.values()], pa.int64())], names=["p", "i", "t"])

    found = rows.select("doc_id", "tie").mapInArrow(tops, "p int, i long, t long").groupBy("p").agg(F.max(F.struct("i", "t")).alias("top"))
    return {r["p"]: (r["top"]["i"], r["top"]["t"]) for r in found.collect()}


def _pair(out: list[list], doc_id: int, data: bytes, following: bytes, a: np.ndarray, after: np.ndarray, known: dict[bytes, int], k: int, words: int) -> None:
    """Adds a document's row, given the text that follows it and both sketches."""
    text = data.decode("utf-8", "surrogatepass")
    n = len(text)
    new = (text[: n - n // 2] + following[: 4 * (n // 2)].decode("utf-8", "ignore")[: n // 2]).encode("utf-8", "surrogatepass")
    b = sketch(shingle_hashes(new, words, known), k)
    for column, value in zip(out, (None if doc_id == LEAST else doc_id, n, hashlib.sha256(new).hexdigest(), to_text(a), to_text(b), resemblance(a, b, k), resemblance(a, after, k))):
        column.append(value)


def _batch(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)
