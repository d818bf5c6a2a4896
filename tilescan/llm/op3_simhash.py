"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits: a bit is 1 if more than half the XXH64 values (seed 42) of the document's word shingles have
it.  Fingerprints link at ``distance`` or fewer differing bits.  Cut into m = distance // 2 + 1 segments, two linked
fingerprints have a segment in which at most one bit differs (otherwise they differed in 2 m > distance bits).  Each
segment is indexed once for each of its bits, with that bit replaced by a wildcard; linked fingerprints share one of
these variants at least, so equality on variants finds every link, and counting the bits that differ verifies it.

Only distinct fingerprints are compared, and a bucket of a variant yields a forest of its verified links instead of all
its pairs, which leaves the components as they are.

Defined results: a null text is an empty one; a text without words has fingerprint zero and is linked like any other;
fewer words than a shingle make one shingle; rows that share a doc_id each keep their row; a null doc_id takes part in
links but cannot name a component (a component of nulls only has a null id); other columns of the input are ignored by
``near_duplicates``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilescan.llm.common import as_bytes, cut, ship
from tilescan.llm.grouping import by_bucket, components, index_pairs, merge

BITS = 64
CHUNK = 1 << 15
ROW = "tilescan_row"
BANDS, DEPTH = 10, 3
_rng = np.random.default_rng(3)
MIX = _rng.integers(0, 1 << 63, BANDS * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)
SALT = _rng.integers(0, 1 << 63, BANDS * DEPTH, np.uint64)


def shingles(text: bytes, words: int = 4, seed: int = 42) -> np.ndarray:
    """The hashes of the word shingles of one UTF-8 text, in order and with repeats."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, "<u8")
    h64 = xxhash.xxh64_intdigest
    if len(parts) <= words:
        hashes = [h64(b" ".join(parts), seed)]
    else:
        joined = b" ".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1]
        hashes = [h64(joined[a:b], seed) for a, b in zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist())]
    return np.array(hashes, dtype="<u8")


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """The fingerprint of one UTF-8 text as a signed 64-bit integer."""
    return majority(shingles(text, words, seed))


def majority(hashes: np.ndarray) -> int:
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), CHUNK):
        part = hashes[k : k + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, words: int = 4, text: str = "text", to: str = "fp") -> DataFrame:
    """``doc_id`` and the fingerprint (long) of each row of ``docs``."""
    ship(docs.sparkSession)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(x, words) for x in as_bytes(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fps], names=["doc_id", to])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(walk, f"doc_id long, {to} long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the segments one of which differs in one bit at most."""
    m = distance // 2 + 1
    cuts = [BITS * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """A forest (a, b: long) with the components of the links among the distinct values of the column ``fp``."""
    variants = []
    for a, n in segments(distance):
        for bit in range(a, a + n):
            kept = ((1 << n) - 1 << a) & ~(1 << bit)
            kept = kept - (1 << 64) if kept >= 1 << 63 else kept
            variants.append(F.xxhash64(F.lit(bit), F.col("fp").bitwiseAND(F.lit(kept).cast("long"))))
    keyed = fps.select("fp").distinct().select(F.explode(F.array(*variants)).alias("key"), F.col("fp").alias("id"))

    def work(rows: pa.Table, starts: np.ndarray, ends: np.ndarray, cross: bool) -> pa.Table:
        fp = rows.column("id").to_numpy()
        side = rows.column("side").to_numpy() if cross else None
        labels = np.arange(len(fp))
        for i, j in index_pairs(starts, ends):
            ok = np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64)) <= distance
            if cross:
                ok &= side[i] != side[j]
            merge(labels, i[ok], j[ok])
        child = np.flatnonzero(labels != np.arange(len(fp)))
        pairs = np.unique(np.stack([fp[child], fp[labels[child]]], 1), axis=0) if len(child) else np.zeros((0, 2), np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return by_bucket(keyed, work, T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


def near_duplicates(docs: DataFrame, distance: int = 4, words: int = 4) -> DataFrame:
    """doc_id, fp (long) and component_id of each row of ``docs`` (doc_id, text)."""
    rows = cut(with_fingerprint(docs, words))
    classes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(classes, distance))
    rooted = classes.join(found.withColumnRenamed("id", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, distance: int = 4, words: int = 4, similarity: float = 0.8) -> DataFrame:
    """One row of each component: that with the smallest doc_id (nulls last), then text hash, then place in ``docs``.

    Rows link at ``distance`` or fewer bits, and where the Jaccard similarity of their sets of shingles is ``similarity`` or
    more.  Candidates of the latter agree in one of BANDS bands of DEPTH min-hashes, and each is verified on the whole sets;
    at similarity s a pair is a candidate with probability 1 - (1 - s ** DEPTH) ** BANDS (0.9992 at 0.8).

    Each row is judged by its own text: rows that share a doc_id, or have none, are documents of their own.
    """
    numbered, rows = _numbered(docs, words)
    found = components(links(rows, distance).unionByName(similar(numbered, rows, words, similarity)))
    return _survivors(docs, numbered, rows, found)


def bands(hashes: np.ndarray) -> list[int]:
    """The keys of the min-hash bands of a set of shingles; none of an empty set."""
    if not len(hashes):
        return []
    least = np.full(BANDS * DEPTH, np.iinfo(np.uint64).max)
    for k in range(0, len(hashes), 1 << 12):
        mixed = (hashes[None, k : k + (1 << 12)] ^ SALT[:, None]) * MIX[:, None]
        mixed ^= mixed >> np.uint64(32)
        least = np.minimum(least, (mixed * MIX[:, None]).min(1))
    return [xxhash.xxh64_intdigest(part.tobytes(), b) - (1 << 63) for b, part in enumerate(least.reshape(BANDS, DEPTH))]


def resemble(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the Jaccard similarity of two sorted sets is ``similarity`` or more."""
    a, b = (a, b) if len(a) < len(b) else (b, a)
    at = np.searchsorted(b, a)
    common = np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a)
    return bool(common >= similarity * (len(a) + len(b) - common) - 1e-9)


def similar(numbered: DataFrame, rows: DataFrame, words: int, similarity: float) -> DataFrame:
    """A forest (a, b: fingerprints) of the links by similarity; sets travel with those rows only that share a band."""
    sets = cut(rows.groupBy("id").agg(F.min("fp").alias("fp"), F.min(F.struct("row", "bands")).alias("first")).select("id", "fp", "first.row", "first.bands"))
    keyed = sets.select("id", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").count().where("count > 1").select("key")
    met = cut(keyed.join(shared, "key", "left_semi"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([np.unique(shingles(x, words)).tobytes() for x in as_bytes(batch)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("fp"), found], names=["id", "fp", "set"])

    some = sets.select("id", "fp", "row").join(met.select("id").distinct(), "id", "left_semi")
    text = numbered.select(F.col(ROW).alias("row"), F.col("text").cast("string").alias("text"))
    whole = cut(text.join(some, "row").select("id", "fp", "text").mapInArrow(walk, "id long, fp long, set binary"))

    def work(rows: pa.Table, starts: np.ndarray, ends: np.ndarray, cross: bool) -> pa.Table:
        fp = rows.column("fp").to_numpy()
        found = [np.frombuffer(x, "<u8") for x in rows.column("set").to_pylist()]
        size = np.array([len(x) for x in found])
        side = rows.column("side").to_numpy() if cross else None
        labels = np.arange(len(fp))
        for i, j in index_pairs(starts, ends):
            ok = np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j]) - 1e-9
            if cross:
                ok &= side[i] != side[j]
            i, j = i[ok], j[ok]
            for k in range(0, len(i), 512):
                a, b = i[k : k + 512], j[k : k + 512]
                apart = labels[a] != labels[b]
                a, b = a[apart], b[apart]
                ok = np.array([resemble(found[x], found[y], similarity) for x, y in zip(a.tolist(), b.tolist())], bool)
                merge(labels, a[ok], b[ok])
        child = np.flatnonzero(fp != fp[labels])
        pairs = np.unique(np.stack([fp[child], fp[labels[child]]], 1), axis=0) if len(child) else np.zeros((0, 2), np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    near = by_bucket(met.join(whole, "id"), work, T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]), cap=1024, block=1024)
    # equal sets whose shingles repeat differently have several fingerprints
    equal = rows.select("id", F.col("fp").alias("a")).distinct().join(sets.select("id", F.col("fp").alias("b")), "id").where("a <> b").select("a", "b")
    return near.unionByName(equal)


def _numbered(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """``docs`` written with a number of each row, and row, doc_id, own (hash of the text), fp, id (hash of the set of shingles) and bands of each."""
    ship(docs.sparkSession)
    numbered = cut(docs.withColumn(ROW, F.monotonically_increasing_id()))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = as_bytes(batch)
            own = np.array([xxhash.xxh64_intdigest(x) for x in found], np.uint64).view(np.int64)
            fps, ids, keys = [], [], []
            for x in found:
                hashes = shingles(x, words)
                fps.append(majority(hashes))
                hashes = np.unique(hashes)
                ids.append(xxhash.xxh64_intdigest(hashes.tobytes()))
                keys.append(bands(hashes))
            columns = [batch.column("row"), batch.column("doc_id"), pa.array(own), pa.array(fps, pa.int64()), pa.array(np.array(ids, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "own", "fp", "id", "bands"])

    plain = numbered.select(F.col(ROW).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return numbered, cut(plain.mapInArrow(walk, "row long, doc_id long, own long, fp long, id long, bands array<long>"))


def _survivors(docs: DataFrame, numbered: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    rooted = rows.join(found.withColumnRenamed("id", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own", "row")).alias("least")
    kept = rooted.groupBy("root").agg(least).select(F.col("least.row").alias(ROW))
    return numbered.join(kept, ROW, "left_semi").select(*(numbered[c] for c in docs.columns))


def hex_fingerprint(fp: F.Column) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


