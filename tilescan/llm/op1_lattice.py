"""Embedding near-duplicates by E8 lattice hashing.

Every table projects the unit vectors to ``blocks`` times 8 dimensions and decodes each block to its nearest point of the
lattice E8; the points together name a cell.  A vector is kept in its home cell, and probes the cells in which some of
its blocks take the second nearest point instead.  Two vectors meet if one's home is among the other's cells in any
table; each meeting is verified by the cosine in double precision, so no link is below the threshold, and recall is
measured against brute force in the tests (0.95 and more for pairs at the threshold itself).

1. Equal vectors become one class with a count; the classes are written with a number each.
2. What is dealt to cells is the class's number and a sketch (64 signs of projections), not the vector.  Classes that meet
   with sketches ``reach`` or fewer signs apart are candidates (a pair at the threshold differs in 6.5 on average, and in
   more than 20 once in 10^6 pairs); a cell gives a forest of its candidates, never the pairs.
3. Each connected group of candidates gets its vectors once, and all its pairs are verified there.  Of a group above ``cap``
   vectors go to their cells instead, where a pair counts in the first cell in which it meets only (lowest table, then
   smallest cell code), which both vectors' codes tell without looking elsewhere.  What leaves a bucket is one row a vector:
   its count, and its root in a forest of the verified links.

Codes come from sums of whole numbers below 2^53, which are exact in any order, so that every task finds the same ones.
Vectors are scaled by a power of two before their norm is taken, so that no finite one overflows or vanishes.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing: no links,
their own component, kept.  Vectors of different lengths do not link.  Rows that repeat a vec_id with equal vectors are
counted as so many vectors; a null vec_id links like any other but names no component unless alone (then null, and kept is
false).  Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilescan.llm.common import cut, ship
from tilescan.llm.grouping import by_bucket, components, index_pairs, merge, small

COORD = 1 << 24
PROJ = 1 << 16


class Lattice:
    """The hash tables' projections, and the cells of vectors."""

    def __init__(self, dim: int, tables: int = 8, blocks: int = 2, scale: float = 0.6, seed: int = 7):
        rng = np.random.default_rng([seed, dim])
        self.tables, self.blocks = tables, blocks
        self.matrix = np.rint(rng.normal(size=(dim, tables * blocks * 8)) * scale * PROJ)
        self.signs = np.rint(rng.normal(size=(dim, 64)) * PROJ)
        self.mix = rng.integers(-(1 << 62), 1 << 62, size=(tables, blocks, 8), dtype=np.int64) | 1
        self.salt = rng.integers(-(1 << 62), 1 << 62, size=tables, dtype=np.int64)

    @staticmethod
    def _checkerboard(x: np.ndarray) -> np.ndarray:
        """The nearest integer points with an even sum."""
        near = np.rint(x)
        off = x - near
        worst = np.abs(off).argmax(-1)[..., None]
        step = np.where(np.take_along_axis(off, worst, -1) >= 0, 1.0, -1.0)
        odd = (near.sum(-1, keepdims=True) % 2) != 0
        flipped = near.copy()
        np.put_along_axis(flipped, worst, np.take_along_axis(near, worst, -1) + step, -1)
        return np.where(odd, flipped, near)

    @classmethod
    def decode(cls, x: np.ndarray) -> np.ndarray:
        """Nearest point of E8 (integers, or halves, with an even sum), in halves."""
        whole, half = cls._checkerboard(x), cls._checkerboard(x - 0.5) + 0.5
        nearer = ((x - whole) ** 2).sum(-1, keepdims=True) <= ((x - half) ** 2).sum(-1, keepdims=True)
        return np.rint(2 * np.where(nearer, whole, half)).astype(np.int64)

    @classmethod
    def second(cls, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The nearest neighbouring point across the face that x is closest to: the minimal vector most along x - first."""
        off = x - first / 2
        # minimal vectors: two coordinates of size 1, or all of size 1/2 with an even number of minus signs
        size, sign = np.abs(off), np.where(off >= 0, 1, -1)
        two = np.argsort(-size, axis=-1, kind="stable")[..., :2]
        along2 = np.take_along_axis(size, two, -1).sum(-1)
        v2 = np.zeros_like(first)
        np.put_along_axis(v2, two, 2 * np.take_along_axis(sign, two, -1), -1)
        odd = ((sign < 0).sum(-1) % 2 != 0)[..., None]
        least = size.argmin(-1)[..., None]
        s = sign.copy()
        np.put_along_axis(s, least, np.where(odd, -1, 1) * np.take_along_axis(sign, least, -1), -1)
        along8 = (s * off).sum(-1) / 2
        return first + np.where((along2 >= along8)[..., None], v2, s)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """(n, tables, 2 ** blocks) codes of unit vectors x; the first of each table is the home cell."""
        n = len(x)
        y = (np.rint(x * COORD) @ self.matrix) / (float(COORD) * PROJ)
        y = y.reshape(n, self.tables, self.blocks, 8)
        first = self.decode(y)
        points = np.stack([first, self.second(y, first)])
        with np.errstate(over="ignore"):
            parts = (points * self.mix).sum(-1)  # (2, n, tables, blocks)
            parts ^= (parts >> 29) & 0x7FFFFFFFF
            out = np.empty((n, self.tables, 1 << self.blocks), np.int64)
            for k in range(1 << self.blocks):
                code = np.broadcast_to(self.salt, (n, self.tables)).copy()
                for b in range(self.blocks):
                    code = (code ^ parts[k >> b & 1, :, :, b]) * np.int64(-7046029254386353131)
                    code ^= (code >> 32) & 0xFFFFFFFF
                out[:, :, k] = code
        return out


    def sketch(self, x: np.ndarray) -> np.ndarray:
        """The signs of 64 projections of each of the unit vectors x, as one number."""
        return np.packbits(np.rint(x * COORD) @ self.signs >= 0, axis=1, bitorder="little").view("<i8").ravel()


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of norm 1 of finite rows that are not zero."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])
    return x / np.sqrt((x * x).sum(1))[:, None]


def unpacked(packed: list[bytes], kind: str) -> np.ndarray:
    """The vectors as rows; shorter ones end in zeros."""
    size = np.dtype(kind).itemsize
    width = max(map(len, packed)) // size
    if all(len(v) == width * size for v in packed):
        return np.frombuffer(b"".join(packed), kind).reshape(-1, width).astype(np.float64)
    out = np.zeros((len(packed), width))
    for row, v in zip(out, packed):
        row[: len(v) // size] = np.frombuffer(v, kind)
    return out


def by_length(packed: list[bytes], kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, unit vectors) of each length, some hundreds at a time."""
    lengths = np.array([len(v) for v in packed])
    for n in np.unique(lengths):
        every = np.flatnonzero(lengths == n)
        for k in range(0, len(every), 500):
            at = every[k : k + 500]
            yield at, unit(unpacked([packed[i] for i in at], kind))


def near_duplicates(vecs: DataFrame, threshold: float = 0.95, tables: int = 8, blocks: int = 2, scale: float = 0.6, seed: int = 7, reach: int = 20, cap: int = 4096) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of ``vecs`` (vec_id, embedding)."""
    ship(vecs.sparkSession)
    of = vecs.schema["embedding"].dataType
    name = "float" if isinstance(of, T.ArrayType) and isinstance(of.elementType, T.FloatType) else "double"
    kind = "<f4" if name == "float" else "<f8"
    grids: dict[int, Lattice] = {}
    per = 1 << blocks  # cells of a table

    def grid(dim: int) -> Lattice:
        if dim not in grids:
            grids[dim] = Lattice(dim, tables, blocks, scale, seed)
        return grids[dim]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            numbers = column.values.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            edges, there = column.offsets.to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
            found, high, low = [], [], []
            for a, b, known in zip(edges[:-1].tolist(), edges[1:].tolist(), there.tolist()):
                x = numbers[a:b]
                if not (known and np.isfinite(x).all() and x.any()):
                    found.append(None)
                    high.append(None)
                    low.append(None)
                    continue
                found.append((x + x.dtype.type(0)).astype(kind).tobytes())  # a negative zero is a zero
                digest = np.frombuffer(xxhash.xxh3_128_digest(found[-1]), ">i8")
                high.append(int(digest[0]))
                low.append(int(digest[1]))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(found, pa.binary()), pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=["vec_id", "v", "h1", "h2"])

    packed = vecs.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{name}>").alias("embedding")).mapInArrow(pack, "vec_id long, v binary, h1 long, h2 long")
    classes = packed.where("v is not null").groupBy("v", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    named = cut(classes.withColumn("id", F.monotonically_increasing_id()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = np.arange(tables * per) % per == 0
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for at, x in by_length(batch.column("v").to_pylist(), kind):
                lattice = grid(x.shape[1])
                marked = ids[at][:, None] * 2 + home
                sketch = np.repeat(lattice.sketch(x), tables * per)
                yield pa.RecordBatch.from_arrays([pa.array(lattice.cells(x).ravel()), pa.array(marked.ravel()), pa.array(sketch)], names=["key", "id", "sketch"])

    def candidates(rows: pa.Table, starts: np.ndarray, ends: np.ndarray, cross: bool) -> pa.Table:
        marked, sketch = rows.column("id").to_numpy(), rows.column("sketch").to_numpy()
        ids, home = marked >> 1, (marked & 1).astype(bool)
        side = rows.column("side").to_numpy() if cross else None
        labels = np.arange(len(ids))
        for i, j in index_pairs(starts, ends):
            ok = (home[i] | home[j]) & (np.bitwise_count((sketch[i] ^ sketch[j]).view(np.uint64)) <= reach)
            if cross:
                ok &= side[i] != side[j]
            merge(labels, i[ok], j[ok])
        some = np.flatnonzero(ids != ids[labels])
        pairs = np.unique(np.stack([ids[some], ids[labels[some]]], 1), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    narrow = named.select("id", "v").mapInArrow(deal, "key long, id long, sketch long")
    groups = cut(components(by_bucket(narrow, candidates, T.StructType([T.StructField(c, T.LongType()) for c in "ab"]))))
    large = cut(groups.groupBy("component").count().where(F.col("count") > cap).select("component", F.lit(True).alias("large")))
    groups = groups.join(small(large), "component", "left")
    held = cut(named.select("id", "n", "v").join(groups, "id"))

    def deal_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = tables * per
        for batch in batches:
            vectors = batch.column("v").to_pylist()
            for at, x in by_length(vectors, kind):
                take = pa.array(np.repeat(at, m))
                yield pa.RecordBatch.from_arrays([pa.array(grid(x.shape[1]).cells(x).ravel()), batch.column("id").take(take), batch.column("n").take(take), pa.array(np.tile(np.arange(m), len(at)).astype(np.int32)), batch.column("v").take(take)], names=["key", "id", "n", "slot", "v"])

    whole = held.where("large is null").select(F.xxhash64("component").alias("key"), "id", "n", F.lit(-1).alias("slot"), "v")
    dealt = held.where("large").select("id", "n", "v").mapInArrow(deal_vectors, "key long, id long, n long, slot int, v binary")

    def verify(rows: pa.Table, starts: np.ndarray, ends: np.ndarray, cross: bool) -> pa.Table:
        ids, n, slot = (rows.column(c).to_numpy() for c in ("id", "n", "slot"))
        key = rows.column("bucket" if "bucket" in rows.column_names else "key").to_numpy()  # the cell: blocks have a key of their own
        side = rows.column("side").to_numpy() if cross else None
        vectors = rows.column("v").to_pylist()
        length = np.array([len(v) for v in vectors])
        x = unit(unpacked(vectors, kind))
        in_table, home = slot // per, slot % per == 0  # of groups -1 and false
        codes: np.ndarray | None = None
        labels, found = np.arange(len(ids)), np.zeros(len(ids), np.int64)
        for i, j in index_pairs(starts, ends):
            ok = np.where(slot[i] < 0, slot[j] < 0, (slot[j] >= 0) & (home[i] | home[j])) & (ids[i] != ids[j]) & (length[i] == length[j])
            if cross:
                ok &= side[i] != side[j]
            i, j = i[ok], j[ok]
            ok = np.einsum("ij,ij->i", x[i], x[j]) >= threshold
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            merge(labels, i, j)
            first = np.ones(len(i), bool)
            cells = np.flatnonzero(slot[i] >= 0)
            if len(cells):
                if codes is None:
                    codes, coded = np.zeros((len(ids), tables, per), np.int64), np.zeros(len(ids), bool)
                new = np.unique(np.r_[i[cells], j[cells]])
                new = new[~coded[new]]
                for size in np.unique(length[new]):
                    at, width = new[length[new] == size], size // np.dtype(kind).itemsize
                    codes[at] = grid(width).cells(x[at, :width])
                coded[new] = True
            for t in range(tables):
                at = cells[first[cells] & (in_table[i[cells]] >= t)]
                if not len(at):
                    break
                a, b = codes[i[at], t], codes[j[at], t]
                met_a, met_b = (b == a[:, :1]).any(1), (a == b[:, :1]).any(1)  # in the home of i, of j
                least = np.minimum(np.where(met_a, a[:, 0], np.iinfo(np.int64).max), np.where(met_b, b[:, 0], np.iinfo(np.int64).max))
                here = in_table[i[at]] == t
                first[at] = np.where(here, least == key[i[at]], ~(met_a | met_b))
            np.add.at(found, i[first], n[j[first]])
            np.add.at(found, j[first], n[i[first]])
        some = np.flatnonzero((labels != np.arange(len(ids))) | (found > 0))
        return pa.table({"id": ids[some], "root": ids[labels[some]], "links": found[some]}, schema=pa.schema([("id", pa.int64()), ("root", pa.int64()), ("links", pa.int64())]))

    # what a task holds at once is some 32 MB of vectors
    wide = named.agg(F.max(F.octet_length("v"))).first()[0] or 1
    fit = max(64, min(4096, (1 << 25) // (wide * 8 // np.dtype(kind).itemsize)))
    met = cut(by_bucket(whole.unionByName(dealt), verify, T.StructType([T.StructField(c, T.LongType()) for c in ("id", "root", "links")]), cap=fit, block=max(32, fit // 2)))
    counts = met.groupBy("id").agg(F.sum("links").alias("links"))
    found = components(met.select(F.col("id").alias("a"), F.col("root").alias("b")))
    linked = named.drop("v").join(counts, "id", "left").join(found, "id", "left").withColumn("root", F.coalesce("component", "id"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    rooted = cut(linked.join(least, "root").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"))
    keyed = packed.select("vec_id", "h1", "h2")
    good = keyed.where("h1 is not null").join(rooted, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = keyed.where("h1 is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
