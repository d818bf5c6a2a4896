"""Linear-output work on groups of rows that share a key, and connected components.

A *bucket* is the rows of one key.  Rows are dealt out by ranges of (key, id) and sorted, so that a bucket of any size is
spread over as many tasks as it fills, and a task walks over the buckets that lie within its range in numpy.  Buckets above
``cap`` rows, and those at the ends of a range, are handed on and split into blocks, each pair of blocks being a task of its
own, so no bucket has to fit in one task and none is cut short.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tilescan.llm.common import cut, ship

SHORT = 48
PAIRS = 1 << 16
SMALL = 1_000_000
Work = Callable[[pa.Table, np.ndarray, np.ndarray, bool], pa.Table]


def _spread(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The ranges [start, end) after one another."""
    n = ends - starts
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)


def index_pairs(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of positions i < j within the runs [start, end), at most about PAIRS at a time."""
    small = ends - starts <= SHORT
    at, last = _spread(starts[small], ends[small]), np.repeat(ends[small], (ends - starts)[small])
    for d in range(1, SHORT):
        ok = at + d < last
        at, last = at[ok], last[ok]
        if not len(at):
            break
        for k in range(0, len(at), PAIRS):
            yield at[k : k + PAIRS], at[k : k + PAIRS] + d
    side = 256
    for a, b in zip(starts[~small], ends[~small], strict=True):
        for i in range(a, b, side):
            for j in range(i, b, side):
                x, y = (v.ravel() for v in np.meshgrid(np.arange(i, min(i + side, b)), np.arange(j, min(j + side, b)), indexing="ij"))
                up = x < y
                yield x[up], y[up]


def merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the classes of i and j in place; each label is the smallest position of its class."""
    while len(i):
        a, b = labels[i], labels[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while ((up := labels[labels]) != labels).any():
            labels[:] = up


def _edges(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])


def by_bucket(df: DataFrame, work: Work, out: T.StructType, cap: int = 4096, block: int = 2048) -> DataFrame:
    """Applies ``work`` to the buckets of ``df``, whose columns ``key`` (long, not null) names the bucket and ``id`` (long) tells rows apart.

    ``work(rows, starts, ends, cross)`` gets whole buckets as runs of ``rows`` and returns rows of ``out``; with ``cross``
    the rows have a column ``side``, and pairs of one side belong to another task.  Buckets of one row are skipped.
    """
    ship(df.sparkSession)
    names = df.columns
    both = T.StructType([*(T.StructField(f.name, f.dataType) for f in out.fields), *(T.StructField(f"in_{f.name}", f.dataType) for f in df.schema.fields)])
    shape, n_out = to_arrow_schema(both), len(out.fields)

    def result(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = rows.column("key").to_numpy()
        edge = _edges(keys)
        several = np.diff(edge) > 1
        if several.any():
            found = work(rows, edge[:-1][several], edge[1:][several], False)
            yield from pa.table([*found.columns, *(pa.nulls(found.num_rows, f.type) for f in list(shape)[n_out:])], schema=shape).to_batches()

    def handed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from pa.table([*(pa.nulls(rows.num_rows, f.type) for f in list(shape)[:n_out]), *rows.columns], schema=shape).to_batches()

    def limited(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        edge = _edges(rows.column("key").to_numpy())
        at = 0
        for k in np.flatnonzero(np.diff(edge) > cap):
            if edge[k] > at:
                yield from result(rows.slice(at, edge[k] - at).combine_chunks())
            yield from handed(rows.slice(edge[k], edge[k + 1] - edge[k]))
            at = edge[k + 1]
        if at < rows.num_rows:
            yield from result(rows.slice(at).combine_chunks())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n_held, hot, begun = 0, None, False
        for batch in batches:
            if batch.num_rows and not begun:
                hot, begun = batch.column("key")[0].as_py(), True  # the first bucket may have begun in another task
            if batch.num_rows and hot is not None:
                upto = int(np.searchsorted(batch.column("key").to_numpy(), hot, "right"))
                if upto:
                    yield from handed(pa.Table.from_batches([batch.slice(0, upto)]))
                batch = batch.slice(upto)
            if not batch.num_rows:
                continue
            hot = None
            held.append(batch)
            n_held += batch.num_rows
            if n_held < 4 * cap:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            keys = rows.column("key").to_numpy()
            last = int(np.searchsorted(keys, keys[-1], "left"))
            if last:
                yield from limited(rows.slice(0, last).combine_chunks())
            rows = rows.slice(last)
            held, n_held = [], 0
            if rows.num_rows > cap:
                hot = keys[-1]
                yield from handed(rows)
            else:
                held, n_held = rows.combine_chunks().to_batches(), rows.num_rows
        if held:
            rows = pa.Table.from_batches(held).combine_chunks()
            keys = rows.column("key").to_numpy()
            last = int(np.searchsorted(keys, keys[-1], "left"))
            if last:
                yield from limited(rows.slice(0, last).combine_chunks())
            yield from handed(rows.slice(last))  # the last one may go on in another task

    first = cut(df.repartitionByRange("key", "id").sortWithinPartitions("key", "id").mapInArrow(walk, both))
    rest = first.where(F.col("in_key").isNotNull()).select(*(F.col(f"in_{n}").alias(n) for n in names))
    return first.where(F.col("in_key").isNull()).select(*out.names).unionByName(_in_blocks(rest, work, out, block))


def _in_blocks(df: DataFrame, work: Work, out: T.StructType, block: int) -> DataFrame:
    """``work`` on large buckets: each row goes to one of n blocks by its id, and to the n tasks that pair this block with each other."""
    n = cut(df.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / block).alias("n_blocks")))
    own = F.pmod(F.xxhash64("id"), F.col("n_blocks"))
    dealt = (
        df.join(small(n), "key")
        .withColumn("side", own.cast("long"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
        .withColumn("bucket", F.col("key"))
        .withColumn("key", F.xxhash64("key", F.least("side", "other"), F.greatest("side", "other")))
        .drop("n_blocks")
    )
    shape = to_arrow_schema(out)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            within = (pa.compute.equal(rows.column("side"), rows.column("other"))).to_numpy()
            spans = np.array([0]), np.array([rows.num_rows])
            if rows.num_rows > 1:
                yield from work(rows, *spans, not within.all()).cast(shape).to_batches()

        for batch in batches:
            at = _edges(batch.column("key").to_numpy()) if batch.num_rows else []
            for a, b in zip(at[:-1], at[1:], strict=True):
                if held and held[0].column("key")[0] != batch.column("key")[int(a)]:
                    yield from done()
                    held = []
                held.append(batch.slice(int(a), int(b - a)))
        if held:
            yield from done()

    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(walk, out)


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """``df`` (a written table of few columns) with a broadcast hint if it has at most ``rows`` rows; beyond, joins shuffle and
    split what is skewed."""
    return F.broadcast(df) if df.count() <= rows else df


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id of ``edges`` (a, b: long): the smallest id it can reach.

    Alternates star operations, each of which points ids at smaller ones, until nothing changes; each round is written
    to the shared folder.  The middle of a star is one key: up to ``SMALL`` edges the least neighbours are broadcast, beyond
    they are written, as joins of plain tables have their skewed sides split.  No edge or label reaches the driver, only a
    count and a sum of hashes.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        sign = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == seen or not sign[0]:
            break
        seen = sign
        around = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        at_hand = F.broadcast if sign[0] <= SMALL else cut
        least = at_hand(around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = large if sign[0] <= SMALL else cut(large)
        least = at_hand(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = cut(small.select("e.a", "e.b").where("a <> b").distinct())
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
