"""Token counts of sections by offset-mapped attribution.

A document is encoded once and whole; each token has a character span (from the character that holds its first byte to
the one that holds its last).  Sections are spans too: lines with the line feed that ends them, or the fields of a record
(columns, joined by a separator that belongs to the field before it).  Both run in text
order, so the interval join is a binary search of token spans among section bounds.  A token over a bound is allocated by
rule:

* ``majority`` (default): to the section that has most of its characters, of equal ones the earliest;
* ``first``: to the section of its first character;
* ``split``: to each section by its share of the token's characters, so that sums stay whole.

Defined results: a null text is an empty one and has no sections; a final line feed ends the last section and starts no
other; every row is kept, with repeated or null doc_ids; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescan.llm.common import ship, texts
from tilescan.llm.op4_bpe import Encoder, default_vocabulary, encoder_of

RULES = ("majority", "first", "split")


def line_bounds(text: str) -> np.ndarray:
    """First character of each line, and the length of the text at the end."""
    starts, at = [0] if text else [], text.find("\n")
    while at >= 0:
        if at + 1 < len(text):
            starts.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array([*starts, len(text)], np.int64)


def token_spans(encoder: Encoder, ids: list[int], text: str) -> tuple[np.ndarray, np.ndarray]:
    """First character, and the one after the last, of each token."""
    ends = np.cumsum(np.fromiter(map(encoder.vocabulary.length.__getitem__, ids), np.int64, len(ids)))
    starts = np.r_[0, ends[:-1]] if len(ids) else ends
    if text.isascii():
        return starts, ends
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    char_of = np.cumsum((data & 0xC0) != 0x80) - 1
    return char_of[starts], char_of[ends - 1] + 1


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str = "majority") -> tuple[np.ndarray, int]:
    """Tokens of each section [bounds[k], bounds[k + 1]), and how many tokens cross a bound."""
    n = len(bounds) - 1
    if n <= 0 or not len(starts):
        return np.zeros(max(n, 0)), 0
    a = np.searchsorted(bounds, starts, "right") - 1
    b = np.searchsorted(bounds, ends - 1, "right") - 1
    inside = a == b
    counts = np.bincount(a[inside], minlength=n).astype(float)
    for s, e, i, j in zip(starts[~inside], ends[~inside], a[~inside], b[~inside]):
        shares = np.minimum(bounds[i + 1 : j + 2], e) - np.maximum(bounds[i : j + 1], s)
        if rule == "split":
            counts[i : j + 1] += shares / (e - s)
        else:
            counts[i if rule == "first" else i + int(shares.argmax())] += 1
    return counts, int((~inside).sum())


def section_tokens(docs: DataFrame, path: str | None = None, pattern: str | None = None, rule: str = "majority") -> DataFrame:
    """doc_id, n_tokens, n_sections, n_crossing, largest_section (tokens), section_tokens (array<double>) of each row of ``docs`` (doc_id, text)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    spark = docs.sparkSession
    ship(spark)
    if path is None or pattern is None:
        path, pattern = path or default_vocabulary()[0], pattern or default_vocabulary()[1]
    with open(path, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(data.value, pattern)
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                rows = []
                all_texts = texts(batch)
                for text, ids in zip(all_texts, encoder.encode_all(all_texts)):
                    counts, crossing = attribute(*token_spans(encoder, ids, text), line_bounds(text), rule)
                    rows.append((len(ids), len(counts), crossing, float(counts.max()) if len(counts) else 0.0, counts))
                n, sections, crossing, largest, counts = zip(*rows) if rows else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sections, pa.int64()), pa.array(crossing, pa.int64()), pa.array(largest, pa.float64()), pa.array(list(counts), pa.list_(pa.float64()))],
                    names=["doc_id", "n_tokens", "n_sections", "n_crossing", "largest_section", "section_tokens"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        walk, "doc_id long, n_tokens long, n_sections long, n_crossing long, largest_section double, section_tokens array<double>"
    )


def field_tokens(docs: DataFrame, fields: list[str], separator: str = "\n", path: str | None = None, pattern: str | None = None, rule: str = "majority") -> DataFrame:
    """doc_id, n_tokens, n_crossing and ``tokens`` (field to tokens) of each row of ``docs``: its ``fields`` joined by
    ``separator`` and encoded once; a null field is an empty one and may have none."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    spark = docs.sparkSession
    ship(spark)
    if path is None or pattern is None:
        path, pattern = path or default_vocabulary()[0], pattern or default_vocabulary()[1]
    with open(path, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(data.value, pattern)
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                parts = list(zip(*(texts(batch, f"field_{i}") for i in range(len(fields)))))
                joined = [separator.join(p) for p in parts]
                rows = []
                for part, text, ids in zip(parts, joined, encoder.encode_all(joined)):
                    lengths = [len(x) + len(separator) for x in part]
                    lengths[-1] -= len(separator)
                    counts, crossing = attribute(*token_spans(encoder, ids, text), np.r_[0, np.cumsum(lengths)], rule)
                    rows.append((len(ids), crossing, list(zip(fields, counts.tolist()))))
                n, crossing, counts = zip(*rows) if rows else ((),) * 3
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(crossing, pa.int64()), pa.array(list(counts), pa.map_(pa.string(), pa.float64()))], names=["doc_id", "n_tokens", "n_crossing", "tokens"])

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(f"field_{i}") for i, c in enumerate(fields)))
    return named.mapInArrow(walk, "doc_id long, n_tokens long, n_crossing long, tokens map<string,double>")
