"""Toxicity by weak supervision.

1. Lexicon: of a bounded sample of labelled training rows, the words and word beginnings that are far more frequent in
   toxic documents (log odds).  Counting is a distributed aggregate; at most ``max_terms`` terms reach the driver.
2. Voters: each strong term, counts and densities of hits, and patterns (shouting, exclamation) vote toxic or abstain or, if
   nothing is found, vote clean.
3. Label model: a generative model with a class and, given it, votes; EM estimates the class's share and each voter's
   accuracy from the votes alone (the labels only give the starting point).  Voters whose votes remain correlated given the
   class are grouped, and a group of m voters with mean correlation r counts as m / (1 + r (m - 1)) voters.
4. A linear classifier (logistic regression) is trained on the posterior labels and scores every document.

Only rows of ``labels`` whose crc32 of the doc_id as text, modulo 3, is not 1 teach anything; ``lang``, ``source`` and
``doc_id`` are no inputs.  The sample is the ``max_train`` rows (a documented bound, 8,000) with the smallest hash of the
doc_id; all texts are read and scored whole.

Defined results: a null text is an empty one and gets the score of a text without any feature; without training rows of
both classes every score is 0.0; a null doc_id is not held out and teaches nothing; rows that share a doc_id keep their rows;
other columns are ignored; an empty table gives an empty result; training rows of equal text and label teach once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilescan.llm.common import cut, ship, texts

WORD = re.compile(r"[^\W\d_]+")
BEGIN = (4, 5, 6, 7)
MARK = "^"  # before the beginnings of words, among terms
N_EXTRA = 10


def held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))


def terms_of(word: str) -> list[str]:
    return [word, *(MARK + word[:n] for n in BEGIN if len(word) > n)]


@dataclass
class Model:
    """Terms with their log odds, the classifier's weights, and what the label model found."""

    terms: list[str] = field(default_factory=list)
    odds: list[float] = field(default_factory=list)
    weights: np.ndarray | None = None
    bias: float = 0.0
    accuracies: np.ndarray | None = None
    correlations: np.ndarray | None = None

    def __post_init__(self) -> None:
        self.at = {t: k for k, t in enumerate(self.terms)}
        self.begins = {t[1:5] for t in self.terms if t[0] == MARK}

    def features(self, counts: dict[str, int], shout: float = 0.0, exclaim: float = 0.0) -> np.ndarray:
        """Of a document's word counts: each term (0 to 1), then counts and densities of hits, then patterns."""
        out = np.zeros(len(self.terms) + N_EXTRA)
        at, begins, hits, strong = self.at, self.begins, 0, 0.0
        total = 0
        for word, n in counts.items():
            total += n
            best = -1.0
            k = at.get(word)
            if k is not None:
                out[k] += n
                best = self.odds[k]
            if word[:4] in begins:
                for size in BEGIN:
                    if len(word) > size and (k := at.get(MARK + word[:size])) is not None:
                        out[k] += n
                        best = max(best, self.odds[k])
            if best >= 0:  # a word that a text repeats counts twice at most
                hits += min(n, 2)
                strong += min(n, 2) * min(best, 6.0)
        out[: len(self.terms)] = np.minimum(out[: len(self.terms)], 3) / 3
        density = hits / total if total else 0.0
        out[len(self.terms) :] = (hits >= 1, hits >= 2, hits >= 3, hits >= 5, min(1.0, 40 * density), min(1.0, 10 * density), min(1.0, strong / 20), min(1.0, 12 * strong / max(total, 1)), shout, exclaim)
        return out

    def score(self, text: str) -> float:
        if self.weights is None:
            return 0.0
        counts, shout, exclaim = word_counts(text)
        x = float(self.features(counts, shout, exclaim) @ self.weights) + self.bias
        return 1.0 / (1.0 + float(np.exp(-max(-500.0, min(500.0, x)))))


def word_counts(text: str) -> tuple[dict[str, int], float, float]:
    """Words in lower case with their counts; whether the text shouts; whether it exclaims."""
    lowered = text.lower()
    counts = Counter(WORD.findall(lowered))
    n = sum(counts.values())
    return counts, float(n > 0 and text.upper() == text), float(n > 0 and 10 * text.count("!") > n)


def votes_of(x: np.ndarray, odds: np.ndarray, max_voters: int | None = 60) -> np.ndarray:
    """Votes (1 toxic, 0 clean, -1 none) of the voters, from feature rows."""
    n = len(odds)
    best = np.argsort(-odds, kind="stable")[:max_voters]
    term = np.where(x[:, best] > 0, 1, -1)
    h = x[:, n:]
    counts = np.stack([np.where(h[:, 0] == 0, 0, np.where(h[:, k] > 0, 1, -1)) for k in (1, 2, 3)], 1)
    dense = np.stack([np.where(h[:, 4] >= 0.3, 1, np.where(h[:, 4] < 0.05, 0, -1)), np.where(h[:, 7] >= 0.5, 1, np.where(h[:, 7] < 0.1, 0, -1)), np.where(h[:, 6] >= 0.5, 1, np.where(h[:, 6] < 0.15, 0, -1))], 1)
    pattern = np.stack([np.where((h[:, 8] > 0) & (h[:, 0] > 0), 1, -1), np.where((h[:, 9] > 0) & (h[:, 0] > 0), 1, -1)], 1)
    return np.concatenate([term, counts, dense, pattern], 1)


def label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the toxic class, P(vote toxic / clean / none | class) of each voter, residual correlations."""
    onehot = np.stack([votes == 1, votes == 0, votes == -1]).astype(float)  # 3, documents, voters
    post = start.astype(float)
    for _ in range(rounds):
        share = np.clip(post.mean(), 1e-3, 0.5)
        rate = np.stack([np.einsum("vdj,d->vj", onehot, 1 - post), np.einsum("vdj,d->vj", onehot, post)]) + 0.5
        rate /= rate.sum(1, keepdims=True)  # class, vote, voter
        # correlations of the votes, given the class
        signed = (votes == 1).astype(float) - (votes == 0)
        mean = (rate[:, 0] - rate[:, 1])[:, None, :]
        spread = sum(w[:, None] * (signed - m) for w, m in ((1 - post, mean[0]), (post, mean[1])))
        scale = np.sqrt((spread**2).mean(0)) + 1e-9
        corr = (spread.T @ spread) / len(votes) / np.outer(scale, scale)
        np.fill_diagonal(corr, 0)
        tied = corr > 0.25
        group = np.arange(len(corr))
        for i in range(len(corr)):  # connected voters form a group
            for j in np.flatnonzero(tied[i]):
                if group[i] != group[j]:
                    group[group == max(group[i], group[j])] = min(group[i], group[j])
        weight = np.ones(len(corr))
        for g in np.unique(group):
            at = np.flatnonzero(group == g)
            if len(at) > 1:
                inside = corr[np.ix_(at, at)].sum() / (len(at) * (len(at) - 1))
                weight[at] = 1 / (1 + max(0.0, inside) * (len(at) - 1))
        llr = np.log(rate[1]) - np.log(rate[0])
        x = np.log(share / (1 - share)) + np.einsum("vdj,vj,j->d", onehot, llr, weight)
        post = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    return post, rate, corr


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, rounds: int = 30) -> tuple[np.ndarray, float]:
    """L2-penalised logistic regression on soft labels, by Newton steps."""
    z = np.c_[x, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    ridge = np.full(z.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, max_train: int = 8000, max_terms: int | None = 400, max_voters: int | None = 60) -> Model:
    """The model from the labelled training rows of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    ``max_terms`` bounds the lexicon and ``max_voters`` the terms that vote by themselves (all of them count as hits); None
    takes every term that passes the tests of frequency and odds.
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [word_counts(x) for x in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), batch.column("copy"), pa.array([list(r[0]) for r in rows], pa.list_(pa.string())), pa.array([list(r[0].values()) for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.float64())],
                names=["doc_id", "toxic", "copy", "words", "counts", "shout", "exclaim"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # equal texts of one label teach once; unlike ones are never taken for copies
    picked = rows.join(F.broadcast(sample), "doc_id").withColumn("copy", F.sha2("text", 256)).groupBy("toxic", "copy").agg(F.min_by(F.struct("doc_id", "text"), "doc_id").alias("r")).select("r.doc_id", "toxic", "copy", "r.text")
    counted = cut(picked.mapInArrow(count, "doc_id long, toxic int, copy string, words array<string>, counts array<int>, shout double, exclaim double"))
    size = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    n, t = size["n"], size["t"] or 0
    if not t or t == n:
        return Model()
    begin = [F.when(F.length("word") > k, F.concat(F.lit(MARK), F.substring("word", 1, k))) for k in BEGIN]
    word = counted.select("doc_id", "toxic", F.explode("words").alias("word")).where("length(word) >= 3")
    term = word.select("doc_id", "toxic", "word", F.explode(F.array("word", *begin)).alias("term")).where("term is not null")
    term = term.groupBy("term", "doc_id", "toxic").agg(F.min("word").alias("word"))
    odds = (
        term.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"), F.countDistinct(F.when(F.col("toxic") == 1, F.col("word"))).alias("n_words"))
        .where(f"substring(term, 1, 1) <> '{MARK}' or n_words >= 4")  # a beginning stands for several words
        .where(f"a >= {max(4, t // 60)}")
        .withColumn("odds", F.log((F.col("a") + 0.5) / (t + 1.0)) - F.log((F.col("b") + 0.5) / (n - t + 1.0)))
        .where("odds >= 2")
        .orderBy(F.desc(F.col("odds") * F.sqrt("a")), "term")
    )
    # what is frequent in a bounded sample is bounded, with and without the limit
    odds = (odds if max_terms is None else odds.limit(max_terms)).collect()
    if not odds:
        return Model()
    model = Model([r["term"] for r in odds], [float(r["odds"]) for r in odds])

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("words", "counts", "shout", "exclaim")]
            rows = [model.features(dict(zip(w, c)), s, e).astype(np.float32).tobytes() for w, c, s, e in zip(*columns)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(rows, pa.binary())], names=["doc_id", "toxic", "x"])

    rows = counted.mapInArrow(vector, "doc_id long, toxic int, x binary").orderBy("doc_id", "x").collect()  # max_train rows and their repeats
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows]).astype(float)
    truth = np.array([r["toxic"] for r in rows], float)
    start = np.where(truth == 1, 0.9, 0.1)
    post, rate, model.correlations = label_model(votes_of(x, np.array(model.odds), max_voters), start)
    model.accuracies = rate
    model.weights, model.bias = logistic(x, post)
    return model


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, model: Model | None = None, keep: bool = False, **bounds: int | None) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of ``docs``; with ``keep`` all its columns and, as the
    last one, the prediction."""
    spark = docs.sparkSession
    ship(spark)
    weights = spark.sparkContext.broadcast(model or fit(docs, labels, **bounds))

    def score(text: pa.Array) -> pa.Array:
        own = weights.value
        return pa.array([own.score(x or "") for x in text.to_pylist()], pa.float64())

    if keep:
        taken = {c.lower() for c in docs.columns}
        mark = next(f"predicted_{k}" for k in range(len(taken) + 1) if f"predicted_{k}" not in taken)  # a name that ``docs`` does not have

        def walk_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = score(batch.column("text").cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([int(x >= threshold) for x in found.to_pylist()], pa.int32())], names=[*batch.schema.names, mark])

        return docs.mapInArrow(walk_all, T.StructType([*docs.schema.fields, T.StructField(mark, T.IntegerType())]))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), score(batch.column("text"))], names=["doc_id", "score"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(walk, "doc_id long, score double").select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``."""
    rows = scored(docs, labels, threshold, keep=True)
    return rows.where(F.col(rows.columns[-1]) == 0).drop(rows.columns[-1])
