"""A training corpus in four stages: drop toxic documents, keep one of each group of near-duplicates, mix sources to target
weights, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
``run`` writes every stage's rows as Parquet to the shared folder and reads them again for the next.

Defined results, of every stage: a null text is an empty one; a null doc_id, lang or source is a value like any other; rows are
judged by their own text, and repeated rows are rows (of which the second stage leaves one); other columns, of any name, go
through the first three stages unchanged; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tilescan.llm import op3_simhash, op4_bpe, op5_mixing, op6_toxicity
from tilescan.llm.common import cut, discard, made, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.7; without labels of both classes all of them."""
    return op6_toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group linked at 4 or fewer bits, or at a similarity of 0.8 or more.  Shingles of
    five words, which is what stages take; the four of operator 3's query are that query's contract."""
    return op3_simhash.one_of_each(docs, distance=4, words=5)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """By weights of domain, language and source, no document twice; as many tokens (here those between white space, as the next
    stage counts its own) as leave every language that has a weight its share."""
    return op5_mixing.selected(docs, fraction=None, max_epochs=1)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes that they decode to."""
    return op4_bpe.encode_documents(docs, with_ids=False)


STAGES = [("toxicity", toxicity), ("simhash_near_dedup", simhash_near_dedup), ("source_mixing", source_mixing), ("bpe_encoding", bpe_encoding)]

#: the toxicity model, components of near-duplicates and byte-pair encoding have no SQL; the tests hold the rows of the second to
#: fourth stage against brute-force versions, and the first against its labels
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), made()
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
        discard(spark, before)  # what this stage wrote on the way, and the rows of the one before
    return docs
