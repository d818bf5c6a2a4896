"""The registered queries of this package: each operator over its whole table, with the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilescan.llm import op1_lattice, op2_html, op3_simhash, op4_bpe, op5_mixing, op6_toxicity, op7_token_counts, op8_license, op9_token_files, op10_sketch
from tilescan.llm.common import table


def op1_lattice_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_html.main_text(table(spark, sf_dir, "pages"))


def op3_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op3_simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", op3_simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_bpe.encode_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = op5_mixing.mixed(table(spark, sf_dir, "documents"), fraction=1.0, max_epochs=2)
    return mixed.select("doc_id", "domain", "lang", "source", "n_words", "n_copies", F.round("budget", 3).alias("leaf_budget"))


def op6_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_token_counts.section_tokens(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_license.licenses(table(spark, sf_dir, "documents"))


def op9_token_binaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_token_files.written_and_read(table(spark, sf_dir, "documents"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_sketch.edited(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_lattice_near_dup, op2_html_extraction, op3_simhash_near_dup, op4_byte_bpe, op5_source_mixing, op6_toxicity_scores, op7_token_attribution, op8_license_scan, op9_token_binaries, op10_document_fingerprints)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op1_lattice_near_dup": OP1_SQL}


# every pair of vectors, and labels that spread along the links until they settle
OP1_SQL = """
with recursive v as (
  select vec_id, embedding::double[] as e, sqrt(list_dot_product(embedding::double[], embedding::double[])) as n from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95
), reach(a, b) as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a
)
select vec_id, coalesce(k.n, 0)::bigint as n_links, least(vec_id, coalesce(c.m, vec_id)) as component_id,
       vec_id <= coalesce(c.m, vec_id) as kept
from embeddings left join (select a, count(*) as n from links group by a) k on k.a = vec_id
left join (select a, min(b) as m from reach group by a) c on c.a = vec_id
"""
