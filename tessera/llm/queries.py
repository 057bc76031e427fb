"""The queries opN_<name> of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table
from tessera.llm.fingerprint import fingerprints
from tessera.llm.html import extract_pages
from tessera.llm.language import language_query
from tessera.llm.licenses import oracle as license_sql
from tessera.llm.licenses import scan
from tessera.llm.neardup import near_duplicate_query
from tessera.llm.packing import pack
from tessera.llm.pieces import encode_digests
from tessera.llm.sharding import shard
from tessera.llm.topk import top_k
from tessera.llm.toxicity import toxicity_query


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


OP1_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), p as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 20 = 0
), r as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from p
)
select query_id, rank, vec_id, score from r where rank <= 20
"""


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=1024)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_query(table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), shards=16)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_query(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_language": op4_language,
    "op5_licenses": op5_licenses,
    "op6_sharding": op6_sharding,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_html": op8_html,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_fingerprints": op10_fingerprints,
}

ORACLES: dict[str, str] = {"op1_topk": OP1_SQL, "op5_licenses": license_sql()}
