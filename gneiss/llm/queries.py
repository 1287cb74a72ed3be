"""One query per training-data operator, over its whole table with production parameters.

Modules are imported by the query that needs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gneiss.llm import oracles


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gneiss.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op2_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gneiss.llm.suffix import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gneiss.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gneiss.llm.warc import derive, responses_of

    return derive(responses_of(table(spark, sf_dir, "pages"))).withColumnRenamed("key", "page_id")


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gneiss.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gneiss.llm.ngram import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents")).drop("text_hash", "group_id")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gneiss.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gneiss.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gneiss.llm.html import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gneiss.llm.sharding import assign_shards

    return assign_shards(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_topk, op2_suffix, op3_packing, op4_warc, op5_neardup, op6_ngram, op7_toxicity, op8_mixing, op9_html, op10_sharding)}
ORACLE_SQL: dict[str, str] = {"op1_topk": oracles.OP1, "op2_suffix": oracles.OP2, "op5_neardup": oracles.OP5, "op6_ngram": oracles.OP6, "op9_html": oracles.OP9, "op10_sharding": oracles.OP10}
