"""Documents to token files: the stages of the training-data pipeline, in order.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows the stage before kept and
returns the columns of ``documents``; the last returns what the token files hold of each
document. ``run`` writes the result of each stage as Parquet and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import decontamination, jaccard, language, mixing, queries, token_files
from corpusmill.session import materialize, scratch_path, ship_package


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no letters, or words that fit none of the languages."""
    ship_package(spark)
    return language.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each group linked by word shingles."""
    ship_package(spark)
    return jaccard.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    ship_package(spark)
    return decontamination.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many words as there are, at the target weights of domains, languages and sources.

    A document used in several epochs is there several times.
    """
    levels = [F.expr(queries.DOMAIN), F.col("lang"), F.col("source")]
    return mixing.mixed(docs, levels, queries.WEIGHTS, budget=1.0).drop("epoch")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what they hold of each."""
    ship_package(spark)
    path = scratch_path(spark, "corpus-tokens")
    encode = token_files.byte_level_encoder(queries.vocabulary(), encode_special_tokens=False)
    token_files.write_token_files(docs, path, encode)
    return token_files.read_token_files(spark, path, tokens=False)


STAGES = [
    ("language", identify_language),
    ("near copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("mixture", mix_sources),
    ("tokens", write_tokens),
]
# The language model and the components reached by links are beyond SQL that runs on
# whole tables; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
