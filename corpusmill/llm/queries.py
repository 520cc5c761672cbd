"""One named query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import (
    decontamination,
    exact_dedup,
    jaccard,
    language,
    mixing,
    quotes,
    resampling,
    scoring,
    sharding,
    substrings,
    token_files,
    toxicity,
    tries,
)
from corpusmill.session import scratch_path, ship_package


VOCABULARY = "byte_bpe_50k.json"


# Four domains of five sources each, and what they shall have of the mixture. Sources
# without a number (of 64 bits) are a domain of their own, null.
DOMAIN = "concat('d', cast(try_cast(regexp_extract(source, '[0-9]+', 0) as bigint) div 5 as string))"
WEIGHTS = [
    {"d0": 0.4, "d1": 0.3, "d2": 0.2, "d3": 0.1},
    {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2},
    {},
]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(ship_package(spark), sf_dir, "documents")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.duplicate_groups(_documents(spark, sf_dir)).drop("row")


def op2_quote_links(spark, sf_dir):
    return quotes.reply_ordered(quotes.as_mail(_table(spark, sf_dir, "conversations")))


def op3_word_languages(spark, sf_dir):
    return language.predict_languages(_documents(spark, sf_dir))


def op4_byte_shards(spark, sf_dir):
    return sharding.byte_shards(_documents(spark, sf_dir)).drop("row")


def op5_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    encode = token_files.byte_level_encoder(vocabulary(), encode_special_tokens=False)
    token_files.write_token_files(_documents(spark, sf_dir), path, encode)
    return token_files.read_token_files(spark, path, tokens=False)


def op6_benchmark_containment(spark, sf_dir):
    return decontamination.contained_items(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op7_filter_scores(spark, sf_dir):
    return scoring.score_texts(_documents(spark, sf_dir))


def op8_jaccard_links(spark, sf_dir):
    return jaccard.link_groups(_documents(spark, sf_dir)).drop("text_key")


def op9_weighted_mixture(spark, sf_dir):
    docs = _documents(spark, sf_dir).withColumn("domain", F.expr(DOMAIN))
    levels = [F.col("domain"), F.col("lang"), F.col("source")]
    taken = mixing.mixed(docs, levels, WEIGHTS, budget=0.5)
    words = mixing.word_count(F.col("text"))
    return taken.select("doc_id", "domain", "lang", "source", words.alias("n_words"), "epoch")


def op10_repeated_passages(spark, sf_dir):
    return substrings.repeated_spans(_documents(spark, sf_dir)).drop("spans", "text_key")


def op11_kernel_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark, sf_dir):
    turns = tries.ordered_turns(_table(spark, sf_dir, "conversations"))
    return tries.with_end_digests(tries.prefix_trie(*tries.with_borrowed_heads(turns)))


def op13_importance_resampling(spark, sf_dir):
    return resampling.resample(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def all_queries():
    return {name: f for name, f in globals().items() if name.startswith("op")}
