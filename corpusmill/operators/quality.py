"""Lexical quality of texts and summaries of generation records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx


def repetition_score(tokens: Column) -> Column:
    """Distinct words over words; higher means *less* repetition. Null without words."""
    return F.when(F.size(tokens) > 0, F.size(F.array_distinct(tokens)) / F.size(tokens))


def diversity_score(tokens: Column) -> Column:
    """Distinct adjacent word pairs over pairs; null below four words.

    Pairs are compared as ``"a b"`` strings, which hash; words hold no spaces.
    """
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    joined = F.zip_with(
        F.slice(tokens, F.lit(1), pairs), F.slice(tokens, F.lit(2), pairs),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.when(F.size(tokens) >= 4, F.size(F.array_distinct(joined)) / pairs)


def score_texts(df: DataFrame, column: str = "text") -> DataFrame:
    """Add ``repetition_score`` and ``diversity_score``."""
    return (
        df.withColumn("_words", tx.words(F.col(column)))
        .withColumn("repetition_score", repetition_score(F.col("_words")))
        .withColumn("diversity_score", diversity_score(F.col("_words")))
        .drop("_words")
    )


def coherence(scored: DataFrame, *by: str) -> DataFrame:
    """Average scores (0 where no text has one), optionally per group."""
    return scored.groupBy(*by).agg(
        F.coalesce(F.avg("repetition_score"), F.lit(0.0)).alias("avg_repetition_score"),
        F.coalesce(F.avg("diversity_score"), F.lit(0.0)).alias("avg_diversity_score"),
        F.count("repetition_score").alias("scored_texts"),
    )


def generation_summary(log: DataFrame) -> DataFrame:
    """Averages over records with ``generated_tokens`` and ``generation_time`` (seconds)."""
    return log.agg(
        F.avg("generation_time").alias("avg_generation_time"),
        F.avg(F.col("generated_tokens") / F.col("generation_time")).alias("avg_tokens_per_second"),
        F.avg("generated_tokens").alias("avg_generated_length"),
        F.count("*").alias("total_prompts"),
    )


def perplexity(losses: DataFrame) -> DataFrame:
    """Perplexity over ``(loss, n_tokens)`` rows, one per evaluated block."""
    return losses.agg(
        F.exp(F.avg("loss")).alias("perplexity"),
        F.avg("loss").alias("avg_loss"),
        F.count("*").alias("num_samples"),
        F.sum("n_tokens").alias("total_tokens"),
    )
