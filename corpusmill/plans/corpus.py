"""Documents to training data: the headline plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators import clean, splits, tokens
from corpusmill.session import materialize


def _tokenizer(kept: DataFrame, vocab_size: int = 65_535) -> tokens.Tokenizer:
    return tokens.word_tokenizer(tokens.word_vocab(kept, max_size=vocab_size, cleaned=True), cleaned=True)


def corpus_token_stats(
    documents: DataFrame, min_length: int = 50, max_length: int | None = None,
    train_fraction: float = 0.9, seed: int = 42,
) -> DataFrame:
    """How many training tokens a corpus gives: clean, filter, tokenize, split, count.

    Counting happens before the split, so that only an id and a number per document
    are left when the cut between the splits is searched.
    """
    kept = materialize(clean.prepare(documents, min_length, max_length).select("doc_id", "text"), "cleaned")
    counted = tokens.count_tokens(kept, _tokenizer(kept)).select("doc_id", "n_tokens")
    counted = materialize(counted, "token-counts")
    return tokens.token_stats(splits.train_val_split(counted, "doc_id", train_fraction, seed))


def processing_stats(
    documents: DataFrame, min_length: int = 50, train_fraction: float = 0.9, seed: int = 42
) -> DataFrame:
    """One row: the document funnel, the token statistics of both splits and the vocabulary size."""
    cleaned = materialize(clean.clean_text(documents.select("doc_id", "text")), "cleaned")
    kept = clean.drop_short(cleaned, min_length)
    tokenizer = _tokenizer(kept)
    counted = materialize(tokens.count_tokens(kept, tokenizer).select("doc_id", "n_tokens"), "token-counts")
    stats = tokens.token_stats(splits.train_val_split(counted, "doc_id", train_fraction, seed))
    fields = F.struct(*[c for c in stats.columns if c != "split"])
    per_split = stats.agg(
        *[F.any_value(F.when(F.col("split") == s, fields), True).alias(s) for s in ("train", "val")]
    )
    both = per_split.select(F.struct("train", "val").alias("splits")).scalar()
    counts = cleaned.agg(
        F.count("*").alias("total_documents"),
        F.count_if(F.length("text") >= min_length).alias("processed_documents"),
    )
    count_of = lambda s: F.coalesce(F.col(f"splits.{s}.num_documents"), F.lit(0))
    return counts.withColumn("splits", both).select(
        "total_documents", "processed_documents",
        count_of("train").alias("train_documents"), count_of("val").alias("val_documents"), "splits.*",
        F.lit(tokenizer.vocab_size).cast("bigint").alias("vocab_size"),
    )


def tokenized_corpus(
    documents: DataFrame, vocab_size: int = 65_535, min_length: int = 50,
    train_fraction: float = 0.9, seed: int = 42,
) -> tuple[DataFrame, tokens.Tokenizer]:
    """Token ids per document with its split; stored once for all later uses."""
    kept = materialize(clean.prepare(documents, min_length).select("doc_id", "text"), "cleaned")
    tokenizer = _tokenizer(kept, vocab_size)
    encoded = tokens.tokenize(kept, tokenizer).drop("text")
    labelled = splits.train_val_split(encoded, "doc_id", train_fraction, seed)
    return materialize(labelled, "tokenized"), tokenizer
