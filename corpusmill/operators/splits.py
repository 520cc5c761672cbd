"""Exact, reproducible train/validation split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.ordering import key_at_rank, seeded_key


def train_val_split(
    df: DataFrame, ident: str = "doc_id", train_fraction: float = 0.9, seed: int = 42
) -> DataFrame:
    """Add ``split_key`` and ``split``; the first ``floor(n * fraction)`` keys train.

    ``ident`` must identify the rows; copies of a text are rows of their own.
    Finding the cut takes a small aggregation and a sort of one key bucket. The cut
    then reaches the labelling projection as a scalar subquery, so the documents
    themselves are never shuffled.
    """
    if not 0 < train_fraction < 1:
        raise ValueError(f"train_fraction must be between 0 and 1, got {train_fraction}")
    keyed = df.withColumn("split_key", seeded_key(F.col(ident), seed))
    cut = key_at_rank(keyed, "split_key", ident, train_fraction).scalar()
    position = F.struct(F.col("split_key").alias("key"), F.col(ident).alias("ident"))
    return keyed.withColumn("split", F.when(position <= cut, "train").otherwise("val"))
