"""Cleaning, length filtering, truncation and the document funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.functions.binding import computed_once


def clean_text(df: DataFrame, column: str = "text") -> DataFrame:
    return computed_once(df, column, tx.cleaned(F.col(column)))


def drop_short(df: DataFrame, min_length: int = 50, column: str = "text") -> DataFrame:
    """Keep rows whose (already cleaned) text has at least ``min_length`` code points."""
    return df.filter(F.length(column) >= min_length)


def truncate(df: DataFrame, max_length: int | None = None, column: str = "text") -> DataFrame:
    """Cut longer texts; ``None`` or 0 leaves them whole. The cut text is not trimmed again."""
    if not max_length:
        return df
    return df.withColumn(column, F.substring(F.col(column), 1, max_length))


def prepare(
    df: DataFrame, min_length: int = 50, max_length: int | None = None, column: str = "text"
) -> DataFrame:
    """Clean, filter on the cleaned length, then truncate."""
    return truncate(drop_short(clean_text(df, column), min_length, column), max_length, column)


def funnel(
    df: DataFrame, min_length: int = 50, train_fraction: float = 0.9, column: str = "text"
) -> DataFrame:
    """Document counts from input to splits in one pass.

    The split is exact, so its sizes follow from the number of kept documents.
    """
    kept = F.count_if(F.length(tx.cleaned(F.col(column))) >= min_length)
    train = F.floor(F.col("processed_documents") * F.lit(float(train_fraction)))
    return (
        df.agg(F.count("*").alias("total_documents"), kept.alias("processed_documents"))
        .withColumn("train_documents", train.cast("bigint"))
        .withColumn("val_documents", F.col("processed_documents") - F.col("train_documents"))
    )
