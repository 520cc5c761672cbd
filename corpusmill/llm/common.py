"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import materialize

# Fixed value: the characters that separate words in every contract of this subpackage.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def column(name: str) -> Column:
    """The column of that exact name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def picked(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the names the operators use; others can't clash."""
    return df.select(*[column(source).alias(target) for target, source in names.items()])


def numbered(df: DataFrame, name: str, label: str) -> DataFrame:
    """``df`` stored, with a column that tells all its rows apart, equal rows too.

    The numbers depend on how the input was cut into tasks, so they are only used once
    they are stored: a repeated task then can't give other numbers.
    """
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), label)


def thin_rows(df: DataFrame, row_column: str | None, label: str, **values: Column) -> DataFrame:
    """The named values of each row with its ``row`` number (that of ``row_column`` if given), stored."""
    number = F.monotonically_increasing_id() if row_column is None else column(row_column)
    return materialize(df.select(number.alias("row"), *[v.alias(k) for k, v in values.items()]), label)


# Keys of two 64-bit numbers: some tens of megabytes when broadcast.
BROADCAST_KEYS = 1_000_000


def narrowed(df: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` with (``left_semi``) or without (``left_anti``) a row of equal key in ``keys``.

    ``keys`` holds stored numeric key columns only. Their number is counted up to a bound:
    below it they are broadcast and ``df`` stays where it is, else both sides are shuffled.
    """
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return df.join(F.broadcast(keys) if few else keys, keys.columns, how)


def rank_within(
    df: DataFrame, group: list[str], order: list[str], coarse: Column, name: str
) -> DataFrame:
    """Gapless position from 0 of each row in its group, without one task per group.

    ``coarse`` must not fall as ``order`` rises; rows are sorted only inside equal
    ``(group, coarse)``, and one row for each of these carries the count before it.
    Null group values form a group.
    """
    cut = df.withColumn("_coarse", coarse)
    sizes = cut.groupBy(*group, "_coarse").agg(F.count("*").alias("_rows"))
    before = (
        Window.partitionBy(*group).orderBy("_coarse").rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = sizes.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_coarse").alias("_at"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"),
    )
    inside = Window.partitionBy(*group, "_coarse").orderBy(*order)
    ranked = cut.withColumn("_local", F.row_number().over(inside) - 1)
    match = F.col("_coarse").eqNullSafe(F.col("_at"))
    for i, g in enumerate(group):
        match = match & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (
        ranked.join(bases, match)
        .withColumn(name, (F.col("_base") + F.col("_local")).cast("bigint"))
        .drop("_coarse", "_local", "_rows", "_at", "_base", *[f"_g{i}" for i in range(len(group))])
    )
