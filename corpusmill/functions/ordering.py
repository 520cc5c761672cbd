"""Seeded order of rows and exact global positions without a global sort.

Rows are ordered by the md5 of ``seed:id``. The leading hex digits of that key cut
the order into at most 65,536 consecutive buckets of nearly equal size, whatever
the data looks like, so a running total needs only a sort inside each bucket plus
a prefix sum over one small row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 4


def seeded_key(ident: Column, seed: int) -> Column:
    """Position of a row in the seeded shuffle; pass a column that identifies it."""
    return F.md5(F.concat(F.lit(f"{seed}:"), ident.cast("string")).cast("binary"))


def bucket_of(key: Column) -> Column:
    return F.substring(key, 1, BUCKET_DIGITS)


def running_offsets(
    df: DataFrame, amount: str, key: str, ident: str, within: list[str], offset: str
) -> DataFrame:
    """Exclusive running sum of ``amount`` in key order, separately per ``within``.

    ``within`` must name columns with few distinct values (such as the split).
    """
    bucketed = df.withColumn("_bucket", bucket_of(F.col(key)))
    totals = bucketed.groupBy(*within, "_bucket").agg(F.sum(amount).alias("_total"))
    earlier = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # At most 65,536 rows per split: safe to broadcast whatever the corpus size.
    bases = totals.select(
        *within, "_bucket", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base")
    )
    local = Window.partitionBy(*within, "_bucket").orderBy(key, ident).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        bucketed.withColumn("_local", F.coalesce(F.sum(amount).over(local), F.lit(0)))
        .join(F.broadcast(bases), [*within, "_bucket"])
        .withColumn(offset, (F.col("_base") + F.col("_local")).cast("bigint"))
        .drop("_bucket", "_base", "_local")
    )


def key_at_rank(df: DataFrame, key: str, ident: str, fraction: float) -> DataFrame:
    """One row holding the ``(key, ident)`` of the row ranked ``floor(n * fraction)``.

    Empty when that rank is zero. Only the rows of a single bucket are sorted.
    """
    keyed = df.select(F.col(key).alias("key"), F.col(ident).alias("ident")).withColumn(
        "bucket", bucket_of(F.col("key"))
    )
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("size"))
    # One row per bucket (65,536 at most), hence the window without partitions.
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    boundary = (
        sizes.select(
            "bucket",
            (F.sum("size").over(upto) - F.col("size")).alias("before"),
            "size",
            F.floor(F.sum("size").over(whole) * F.lit(float(fraction))).alias("wanted"),
        )
        .filter((F.col("before") < F.col("wanted")) & (F.col("wanted") <= F.col("before") + F.col("size")))
        .select("bucket", (F.col("wanted") - F.col("before")).alias("rank"))
    )
    ranked = keyed.join(F.broadcast(boundary), "bucket").withColumn(
        "position", F.row_number().over(Window.partitionBy("bucket").orderBy("key", "ident"))
    )
    return ranked.filter("position = rank").select(F.struct("key", "ident").alias("cut"))
