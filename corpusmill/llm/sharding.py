"""Contiguous shards of nearly equal bytes, cut on a global prefix sum.

The rows' sizes are sorted by id into ranges and stored once. A sum for each range gives
its base; a running sum inside the range gives each row its place among all bytes, and
the shard follows from that place alone. Only ids, sizes and checksums are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import column, numbered, thin_rows
from corpusmill.session import materialize

OVERHEAD = 16
SHARDS = 40


def byte_shards(
    df: DataFrame,
    n_shards: int = SHARDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    overhead: int = OVERHEAD,
    row_column: str | None = None,
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, row`` for every row of ``df``.

    Rows are laid out by id (null first), then checksum and size, as one stretch of bytes; the shard of a row
    is the equal target that holds its middle, so shards are contiguous and differ from
    the mean by less than one row. A null or empty text has ``overhead`` bytes and the
    checksum 0. Repeated rows are separate rows. A text larger than a whole target leaves
    some shards empty. An empty table gives no rows. ``law`` is always ``bytes``.
    """
    text = F.coalesce(column(text_column), F.lit("")).cast("binary")
    # Stored first, so that the sampling of range bounds stays off the texts.
    sizes = thin_rows(
        df,
        row_column,
        "sizes",
        id=column(id_column),
        size=(F.octet_length(text) + F.lit(overhead)).cast("bigint"),
        crc=F.crc32(text).cast("bigint"),
    )
    ranged = materialize(
        sizes.repartitionByRange("id", "crc", "size", "row").withColumn("part", F.spark_partition_id()),
        "ranges",
    )
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    # One row for each shuffle partition: small enough for one task and for a broadcast.
    bases = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(whole).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy("id", "crc", "size", "row").rowsBetween(
        Window.unboundedPreceding, -1
    )
    upto = Window.partitionBy("part").orderBy("id", "crc", "size", "row")
    placed = ranged.select(
        "*",
        F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("local"),
        (F.row_number().over(upto) - 1).alias("nth"),
    ).join(F.broadcast(bases), "part")
    # Decimals, since bytes times shards may leave 64 bits.
    shard = F.expr(
        "cast(cast(2 * (bytes_before + local) + size as decimal(20, 0)) * {n} "
        "div cast(2 * total as decimal(20, 0)) as int)".format(n=int(n_shards))
    )
    sharded = materialize(
        placed.select(
            "id", "size", "crc", "row",
            F.least(shard, F.lit(n_shards - 1)).alias("shard"),
            (F.col("rows_before") + F.col("nth")).alias("place"),
        ),
        "placed",
    )
    firsts = sharded.groupBy("shard").agg(F.min("place").alias("first"))
    return sharded.join(F.broadcast(firsts), "shard").select(  # one row for each shard
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row",
    )


def write_shards(
    df: DataFrame, path: str, n_shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Write the rows of ``df`` as Parquet, a folder ``_shard=N`` for each shard, by slot.

    Every shard is a contiguous range of ids, so it is written by tasks that each hold
    one shard's rows; the shard count bounds what a task gets.
    """
    stored = numbered(df, "_row", "shard-input")
    places = byte_shards(stored, n_shards, id_column, text_column, row_column="_row").select(
        F.col("row").alias("_row"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot")
    )
    ordered = stored.join(places, "_row").drop("_row").repartition(n_shards, "_shard")
    ordered.sortWithinPartitions("_shard", "_slot").drop("_slot").write.partitionBy("_shard").parquet(path)
