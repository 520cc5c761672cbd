"""Packing token lists into one continuous stream per split, and sampling from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.binding import whole_part
from corpusmill.functions.ordering import running_offsets

# About 24 MB of window positions.
_BROADCAST_ROWS = 1_000_000


def stream_offsets(tokenized: DataFrame, ident: str = "doc_id") -> DataFrame:
    """Add ``global_offset``: where a document's tokens start in its split's stream."""
    return running_offsets(
        tokenized, "n_tokens", "split_key", ident, within=["split"], offset="global_offset"
    )


def _in_order(position: str, piece: str) -> Column:
    """Concatenate the collected pieces of one group by position."""
    ordered = F.array_sort(F.collect_list(F.struct(position, piece)))
    return F.flatten(F.transform(ordered, lambda p: p[piece]))


def pack_blocks(tokenized: DataFrame, block_size: int, ident: str = "doc_id") -> DataFrame:
    """``(split, block_id, tokens)``: the streams cut into blocks of ``block_size``.

    Nothing is put between documents. A document becomes one slice per block it touches.
    A slice that is a whole block is one as it stands; only the others, at most two for each
    document, are shuffled to meet, in groups that never hold more than one block of tokens.
    """
    if block_size <= 0:
        raise ValueError(f"block_size must be positive, got {block_size}")
    size = F.lit(block_size).cast("bigint")
    start, count = F.col("global_offset"), F.col("n_tokens")

    def piece(block: Column) -> Column:
        left = F.greatest(block * size, start)
        right = F.least((block + 1) * size, start + count)
        return F.struct(
            block.alias("block_id"),
            left.alias("position"),
            F.slice("tokens", (left - start + 1).cast("int"), (right - left).cast("int")).alias("piece"),
        )

    # Blocks that begin in the document, and those that end in it, are whole where they do both.
    begun, ended = whole_part(start + block_size - 1, block_size), whole_part(start + count, block_size)
    inside = F.when(begun < ended, F.sequence(begun, ended - 1))
    first, last = whole_part(start, block_size), whole_part(start + count - 1, block_size)
    ends = F.filter(F.array_distinct(F.array(first, last)), lambda b: (b < begun) | (b >= ended))
    placed = stream_offsets(tokenized.filter("n_tokens > 0"), ident)
    pieces = lambda touched: placed.select("split", F.inline(F.transform(touched, piece)))
    whole = pieces(inside).select("split", "block_id", F.col("piece").alias("tokens"))
    rest = pieces(ends).groupBy("split", "block_id")
    return whole.unionByName(rest.agg(_in_order("position", "piece").alias("tokens")))


def sample_windows(
    blocks: DataFrame,
    block_size: int,
    context: int,
    n_windows: int,
    split: str = "train",
    seed: int = 42,
) -> DataFrame:
    """Random training windows ``x`` and the same windows shifted by one, ``y``.

    ``blocks`` must come from :func:`pack_blocks` with the same ``block_size``. All blocks
    but the last are full, so the length of the stream takes the block numbers alone and
    the tokens of the last block.
    """
    stream = blocks.filter(F.col("split") == split)
    last_block = stream.agg(F.max("block_id").alias("last")).scalar()
    length = stream.filter(F.col("block_id") == last_block).select(
        (F.col("block_id") * block_size + F.size("tokens")).alias("n")
    ).agg(F.max("n").alias("n")).scalar()
    number = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id")).cast("binary")), 1, 12), 16, 10)
    too_short = F.raise_error(F.lit(f"split {split} has no window of {context} tokens"))
    starts = (
        blocks.sparkSession.range(n_windows)
        .withColumn("stream_length", length)
        .select(
            F.col("id").alias("window_id"),
            F.when(
                F.col("stream_length") > context,
                F.pmod(number.cast("bigint"), F.col("stream_length") - context),
            )
            .otherwise(too_short.cast("bigint"))
            .alias("start"),
        )
    )
    first, last = whole_part(F.col("start"), block_size), whole_part(F.col("start") + context, block_size)
    wanted = starts.withColumn("block_id", F.explode(F.sequence(first, last)))
    if n_windows * (context // block_size + 2) <= _BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    parts = wanted.join(stream, "block_id")
    skip = (F.pmod("start", F.lit(block_size)) + 1).cast("int")
    return (
        parts.groupBy("window_id", "start")
        .agg(_in_order("block_id", "tokens").alias("run"))
        .select(
            F.lit(split).alias("split"),
            "window_id",
            "start",
            F.slice("run", skip, F.lit(context)).alias("x"),
            F.slice("run", skip + 1, F.lit(context)).alias("y"),
        )
    )
