"""Tokenizers, vocabularies and token statistics."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.functions.batches import OBJECT_BYTES, piecewise
from corpusmill.functions.binding import whole_part

# Token ids 0-255 are UTF-8 bytes; this one opens a word that is spelled in bytes.
SPELLED_ID = 256
FIRST_WORD_ID = 257
MAX_TOKEN_VALUE = {"uint8": 0xFF, "uint16": 0xFFFF, "uint32": 0xFFFFFFFF}
# Fixed value: the published word-splitting pattern of the gpt2 encoding.
GPT2_PATTERN = (
    r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
)


class Tokenizer(NamedTuple):
    """Encoding and decoding as column expressions, with the vocabulary size.

    ``count`` gives the number of tokens where that is cheaper than building them.
    """

    encode: Callable[[Column], Column]
    decode: Callable[[Column], Column]
    vocab_size: int
    count: Callable[[Column], Column] | None = None


def check_vocab_size(vocab_size: int, dtype: str = "uint16") -> None:
    if dtype not in MAX_TOKEN_VALUE:
        raise ValueError(f"unsupported token type {dtype}")
    if vocab_size > MAX_TOKEN_VALUE[dtype]:
        raise ValueError(
            f"vocabulary of {vocab_size} does not fit {dtype} (max {MAX_TOKEN_VALUE[dtype]})"
        )


def _splittable(text: Column, cleaned: bool) -> Column:
    """What the Arrow functions below take words from: a cleaned text itself, else a list of its words."""
    return text if cleaned else tx.words(text)


def _words_of(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all values, and for each value where its words begin and end."""
    texts = not pa.types.is_list(values.type)
    lists = pc.split_pattern(values, " ") if texts else values
    words = lists.flatten()
    bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
    if texts:
        there = pc.greater(pc.binary_length(words), 0)
        kept = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
        words, bounds = words.filter(there), kept[bounds]
    return words, bounds


def word_vocab(
    df: DataFrame, column: str = "text", max_size: int = 65_535, cleaned: bool = False
) -> DataFrame:
    """``(token_id, token, count)`` for the most frequent words, from id 257 on.

    ``max_size`` counts all ids, those of the bytes included. ``cleaned`` tells that the
    texts come from the cleaning step, which makes finding the words cheaper. Ids follow
    descending count, ties in code-point order. Counting combines on the map side, so a very
    frequent word costs one row per task.
    """
    check_vocab_size(max_size)
    if max_size <= FIRST_WORD_ID:
        raise ValueError(f"a vocabulary needs more than {FIRST_WORD_ID} ids, got {max_size}")
    words = tx.words_of_cleaned if cleaned else tx.words
    counts = (
        df.select(F.explode(words(F.col(column))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("count"))
    )
    by_rank = [F.desc("count"), F.asc("token")]
    top = counts.orderBy(*by_rank).limit(max_size - FIRST_WORD_ID)
    # At most 65,278 rows remain, so one task may number them.
    return top.select(
        (F.row_number().over(Window.orderBy(*by_rank)) + SPELLED_ID).cast("bigint").alias("token_id"),
        "token",
        "count",
    )


def word_tokenizer(vocab: DataFrame, cleaned: bool = False) -> Tokenizer:
    """Lossless tokenizer over a vocabulary from :func:`word_vocab`.

    A word of the vocabulary is one token; any other is the token 256 and its UTF-8
    bytes. Decoding gives the words back, joined by one space; a list that starts or ends
    inside a spelled character loses that character only.

    The vocabulary is bounded by the token type (65,278 words), so it is sent to the
    executors once; encoding is a vectorised lookup and needs no shuffle.
    """
    rows = vocab.orderBy("token_id").select("token").limit(MAX_TOKEN_VALUE["uint16"]).toArrow()
    shared = vocab.sparkSession.sparkContext.broadcast(rows.column("token").combine_chunks())

    @piecewise("array<int>")
    def lookup(values: pa.Array) -> pa.Array:
        words, bounds = _words_of(values)
        found = pc.index_in(words, value_set=shared.value.cast(words.type))
        ids = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int32) + FIRST_WORD_ID
        known = ids >= FIRST_WORD_ID
        spelled = words.filter(pa.array(~known)).cast(pa.binary())
        lengths = np.ones(len(ids), np.int64)
        lengths[~known] += pc.binary_length(spelled).to_numpy()
        ends = np.concatenate([[0], np.cumsum(lengths)])
        out = np.full(ends[-1], SPELLED_ID, np.int32)
        out[ends[:-1][known]] = ids[known]
        inside = np.ones(len(out), bool)
        inside[ends[:-1]] = False
        out[inside] = np.frombuffer(b"".join(spelled.to_pylist()), np.uint8)
        mask = values.is_null() if values.null_count else None
        return pa.ListArray.from_arrays(pa.array(ends[bounds], pa.int32()), pa.array(out), mask=mask)

    @piecewise("int")
    def count(values: pa.Array) -> pa.Array:
        words, bounds = _words_of(values)
        known = pc.is_in(words, value_set=shared.value.cast(words.type))
        sizes = pc.if_else(known, pa.scalar(0, pa.int32()), pc.binary_length(words.cast(pa.binary())))
        ends = np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False) + 1)])
        totals = np.diff(ends[bounds]).astype(np.int32)
        return pa.array(totals, mask=values.is_null().to_numpy(zero_copy_only=False))

    @piecewise("string", OBJECT_BYTES)
    def spell(id_lists: pa.Array) -> pa.Array:
        single = [bytes([b]) for b in range(256)]
        entries = pa.concat_arrays([
            pa.array([*single, b" "], pa.binary()),
            pc.binary_join_element_wise(pa.scalar(b" "), shared.value.cast(pa.binary()), pa.scalar(b"")),
        ])
        joined = pc.binary_join(_as_lists(entries.take(id_lists.flatten()), id_lists), b"")
        return pa.array([None if v is None else v.removeprefix(b" ").decode("utf-8", "ignore") for v in joined.to_pylist()], pa.string())

    return Tokenizer(
        encode=lambda text: lookup(_splittable(text, cleaned)),
        decode=spell,
        vocab_size=rows.num_rows + FIRST_WORD_ID,
        count=lambda text: count(_splittable(text, cleaned)),
    )


def utf8_tokenizer() -> Tokenizer:
    """One token per UTF-8 byte (vocabulary of 256)."""

    @piecewise("array<int>")
    def to_bytes(texts: pa.Array) -> pa.Array:
        raw = texts.cast(pa.binary())
        joined = b"".join(v for v in raw.to_pylist() if v is not None)
        flat = pa.Array.from_buffers(pa.uint8(), len(joined), [None, pa.py_buffer(joined)])
        return _lists_of(flat.cast(pa.int32()), pc.fill_null(pc.binary_length(raw), 0), texts)

    @piecewise("string", OBJECT_BYTES)
    def from_bytes(id_lists: pa.Array) -> pa.Array:
        return pa.array(
            [None if ids is None else bytes(ids).decode("utf-8", "replace") for ids in id_lists.to_pylist()],
            pa.string(),
        )

    return Tokenizer(encode=to_bytes, decode=from_bytes, vocab_size=256, count=F.octet_length)


def _encoding(ranks: dict[bytes, int], pattern: str):
    import tiktoken

    return tiktoken.Encoding("caller", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def rank_file_length(ranks: dict[bytes, int], pattern: str = GPT2_PATTERN) -> Callable[[str], int]:
    """Number of byte-pair tokens of a text, to measure chunks with."""
    made = {}

    def length(text: str) -> int:
        if not made:
            made["encoding"] = _encoding(ranks, pattern)
        return len(made["encoding"].encode_ordinary(text))

    return length


def rank_file_tokenizer(
    spark: SparkSession, ranks: dict[bytes, int], pattern: str = GPT2_PATTERN
) -> Tokenizer:
    """Byte-pair tokenizer from caller-supplied merge ranks (such as gpt2's)."""
    check_vocab_size(max(ranks.values()) + 1)
    shared, made = spark.sparkContext.broadcast((ranks, pattern)), {}

    def encoding():
        if not made:
            made["encoding"] = _encoding(*shared.value)
        return made["encoding"]

    @piecewise("array<int>", OBJECT_BYTES)
    def encode(texts: pa.Array) -> pa.Array:
        enc = encoding()
        return pa.array(
            [None if t is None else enc.encode_ordinary(t) for t in texts.to_pylist()],
            pa.list_(pa.int32()),
        )

    @piecewise("string", OBJECT_BYTES)
    def decode(id_lists: pa.Array) -> pa.Array:
        enc = encoding()
        return pa.array(
            [None if ids is None else enc.decode(ids) for ids in id_lists.to_pylist()], pa.string()
        )

    return Tokenizer(encode=encode, decode=decode, vocab_size=max(ranks.values()) + 1)


def _as_lists(values: pa.Array, like: pa.Array) -> pa.Array:
    """Regroup flat ``values`` into lists shaped as those of ``like``."""
    return _lists_of(values, pc.fill_null(pc.list_value_length(like), 0), like)


def _lists_of(values: pa.Array, lengths: pa.Array, like: pa.Array) -> pa.Array:
    ends = pc.cumulative_sum(lengths.cast(pa.int32()))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    mask = like.is_null() if like.null_count else None
    return pa.ListArray.from_arrays(offsets, values, mask=mask)


def tokenize(df: DataFrame, tokenizer: Tokenizer, column: str = "text") -> DataFrame:
    """Add ``tokens`` and ``n_tokens``."""
    return df.withColumn("tokens", tokenizer.encode(F.col(column))).withColumn(
        "n_tokens", F.size("tokens")
    )


def count_tokens(df: DataFrame, tokenizer: Tokenizer, column: str = "text") -> DataFrame:
    """Add ``n_tokens`` only."""
    count = tokenizer.count or (lambda text: F.size(tokenizer.encode(text)))
    return df.withColumn("n_tokens", count(F.col(column)))


def token_stats(df: DataFrame) -> DataFrame:
    """Per split: token totals, document count, average, extremes and stream size in MB."""
    total = F.sum("n_tokens")
    return df.groupBy("split").agg(
        total.alias("total_tokens"),
        F.count("*").alias("num_documents"),
        (total / F.count("*")).alias("avg_tokens_per_doc"),
        F.min("n_tokens").alias("min_tokens"),
        F.max("n_tokens").alias("max_tokens"),
        (total * 2 / F.lit(1048576.0)).alias("file_size_mb"),
    )


def verify_tokens(df: DataFrame, vocab_size: int) -> DataFrame:
    """Per split: more than 100 tokens and every id inside the vocabulary."""
    return (
        df.select("split", F.size("tokens").alias("n"), F.array_max("tokens").alias("top"))
        .groupBy("split")
        .agg(F.sum("n").alias("n_tokens"), F.max("top").alias("max_token"))
        .withColumn(
            "ok", (F.col("n_tokens") > 100) & F.coalesce(F.col("max_token") < vocab_size, F.lit(False))
        )
    )


def training_budget(stats: DataFrame, max_iters: int, batch_size: int, block_size: int) -> DataFrame:
    """Tokens a training run wants and the iterations the train split supports."""
    per_iteration = batch_size * block_size
    available = F.col("total_tokens")
    return stats.filter("split = 'train'").select(
        available.alias("available_tokens"),
        F.lit(max_iters * per_iteration).cast("bigint").alias("required_tokens"),
        F.when(available >= max_iters * per_iteration, F.lit(max_iters))
        .otherwise(F.greatest(F.lit(100), whole_part(available, per_iteration)))
        .cast("bigint")
        .alias("max_iters"),
    )
