"""Add-one bigram model that scores token blocks for perplexity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.batches import PIECE_BYTES, pieces
from corpusmill.session import materialize

# A transition counts as frequent above this share of all scored transitions, so
# there can never be more frequent transitions than its inverse.
_FREQUENT_SHARE = 1 / 4096
_BROADCAST_VOCABULARY = 1 << 17
# Transitions that are sorted together, that meet in one slice, and that are handed on at once.
_SORTED_PAIRS, _SLICE_PAIRS, _HANDED_ON = 1 << 22, 1 << 21, 1 << 19
# An odd factor deals transitions evenly over the slices, and its inverse gives them back.
_MIX = np.uint64(0x9E3779B97F4A7C15)
_UNMIX = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def sample_blocks(
    blocks: DataFrame, block_size: int, split: str = "val", max_samples: int | None = 1000, seed: int = 42
) -> DataFrame:
    """Full blocks of a split; at most ``max_samples`` of them, chosen by seeded hash."""
    full = blocks.filter((F.col("split") == split) & (F.size("tokens") == block_size))
    if max_samples is None:
        return full
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col("block_id")).cast("binary"))
    return full.orderBy(order, "block_id").limit(max_samples)


def transitions(blocks: DataFrame) -> DataFrame:
    """``(block_id, current, following)``: adjacent tokens inside each block."""
    pairs = F.size("tokens") - 1
    moves = F.arrays_zip(
        F.slice("tokens", F.lit(1), pairs).alias("current"),
        F.slice("tokens", F.lit(2), pairs).alias("following"),
    )
    return blocks.filter(F.size("tokens") > 1).select("block_id", F.inline(moves))


def _counted(slices: int, wanted: bool):
    """Distinct transitions with their counts, cut into slices by hash; a few million are sorted at a time."""
    bounds = np.array([(i << 64) // slices for i in range(1, slices)], np.uint64)

    def counts(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs, seen = np.unique(np.concatenate(held), return_counts=True)
        pairs, seen = pairs.astype("<u8", copy=False), seen.astype("<u4")
        cuts = [0, *np.searchsorted(pairs, bounds).tolist(), len(pairs)]
        full = [i for i in range(slices) if cuts[i] < cuts[i + 1]]
        step = max(1, len(full) * _HANDED_ON // len(pairs))
        for i in range(0, len(full), step):
            own = full[i : i + step]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own, pa.int32()), pa.array([wanted] * len(own)),
                    pa.array([pairs[cuts[n] : cuts[n + 1]].tobytes() for n in own], pa.binary()),
                    pa.array([seen[cuts[n] : cuts[n + 1]].tobytes() for n in own], pa.binary()),
                ],
                ["slice", "wanted", "pairs", "seen"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for (lists,) in pieces((batch.column(0),), PIECE_BYTES):
                ids = lists.flatten().to_numpy().astype(np.uint64)
                inside = np.ones(len(ids), bool)
                ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                inside[ends[ends > 0] - 1] = False  # the last token of a block is followed by none
                at = np.flatnonzero(inside)
                held.append((ids[at] << np.uint64(32) | ids[at + 1]) * _MIX)
                size += len(at)
                if size >= _SORTED_PAIRS:
                    yield from counts(held)
                    held, size = [], 0
        if size:
            yield from counts(held)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the wanted transitions, from rows that are sorted by slice."""

    def total(held: list[tuple]) -> pa.RecordBatch:
        codes = np.concatenate([np.frombuffer(pairs, "<u8") for _, pairs, _ in held])
        seen = np.concatenate([np.frombuffer(counts, "<u4") for _, _, counts in held]).astype(np.int64)
        wanted = np.repeat([w for w, _, _ in held], [len(pairs) // 8 for _, pairs, _ in held])
        order = np.argsort(codes, kind="stable")
        codes, seen, wanted = codes[order], seen[order], wanted[order]
        starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        times = np.add.reduceat(np.where(wanted, seen, 0), starts)
        known = np.add.reduceat(np.where(wanted, 0, seen), starts)
        used = times > 0
        pairs = codes[starts[used]] * _UNMIX
        return pa.RecordBatch.from_arrays(
            [
                pa.array((pairs >> np.uint64(32)).astype(np.int32)),
                pa.array((pairs & np.uint64(0xFFFFFFFF)).astype(np.int32)),
                pa.array(times[used]), pa.array(known[used]),
            ],
            ["current", "following", "times", "pair_count"],
        )

    held, now = [], None
    for batch in batches:
        columns = [batch.column(c) for c in ("slice", "wanted", "pairs", "seen")]
        for i in range(batch.num_rows):
            slice_, *row = (c[i].as_py() for c in columns)
            if slice_ != now and held:
                yield total(held)
                held = []
            now = slice_
            held.append(row)
    if held:
        yield total(held)


def score_transitions(train_blocks: DataFrame, blocks: DataFrame, vocab_size: int) -> DataFrame:
    """``(current, following, times, nll)`` for the transitions of ``blocks``.

    Transitions are counted where they are read. The counts meet in slices by hash, of
    which there are more the more tokens there are, so a task holds a few million at once;
    only transitions that ``blocks`` hold go on.
    """
    tokens = train_blocks.select("tokens").unionByName(blocks.select("tokens"))
    slices = (tokens.agg(F.sum(F.size("tokens")).alias("n")).first()["n"] or 0) // _SLICE_PAIRS + 1
    schema = "slice int, wanted boolean, pairs binary, seen binary"
    counted = [b.select("tokens").mapInArrow(_counted(slices, w), schema) for b, w in ((train_blocks, False), (blocks, True))]
    met = counted[0].unionByName(counted[1]).repartition(slices, "slice").sortWithinPartitions("slice")
    needed = met.mapInArrow(_summed, "current int, following int, times bigint, pair_count bigint")
    moves = train_blocks.filter(F.size("tokens") > 1).select(
        F.explode(F.slice("tokens", F.lit(1), F.size("tokens") - 1)).alias("current")
    )
    contexts = moves.groupBy("current").agg(F.count("*").alias("context_count"))
    if vocab_size <= _BROADCAST_VOCABULARY:
        contexts = F.broadcast(contexts)  # one row per token id
    bottom = F.coalesce("context_count", F.lit(0)) + vocab_size
    return needed.join(contexts, "current", "left").select(
        "current", "following", "times", (-F.log((F.col("pair_count") + 1) / bottom)).alias("nll")
    )


def block_losses(train_blocks: DataFrame, blocks: DataFrame, vocab_size: int) -> DataFrame:
    """``(block_id, n_tokens, loss)``: mean negative log likelihood of each block.

    Blocks of fewer than two tokens have no transition, so their loss is null.

    Blocks meet the scored transitions in two ways: the few very frequent
    transitions through a broadcast, all others through a shuffle whose keys are
    then known to be light. Both ways together cover every transition exactly once.
    """
    scored = materialize(score_transitions(train_blocks, blocks, vocab_size), "scored-transitions")
    total = scored.agg(F.sum("times").alias("n")).scalar()
    frequent = F.col("times") > total * F.lit(_FREQUENT_SHARE)
    pair = ["current", "following"]
    common = scored.filter(frequent).select(*pair, F.col("nll").alias("common_nll"))
    rare = scored.filter(~frequent).select(*pair, "nll")

    tagged = transitions(blocks).join(F.broadcast(common), pair, "left")
    through_broadcast = tagged.filter("common_nll is not null").select(
        "block_id", F.col("common_nll").alias("nll")
    )
    through_shuffle = (
        tagged.filter("common_nll is null").drop("common_nll").join(rare, pair).select("block_id", "nll")
    )
    losses = through_broadcast.unionByName(through_shuffle).groupBy("block_id").agg(F.avg("nll").alias("loss"))
    sizes = blocks.select("block_id", F.size("tokens").cast("bigint").alias("n_tokens"))
    return sizes.join(losses, "block_id", "left")
