"""Importance resampling towards a target corpus over hashed word runs.

A run of consecutive words falls into the bucket of the CRC-32 of its UTF-8 bytes. The
vocabulary is split: a *head* of frequent words and word pairs, found in a pass over all
texts, is broadcast with exact CRC states, so that frequent runs are looked up in arrays
and longer runs go on from the state of their beginning; runs of the *tail* take their CRC
directly. Both give the same numbers, so the head only decides speed, never a result.

Bucket totals of the corpus and of the target give each bucket a gain, the log ratio of
smoothed shares; a document weighs the sum of the gains of its runs. Gumbel noise of the
id's SHA-256 turns the order by score into a draw without replacement.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm import words as w
from corpusmill.llm.common import column
from corpusmill.session import materialize

BUCKETS = 10_000
LONGEST = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
# The head: entries that may be broadcast (16 bytes each), and the share of the runs of
# some piece of text that makes a run a candidate.
HEAD_ENTRIES = 1 << 16
HEAD_SHARE = 1 / (1 << 15)

# Letters and digits of ASCII, lower-cased, and all other characters; the rest are spaces.
_PLAIN = np.full(256, 32, np.uint8)
for _kept in (range(48, 58), range(97, 123), range(128, 256)):
    _PLAIN[_kept] = _kept
_PLAIN[65:91] = _PLAIN[97:123]


class Head(NamedTuple):
    """Hashes of frequent runs of one length, sorted, with the CRC state of each."""

    hashes: np.ndarray
    states: np.ndarray


def plain(texts: pa.Array) -> pa.Array:
    """The texts with A-Z lower-cased and all that parts words made spaces; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = w._offsets(texts)
    data = texts.buffers()[2]
    if data is None or len(texts) == 0:
        return pa.array([""] * len(texts), pa.large_string())
    data = _PLAIN[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]]
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(data))


def _runs(table: w.Words, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length: where runs begin among the words, and the hash of each."""
    for n in range(1, longest + 1):
        at = np.flatnonzero(table.windows(n))
        yield n, at, table.hashes[at] if n == 1 else w.window_hashes(table.hashes, n)[at]


def _text(table: w.Words, first: int, n: int) -> bytes:
    """The words of a run, joined by one space."""
    raw, ends = table.data, range(first, first + n)
    return b" ".join(raw[table.starts[i] : table.ends[i]].tobytes() for i in ends)


def run_states(table: w.Words, heads: list[Head], longest: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length, where runs begin and the CRC-32 of each run's bytes.

    Every distinct run is looked up once: in the head of its length, else computed; a run
    of several words goes on from the CRC of its first words.
    """
    found, before = [], None
    for n, at, hashes in _runs(table, longest):
        kinds, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        states = np.zeros(len(kinds), np.uint32)
        tail = np.ones(len(kinds), bool)
        if n <= len(heads) and len(heads[n - 1].hashes):
            head = heads[n - 1]
            near = np.minimum(np.searchsorted(head.hashes, kinds), len(head.hashes) - 1)
            tail = head.hashes[near] != kinds
            states[~tail] = head.states[near[~tail]]
        left = np.flatnonzero(tail)
        last = at[first[left]] + n - 1
        raw, begin, end = table.data.tobytes(), table.starts[last].tolist(), table.ends[last].tolist()
        if before is None:
            fresh = [zlib.crc32(raw[b:e]) for b, e in zip(begin, end, strict=True)]
        else:
            so_far = before[at[first[left]]].tolist()
            fresh = [zlib.crc32(raw[b:e], zlib.crc32(b" ", s)) for b, e, s in zip(begin, end, so_far, strict=True)]
        states[left] = np.array(fresh, np.uint32)
        before = np.zeros(len(table.hashes), np.uint32)
        before[at] = states[place]
        found.append((at, before[at]))
    return found


def _candidates(longest: int, share: float):
    """Runs that hold ``share`` of the runs of their piece, counted, with their CRC."""

    def run(batches):
        for batch in batches:
            for _, texts in w.pieces(batch.column("text")):
                table = w.words(plain(texts))
                for n, at, hashes in _runs(table, min(longest, 2)):
                    kinds, first, counts = np.unique(hashes, return_index=True, return_counts=True)
                    often = np.flatnonzero(counts >= max(2, share * len(hashes)))
                    yield pa.RecordBatch.from_pydict({
                        "n": pa.array(np.full(len(often), n, np.int32)),
                        "hash": pa.array(kinds[often].view(np.int64)),
                        "seen": pa.array(counts[often]),
                        "state": pa.array([zlib.crc32(_text(table, int(at[i]), n)) for i in first[often]], pa.int64()),
                    })

    return run


def _heads(df: DataFrame, longest: int, entries: int, share: float) -> list[Head]:
    """The most frequent words and pairs of all texts; at most ``entries`` come to the driver."""
    seen = df.select("text").mapInArrow(_candidates(longest, share), "n int, hash bigint, seen bigint, state bigint")
    counted = seen.groupBy("n", "hash", "state").agg(F.sum("seen").alias("seen"))
    # Two runs of one hash can't both be in the head: their bytes would be in doubt.
    best = counted.groupBy("n", "hash").agg(F.max("seen").alias("seen"), F.max("state").alias("state"), F.count("*").alias("kinds"))
    top = best.filter("kinds = 1").orderBy(F.desc("seen"), "n", "hash").limit(entries).toArrow()
    heads = []
    for n in range(1, min(longest, 2) + 1):
        own = top.filter(pc.equal(top.column("n"), n))
        hashes = own.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        heads.append(Head(hashes[order], own.column("state").to_numpy().astype(np.uint32)[order]))
    return heads


def _bucketed(shared, longest: int, buckets: int):
    """Each text's buckets as a list, and how many words it has, beside its other columns."""

    def run(batches):
        for batch in batches:
            for begin, texts in w.pieces(batch.column("text")):
                table = w.words(plain(texts))
                found = run_states(table, shared.value, longest)
                at = np.concatenate([a for a, _ in found])
                own = np.concatenate([s for _, s in found]) % np.uint32(buckets)
                owner = table.owners[at]
                if longest > 1:
                    order = np.argsort(owner, kind="stable")
                    owner, own = owner[order], own[order]
                part = batch.slice(begin, len(texts))
                out = {name: part.column(name) for name in part.schema.names if name != "text"}
                out["n_words"] = pa.array(np.diff(table.bounds))
                out["buckets"] = w.lists(own.astype(np.int32), np.searchsorted(owner, np.arange(len(texts) + 1)))
                yield pa.RecordBatch.from_pydict(out)

    return run


def _totals(buckets: int):
    """Counts of all buckets in the rows of a task."""

    def run(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            sums += np.bincount(batch.column("buckets").flatten().to_numpy(), minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at.astype(np.int32)), "seen": pa.array(sums[at])})

    return run


def _counts(bucketed: DataFrame, buckets: int) -> np.ndarray:
    seen = bucketed.select("buckets").mapInArrow(_totals(buckets), "bucket int, seen bigint")
    sums = seen.groupBy("bucket").agg(F.sum("seen").alias("seen")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[sums.column("bucket").to_numpy()] = sums.column("seen").to_numpy()
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousandfold log ratio of the smoothed shares of each bucket, floored."""
    s, t, n = corpus.astype(float), target.astype(float), len(corpus)
    ratio = ((t + 1) * (s.sum() + n)) / ((s + 1) * (t.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weighed(shared):
    def run(batches):
        gains = shared.value
        for batch in batches:
            lists = batch.column("buckets")
            bounds = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1]
            values = gains[lists.values.to_numpy()[bounds[0] : bounds[-1]]] if len(lists) else np.zeros(0, np.int64)
            sums = np.concatenate([[0], np.cumsum(values)])
            bounds = bounds - bounds[:1]
            out = {name: batch.column(name) for name in batch.schema.names if name != "buckets"}
            out["n_features"] = pa.array(np.diff(bounds).astype(np.int64))
            out["weight"] = pa.array((sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.int64))
            yield pa.RecordBatch.from_pydict(out)

    return run


def gumbel(ident: Column, seed: int) -> Column:
    """Noise of an id: Gumbel distributed, in thousandths, floored; a null id counts as empty."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def _ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``place`` from 1 over all rows in ``order``, without one task for all.

    Rows are ranged by the order and stored with their place inside the range; the ranges'
    sizes give the rest.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part, local = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # One row for each range of the shuffle, summed in one place.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    placed = stored.withColumn("_part", part).join(F.broadcast(bases), "_part")
    return placed.withColumn("place", F.col("_base") + local + 1).drop("_part", "_base", "_at")


def resample(
    df: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text_column: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
    head_entries: int = HEAD_ENTRIES,
    head_share: float = HEAD_SHARE,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row of ``df``.

    Features are the runs of 1 to ``longest`` words of the whole text, repeats counted;
    without words there are none and the weight is 0. Of the rows with at least
    ``min_words`` words the ``percent`` % of highest score are drawn, ties to the smaller id
    (null first); rows repeated with their id are ranked each. ``rank`` counts the drawn
    from 1, for others it is null. An empty target gives every bucket the same smoothed share; an
    empty ``df`` gives no rows. A null id draws the noise of an empty one.

    To the driver come at most ``head_entries`` runs and ``buckets`` totals.
    """
    texts = df.select(column(id_column).alias("doc_id"), column(text_column).alias("text"))
    wanted = target.select(column(target_text_column).alias("text"))
    sc = df.sparkSession.sparkContext
    heads = sc.broadcast(_heads(texts, longest, head_entries, head_share))
    kind = dict(texts.dtypes)["doc_id"]
    cut = _bucketed(heads, longest, buckets)
    stored = materialize(texts.mapInArrow(cut, f"doc_id {kind}, n_words bigint, buckets array<int>"), "buckets")
    aimed = wanted.mapInArrow(cut, "n_words bigint, buckets array<int>")
    gains = sc.broadcast(bucket_gains(_counts(stored, buckets), _counts(aimed, buckets)))
    weighed = stored.mapInArrow(_weighed(gains), f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")
    # Stored, so that the sampling of range bounds does not weigh all rows again.
    scored = materialize(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scored")
    able = F.col("n_words") >= min_words
    drawn = scored.filter(able).count() * percent // 100
    # Rows that can't be drawn go last, dealt out like the others.
    placed = _ranked(scored, [F.desc(able), F.desc("score"), F.asc("doc_id")])
    rank = F.when(able & (F.col("place") <= drawn), F.col("place"))
    return placed.select("doc_id", "n_features", "weight", "score", rank.cast("bigint").alias("rank"))


def drawn_rows(df: DataFrame, target: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of ``df``, with all columns, whose id is drawn; every row of a drawn id stays."""
    chosen = resample(df, target, id_column, **options).filter("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn_id"))
    chosen = materialize(chosen.distinct(), "drawn")
    return df.join(chosen, column(id_column).eqNullSafe(F.col("_drawn_id")), "left_semi")
