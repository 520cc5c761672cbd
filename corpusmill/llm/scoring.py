"""Scores of texts under a bigram model kept in a log-frequency Bloom filter.

Counts of words and word pairs are quantised to levels; a key is put into the filter once
for each level up to its own, so its level is found by probing level after level until one
is missing. The filter is cut into slices by key, each an ordinary Bloom filter filled by
one task, and slices are broadcast to the workers in groups of bounded size. A document's
tokens are probed against each group in turn; one group is enough for small corpora.

Beside the model's score stands an exact base score under add-one word probabilities.
Counts of frequent words are broadcast, a bounded number; other words are joined.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words as w
from corpusmill.llm.common import column
from corpusmill.session import materialize, scan_bytes

START, END = np.uint64(0x5BD1E995A5A5A5A5), np.uint64(0xC2B2AE3D27D4EB4F)
LEVEL_BASE = 1.5
HASHES, BITS_PER_ENTRY = 7, 10  # about one false answer in a hundred probes
PRIOR = 50.0
GROUP_BYTES = 256 << 20
FETCH_BYTES = 8 << 20  # of the filter that pass the driver at a time
HOT_WORDS = 1 << 20
SLICE_BYTES = 512 << 10  # of input
FLUSH_TOKENS = 750_000  # some 130 bytes of arrays for each
PROBE_BYTES = 512 << 10  # of text probed at a time
MEMO_KEYS = 1 << 20  # of which a worker keeps the level, 9 bytes each


def level_starts() -> np.ndarray:
    """Smallest count of each level: the whole numbers above the powers of the base."""
    return np.unique(np.ceil(LEVEL_BASE ** np.arange(105)).astype(np.int64))


def level_counts() -> np.ndarray:
    """The count that a level stands for (level 0: none), midway between its ends."""
    starts = level_starts()
    return np.concatenate([[0.0], (starts[:-1] + starts[1:] - 1) / 2])


def _word_keys(hashes: np.ndarray) -> np.ndarray:
    return w.mixed(hashes, 21)


def _pair_keys(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return w.mixed(w.mixed(before, 22) * np.uint64(0x9E3779B97F4A7C15) + after, 23)


def _sequences(table: w.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts (words, then one end), the token before each, and where texts begin."""
    counts = np.diff(table.bounds)
    bounds = table.bounds + np.arange(len(table.bounds))
    tokens = np.full(bounds[-1], END, np.uint64)
    tokens[np.arange(len(table.hashes)) + np.repeat(np.arange(len(counts)), counts)] = table.hashes
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = START
    return tokens, before, bounds


def _counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def _cut(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """A binary column whose row ``i`` holds the bytes of ``values[edges[i]:edges[i + 1]]``."""
    offsets = (edges * values.itemsize).astype(np.int64)
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(offsets), data]).cast(pa.binary())


def _counted(bits: int):
    """Counts of words (all, and of training texts) and of pairs, in blocks by slice of the key."""
    shift, slices = np.uint64(64 - bits), 1 << bits

    def blocks(kind, keys, total, train):
        edges = np.searchsorted(keys >> shift, np.arange(slices + 1, dtype=np.uint64))
        out = pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(slices, dtype=np.int32)),
                pa.array(np.full(slices, kind, np.int32)),
                _cut(keys, edges), _cut(total.astype(np.int64), edges), _cut(train.astype(np.int64), edges),
            ],
            names=["slice", "kind", "keys", "total", "train"],
        )
        return out.filter(pa.array(np.diff(edges) > 0))

    def flushed(of_all, of_training, of_pairs):
        keys, total = _counts(np.concatenate(of_all))
        seen, times = _counts(np.concatenate(of_training))
        train = np.zeros(len(keys), np.int64)
        train[np.searchsorted(keys, seen)] = times
        yield blocks(0, keys, total, train)
        keys, total = _counts(np.concatenate(of_pairs))
        yield blocks(1, keys, total, np.zeros(len(keys), np.int64))

    def run(batches):
        held, n = ([], [], []), 0
        for batch in batches:
            learn = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            for first, texts in w.pieces(batch.column("text")):
                tokens, before, bounds = _sequences(w.words(texts, fold=True))
                mine = np.repeat(learn[first : first + len(texts)], np.diff(bounds))
                keys = _word_keys(tokens)
                held[0].append(keys)
                held[1].append(keys[mine])
                held[2].append(_pair_keys(before[mine], tokens[mine]))
                n += len(tokens)
                if n >= FLUSH_TOKENS:
                    yield from flushed(*held)
                    held, n = ([], [], []), 0
        if n:
            yield from flushed(*held)

    return run


def _merged(blocks: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    read = lambda name, kind: np.concatenate([np.frombuffer(b[name], kind) for b in blocks])
    keys, at = np.unique(read("keys", np.uint64), return_inverse=True)
    add = lambda name: np.bincount(at, read(name, np.int64), len(keys)).astype(np.int64)
    return keys, add("total"), add("train")


def _positions(keys: np.ndarray, level: int, size: np.ndarray | np.uint64):
    """The places of a key and level in a filter of ``size`` bits, one after the other."""
    first = w.mixed(keys, 1000 + level)
    step = w.mixed(first, 7) | np.uint64(1)
    for _ in range(HASHES):
        yield first % size
        first = first + step


def _filled(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Bloom filter of a slice: every key once for each of its levels."""
    levels = np.searchsorted(level_starts(), counts, "right")
    size = 8 * (1 + int(levels.sum()) * BITS_PER_ENTRY // 8)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for at in _positions(keys[levels >= level], level, np.uint64(size)):
            bits[at.astype(np.int64)] = True
    return np.packbits(bits, bitorder="little"), size


def _slices(batches):
    """One row per slice: its filter, and the exact word counts; rows come sorted by slice."""

    def done(number, blocks):
        words_, total, train = _merged([b for b in blocks if b["kind"] == 0])
        pairs, times, _ = _merged([b for b in blocks if b["kind"] == 1])
        learned = train > 0
        bits, size = _filled(np.concatenate([words_[learned], pairs]), np.concatenate([train[learned], times]))
        whole = lambda v: pa.array([v.tolist()], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([size], pa.int64()), pa.array([bits.tobytes()], pa.binary()),
             whole(words_.view(np.int64)), whole(total), whole(train)],
            names=["slice", "size", "bits", "words", "total", "train"],
        )

    number, blocks = None, []
    for batch in batches:
        for at, new in enumerate(batch.column("slice").to_pylist()):
            if new != number and blocks:
                yield done(number, blocks)
                blocks = []
            number = new
            blocks += batch.slice(at, 1).to_pylist()  # only the rows of a slice become Python objects
    if blocks:
        yield done(number, blocks)


class _Filter:
    """Some slices of the filter, as one array of bytes."""

    def __init__(self, bits: int, slices: list[int], sizes: list[int], filters: Iterable[bytes]):
        self.shift = np.uint64(64 - bits)
        self.base = np.full(1 << bits, -1, np.int64)
        self.size = np.ones(1 << bits, np.uint64)
        lengths, whole = [], bytearray()
        for own in filters:  # which may come one after the other, with their slices
            lengths.append(len(own))
            whole += own
        self.base[slices] = np.cumsum([0, *lengths[:-1]])[: len(lengths)]
        self.size[slices] = sizes
        self.bytes = np.frombuffer(whole, np.uint8)
        self.memo = None  # made by the worker

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key whose slice is here, 0 for all others.

        Keys of high levels take most probes and come again most often, so their levels are
        kept: each place of the memo has the key of the highest level that fell on it.
        """
        if self.memo is None:
            # At first every place has a key that belongs elsewhere.
            self.memo = np.arange(MEMO_KEYS, dtype=np.uint64) ^ np.uint64(1), np.zeros(MEMO_KEYS, np.uint8)
        kept, level = self.memo
        place = (keys & np.uint64(len(kept) - 1)).astype(np.int64)
        known = kept[place] == keys
        found = np.where(known, level[place], np.uint8(0))
        new = np.flatnonzero(~known)
        found[new] = self._probed_levels(keys[new])
        # In rising order, so that of new keys of one place the highest level stays.
        new = new[np.argsort(found[new], kind="stable")]
        new = new[found[new] > level[place[new]]]
        kept[place[new]], level[place[new]] = keys[new], found[new]
        return found

    def _probed_levels(self, keys: np.ndarray) -> np.ndarray:
        """The levels by repeated membership probes."""
        found = np.zeros(len(keys), np.uint8)
        number = (keys >> self.shift).astype(np.int64)
        base, size = self.base[number], self.size[number]
        at = np.flatnonzero(base >= 0)
        level = 0
        while len(at):
            level += 1
            first = w.mixed(keys[at], 1000 + level)
            step = w.mixed(first, 7) | np.uint64(1)
            for _ in range(HASHES):
                place = (first % size[at]).astype(np.int64)
                ok = (self.bytes[base[at] + (place >> 3)] >> (place & 7).astype(np.uint8)) & 1 == 1
                at, first, step = at[ok], first[ok], step[ok]
                first = first + step
            found[at] = level
        return found


def _probed(shared):
    """Add what one group of slices knows about each token: a level for its word and its pair."""

    def run(batches):
        for batch in batches:
            for first, texts in w.pieces(batch.column("text"), PROBE_BYTES):
                part = batch.slice(first, len(texts))
                words_, pairs, bounds, _ = _looked_up(part, texts, shared.value)
                columns = dict(zip(part.schema.names, part.columns, strict=True))
                columns |= {"words": _cut(words_, bounds), "pairs": _cut(pairs, bounds)}
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _looked_up(part, texts, group: _Filter):
    tokens, before, bounds = _sequences(w.words(texts, fold=True))
    distinct, at = np.unique(tokens, return_inverse=True)
    words_ = group.levels(_word_keys(distinct))[at]
    pairs = group.levels(_pair_keys(before, tokens))
    if "words" in part.schema.names:  # what earlier groups found
        known = lambda name: np.frombuffer(b"".join(part.column(name).to_pylist()), np.uint8)
        words_, pairs = np.maximum(words_, known("words")), np.maximum(pairs, known("pairs"))
    return words_, pairs, bounds, (tokens, distinct, at)


def _scored(shared, hot, n_train: int, n_distinct: int, n_texts: int, prior: float):
    counts = level_counts()
    denominator = n_train + n_distinct + 1

    def run(batches):
        keys, exact = hot.value
        for batch in batches:
            for first, texts in w.pieces(batch.column("text"), PROBE_BYTES):
                part = batch.slice(first, len(texts))
                words_, pairs, bounds, (_, distinct, at) = _looked_up(part, texts, shared.value)
                starts = bounds[:-1]
                own = counts[words_]
                context = np.empty_like(own)
                context[1:] = own[:-1]
                context[starts] = n_texts
                simple = (own + 1) / denominator
                likely = (np.minimum(counts[pairs], context) + prior * simple) / (context + prior)
                own_keys = _word_keys(distinct)
                place = np.minimum(np.searchsorted(keys, own_keys), max(len(keys) - 1, 0))
                there = keys[place] == own_keys if len(keys) else np.zeros(len(own_keys), bool)
                times = np.where(there, exact[place], 0) if len(keys) else np.zeros(len(own_keys))
                rare = ~there[at]
                lost = np.concatenate([[0], np.cumsum(rare)])
                sums = lambda v: np.add.reduceat(v, starts)  # noqa: E731  every text has its end
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), part.column("held_out"),
                        pa.array(np.diff(bounds)),
                        pa.array(sums((times > 0)[at].astype(np.int64))),
                        pa.array(sums(np.log10(times + 1)[at])),
                        pa.array(sums(np.log10(likely))),
                        w.lists(own_keys[at][rare].view(np.int64), lost[bounds]),
                    ],
                    names=["id", "held_out", "n_tokens", "known", "base", "score", "rare"],
                )

    return run


def held_out(ident: Column, parts: int = 7, part: int = 2) -> Column:
    """Whether a document is not learned from: by the checksum of its id; null ids are learned from."""
    digits = F.coalesce(ident.cast("string"), F.lit("")).cast("binary")
    return F.crc32(digits) % parts == part


def score_texts(
    df: DataFrame,
    held: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    prior: float = PRIOR,
    group_bytes: int = GROUP_BYTES,
    hot_words: int = HOT_WORDS,
) -> DataFrame:
    """Scores of all texts: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from rows that ``held`` does not hold out. A-Z is lower-cased, tokens
    are the words and one end. ``base_score`` sums log10((c + 1) / (N + V + 1)) exactly.
    ``score`` sums log10 of (c(v w) + prior * p(w)) / (c(v) + prior), where v is the token
    before w, p(w) the add-one probability of w, and all counts come from the filter; the
    count of a pair is never above that of its first token.

    Null, empty and blank texts have the end as their only token. Rows repeated are learned
    from and scored repeatedly. Null ids are carried. Without training rows all counts are
    0. An empty table gives no rows. Texts may be of any length. Nothing else of a row is read.
    """
    chosen = held_out(column(id_column)) if held is None else held
    docs = df.select(
        column(id_column).alias("id"),
        F.coalesce(column(text_column), F.lit("")).alias("text"),
        F.coalesce(chosen, F.lit(False)).alias("held_out"),
    )
    kind = dict(docs.dtypes)["id"]
    bits = min(16, max(8, (scan_bytes(df) // SLICE_BYTES).bit_length()))
    counted = docs.select("text", "held_out").mapInArrow(
        _counted(bits), "slice int, kind int, keys binary, total binary, train binary"
    )
    slices = materialize(
        counted.repartition("slice").sortWithinPartitions("slice").mapInArrow(
            _slices, "slice int, size bigint, bits binary, words array<bigint>, total array<bigint>, train array<bigint>"
        ),
        "count-filter",
    )
    exact = materialize(
        slices.select(F.explode(F.arrays_zip("words", "total", "train")).alias("x")).select(
            F.col("x.words").alias("key"), F.col("x.total").alias("total"), F.col("x.train").alias("train")
        ),
        "word-counts",
    )
    sums = exact.agg(F.sum("train").alias("n"), F.sum((F.col("train") > 0).cast("bigint")).alias("v")).first()
    n_train, n_distinct = sums["n"] or 0, sums["v"] or 0
    n_texts = docs.filter("not held_out").count()

    context = df.sparkSession.sparkContext
    hot = context.broadcast(_frequent(exact, hot_words))
    broadcasts, scored = [hot], docs
    groups = _groups(slices, bits, group_bytes)
    for number, members in enumerate(groups):
        shared = context.broadcast(_fetched(slices, bits, members))  # at most the bytes of a group
        broadcasts.append(shared)
        if number + 1 < len(groups):
            scored = materialize(
                scored.mapInArrow(_probed(shared), f"id {kind}, text string, held_out boolean, words binary, pairs binary"),
                "probed",
            )
    scored = scored.mapInArrow(
        _scored(shared, hot, n_train, n_distinct, n_texts, prior),
        f"id {kind}, held_out boolean, n_tokens bigint, known bigint, base double, score double, rare array<bigint>",
    )
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    for used in broadcasts:  # the scores are stored, so workers can let go of the filter
        used.unpersist()
    learned = exact.filter("train > 0").select("key", "train")
    rest = scored.select("row", F.explode("rare").alias("key")).join(learned, "key").groupBy("row").agg(
        F.sum(F.log10(F.col("train") + 1)).alias("more"), F.count("*").alias("known_too")
    )
    base = F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(n_train + n_distinct + 1)))
    return scored.drop("rare").join(rest, "row", "left").select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("known_too", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("bigint").alias("train_tokens"),
        base.alias("base_score"), "score",
    )


def _frequent(exact: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and training counts of the words of highest counts, at most ``most``, sorted by key.

    Counts over all texts decide, so no word left out is frequent anywhere.
    """
    ranked = exact.withColumn("grade", F.floor(F.log(F.col("total").cast("double")) * 8).cast("int"))
    sizes = dict(ranked.groupBy("grade").count().collect())  # a few hundred grades
    least, held = max(sizes, default=0) + 1, 0
    for grade in sorted(sizes, reverse=True):
        if held + sizes[grade] > most:
            break
        held, least = held + sizes[grade], grade
    found = ranked.filter(F.col("grade") >= least).select("key", "train").toArrow()
    keys = found.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], found.column("train").to_numpy()[order]


def _fetched(slices: DataFrame, bits: int, members: list[int], most: int = FETCH_BYTES) -> _Filter:
    """The filter of a group of consecutive slices, of which the driver takes ``most`` bytes at a time."""
    within = lambda own: slices.filter(F.col("slice").between(own[0], own[-1]))
    numbers, sizes = [], []

    def parts():
        for own in _groups(within(members), bits, most) if members else ():
            found = within(own).select("slice", "size", "bits").toArrow()
            numbers.extend(found.column("slice").to_pylist())
            sizes.extend(found.column("size").to_pylist())
            yield from (x.as_buffer() for x in found.column("bits"))

    return _Filter(bits, numbers, sizes, parts())


def _groups(slices: DataFrame, bits: int, most: int) -> list[list[int]]:
    """Slice numbers in groups of at most ``most`` bytes; there are at most 2**16 slices."""
    groups, room = [[]], most
    for row in slices.select("slice", F.octet_length("bits").alias("n")).orderBy("slice").collect():
        if row["n"] > room and groups[-1]:
            groups.append([])
            room = most
        groups[-1].append(row["slice"])
        room -= row["n"]
    return groups
