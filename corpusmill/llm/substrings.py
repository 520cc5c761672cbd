"""Passages that repeat across documents, found by level-wise doubling of window lengths.

The goal is every window of ``window`` words that also starts in a document of smaller
id. Lengths double up to it (13, 25, 50): a window repeats only if the shorter windows in
it repeat, so at each length only windows inside spans that are still alive are looked up.
Below the full length one window stands for a span, the one of smallest hash in it: equal
spans choose equal windows, so a span whose choice is found in one document only is dead.
At the full length every window still alive is compared. Equal documents are grouped
first, and only the one of smallest id goes through the levels.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words as w
from corpusmill.llm.common import column, narrowed
from corpusmill.session import materialize

WINDOW = 50
SHORTEST = 13
_EMPTY = hashlib.sha256(b"").digest()


def levels(window: int, shortest: int = SHORTEST) -> list[int]:
    """Lengths that double up to ``window``; the first is at least ``shortest`` if possible."""
    lengths = [window]
    while -(-lengths[0] // 2) >= shortest:
        lengths.insert(0, -(-lengths[0] // 2))
    return lengths


def _smallest_inside(hashes: np.ndarray, span: int, length: int) -> np.ndarray:
    """For each word, the smallest hash among the windows of ``length`` in the ``span`` words from it on."""
    low = w.window_hashes(hashes, length)
    many, have = span - length + 1, 1
    while have < many:
        step = min(have, many - have)
        if len(low) <= step:
            return np.zeros(0, np.uint64)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low


def _alive(table: w.Words, span: int, pairs: pa.Array | None) -> np.ndarray:
    """Words at which a span starts that is still alive."""
    if pairs is None:
        return np.flatnonzero(table.windows(span))
    offsets = pairs.offsets.to_numpy()
    flat = pairs.flatten().to_numpy().reshape(-1, 2)
    base = np.repeat(table.bounds[:-1], np.diff(offsets) // 2)
    starts, ends = flat[:, 0] + base, flat[:, 1] + base
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(lengths.sum())


def _pairs(table: w.Words, at: np.ndarray) -> pa.ListArray:
    """Positions, ascending, as runs ``[start, end)`` counted in the words of each text."""
    owner = np.searchsorted(table.bounds, at, "right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(owner) != 0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    owners = owner[first]
    flat = np.stack([at[first], at[last] + 1], 1) - table.bounds[owners][:, None] if len(at) else np.zeros((0, 2))
    return w.lists(flat.astype(np.int32).ravel(), 2 * np.searchsorted(owners, np.arange(len(table.bounds))))


def _lists(batch: pa.RecordBatch, name: str, first: int, n: int) -> pa.Array:
    part = batch.column(name).slice(first, n)
    return pa.concat_arrays([part]) if part.offset else part


def _chosen(table: w.Words, at: np.ndarray, span: int, length: int) -> pa.ListArray:
    """The windows that stand for the living spans of each text."""
    low = _smallest_inside(table.hashes, span, length)[at]
    owner = np.searchsorted(table.bounds, at, "right") - 1
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])
    return w.lists(low[new].view(np.int64), np.searchsorted(owner[new], np.arange(len(table.bounds))))


def _first_pass(span: int, length: int):
    """Word counts, digests of the words, and the windows of the first level."""

    def run(batches):
        for batch in batches:
            for first, texts in w.pieces(batch.column("text")):
                table = w.words(texts)
                joined = [b" ".join(t.as_buffer().to_pybytes().split()) for t in texts.cast(pa.large_binary())]
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("text_key"),
                        pa.array(np.diff(table.bounds)),
                        pa.array([hashlib.sha256(j).digest() for j in joined], pa.binary()),
                        _chosen(table, _alive(table, span, None), span, length),
                    ],
                    names=["id", "text_key", "n_words", "sha", "chosen"],
                )

    return run


def _narrowed(span: int, length: int, then: int):
    """Keep the spans whose window of ``length`` repeats; choose windows of length ``then``."""

    def run(batches):
        for batch in batches:
            for first, texts in w.pieces(batch.column("text")):
                table = w.words(texts)
                known = None if "alive" not in batch.schema.names else _lists(batch, "alive", first, len(texts))
                at = _alive(table, span, known)
                # A window repeats or not whatever the document, so the lists can be joined.
                repeated = np.unique(_lists(batch, "repeated", first, len(texts)).flatten().to_numpy()).view(np.uint64)
                at = at[np.isin(_smallest_inside(table.hashes, span, length)[at], repeated)]
                part = batch.slice(first, len(texts))
                columns = [part.column("id"), part.column("text_key"), part.column("text"), _pairs(table, at)]
                names = ["id", "text_key", "text", "alive"]
                if then < span:
                    columns.append(_chosen(table, at, span, then))
                    names.append("chosen")
                out = pa.RecordBatch.from_arrays(columns, names=names)
                yield out.filter(pa.array(np.diff(out.column("alive").offsets.to_numpy()) > 0))

    return run


def _full_windows(span: int):
    """Every living window of the full length, under a hash of 128 bits."""

    def run(batches):
        for batch in batches:
            for first, texts in w.pieces(batch.column("text"), 1 << 20):
                table = w.words(texts)
                at = _alive(table, span, _lists(batch, "alive", first, len(texts)))
                owner = np.searchsorted(table.bounds, at, "right") - 1
                part = batch.slice(first, len(texts))
                rows = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(rows),
                        part.column("text_key").take(rows),
                        pa.array(w.window_hashes(table.hashes, span, seed=2)[at].view(np.int64)),
                        pa.array(w.window_hashes(table.hashes, span, seed=3)[at].view(np.int64)),
                        pa.array((at - table.bounds[owner]).astype(np.int32)),
                    ],
                    names=["id", "text_key", "h", "h2", "at"],
                )

    return run


def _removed(span: int):
    """Count and digest what is left of each document once repeated windows are cut out."""

    def run(batches):
        for batch in batches:
            out = {"id": [], "text_key": [], "n_removed": [], "kept": [], "spans": []}
            for row in batch.to_pylist():
                own = row["text"].encode().split()
                gone = np.zeros(len(own) + 1, np.int64)
                starts = np.asarray(row["starts"])
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + span, -1)
                gone = np.cumsum(gone)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                kept = b" ".join([x for x, g in zip(own, gone.tolist(), strict=True) if not g])
                for name, value in zip(out, (row["id"], row["text_key"], int(gone.sum()), hashlib.sha256(kept).digest(), edges.tolist()), strict=True):
                    out[name].append(value)
            types = {"n_removed": pa.int64(), "kept": pa.binary(), "spans": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, types.get(k, batch.schema.field(k).type if k in batch.schema.names else None)) for k, v in out.items()],
                names=list(out),
            )

    return run


def _repeated(chosen: DataFrame) -> DataFrame:
    """Per document, those of its chosen windows that documents of two ids or more have."""
    rows = materialize(chosen.select("id", "text_key", F.explode("chosen").alias("h")), "windows")
    # Counted before the shuffle; stored, so that a very frequent window can be split in the join.
    found = materialize(
        rows.groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("h"), "repeated"
    )
    return rows.join(found, "h").groupBy("id", "text_key").agg(F.collect_set("h").alias("repeated"))


def repeated_spans(
    df: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text", shortest: int = SHORTEST
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_words, n_removed, kept_sha256, spans, text_key``.

    A word is removed if a window of ``window`` words that covers it also starts in a
    document of smaller id. ``spans`` holds the word positions of what is removed as
    ``start, end`` pairs (null: nothing or everything), ``kept_sha256`` the words that stay,
    joined by one space. Null, empty and blank texts have no words. Texts with fewer words
    than a window lose nothing. Rows of one id never remove each other's words, so repeated
    rows agree. Rows with a null id are kept whole and remove nothing. Texts may be of any
    length. An empty table gives no rows.
    """
    docs = df.select(column(id_column).alias("id"), F.coalesce(column(text_column), F.lit("")).alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    kind = dict(docs.dtypes)["id"]
    key, keys = ["id", "text_key"], f"id {kind}, text_key bigint"
    lengths = levels(window, shortest)
    if len(lengths) == 1:
        lengths.insert(0, window)  # too short to halve: the full length is looked at twice

    first = materialize(
        docs.mapInArrow(_first_pass(window, lengths[0]), f"{keys}, n_words bigint, sha binary, chosen array<bigint>"),
        "first-level",
    )
    classes = materialize(
        first.filter(f"id is not null and n_words >= {window}").groupBy("sha")
        .agg(F.min("id").alias("leader"), F.max("id").alias("b")).filter("leader < b").drop("b"),
        "equal-documents",
    )
    led = first.drop("chosen").join(classes, "sha", "left").withColumn("copy", F.coalesce(F.col("id") > F.col("leader"), F.lit(False)))
    led = materialize(led, "led")
    alone = first.filter(f"id is not null and n_words >= {window}").join(led.filter("copy").select(*key).distinct(), key, "left_anti")

    survivors, living, length = _repeated(alone), docs, lengths[0]
    for longer in lengths[1:]:
        more = ", chosen array<bigint>" if longer < window else ""
        survivors = materialize(survivors, "survivors")
        near = narrowed(living, survivors.select(*key))
        living = materialize(
            near.join(survivors, key).mapInArrow(
                _narrowed(window, length, longer), f"{keys}, text string, alive array<int>{more}"
            ),
            "living",
        )
        if longer < window:
            if living.isEmpty():
                break
            survivors, length = _repeated(living), longer
            living = living.drop("chosen")
    if "alive" not in living.columns:
        return _answer(led, None)
    windows = materialize(
        living.mapInArrow(_full_windows(window), f"{keys}, h bigint, h2 bigint, at int"), "full-windows"
    )
    origins = materialize(
        windows.groupBy("h", "h2").agg(F.min("id").alias("origin"), F.max("id").alias("b")).filter("origin < b").drop("b"),
        "origins",
    )
    starts = windows.join(origins, ["h", "h2"]).filter("id > origin").groupBy(*key).agg(F.collect_set("at").alias("starts"))
    cut = living.select(*key, "text").dropDuplicates(key).join(starts, key)
    return _answer(led, cut.mapInArrow(_removed(window), f"{keys}, n_removed bigint, kept binary, spans array<int>"))


def _answer(led: DataFrame, cut: DataFrame | None) -> DataFrame:
    if cut is None:
        none = {"n_removed": "bigint", "kept": "binary", "spans": "array<int>"}
        joined = led.withColumns({k: F.lit(None).cast(v) for k, v in none.items()})
    else:
        joined = led.join(cut, ["id", "text_key"], "left")
    removed = F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    kept = F.when(F.col("copy"), F.lit(_EMPTY)).otherwise(F.coalesce("kept", "sha"))
    return joined.select(
        F.col("id").alias("doc_id"), "n_words", removed.cast("bigint").alias("n_removed"),
        F.lower(F.hex(kept)).alias("kept_sha256"), "spans", "text_key",
    )


def without_repeats(df: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``df`` with the removed words cut out of the texts that lose any; other texts stay as they are."""
    found = repeated_spans(df, window, id_column, text_column).filter("n_removed > 0")
    cut = found.select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("spans").alias("_spans")
    ).dropDuplicates(["_id", "_key"])
    text = column(text_column)
    own = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    outside = F.filter(
        own, lambda x, i: ~F.exists(F.sequence(F.lit(0), F.size("_spans") - 2, F.lit(2)), lambda p: (F.get("_spans", p) <= i) & (F.get("_spans", p + 1) > i))
    )
    left = F.when(F.col("_spans").isNull(), "").otherwise(F.array_join(outside, " "))
    joined = df.join(cut, (column(id_column) == F.col("_id")) & (F.xxhash64(text) == F.col("_key")), "left")
    return joined.withColumn(text_column, F.when(F.col("_id").isNull(), text).otherwise(left)).select(*[column(c) for c in df.columns])
