"""Benchmark items found inside documents of any length, by containment of word shingles.

Items are partitioned by the number of their shingles. For each size class the number of
MinHash minima that an item is searched by follows from the threshold: an item of ``q``
shingles of which a document holds ``c`` or more has one of its ``q - c + 1`` smallest
among those the document holds. So a document that holds none of an item's minima can't
contain it, however long the document is, and no contained item is lost. Documents that
hold a minimum are compared with the item on the words of all shingles.

Items are taken in blocks of bounded size; each block is broadcast and all documents pass it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words as w
from corpusmill.llm.common import WORD, column, picked
from corpusmill.session import materialize

SHINGLE = 5
THRESHOLD_PERCENT = 80
BLOCK_BYTES = 16 << 20
_WORD = re.compile(WORD)
_UPPER = {c: c + 32 for c in range(65, 91)}
_MASK = np.uint64((1 << 22) - 1)


def needed(size: int, percent: int) -> int:
    """Smallest count of shared shingles that reaches the threshold."""
    return max(1, -(-size * percent // 100))


def minima(size: int, percent: int) -> int:
    """Minima searched for by all items of the size class (powers of two) of ``size``."""
    largest = 1 << (size - 1).bit_length()
    return largest - needed(largest, percent) + 1


class Sketch(NamedTuple):
    """Minima of a block of items, by shingle length (below ``SHINGLE``: whole short items)."""

    keys: dict[int, np.ndarray]  # sorted minima
    items: dict[int, np.ndarray]  # item of each
    seen: dict[int, np.ndarray]  # low bits of the minima, to pass over most shingles quickly
    texts: list[str]


def _sketch(texts: list[str], percent: int) -> Sketch:
    table = w.words(pa.array(texts, pa.string()), fold=True)
    hashes, bounds = w.shingles(table, SHINGLE)
    counts = np.diff(table.bounds)
    found: dict[int, list[tuple[np.ndarray, int]]] = {}
    for i in np.flatnonzero(counts):
        own = hashes[bounds[i] : bounds[i + 1]]
        smallest = own[: minima(len(own), percent)]  # shingles are sorted by hash in a text
        found.setdefault(min(SHINGLE, int(counts[i])), []).append((smallest, int(i)))
    keys, items, seen = {}, {}, {}
    for length, parts in found.items():
        flat = np.concatenate([p for p, _ in parts])
        owner = np.concatenate([np.full(len(p), i) for p, i in parts])
        order = np.argsort(flat, kind="stable")
        keys[length], items[length] = flat[order], owner[order]
        seen[length] = np.zeros(int(_MASK) + 1, bool)
        seen[length][(flat & _MASK).astype(np.int64)] = True
    return Sketch(keys, items, seen, texts)


def _shingle_set(text: str) -> set[tuple[str, ...]]:
    own = _WORD.findall(text.translate(_UPPER))
    length = min(SHINGLE, len(own))
    return {tuple(own[i : i + length]) for i in range(len(own) - length + 1)} if own else set()


def _holds(words: list[str], item: set[tuple[str, ...]]) -> int:
    length = len(next(iter(item)))
    return len({s for i in range(len(words) - length + 1) if (s := tuple(words[i : i + length])) in item})


def matches(texts: pa.Array, sketch: Sketch, percent: int) -> list[tuple[int, int, int, int]]:
    """``(row, item, shingles of the item, shingles shared)`` of all contained items."""
    found = []
    sets: dict[int, set[tuple[str, ...]]] = {}
    for first, piece in w.pieces(texts):
        table = w.words(piece, fold=True)
        pairs = set()
        for length, keys in sketch.keys.items():
            hashes = w.window_hashes(table.hashes, length, seed=1 if length == SHINGLE else 9)
            at = np.flatnonzero(sketch.seen[length][(hashes & _MASK).astype(np.int64)])
            at = at[table.windows(length)[at]]
            low = np.searchsorted(keys, hashes[at], "left")
            high = np.searchsorted(keys, hashes[at], "right")
            rows = np.searchsorted(table.bounds, at[high > low], "right") - 1
            for row, a, b in zip(rows.tolist(), low[high > low], high[high > low], strict=True):
                pairs.update((row, int(i)) for i in sketch.items[length][a:b])
        held = None
        for row, item in sorted(pairs):
            if held is None or held[0] != row:
                held = (row, _WORD.findall(piece[row].as_py().translate(_UPPER)))
            if item not in sets:
                sets[item] = _shingle_set(sketch.texts[item])
            shared = _holds(held[1], sets[item])
            if shared >= needed(len(sets[item]), percent):
                found.append((first + row, item, len(sets[item]), shared))
    return found


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of the items, block by block; a block is about ``block_bytes`` of text."""
    stored = materialize(items.filter("text is not null"), "items")
    size = stored.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = -(-size // block_bytes)
    for block in range(n):
        own = stored.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block).toArrow()
        if own.num_rows:
            yield own.column("id").to_pylist(), own.column("text").to_pylist()


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    percent: int = THRESHOLD_PERCENT,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment`` of all items found in documents.

    Words are lower-cased (A-Z); an item's set is its distinct five-word shingles, or its
    whole sequence if it is shorter. It is found in a document that holds at least
    ``percent`` of the set. Null, empty and blank texts hold nothing and are not found.
    Every repeated row of a document or an item gives rows of its own; null ids are
    carried. Without items or documents the result is empty.
    """
    rows = picked(docs, id=id_column, text=text_column)
    chosen = picked(items, id=item_id, text=item_text)
    kinds = dict(rows.dtypes) | {"item": dict(chosen.dtypes)["id"]}
    schema = f"doc_id {kinds['id']}, item_id {kinds['item']}, n_shingles bigint, n_shared bigint, containment double"
    spark, parts = docs.sparkSession, []
    for ids, texts in _blocks(chosen, block_bytes):
        shared = spark.sparkContext.broadcast((ids, _sketch(texts, percent)))  # bounded by the block

        def search(batches, shared=shared):
            item_ids, sketch = shared.value
            for batch in batches:
                found = matches(batch.column("text"), sketch, percent)
                at = pa.array([f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(at),
                        pa.array([item_ids[f[1]] for f in found]),
                        pa.array([f[2] for f in found], pa.int64()),
                        pa.array([f[3] for f in found], pa.int64()),
                        pa.array([f[3] / f[2] for f in found], pa.float64()),
                    ],
                    names=["doc_id", "item_id", "n_shingles", "n_shared", "containment"],
                )

        parts.append(rows.mapInArrow(search, schema))
    result = spark.createDataFrame([], schema)
    for part in parts:
        result = result.unionByName(part)
    return result


def without_items(
    docs: DataFrame,
    items: DataFrame,
    percent: int = THRESHOLD_PERCENT,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents, with all columns, that contain no item; decided where they are read."""
    spark = docs.sparkSession
    for _, texts in _blocks(picked(items, id=item_id, text=item_text), block_bytes):
        docs = docs.filter(~_holds_any(spark, texts, percent)(F.coalesce(column(text_column), F.lit(""))))
    return docs


def _holds_any(spark, texts: list[str], percent: int):
    shared = spark.sparkContext.broadcast(_sketch(texts, percent))

    @F.arrow_udf("boolean")
    def holds(values: pa.Array) -> pa.Array:
        found = np.zeros(len(values), bool)
        found[[f[0] for f in matches(values, shared.value, percent)]] = True
        return pa.array(found)

    def call(text: Column) -> Column:
        return holds(text)

    return call
