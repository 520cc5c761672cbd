"""Cutting documents into overlapping chunks."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import chunker
from corpusmill.functions import text as tx
from corpusmill.functions.batches import OBJECT_BYTES, piecewise
from corpusmill.functions.binding import let
from corpusmill.functions.separators import (
    DEFAULT_SEPARATORS,
    LANGUAGE_SEPARATORS,
    separators_for,
)

LENGTHS: dict[str, Callable[[str], int]] = {
    "chars": len,
    "words": lambda s: len(s.split()),
    "utf8_bytes": lambda s: len(s.encode()),
}
_KEEP = {True: "start", False: None, None: None, "start": "start", "end": "end"}
_CHUNK_TYPE = "array<struct<chunk:string,start_index:int>>"
# Unicode noncharacters, which text does not normally contain.
_FENCE, _FILL = "\ufdd0", "\ufdd1"


def check_sizes(size: int, overlap: int) -> None:
    if size <= 0:
        raise ValueError(f"chunk size must be > 0, got {size}")
    if overlap < 0:
        raise ValueError(f"chunk overlap must be >= 0, got {overlap}")
    if overlap > size:
        raise ValueError(f"chunk overlap ({overlap}) must not exceed the chunk size ({size})")


def split_documents(
    df: DataFrame, splitter: Callable[[Column], Column], column: str = "text", chunk: str = "chunk"
) -> DataFrame:
    """One row per chunk with ``chunk_index``; all other columns ride along.

    ``splitter`` maps the text column to an array of strings, or to an array of
    structs whose fields become columns.
    """
    others = [F.col(c) for c in df.columns if c != column]
    parts = df.select(*others, F.posexplode(splitter(F.col(column))).alias("chunk_index", "_part"))
    field = parts.schema["_part"].dataType
    unpacked = F.col("_part.*") if hasattr(field, "fields") else F.col("_part").alias(chunk)
    return parts.select(*[c for c in df.columns if c != column], "chunk_index", unpacked)


def _quoted(separator: str) -> str:
    return "".join("\\" + c if not c.isalnum() and ord(c) < 128 else c for c in separator)


def separated(
    separator: str, keep: bool | str | None = False, is_regex: bool = False
) -> Callable[[Column], Column]:
    """Splitter at every match of ``separator``; empty pieces are dropped.

    The separator is dropped, or kept at the ``"start"`` or ``"end"`` of a piece.
    An empty separator yields single characters.
    """
    if keep not in _KEEP:
        raise ValueError(f"keep must be a boolean, 'start' or 'end', got {keep!r}")
    side = _KEEP[keep]
    pattern = separator if is_regex else _quoted(separator)

    def split(text: Column) -> Column:
        if not separator:
            pieces = F.split(text, "")
        else:
            pieces = let(_unused_marker(text), lambda marker: F.split(marked(text, marker), marker))
        return F.filter(pieces, lambda p: p != "")

    def marked(text: Column, marker: Column) -> Column:
        sides = {None: [marker], "start": [marker, F.lit("$0")], "end": [F.lit("$0"), marker]}
        return F.regexp_replace(text, F.lit(pattern), F.concat(*sides[side]))

    return split


def _unused_marker(text: Column) -> Column:
    """A string that does not occur in the text, so that splitting at it is exact.

    Between two fences stand more fill characters than the text holds anywhere in a row.
    """
    runs = F.transform(F.regexp_extract_all(text, F.lit(f"{_FILL}+"), F.lit(0)), F.length)
    longest = F.when(F.contains(text, F.lit(_FILL)), F.array_max(runs)).otherwise(0)
    return F.concat(F.lit(_FENCE), F.repeat(F.lit(_FILL), longest + 1), F.lit(_FENCE))


def recursive(
    size: int = 4000,
    overlap: int = 200,
    separators: list[str] | None = None,
    keep: bool | str | None = True,
    is_regex: bool = False,
    strip: bool = True,
    length: str | Callable[[str], int] = "chars",
    language: str | Column | None = None,
) -> Callable[[Column], Column]:
    """Recursive splitter yielding ``(chunk, start_index)``.

    ``language`` picks a separator preset, either one for all rows or per row from
    a column. ``length`` measures pieces: a name from ``LENGTHS`` or a function.
    """
    check_sizes(size, overlap)
    if keep not in _KEEP:
        raise ValueError(f"keep must be a boolean, 'start' or 'end', got {keep!r}")
    measure = LENGTHS[length] if isinstance(length, str) else length
    options = {"keep": _KEEP[keep], "strip": strip, "length": measure}
    if isinstance(language, str):
        separators, is_regex = separators_for(language), True
    chosen = separators or DEFAULT_SEPARATORS

    @piecewise(_CHUNK_TYPE, OBJECT_BYTES)
    def split_one(texts: pa.Array) -> pa.Array:
        r = chunker.rules(size, overlap, chosen, is_regex=is_regex, **options)
        return _chunk_lists(texts, (r for _ in range(len(texts))))

    @piecewise(_CHUNK_TYPE, OBJECT_BYTES)
    def split_by_language(texts: pa.Array, languages: pa.Array) -> pa.Array:
        known = {
            name: chunker.rules(size, overlap, separators_for(name), is_regex=True, **options)
            for name in languages.unique().to_pylist()
        }
        return _chunk_lists(texts, (known[name] for name in languages.to_pylist()))

    if isinstance(language, Column):
        return lambda text: split_by_language(text, language)
    return split_one


def _chunk_lists(texts: pa.Array, rules_per_row) -> pa.Array:
    offsets, chunk_values, starts = [0], [], []
    for text, r in zip(texts.to_pylist(), rules_per_row):
        for chunk, start in chunker.located_chunks(text, r) if text is not None else ():
            chunk_values.append(chunk)
            starts.append(start)
        offsets.append(len(starts))
    rows = pa.StructArray.from_arrays(
        [pa.array(chunk_values, pa.string()), pa.array(starts, pa.int32())], ["chunk", "start_index"]
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)


def token_windows(tokens: Column, size: int, overlap: int = 0) -> Column:
    """Overlapping windows over a token array; the last one ends with the tokens.

    Stops at the first window that reaches the end, so no window is a mere tail of
    the one before. An overlap equal to the size would never advance and is refused.
    """
    check_sizes(size, overlap)
    if overlap == size:
        raise ValueError("the overlap of token windows must be smaller than their size")
    step = size - overlap

    def windows(all_tokens: Column) -> Column:
        count = F.size(all_tokens)
        more = F.greatest(F.ceil((count - size) / F.lit(step)).cast("int"), F.lit(0))
        starts = F.when(count > 0, F.sequence(F.lit(0), more)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.slice(all_tokens, i * step + 1, F.lit(size)))

    return let(tokens, windows)


def word_windows(size: int = 4000, overlap: int = 200) -> Callable[[Column], Column]:
    """Splitter into windows of words that are slices of the text.

    A word holds the whitespace before it, the last one also that at the end of the text,
    so windows without an overlap are the text when put together. A text of whitespace
    alone counts as one word.
    """
    check_sizes(size, overlap)
    space, other = f"[{tx.WHITESPACE_CLASS}]", f"[^{tx.WHITESPACE_CLASS}]"
    pattern = f"{space}*+{other}++(?:{space}++\\z)?|{space}++\\z"
    spaced = lambda text: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return lambda text: F.transform(
        token_windows(spaced(text), size, overlap), lambda w: F.array_join(w, "")
    )
