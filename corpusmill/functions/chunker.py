"""Row helper behind the recursive chunker: which pieces of one text form a chunk.

The choice of separator depends on what is left of the text at each level, which
column expressions cannot follow; Spark runs this helper on Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import accumulate, groupby, pairwise
from typing import NamedTuple


class Separator(NamedTuple):
    source: str
    pattern: re.Pattern | None  # None splits into single characters


class ChunkRules(NamedTuple):
    size: int
    overlap: int
    separators: list[Separator]
    keep: str | None  # "start", "end" or None
    strip: bool
    length: Callable[[str], int]


def rules(
    size: int,
    overlap: int,
    separators: list[str],
    keep: str | None,
    is_regex: bool,
    strip: bool,
    length: Callable[[str], int],
) -> ChunkRules:
    compiled = [
        Separator(s, re.compile(s if is_regex else re.escape(s)) if s else None) for s in separators
    ]
    return ChunkRules(size, overlap, compiled, keep, strip, length)


def cut(text: str, separator: Separator, keep: str | None) -> list[str]:
    """Non-empty pieces of ``text`` around the matches of ``separator``."""
    if separator.pattern is None:
        return list(text)
    matches = separator.pattern.finditer(text)
    if keep is None:
        spans, left = [], 0
        for match in matches:
            spans.append((left, match.start()))
            left = match.end()
        spans.append((left, len(text)))
    else:
        marks = [m.start() if keep == "start" else m.end() for m in matches]
        spans = pairwise([0, *marks, len(text)])
    return [text[a:b] for a, b in spans if a < b]


def merge(pieces: list[str], glue: str, r: ChunkRules) -> Iterator[str]:
    """Join neighbouring pieces up to the chunk size, repeating up to the overlap.

    The open chunk is ``pieces[first:i]``; prefix sums give the width of any range.
    """
    glue_length = r.length(glue)
    upto = [0, *accumulate(r.length(p) for p in pieces)]

    def width(a: int, b: int) -> int:
        return upto[b] - upto[a] + glue_length * (b - a - 1) if b > a else 0

    def joined(a: int, b: int) -> str:
        chunk = glue.join(pieces[a:b])
        return chunk.strip() if r.strip else chunk

    first = 0
    for i in range(len(pieces)):
        if first < i and width(first, i + 1) > r.size:
            yield joined(first, i)
            while first < i and (
                width(first, i) > r.overlap or (width(first, i + 1) > r.size and width(first, i) > 0)
            ):
                first += 1
    yield joined(first, len(pieces))


def chunks(text: str, r: ChunkRules, level: int = 0) -> Iterator[str]:
    """Chunks of ``text``; pieces that are too long move on to the next separator."""
    last = len(r.separators) - 1
    chosen = next(
        (
            i
            for i in range(level, last + 1)
            if r.separators[i].pattern is None or r.separators[i].pattern.search(text)
        ),
        None,
    )
    separator = r.separators[last if chosen is None else chosen]
    exhausted = chosen is None or chosen == last or separator.pattern is None
    glue = "" if r.keep else separator.source
    pieces = cut(text, separator, r.keep)
    for fits, group in groupby(pieces, key=lambda p: r.length(p) < r.size):
        if fits:
            yield from filter(None, merge(list(group), glue, r))
        elif exhausted:
            yield from group
        else:
            for piece in group:
                yield from chunks(piece, r, chosen + 1)


def located_chunks(text: str, r: ChunkRules) -> Iterator[tuple[str, int]]:
    """Chunks with the position where each was found, searching on from the previous one."""
    found, previous = 0, 0
    for chunk in chunks(text, r):
        found = text.find(chunk, max(0, found + previous - r.overlap))
        previous = len(chunk)
        yield chunk, found
