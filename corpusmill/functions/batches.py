"""Arrow functions that look at a bounded piece of a record batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import functions as F

# Bytes of a piece whose values become NumPy arrays, and of one whose values become Python objects.
PIECE_BYTES = 1 << 20
OBJECT_BYTES = 1 << 17


def pieces(columns: tuple[pa.Array, ...], size: int) -> Iterator[tuple[pa.Array, ...]]:
    """Slices of the columns that hold at most ``size`` bytes, or a single row."""
    rows = len(columns[0])
    if rows < 2 or sum(c.nbytes for c in columns) <= size:
        yield columns
        return
    half = rows // 2
    yield from pieces(tuple(c.slice(0, half) for c in columns), size)
    yield from pieces(tuple(c.slice(half) for c in columns), size)


def piecewise(return_type, size: int = PIECE_BYTES) -> Callable:
    """``arrow_udf`` whose function gets one piece after another instead of whole batches.

    A record batch holds up to 10,000 rows or 64 MB, and what a function makes of it may be
    many times as large; so only one piece and its result are in memory beside the batch.
    """

    def decorate(function: Callable[..., pa.Array]):
        def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for batch in batches:
                for piece in pieces(batch if isinstance(batch, tuple) else (batch,), size):
                    yield function(*piece)

        return F.arrow_udf(run, return_type)

    return decorate
