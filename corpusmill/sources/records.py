"""Records of delimited files that are read in blocks, wherever their quotes begin and end.

A quoted value may hold line breaks, so a block of a file does not know on its own whether
it starts inside one. Two passes find out without reading from the top. The first runs
over the lines of each block for both cases and leaves what it ends with: a function of
one bit. Chaining these functions over a file's blocks, a running sum of one row for each
block, tells how every block starts and how many records precede it. The second pass then
parses all blocks side by side; only the pieces of records cut by a block's end meet in a
shuffle.
"""

from __future__ import annotations

import codecs
import csv
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.session import materialize
from corpusmill.sources.files import BROADCAST_BLOCKS, with_scan_position

_LINES = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+")
_BATCH_BYTES = 4 << 20


class Dialect:
    """How one kind of file marks values, and in which encoding."""

    def __init__(self, delimiter: str, quotechar: str, encoding: str, autodetect: bool):
        self.delimiter, self.quotechar = delimiter, quotechar
        self.encoding, self.autodetect = codecs.lookup(encoding).name, autodetect
        # Blocks are cut at line feeds, which must be single bytes; other files are one block.
        self.by_lines = all(chr(i).encode(self.encoding) == bytes([i]) for i in range(128))
        d, q = re.escape(delimiter), re.escape(quotechar)
        quoted = f"{q}(?:[^{q}]++|{q}{q})*+{q}"
        self.whole = re.compile(f"(?:(?:{quoted}[^{d}]*+|[^{q}{d}][^{d}]*+|){d})*+")
        self.value, self.rest = re.compile(quoted), re.compile(f"(?:[^{q}]++|{q}{q})*+{q}[^{d}]*+(?:{d}|$)")

    def text(self, raw: bytes, where: str) -> str:
        try:
            return raw.decode(self.encoding)
        except UnicodeDecodeError:
            if self.autodetect:
                return raw.decode("iso-8859-1")
            raise ValueError(f"cannot decode {where}") from None

    def stays_open(self, line: str, inside: bool) -> bool:
        """Whether a quoted value is open after ``line``, given whether one is before it."""
        at = 0
        if inside:
            closing = self.rest.match(line)
            if closing is None:
                return True
            at = closing.end()
            if not closing.group().endswith(self.delimiter):
                return False
        at = self.whole.match(line, at).end()
        return line.startswith(self.quotechar, at) and self.value.match(line, at) is None

    def parsed(self, lines: Iterator[str]) -> Iterator[list[str]]:
        csv.field_size_limit(2**31 - 1)
        return csv.reader(lines, delimiter=self.delimiter, quotechar=self.quotechar)


def _lines(text: str, by_lines: bool) -> list[str]:
    """Physical lines with their ends; a row of the scan has lost its line feed."""
    if by_lines and "\r" not in text:
        return [text + "\n"]
    return _LINES.findall(text + "\n" if by_lines else text)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[pa.RecordBatch]]]:
    """The batches, cut where another block of a file begins: ``(file, block, batches)``."""
    pieces = _cut(batches)
    ahead = next(pieces, None)
    while ahead is not None:
        key = ahead[0]

        def own(key=key):
            nonlocal ahead
            while ahead is not None and ahead[0] == key:
                part = ahead[1]
                ahead = None
                yield part
                ahead = next(pieces, None)

        mine = own()
        yield *key, mine
        for _ in mine:  # what the caller left
            pass


def _cut(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column("file_path"), batch.column("_block")
        which = files.dictionary_encode().indices.to_numpy()
        change = np.flatnonzero((np.diff(which) != 0) | (np.diff(blocks.to_numpy()) != 0)) + 1
        for a, b in zip([0, *change], [*change, batch.num_rows], strict=True):
            yield (files[int(a)].as_py(), blocks[int(a)].as_py()), batch.slice(a, b - a)


def _summed(dialect: Dialect):
    """Of each block, for a start outside and inside a value: its end, its records; its first record."""

    def run(batches):
        for file, block, parts in _blocks(batches):
            state, count = [False, True], [0, 0]
            first, open_first = [], True
            for part in parts:
                values = part.column("value")
                if dialect.by_lines:
                    quoted = pc.match_substring(values, dialect.quotechar.encode(dialect.encoding)).to_numpy(zero_copy_only=False)
                    returns = pc.find_substring(values, b"\r").to_numpy()
                    inner = (returns >= 0) & (returns < pc.binary_length(values).to_numpy() - 1)
                    special = np.flatnonzero(quoted | inner)
                    blank = pc.or_(pc.equal(values, b""), pc.equal(values, b"\r")).to_numpy(zero_copy_only=False)
                else:
                    special, blank = np.arange(len(values)), np.zeros(len(values), bool)
                full = np.concatenate([[0], np.cumsum(~blank)])
                if block == 0 and open_first:
                    for raw in values:
                        for line in _lines(dialect.text(raw.as_py(), file), dialect.by_lines):
                            if open_first and (first or line.strip("\r\n")):
                                inside = dialect.stays_open(line, bool(first))
                                first.append(line)
                                open_first = inside
                        if not open_first:
                            break
                at = 0
                before, places = full.tolist(), special.tolist()
                for i, raw in zip(places, values.take(pa.array(special)).to_pylist(), strict=True):
                    for s in (0, 1):
                        if not state[s]:
                            count[s] += before[i] - before[at]
                    for line in _lines(dialect.text(raw, file), dialect.by_lines):
                        for s in (0, 1):
                            count[s] += not state[s] and bool(line.strip("\r\n"))
                        # Most often both cases agree after a few lines, and then for good.
                        known = {inside: dialect.stays_open(line, inside) for inside in set(state)}
                        state = [known[inside] for inside in state]
                    at = i + 1
                for s in (0, 1):
                    if not state[s]:
                        count[s] += int(full[-1] - full[at])
            header = next(dialect.parsed(iter(first)), None) if first and not open_first else None
            yield pa.RecordBatch.from_pydict({
                "file_path": [file], "_block": pa.array([block], pa.int64()),
                "end_outside": [state[0]], "end_inside": [state[1]],
                "rows_outside": pa.array([count[0]], pa.int64()), "rows_inside": pa.array([count[1]], pa.int64()),
                "header": pa.array([header], pa.list_(pa.string())),
            })

    return run


_PIECES = "file_path string, row bigint, fields array<string>, _block bigint, _begins boolean, _raw string"


class _Rows:
    """Output rows, handed on in batches of bounded size."""

    def __init__(self, file: str, block: int, row: int):
        self.file, self.block, self.row = file, block, row
        self.rows, self.size = [], 0

    def add(self, fields: list[str] | None, begins: bool | None = None, raw: str | None = None) -> bool:
        self.rows.append((self.row, fields, begins, raw))
        self.row += begins is not False
        self.size += sum(map(len, fields)) + 8 * len(fields) if fields is not None else len(raw)
        return self.size > _BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        row, fields, begins, raw = zip(*self.rows, strict=True)
        n = len(self.rows)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_pydict({
            "file_path": [self.file] * n, "row": pa.array(row, pa.int64()), "fields": pa.array(fields, pa.list_(pa.string())),
            "_block": pa.array([self.block] * n, pa.int64()), "_begins": pa.array(begins, pa.bool_()), "_raw": pa.array(raw, pa.string()),
        })


def _parsed(dialect: Dialect):
    """Whole records as ``fields``; what a block's end cuts as ``_raw``, with whether it begins a record."""

    def run(batches):
        for file, block, parts in _blocks(batches):
            first = next(parts)
            inside, before = first.column("_inside")[0].as_py(), first.column("_before")[0].as_py()
            out = _Rows(file, block, before)
            state, held = inside, []

            def lines(first=first, parts=parts):
                nonlocal state
                for part in (p for group in ((first,), parts) for p in group):
                    for raw in part.column("value").to_pylist():
                        for line in _lines(dialect.text(raw, file), dialect.by_lines):
                            if state or dialect.quotechar in line:
                                state = dialect.stays_open(line, state)
                                held.append(line)
                            yield line

            feed = lines()
            if inside:  # the end of a record that an earlier block began
                tail = []
                for line in feed:
                    tail.append(line)
                    if not state:
                        break
                out.add(None, False, "".join(tail))
                held.clear()
            for fields in dialect.parsed(feed):
                if state:  # the block ends inside this record
                    out.add(None, True, "".join(held))
                elif fields and out.add(fields):
                    yield out.batch()
                held.clear()
            if out.rows:
                yield out.batch()

    return run


def _joined(dialect: Dialect):
    def run(batches):
        for batch in batches:
            fields = [next(dialect.parsed(iter(_LINES.findall(raw))), []) for raw in batch.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("file_path"), batch.column("row"), pa.array(fields, pa.list_(pa.string()))],
                ["file_path", "row", "fields"],
            )

    return run


def _starts(blocks: DataFrame) -> DataFrame:
    """How each block starts (``_inside``) and the records before it (``_before``), by chaining."""
    earlier = Window.partitionBy("file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    # A block forgets how it started, keeps it, or turns it round.
    fixed = F.col("end_outside") == F.col("end_inside")
    turns = (F.col("end_outside") & ~F.col("end_inside")).cast("int")
    chained = blocks.withColumn("_turned", F.sum(turns).over(upto)).withColumn("_fixed", F.when(fixed, F.struct("end_outside", "_turned")))
    last = F.last("_fixed", ignorenulls=True).over(earlier)
    since = F.coalesce(F.last("_turned").over(earlier), F.lit(0)) - F.coalesce(last["_turned"], F.lit(0))
    inside = (F.coalesce(last["end_outside"].cast("int"), F.lit(0)) + since) % 2 == 1
    known = chained.withColumn("_inside", inside)
    rows = F.when(F.col("_inside"), F.col("rows_inside")).otherwise(F.col("rows_outside"))
    counted = known.withColumn("_before", F.coalesce(F.sum(rows).over(earlier), F.lit(0)))
    return counted.select("file_path", "_block", "_inside", "_before")


def delimited_records(spark: SparkSession, paths, dialect: Dialect) -> tuple[DataFrame, DataFrame]:
    """``(file_path, row, fields)`` of every record, and ``(file_path, header)`` of every file.

    Rows count the records of a file from 0, its header included; blank lines are none.
    Values are those of Python's ``csv`` module. A file without records has no header.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    scan = reader.text(paths, lineSep="\n") if dialect.by_lines else reader.text(paths, wholetext=True)
    lines = with_scan_position(scan).select(
        "file_path", "_block", "_position", F.col("value").cast("binary").alias("value")
    )
    schema = (
        "file_path string, _block bigint, end_outside boolean, end_inside boolean, rows_outside bigint, "
        "rows_inside bigint, header array<string>"
    )
    blocks = materialize(lines.select("file_path", "_block", "value").mapInArrow(_summed(dialect), schema), "csv-blocks")
    starts = materialize(_starts(blocks), "csv-starts")
    if starts.count() <= BROADCAST_BLOCKS:
        placed = lines.join(F.broadcast(starts), ["file_path", "_block"])
    else:
        placed = lines.join(starts, ["file_path", "_block"]).sortWithinPartitions("file_path", "_block", "_position")
    pieces = placed.select("file_path", "_block", "value", "_inside", "_before").mapInArrow(_parsed(dialect), _PIECES)
    # At most two pieces of each block are cut; only they are parsed again when joined.
    opened = starts.filter("_inside").select("file_path").distinct()
    whole = pieces.filter("fields IS NOT NULL").select("file_path", "row", "fields")
    records = whole
    if not opened.isEmpty():
        cut = materialize(pieces.filter("fields IS NULL").select("file_path", "row", "_block", "_begins", "_raw"), "csv-cuts")
        order = Window.partitionBy("file_path").orderBy("_block", "_begins").rowsBetween(Window.unboundedPreceding, 0)
        numbered = cut.withColumn("_record", F.count_if("_begins").over(order))
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_raw"))), lambda x: x["_raw"]), "")
        joined = numbered.groupBy("file_path", "_record").agg(F.min_by("row", "_block").alias("row"), text.alias("raw"))
        records = whole.unionByName(joined.select("file_path", "row", "raw").mapInArrow(_joined(dialect), "file_path string, row bigint, fields array<string>"))
    else:
        ends = pieces.filter("fields IS NULL").select("file_path", "row", F.col("_raw").alias("raw"))
        lasting = blocks.filter("end_outside").select("file_path").distinct()
        if not lasting.isEmpty():  # a value that is never closed ends with its file
            records = whole.unionByName(ends.mapInArrow(_joined(dialect), "file_path string, row bigint, fields array<string>"))
    headers = blocks.filter("_block = 0 AND header IS NOT NULL").select("file_path", "header")
    cut_headers = blocks.filter("_block = 0 AND header IS NULL AND rows_outside > 0").select("file_path")
    if not cut_headers.isEmpty():  # header records longer than a block
        found = records.filter("row = 0").join(cut_headers, "file_path", "left_semi").select("file_path", F.col("fields").alias("header"))
        headers = materialize(headers.unionByName(found), "csv-headers")
    return records, headers
