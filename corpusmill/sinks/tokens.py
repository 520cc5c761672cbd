"""Raw token streams on disk: a writer and a reader as Python data sources.

A stream is a folder of headerless little-endian files. File names carry the
position of their first token, so the files in name order are the stream.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from corpusmill.operators.tokens import check_vocab_size

_DTYPES = {"uint8": "<u1", "uint16": "<u2", "uint32": "<u4"}
_SUFFIX = ".bin"


# Files that the driver renames at once.
_RENAMES = 16


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def _for_each(act, files: list) -> None:
    with ThreadPoolExecutor(_RENAMES) as pool:
        list(pool.map(act, files))


@dataclass
class WrittenFiles(WriterCommitMessage):
    names: dict[str, int]  # attempt name to first position


@dataclass
class TokenRange(InputPartition):
    file: str
    first: int
    start: int
    count: int


class TokenStreamWriter(DataSourceArrowWriter):
    """Writes ``(split, position, tokens)`` rows that arrive in order, a file per unbroken run."""

    def __init__(self, options: dict):
        self.folders = {split: path.rstrip("/") for split, path in json.loads(options["folders"]).items()}
        self.dtype = _DTYPES[options.get("dtype", "uint16")]

    def write(self, iterator) -> WrittenFiles:
        written, out, following = {}, None, None
        try:
            for batch in iterator:
                splits, positions = batch.column("split").to_pylist(), batch.column("position").to_pylist()
                for split, position, tokens in zip(splits, positions, batch.column("tokens"), strict=True):
                    values = tokens.values.to_numpy().astype(self.dtype)
                    if (split, position) != following:
                        if out is not None:
                            out.close()
                        filesystem, folder = _open(self.folders[split])
                        filesystem.create_dir(folder, recursive=True)
                        name = f"{self.folders[split]}/_attempt-{uuid.uuid4().hex}"
                        out = filesystem.open_output_stream(_open(name)[1])
                        written[name] = position
                    out.write(values.tobytes())
                    following = split, position + len(values)
        finally:
            if out is not None:
                out.close()
        return WrittenFiles(written)

    def commit(self, messages) -> None:
        def publish(attempt: tuple[str, int]) -> None:
            filesystem, name = _open(attempt[0])
            filesystem.move(name, f"{name.rpartition('/')[0]}/part-{attempt[1]:020d}{_SUFFIX}")

        _for_each(publish, [a for m in messages if m is not None for a in m.names.items()])

    def abort(self, messages) -> None:
        def drop(attempt: str) -> None:
            filesystem, name = _open(attempt)
            filesystem.delete_file(name)

        _for_each(drop, [a for m in messages if m is not None for a in m.names])


class TokenStreamReader(DataSourceReader):
    """Reads ``(position, token)`` rows, or ``(position, tokens)`` runs, from byte ranges of the files.

    Bounds on the position are pushed down to the ranges, so only files that hold wanted
    positions are opened. Spark tests all filters again.
    """

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.dtype = np.dtype(_DTYPES[options.get("dtype", "uint16")])
        self.range_tokens = int(options.get("rangetokens", 16 * 1024 * 1024))
        self.run_tokens = int(options.get("runtokens", 0))
        self.low, self.high = 0, 1 << 63  # the wanted positions, the second excluded

    def pushFilters(self, filters):
        for wanted in filters:
            if getattr(wanted, "attribute", None) == ("position",):
                if isinstance(wanted, EqualTo):
                    self._keep(wanted.value, wanted.value)
                elif isinstance(wanted, (GreaterThan, GreaterThanOrEqual)):
                    self._keep(wanted.value + isinstance(wanted, GreaterThan), self.high)
                elif isinstance(wanted, (LessThan, LessThanOrEqual)):
                    self._keep(self.low, wanted.value - isinstance(wanted, LessThan))
                elif isinstance(wanted, In) and wanted.value:
                    self._keep(min(wanted.value), max(wanted.value))
            yield wanted

    def _keep(self, first: int, last: int) -> None:
        self.low, self.high = max(self.low, first), min(self.high, last + 1)

    def partitions(self) -> list[TokenRange]:
        filesystem, folder = _open(self.path)
        info = filesystem.get_file_info(folder)
        if info.type == fs.FileType.File:
            files = [info]
        else:
            listed = filesystem.get_file_info(fs.FileSelector(folder))
            files = sorted((f for f in listed if f.path.endswith(_SUFFIX)), key=lambda f: f.path)
        ranges, first = [], 0
        for file in files:
            tokens = file.size // self.dtype.itemsize
            wanted_from, wanted_to = max(self.low - first, 0), min(self.high - first, tokens)
            if self.run_tokens:  # a run is there as a whole or not at all
                wanted_from -= wanted_from % self.run_tokens
                wanted_to = min(-(-wanted_to // self.run_tokens) * self.run_tokens, tokens)
            for start in range(wanted_from, wanted_to, self._step()):
                count = min(self._step(), wanted_to - start)
                ranges.append(TokenRange(file.path, first + start, start, count))
            first += tokens
        return ranges

    def _step(self) -> int:
        """Tokens of a range, whole runs of them."""
        run = self.run_tokens or 1
        return max(1, self.range_tokens // run) * run

    def read(self, partition: TokenRange):
        filesystem, _ = _open(self.path)
        run = self.run_tokens or 1
        width, step = self.dtype.itemsize, max(1, (1 << 16) // run) * run
        with filesystem.open_input_file(partition.file) as source:
            for done in range(0, partition.count, step):
                n = min(step, partition.count - done)
                raw = source.read_at(n * width, (partition.start + done) * width)
                values = np.frombuffer(raw, self.dtype).astype(np.int32)
                starts = np.arange(0, n, run, dtype=np.int64)
                positions = pa.array(starts + partition.first + done)
                if self.run_tokens:
                    ends = pa.array(np.append(starts, n).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [positions, pa.ListArray.from_arrays(ends, pa.array(values))], ["position", "tokens"]
                    )
                else:
                    yield pa.RecordBatch.from_arrays([positions, pa.array(values)], ["position", "token"])


class TokenStream(DataSource):
    """Format ``tokenstream``.

    Options to read: ``path``, ``dtype``, ``rangeTokens`` and ``runTokens`` (rows are runs
    of that many tokens); to write: ``folders`` (split to folder, JSON) and ``dtype``.
    """

    @classmethod
    def name(cls) -> str:
        return "tokenstream"

    def schema(self) -> str:
        return "position bigint, tokens array<int>" if int(self.options.get("runtokens", 0)) else "position bigint, token int"

    def reader(self, schema) -> TokenStreamReader:
        return TokenStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> TokenStreamWriter:
        return TokenStreamWriter(self.options)


# Tokens that one task writes as one file.
_FILE_TOKENS = 1 << 24


def write_token_streams(
    blocks: DataFrame, folders: Mapping[str, str], block_size: int, vocab_size: int, dtype: str = "uint16",
    lengths: Mapping[str, int] | None = None,
) -> None:
    """Write the packed blocks of several splits as raw token streams to empty folders, in one job.

    Block numbers tell where a block belongs, so each stretch of a stream is one partition
    by its number: nothing is sampled, no two stretches share a task by chance and none goes
    without. A folder that holds a stream already is refused. Splits that are not named
    are not written. ``lengths``, the tokens of each split where they are known, spare a pass
    over the blocks that only finds the last ones.
    """
    check_vocab_size(vocab_size, dtype)
    for path in folders.values():
        filesystem, folder = _open(path.rstrip("/"))
        if filesystem.get_file_info(folder).type != fs.FileType.NotFound and any(
            f.path.endswith(_SUFFIX) for f in filesystem.get_file_info(fs.FileSelector(folder))
        ):
            raise ValueError(f"{path} holds a token stream already")
    spark = blocks.sparkSession
    spark.dataSource.register(TokenStream)
    named = blocks.filter(F.col("split").isin(*folders))
    per_file = max(1, _FILE_TOKENS // block_size)
    if lengths is None:
        last = {r["split"]: r["last"] for r in named.groupBy("split").agg(F.max("block_id").alias("last")).collect()}
    else:
        last = {split: (lengths[split] - 1) // block_size for split in folders if lengths.get(split, 0) > 0}
    task, tasks = F.lit(None).cast("bigint"), 0
    for split in sorted(last):
        stretch = F.floor(F.col("block_id") / per_file) + tasks
        task = F.when(F.col("split") == split, stretch).otherwise(task)
        tasks += last[split] // per_file + 1
    rows = named.select(
        "split", (F.col("block_id") * block_size).alias("position"), "tokens", task.cast("int").alias("task")
    )
    placed = rows.repartitionById(max(1, tasks), "task").sortWithinPartitions("position").drop("task")
    writer = placed.write.format("tokenstream").mode("append").option("dtype", dtype)
    writer.option("folders", json.dumps(dict(folders))).save()


def write_token_stream(
    blocks: DataFrame, path: str, split: str, block_size: int, vocab_size: int, dtype: str = "uint16",
    lengths: Mapping[str, int] | None = None,
) -> None:
    """Write the packed blocks of one split, as :func:`write_token_streams`."""
    write_token_streams(blocks, {split: path}, block_size, vocab_size, dtype, lengths)


def _reading(spark: SparkSession, dtype: str) -> DataFrameReader:
    spark.dataSource.register(TokenStream)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("tokenstream").option("dtype", dtype)


def read_token_stream(spark: SparkSession, path: str, dtype: str = "uint16") -> DataFrame:
    """``(position, token)`` of a stream folder or of one raw token file.

    A filter on ``position`` opens only the byte ranges that it asks for.
    """
    return _reading(spark, dtype).load(path)


def read_token_runs(spark: SparkSession, path: str, run_tokens: int, dtype: str = "uint16") -> DataFrame:
    """``(position, tokens)``: each file of a stream in runs of ``run_tokens``, the last one shorter."""
    if run_tokens <= 0:
        raise ValueError(f"run_tokens must be positive, got {run_tokens}")
    return _reading(spark, dtype).option("runTokens", run_tokens).load(path)
