"""Files as rows: binary scan, decoding, and exact row numbers inside files."""

from __future__ import annotations

import codecs

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions.batches import piecewise
from corpusmill.session import materialize

# Four numbers each, so about 100 MB; a block has tens of megabytes of text.
BROADCAST_BLOCKS = 2_000_000
_BOMS = [
    (codecs.BOM_UTF32_LE, "utf-32"),
    (codecs.BOM_UTF32_BE, "utf-32"),
    (codecs.BOM_UTF16_LE, "utf-16"),
    (codecs.BOM_UTF16_BE, "utf-16"),
]


def scan_files(
    spark: SparkSession, paths: str | list[str], max_size: int | None = None, glob: str | None = None
) -> DataFrame:
    """One row per file. ``max_size`` is applied before any content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # The metadata path lets a filter on the path skip files before they are read.
    files = reader.load(paths).select(
        F.col("_metadata.file_path").alias("path"), "modificationTime", "length", "content"
    )
    return files if max_size is None else files.filter(F.col("length") <= max_size)


def decoded(content: Column, encoding: str | None = None, autodetect: bool = False) -> Column:
    """``struct<text, charset>`` of a binary column; both null when it cannot be decoded.

    The declared encoding (UTF-8 by default) is tried first. With ``autodetect`` the
    next candidates are the one a byte-order mark announces and ISO-8859-1.
    """
    declared = codecs.lookup(encoding or "utf-8").name
    as_utf8 = content.cast("string")
    is_utf8 = F.is_valid_utf8(as_utf8)
    direct = F.struct(as_utf8.alias("text"), F.lit("utf-8").alias("charset"))
    if declared == "utf-8" and not autodetect:
        return F.struct(
            F.when(is_utf8, as_utf8).alias("text"), F.when(is_utf8, F.lit("utf-8")).alias("charset")
        )
    if declared == "utf-8":
        return F.when(is_utf8, direct).otherwise(
            _decode_udf(declared, autodetect)(F.when(~is_utf8, content))
        )
    return _decode_udf(declared, autodetect)(content)


def _decode_udf(declared: str, autodetect: bool):
    @piecewise("text string, charset string")
    def decode(contents: pa.Array) -> pa.Array:
        def attempt(raw):
            if raw is None:
                return None, None
            candidates = [declared]
            if autodetect:
                candidates += [name for bom, name in _BOMS if raw.startswith(bom)]
                candidates += ["utf-8", "iso-8859-1"]
            for name in candidates:
                try:
                    return raw.decode(name), codecs.lookup(name).name
                except UnicodeDecodeError:
                    continue
            return None, None

        pairs = [attempt(raw) for raw in contents.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())],
            ["text", "charset"],
        )

    return decode


def encoded(text: Column) -> Column:
    """UTF-8 bytes of a string."""
    return text.cast("binary")


def blob_source(metadata: Column, path: Column) -> Column:
    """A blob's source: the ``source`` metadata entry, else its path."""
    return F.coalesce(F.try_element_at(metadata, F.lit("source")), path)


def with_scan_position(df: DataFrame) -> DataFrame:
    """Add the file, block and scan position of each row; call it right after a read."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_position"),
    )


def number_rows(positioned: DataFrame, name: str) -> DataFrame:
    """0-based row number inside each file, in file order.

    A file block is read by one task from start to end, so its rows hold consecutive
    positions. Adding the row counts of the file's earlier blocks gives the number. The
    summary is stored, four numbers per block; it is counted, and broadcast up to
    two million blocks (some 100 TB of text), so the rows themselves stay where they are.
    """
    keyed = positioned.withColumn("_file", F.xxhash64("file_path"))
    blocks = keyed.groupBy("_file", "_block").agg(F.min("_position").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    starts = materialize(starts, "blocks")
    if starts.count() <= BROADCAST_BLOCKS:
        starts = F.broadcast(starts)
    return (
        keyed.join(starts, ["_file", "_block"])
        .withColumn(name, F.col("_before") + F.col("_position") - F.col("_first"))
        .drop("_file", "_block", "_position", "_first", "_before")
    )


def checked_utf8(value: Column, where: Column, autodetect: bool = False) -> Column:
    """Text that a reader passed on byte by byte; fails on what is not UTF-8.

    With ``autodetect`` such text is taken as ISO-8859-1 instead.
    """
    if autodetect:
        return F.when(F.is_valid_utf8(value), value).otherwise(F.decode(value.cast("binary"), "ISO-8859-1"))
    problem = F.raise_error(F.concat(F.lit("cannot decode "), where)).cast("string")
    return F.when(value.isNull() | F.is_valid_utf8(value), value).otherwise(problem)
