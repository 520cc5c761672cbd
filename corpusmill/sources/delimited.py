"""CSV and TSV records as documents."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.functions.batches import OBJECT_BYTES, piecewise
from corpusmill.functions.jsontext import ARROW_ENTRIES, ENTRY_TYPE
from corpusmill.session import materialize
from corpusmill.sources.records import Dialect, delimited_records

# Entries of some hundred bytes.
BROADCAST_FILES = 1_000_000

def csv_documents(
    spark: SparkSession,
    paths,
    source_column: str | None = None,
    metadata_columns: Sequence[str] = (),
    content_columns: Sequence[str] = (),
    delimiter: str = ",",
    quotechar: str = '"',
    fieldnames: Sequence[str] | None = None,
    encoding: str = "UTF-8",
    autodetect: bool = False,
) -> DataFrame:
    """``(source, row, page_content, metadata)``, one row per record.

    Every file has its own header, or all have ``fieldnames``: values are picked by name
    for each file, so files may name other columns, in another order or twice (the last
    value counts, at the first place). A file that lacks a chosen column is an error.
    Files of any size are read in blocks side by side, quoted line breaks included.

    Files are UTF-8 unless ``encoding`` says otherwise; a line that is not UTF-8 is an
    error, or is taken as ISO-8859-1 with ``autodetect``.
    """
    dialect = Dialect(delimiter, quotechar, encoding, autodetect)
    records, headers = delimited_records(spark, paths, dialect)
    if fieldnames:
        names = F.array(*[F.lit(n) for n in fieldnames])
        headers = headers.limit(1).select(names.alias("header"))
    elif headers.isEmpty():
        raise ValueError(f"no header in {paths}")
    for wanted in [*([source_column] if source_column else []), *metadata_columns]:
        without = headers.filter(~F.array_contains("header", wanted)).first()
        if without is not None:
            raise ValueError(f"column {wanted!r} not found in {without['header']}")
    if fieldnames:
        named = records.withColumns(_picked(names, source_column, metadata_columns, content_columns))
    else:
        catalogue = materialize(
            headers.select("file_path", *[c.alias(k) for k, c in _picked(F.col("header"), source_column, metadata_columns, content_columns).items()]),
            "csv-header-catalogue",
        )
        # One entry a file; beyond a million files they are joined by a shuffle.
        side = F.broadcast(catalogue) if catalogue.limit(BROADCAST_FILES + 1).count() <= BROADCAST_FILES else catalogue
        named = records.filter("row > 0").withColumn("row", F.col("row") - 1).join(side, "file_path")
    value = lambda place: F.try_element_at(F.col("fields"), place)
    absent = lambda place: F.coalesce(value(place), F.lit("None"))
    lines = F.transform("_shown", lambda x: F.concat(tx.strip(x["name"]), F.lit(": "), tx.strip(absent(x["place"]))))
    if not content_columns:
        extras = F.transform(F.slice("fields", F.col("_width") + 1, F.greatest(F.size("fields") - F.col("_width"), F.lit(0))), tx.strip)
        more = F.array(F.concat(F.lit("None: "), F.array_join(extras, ",")))
        lines = F.when(F.size("fields") > F.col("_width"), F.concat(lines, more)).otherwise(lines)
    metadata = F.map_from_entries(F.transform("_kept", lambda x: F.struct(x["name"], value(x["place"]))))
    return named.select(
        (value(F.col("_source")) if source_column else F.col("file_path")).alias("source"),
        F.col("row"),
        F.array_join(lines, "\n").alias("page_content"),
        metadata.cast("map<string,string>").alias("metadata"),
    )


def _picked(names: Column, source_column, metadata_columns, content_columns) -> dict[str, Column]:
    """Where the values of a file's chosen columns are: a repeated name counts at its last place."""
    last = lambda name: F.size(names) - F.array_position(F.reverse(names), name).cast("int") + 1
    placed = lambda own: F.transform(own, lambda name: F.struct(name.alias("name"), last(name).alias("place")))
    chosen = F.array(*[F.lit(c) for c in (content_columns or metadata_columns)]).cast("array<string>")
    distinct = F.array_distinct(names)
    shown = F.filter(distinct, lambda n: F.array_contains(chosen, n) if content_columns else ~F.array_contains(chosen, n))
    return {
        "_width": F.size(names),
        "_shown": placed(shown),
        "_kept": placed(F.array(*[F.lit(c) for c in dict.fromkeys(metadata_columns)]).cast("array<string>")),
        "_source": last(F.lit(source_column)) if source_column else F.lit(None).cast("int"),
    }


def tsv_documents(spark: SparkSession, paths, **options) -> DataFrame:
    return csv_documents(spark, paths, delimiter="\t", **options)


def csv_entries(
    text: Column,
    delimiter: Column,
    metadata_columns: Sequence[str] = (),
    content_columns: Sequence[str] = (),
    quotechar: str = '"',
    fieldnames: Sequence[str] | None = None,
) -> Column:
    """Records of a CSV text held in a column, where every row may have its own header.

    Used for archive members and mixed file sets, which Spark's CSV reader cannot
    open; ``delimiter`` is a column as well. Null if a chosen column is missing. With
    ``fieldnames`` the first record is data as well.
    """
    parser = _csv_parser(tuple(metadata_columns), tuple(content_columns), quotechar, fieldnames and list(fieldnames))
    return parser(text, delimiter)


def _csv_parser(
    metadata_columns: tuple[str, ...], content_columns: tuple[str, ...], quotechar: str, fieldnames: list[str] | None
):
    def shown(value):
        if isinstance(value, list):
            return ",".join(v.strip() for v in value)
        return "None" if value is None else value.strip()

    def wanted(name):
        return name in content_columns if content_columns else name not in metadata_columns

    def documents(text, delimiter):
        if text is None:
            return None
        records = csv.DictReader(io.StringIO(text, newline=""), fieldnames, delimiter=delimiter, quotechar=quotechar)
        if {*metadata_columns, *content_columns} - {*(records.fieldnames or ())}:
            return None
        return [
            {
                "seq_num": i,
                "content": "\n".join(
                    f"{name.strip() if name is not None else name}: {shown(v)}"
                    for name, v in record.items()
                    if wanted(name)
                ),
                "is_json": False,
                "metadata": [("row", str(i)), *((name, record[name]) for name in metadata_columns)],
            }
            for i, record in enumerate(records)
        ]

    @piecewise(ENTRY_TYPE, OBJECT_BYTES)
    def parse(texts: pa.Array, delimiters: pa.Array) -> pa.Array:
        csv.field_size_limit(2**31 - 1)
        rows = [documents(t, d) for t, d in zip(texts.to_pylist(), delimiters.to_pylist())]
        return pa.array(rows, ARROW_ENTRIES)

    return parse
