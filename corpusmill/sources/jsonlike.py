"""JSON and JSON Lines documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import jsontext as js
from corpusmill.functions import text as tx
from corpusmill.functions.binding import computed_once
from corpusmill.sources.files import checked_utf8, decoded, number_rows, scan_files, with_scan_position


def _content(entry: str) -> Column:
    """Content of an entry; anything but text is written out as JSON first."""
    content, as_json = F.col(f"{entry}.content"), F.col(f"{entry}.is_json")
    return F.when(as_json, js.rendered(F.when(as_json, content))).otherwise(content)


def json_documents(
    files: DataFrame, content_key: str | None = None, metadata_keys: list[str] | None = None
) -> DataFrame:
    """``(source, seq_num, page_content, metadata)`` of files with one JSON value each.

    Item fields called ``source`` or ``seq_num`` replace the file's. Fails on text
    that is not JSON.
    """
    js.accept_repeated_keys(files.sparkSession)
    text = decoded(F.col("content"))["text"]
    entries = js.whole_text_entries(F.col("text"), content_key, metadata_keys)
    problem = F.raise_error(F.concat(F.lit("invalid JSON in "), F.col("path")))
    parsed = files.select("path", text.alias("text")).select(
        "path", F.coalesce(entries, problem.cast(js.ENTRY_TYPE)).alias("entries")
    )
    # The outer form keeps the optimizer from testing the entries before they are
    # unfolded, which would parse every file twice.
    return _rows(parsed.select("path", F.explode_outer("entries").alias("e")).filter("e is not null"))


def read_json_documents(spark: SparkSession, paths, **options) -> DataFrame:
    return json_documents(scan_files(spark, paths), **options)


def jsonl_documents(
    spark: SparkSession,
    paths,
    content_key: str | None = None,
    metadata_keys: list[str] | None = None,
    autodetect: bool = False,
) -> DataFrame:
    """JSON Lines files of any size, read in parallel blocks; bad lines are skipped.

    Fails on a line that is not UTF-8, or takes it as ISO-8859-1 with ``autodetect``.
    """
    lines = _parsed_lines(spark, paths, autodetect).filter("value is not null")
    entry = js.line_document(F.col("line"), F.col("value"), F.col("line_number"), content_key, metadata_keys)
    return _rows(lines.select(F.col("file_path").alias("path"), entry.alias("e")))


def jsonl_rejects(spark: SparkSession, paths, autodetect: bool = False) -> DataFrame:
    """``(source, line_number, line)`` of the lines that hold no JSON value."""
    lines = _parsed_lines(spark, paths, autodetect).filter("value is null")
    return lines.select(F.col("file_path").alias("source"), "line_number", "line")


def _parsed_lines(spark: SparkSession, paths, autodetect: bool) -> DataFrame:
    """Lines that are not blank, with their number and their value as a variant."""
    js.accept_repeated_keys(spark)
    lines = number_rows(with_scan_position(spark.read.text(paths)), "line_number")
    text = checked_utf8(F.col("value"), F.col("file_path"), autodetect)
    lines = lines.select("file_path", "line_number", tx.strip(text).alias("line"))
    return computed_once(lines.filter("line <> ''"), "value", js.one_value(F.col("line")))


def _rows(entries: DataFrame) -> DataFrame:
    own = F.col("e.metadata")
    return entries.select(
        F.coalesce(F.try_element_at(own, F.lit("source")), F.col("path")).alias("source"),
        F.coalesce(
            F.expr("try_cast(try_element_at(e.metadata, 'seq_num') as bigint)"), F.col("e.seq_num")
        ).alias("seq_num"),
        _content("e").alias("page_content"),
        own.alias("metadata"),
    )
