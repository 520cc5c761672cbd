"""Plain-text documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.sources.files import checked_utf8, decoded, scan_files


def text_entries(text: Column) -> Column:
    """A file as a single document; null for a file without text."""
    single = F.struct(
        F.lit(0).cast("bigint").alias("seq_num"),
        text.alias("content"),
        F.lit(False).alias("is_json"),
        F.create_map().cast("map<string,string>").alias("metadata"),
    )
    return F.when(text.isNotNull(), F.array(single))


def text_documents(files: DataFrame, encoding: str | None = None, autodetect: bool = False) -> DataFrame:
    """``(source, page_content, charset)``, one row per file, newlines unified.

    Fails on a file that cannot be decoded, like the declared encoding would.
    """
    result = files.select(F.col("path").alias("source"), decoded(F.col("content"), encoding, autodetect).alias("d"))
    problem = F.raise_error(F.concat(F.lit("cannot decode "), F.col("source"))).cast("string")
    return result.select(
        "source",
        F.when(F.col("d.text").isNotNull(), tx.unix_newlines(F.col("d.text")))
        .otherwise(problem)
        .alias("page_content"),
        F.col("d.charset").alias("charset"),
    )


def read_text_documents(spark: SparkSession, paths, **options) -> DataFrame:
    return text_documents(scan_files(spark, paths), **options)


def read_gzip_text(spark: SparkSession, paths, autodetect: bool = False) -> DataFrame:
    """Compressed text files, one document per file; the codec follows from the name.

    Fails on text that is not UTF-8, or takes it as ISO-8859-1 with ``autodetect``.
    """
    read = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("source"), "value")
    text = checked_utf8(F.col("value"), F.col("source"), autodetect)
    return read.select("source", tx.unix_newlines(text).alias("page_content"))
