"""Files to documents: expansion, type detection, loading and provenance."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import jsontext as js
from corpusmill.functions import names
from corpusmill.functions import text as tx
from corpusmill.operators.manifest import newest_entries
from corpusmill.session import materialize
from corpusmill.sources.archives import MAX_MEMBER_BYTES, expand_archives
from corpusmill.sources.delimited import csv_entries
from corpusmill.sources.files import decoded
from corpusmill.sources.textual import text_entries

Loader = Callable[[Column], Column]


def classify(files: DataFrame) -> DataFrame:
    """Add ``detected_mime_type`` and ``loader`` to expanded files."""
    mime = names.mime_type(F.col("path"), F.col("content"))
    return files.withColumn("detected_mime_type", F.when(F.col("error").isNull(), mime)).withColumn(
        "loader", names.loader(F.col("path"), F.col("detected_mime_type"))
    )


def load_entries(
    files: DataFrame,
    custom: Mapping[str, Loader] | None = None,
    autodetect: bool = False,
    content_key: str | None = None,
    metadata_keys: list[str] | None = None,
    encoding: str | None = None,
    delimiter: str | None = None,
    metadata_columns: Sequence[str] = (),
    content_columns: Sequence[str] = (),
    quotechar: str = '"',
    fieldnames: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``entries``, the documents of each classified file, their number ``n_documents``, and its ``error``.

    Every file is decoded and parsed in the same pass, whatever its loader. ``custom``
    maps MIME types to expressions from text to entries; they replace the built-in ones.
    A loader of a binary format finds the bytes in the column ``content``. ``encoding``,
    ``delimiter`` (of CSV files), ``quotechar``, ``fieldnames`` and the column choices are
    those of the path readers; a table that lacks a chosen column has invalid content.
    """
    js.accept_repeated_keys(files.sparkSession)
    custom = custom or {}
    mime, text, which = F.col("detected_mime_type"), F.col("text"), F.col("loader")
    is_table = which.isin("csv", "tsv")
    by_loader = {
        "text": text_entries(tx.unix_newlines(text)),
        "json": js.whole_text_entries(text, content_key, metadata_keys),
        "jsonl": js.line_entries(tx.unix_newlines(text), content_key, metadata_keys),
        **{f"custom {name}": load(text) for name, load in custom.items()},
    }
    entries = F.when(is_table, F.col("_tables"))
    for name, parsed in by_loader.items():
        entries = entries.when(which == name, parsed.cast(js.ENTRY_TYPE))
    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("entries").isNull() & text.isNull() & which.isNotNull(), "cannot decode file")
        .when(which.isNotNull() & F.col("entries").isNull(), "invalid content")
    )
    # Stored with the entries, so that outcomes are told without reading the documents again.
    count = F.when(F.col("entries").isNull(), 0).otherwise(F.size("entries"))
    if custom:
        chosen = F.when(mime.isin(*custom), F.concat(F.lit("custom "), mime)).otherwise(which)
        files = files.withColumn("loader", chosen)
    readable = F.when(which.isNotNull(), decoded(F.col("content"), encoding, autodetect)["text"])
    separator = F.when(which == "tsv", "\t").otherwise(delimiter or ",")
    tables = csv_entries(
        F.when(is_table, text), separator, metadata_columns, content_columns, quotechar, fieldnames
    )
    return (
        files.withColumn("text", readable)
        .withColumn("_tables", tables)
        .withColumn("entries", entries)
        .withColumn("error", error)
        .withColumn("n_documents", count.cast("bigint"))
        .drop("text", "_tables", "content")
    )


def documents_of(loaded: DataFrame) -> DataFrame:
    """One row per document of the loaded files; all file columns ride along."""
    # The outer form keeps the optimizer from testing the entries before they are
    # unfolded, which would parse every file twice.
    others = [c for c in loaded.columns if c not in ("path", "entries", "n_documents", "error", "loader", "upload_path")]
    rows = loaded.select("path", *others, F.inline_outer("entries")).filter("seq_num is not null")
    text = F.when(F.col("is_json"), js.rendered(F.when(F.col("is_json"), F.col("content"))))
    return rows.select(
        F.col("path").alias("source"),
        "seq_num",
        text.otherwise(F.col("content")).alias("page_content"),
        "metadata",
        *others,
    )


def outcomes_of(loaded: DataFrame) -> DataFrame:
    """``(file_path, path, loader, n_documents, status, error)`` per file found."""
    status = (
        F.when(F.col("error").isNotNull(), F.when(F.col("loader").isNull(), "unsupported").otherwise("failed"))
        .when(F.col("loader").isNull(), "unsupported")
        .when(F.col("n_documents") == 0, "empty")
        .otherwise("completed")
    )
    return loaded.withColumn("status", status).select(
        F.col("upload_path").alias("file_path"), "path", "loader", "n_documents", "status", "error"
    )


def with_provenance(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Attach each uploaded file's latest manifest entry; its documents will carry it.

    The join is made before files are unfolded: every key occurs once per side, so an
    upload that holds a large share of all documents does not unbalance it.
    """
    uploads = newest_entries(manifest).select(
        F.col("file_path").alias("path"),
        "upload_id", "original_filename", "upload_timestamp",
        F.col("checksum").alias("file_checksum"),
    )
    return files.join(uploads, "path", "left").withColumn("processing_timestamp", F.current_timestamp())


def process_files(
    files: DataFrame,
    manifest: DataFrame | None = None,
    max_depth: int = 3,
    max_member: int = MAX_MEMBER_BYTES,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Documents and per-file outcomes of scanned files.

    A broken file or archive member gives an outcome row with its error and never stops
    the others. Files are parsed once: both results read the stored entries. Archive
    members of more than ``max_member`` bytes are such errors. Other options are those of
    :func:`load_entries`.
    """
    if manifest is not None:
        files = with_provenance(files, manifest)
    loaded = load_entries(classify(expand_archives(files, max_depth, max_member)), **options)
    if not files.isStreaming:
        loaded = materialize(loaded, "loaded")
    return documents_of(loaded), outcomes_of(loaded)
