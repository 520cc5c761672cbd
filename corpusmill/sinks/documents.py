"""Documents and text splits on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: class path written into serialized documents.
_DOCUMENT_CLASS = ("langchain", "schema", "document", "Document")


def document_json(content: Column, metadata: Column | None = None, ident: Column | None = None) -> Column:
    """Serialized form of a document; an absent id and empty metadata are left out."""
    fields = []
    if ident is not None:
        fields.append(ident.cast("string").alias("id"))
    if metadata is not None:
        fields.append(F.when(F.size(metadata) > 0, metadata).alias("metadata"))
    fields += [content.alias("page_content"), F.lit("Document").alias("type")]
    return F.to_json(
        F.struct(
            F.lit(1).alias("lc"),
            F.lit("constructor").alias("type"),
            F.array(*[F.lit(part) for part in _DOCUMENT_CLASS]).alias("id"),
            F.struct(*fields).alias("kwargs"),
        )
    )


def write_documents_json(documents: DataFrame, path: str, ident: str | None = None) -> None:
    """One serialized document per line."""
    row = document_json(F.col("page_content"), F.col("metadata"), F.col(ident) if ident else None)
    documents.select(row.alias("value")).write.text(path)


def write_text_splits(labelled: DataFrame, path: str, ident: str = "doc_id") -> None:
    """Texts of each split under ``split=<name>``, separated by blank lines, in split order."""
    ordered = labelled.repartitionByRange("split", "split_key").sortWithinPartitions(
        "split", "split_key", ident
    )
    ordered.select("split", F.concat("text", F.lit("\n")).alias("value")).write.partitionBy("split").text(path)


def write_stats(stats: DataFrame, path: str) -> None:
    """A small, already aggregated frame, such as the processing statistics, as one JSON file."""
    stats.coalesce(1).write.json(path)
