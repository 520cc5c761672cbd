"""Incremental ingestion: the batch plan over newly arrived files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.manifest import DEFAULT_MAX_SIZE
from corpusmill.plans.ingest import process_files

_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def incoming_files(spark: SparkSession, folder: str, max_size: int | None = None) -> DataFrame:
    """Files appearing in a folder, one row each."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return files if max_size is None else files.filter(F.col("length") <= max_size)


def stream_documents(
    files: DataFrame, manifest: DataFrame | None = None, max_depth: int = 3, **options
) -> DataFrame:
    """Documents of streamed files; files that fail are left out.

    Every step works on single files, so the stream keeps no state. It is the batch
    plan: the same files give the same documents.
    """
    documents, _ = process_files(files, manifest, max_depth, **options)
    return documents


def ingest_available(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    max_depth: int = 3,
    max_size: int = DEFAULT_MAX_SIZE,
    outcomes: str | None = None,
    **options,
) -> None:
    """Store the documents of all files not seen before below ``target``.

    A row per file goes to ``outcomes`` if given, files larger than ``max_size`` included;
    their content is never read. Each batch has a folder of its own, which a repeated batch
    replaces, so that nothing is stored twice.
    """

    def store(batch: DataFrame, number: int) -> None:
        small = batch.filter(F.col("length") <= max_size)
        found, states = process_files(small, max_depth=max_depth, **options)
        found.write.mode("overwrite").parquet(f"{target}/batch={number}")
        if outcomes is not None:
            nothing = F.lit(None).cast("string")
            refused = batch.filter(F.col("length") > max_size).select(
                F.col("path").alias("file_path"), "path", nothing.alias("loader"),
                F.lit(0).cast("bigint").alias("n_documents"), F.lit("failed").alias("status"),
                F.concat(F.lit("File too large: "), "length", F.lit(f" bytes (max: {max_size} bytes)")).alias("error"),
            )
            states.unionByName(refused).write.mode("overwrite").parquet(f"{outcomes}/batch={number}")

    query = (
        incoming_files(spark, folder)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
