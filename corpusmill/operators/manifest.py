"""The upload manifest: one row per uploaded file."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import names

DEFAULT_MAX_SIZE = 500 * 1024 * 1024
# States of an upload.
PENDING, PROCESSING, COMPLETED, FAILED = "pending", "processing", "completed", "failed"
MANIFEST_SCHEMA = (
    "upload_id string, original_filename string, file_path string, file_size bigint, "
    "mime_type string, upload_timestamp timestamp, checksum string, status string, "
    "error_message string"
)
# What the stored log adds: the change that wrote an entry, and whether it removes the upload.
_CHANGE_SCHEMA = f"{MANIFEST_SCHEMA}, version bigint, removed boolean"


def build_manifest(
    files: DataFrame,
    max_size: int = DEFAULT_MAX_SIZE,
    check_extension: bool = False,
    uploaded_at: Column | None = None,
    provided_mime: Column | None = None,
) -> DataFrame:
    """Manifest rows for ``(path, length, content)``; rejected files have status failed.

    ``upload_id`` is the upload time, the safe file name and a hash of the path, so that
    files of one name in several folders are told apart.
    """
    name, size = names.base_name(F.col("path")), F.col("length")
    allowed = names.is_allowed(name) if check_extension else F.lit(True)
    too_large = F.concat(F.lit("File too large: "), size, F.lit(f" bytes (max: {max_size} bytes)"))
    refused = F.concat(F.lit("File type not allowed: "), name)
    nothing = F.lit(None).cast("string")

    # Two scans, so that the content of a rejected file is never read.
    accepted = files.filter(size <= max_size).filter(allowed).select(
        "path", "length",
        names.mime_type(F.col("path"), F.col("content"), provided_mime).alias("mime_type"),
        F.sha2("content", 256).alias("checksum"),
        nothing.alias("error_message"),
    )
    rejected = files.filter((size > max_size) | ~allowed).select(
        "path", "length", nothing.alias("mime_type"), nothing.alias("checksum"),
        F.when(~allowed, refused).otherwise(too_large).alias("error_message"),
    )
    stamped = accepted.unionByName(rejected).withColumn(
        "upload_timestamp", F.current_timestamp() if uploaded_at is None else uploaded_at
    )
    upload_id = F.concat(
        F.date_format("upload_timestamp", "yyyyMMdd_HHmmss"), F.lit("_"), names.upload_name(name),
        F.lit("_"), F.substring(F.md5(F.col("path").cast("binary")), 1, 12),
    )
    return stamped.select(
        upload_id.alias("upload_id"),
        name.alias("original_filename"),
        F.col("path").alias("file_path"),
        size.cast("bigint").alias("file_size"),
        "mime_type",
        "upload_timestamp",
        "checksum",
        F.when(F.col("error_message").isNull(), COMPLETED).otherwise(FAILED).alias("status"),
        "error_message",
    )


def list_uploads(manifest: DataFrame) -> DataFrame:
    return manifest.orderBy("upload_timestamp", "upload_id")


def get_upload(manifest: DataFrame, upload_id: str) -> DataFrame:
    return manifest.filter(F.col("upload_id") == upload_id)


def upload_status(manifest: DataFrame, upload_id: str) -> DataFrame:
    return get_upload(manifest, upload_id).select("upload_id", "status")


def delete_uploads(manifest: DataFrame, removed: DataFrame) -> DataFrame:
    """The manifest without the uploads listed in ``removed(upload_id)``."""
    return manifest.join(removed.select("upload_id").distinct(), "upload_id", "left_anti")


def mark_processing(manifest: DataFrame, started: DataFrame) -> DataFrame:
    """Set status ``processing`` for the uploads in ``started(upload_id)``."""
    flag = started.select("upload_id", F.lit(True).alias("_started")).distinct()
    joined = manifest.join(flag, "upload_id", "left")
    return joined.select(
        *[c for c in manifest.columns if c not in ("status", "error_message")],
        F.when(F.col("_started"), PROCESSING).otherwise(F.col("status")).alias("status"),
        F.when(F.col("_started"), F.lit(None)).otherwise(F.col("error_message")).alias("error_message"),
    ).select(manifest.columns)


def apply_outcomes(manifest: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Final status of the uploads that are ``processing``.

    ``outcomes(file_path, path, status)`` has a row per file found in an upload. An
    archive without a single file that has a loader fails; errors of single files
    leave the upload completed.
    """
    found = outcomes.groupBy("file_path").agg(F.max(F.col("status") != "unsupported").alias("_usable"))
    usable = F.coalesce("_usable", F.lit(False)) | ~names.is_archive(F.col("file_path"))
    running = F.col("status") == PROCESSING
    failed = F.when(running & ~usable, "No processable files found after extraction")
    return (
        manifest.join(found, "file_path", "left")
        .withColumn("error_message", F.coalesce(failed, "error_message"))
        .withColumn("status", F.when(running, F.when(usable, COMPLETED).otherwise(FAILED)).otherwise(F.col("status")))
        .select(manifest.columns)
    )


def newest_entries(manifest: DataFrame) -> DataFrame:
    """One row per path: the entry of its latest upload."""
    latest = F.max_by(F.struct(*manifest.columns), F.struct("upload_timestamp", "upload_id"))
    return manifest.groupBy("file_path").agg(latest.alias("_entry")).select("_entry.*")


def supported_extensions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(e, m) for e, m in names.MIME_BY_EXTENSION.items()], "extension string, mime_type string")


def supported_mime_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m, n) for m, n in names.LOADER_BY_MIME.items()], "mime_type string, loader string")


def append_manifest(manifest: DataFrame, path: str) -> None:
    """Store entries; those of an ``upload_id`` stored before replace it (a new status, say).

    The stored manifest is a log of changes, each a folder of its own that is never
    written again. A change counts once its commit file is there, which lists the folders
    of the whole log: a failure before that leaves the manifest as it was.
    """
    _add_change(manifest.sparkSession, manifest.withColumn("removed", F.lit(False)), path)


def delete_stored(spark: SparkSession, path: str, removed: DataFrame) -> None:
    """Remove the uploads of ``removed(upload_id)`` from the stored manifest.

    Adds one entry for each; nothing stored is rewritten.
    """
    gone = removed.select("upload_id").distinct().withColumn("removed", F.lit(True))
    empty = spark.createDataFrame([], MANIFEST_SCHEMA)
    _add_change(spark, empty.unionByName(gone, allowMissingColumns=True), path)


def compact_manifest(spark: SparkSession, path: str) -> None:
    """Write the present manifest as one folder, from which later reads and changes go on."""
    version, folders = _committed(spark, path)
    if len(folders) > 1:
        entries = read_manifest(spark, path).withColumn("removed", F.lit(False))
        _commit(spark, path, version + 1, [_write_change(entries, path, version + 1)])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The stored manifest, one row per upload; empty when nothing has been stored yet."""
    _, folders = _committed(spark, path)
    if not folders:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    changes = spark.read.schema(_CHANGE_SCHEMA).parquet(*[f"{path}/{folder}" for folder in folders])
    # Entries of one change for one upload are told apart by their values.
    order = F.struct("version", "removed", "upload_timestamp", "status", "checksum", "error_message")
    latest = F.max_by(F.struct("*"), order)
    entries = changes.groupBy("upload_id").agg(latest.alias("_entry")).filter("not _entry.removed")
    return entries.select("_entry.*").drop("version", "removed")


def _add_change(spark: SparkSession, entries: DataFrame, path: str) -> None:
    version, folders = _committed(spark, path)
    _commit(spark, path, version + 1, [*folders, _write_change(entries, path, version + 1)])


def _write_change(entries: DataFrame, path: str, version: int) -> str:
    folder = f"change-{version}-{uuid.uuid4().hex}"
    entries.withColumn("version", F.lit(version).cast("bigint")).write.parquet(f"{path}/{folder}")
    return folder


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _committed(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Number of the last commit and the folders it lists."""
    folder, system = _file_system(spark, path)
    if not system.exists(folder):
        return 0, []
    numbers = [s.getPath().getName() for s in system.listStatus(folder)]
    last = max((int(n) for n in numbers if n.isdigit()), default=0)
    if not last:
        return 0, []
    return last, json.loads(spark.read.text(f"{folder.toString()}/{last}", wholetext=True).first()[0])


def _commit(spark: SparkSession, path: str, number: int, folders: list[str]) -> None:
    """Publish a commit by renaming, which fails if another writer has taken the number."""
    folder, system = _file_system(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft, target = hadoop.Path(folder, f".draft-{uuid.uuid4().hex}"), hadoop.Path(folder, str(number))
    out = system.create(draft, False)
    out.write(json.dumps(folders).encode())
    out.close()
    context = hadoop.FileContext.getFileContext(folder.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(draft, target, spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
