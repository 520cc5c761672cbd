"""Archives as rows: member listing and nested expansion."""

from __future__ import annotations

import bz2
import gzip
import io
import lzma
import posixpath
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import names

SUPPORTED = ("zip", "gz", "tar", "tar.gz", "tar.bz2")
_READ_ERRORS = (
    OSError, EOFError, zipfile.BadZipFile, tarfile.TarError, zlib.error, lzma.LZMAError,
    RuntimeError, NotImplementedError, ValueError, MemoryError,
)
# Unless another bound is given, a member that unpacks to more is an error row, read no further.
MAX_MEMBER_BYTES = 1 << 30
_PACKED = {
    b"\x1f\x8b": lambda raw: gzip.GzipFile(fileobj=io.BytesIO(raw)),
    b"BZh": lambda raw: bz2.BZ2File(io.BytesIO(raw)),
}
_MEMBER_FIELDS = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("wanted", T.BooleanType()),
        T.StructField("is_file", T.BooleanType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)
_MEMBER_TYPES = [pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.binary(), pa.string()]
# A member as it was cut out of its archive.
_PIECE_FIELDS = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("member", T.StringType()),
        T.StructField("is_file", T.BooleanType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("crc", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)
_PIECE_TYPES = [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.binary(), pa.int64(), pa.string()]


def _bounded(source, most: int) -> bytes:
    """All that a decompressing reader gives, unless it is more than ``most`` bytes."""
    data = source.read(most + 1)
    if len(data) > most:
        raise ValueError(f"unpacks to more than {most} bytes")
    return data


def _members(path: str, kind: str, raw: bytes, contents: bool, most: int) -> Iterator[tuple]:
    """``(member, is_file, bytes, error)`` one at a time, so one member is in memory at once.

    A member that cannot be read has an error and does not end the archive. What follows
    a place where a tar file itself is broken cannot be found; that raises.
    """

    def attempt(member: str, is_file: bool, read) -> tuple:
        if not (contents and is_file):
            return member, is_file, None, None
        try:
            return member, is_file, read(), None
        except _READ_ERRORS as problem:
            return member, is_file, None, f"{type(problem).__name__}: {problem}"

    if kind == "zip":
        with zipfile.ZipFile(io.BytesIO(raw)) as box:
            for info in box.infolist():

                def unzip(info=info):
                    with box.open(info) as source:
                        return _bounded(source, most)

                yield attempt(info.filename, not info.is_dir(), unzip)
    elif kind == "gz":
        name = posixpath.splitext(posixpath.basename(path))[0]
        yield attempt(name, True, lambda: _bounded(gzip.GzipFile(fileobj=io.BytesIO(raw)), most))
    else:
        # By what the bytes are, whatever the name says; both check what they unpack.
        opened = next((f for magic, f in _PACKED.items() if raw.startswith(magic)), io.BytesIO)
        with tarfile.open(fileobj=opened(raw), mode="r|") as box:
            for info in box:
                yield attempt(info.name, info.isfile(), lambda: _bounded(box.extractfile(info), most))  # noqa: B023


def archive_kind(path: str) -> str | None:
    """Archive type by name, as :func:`corpusmill.functions.names.archive_type`."""
    suffixes = "." + ".".join(posixpath.basename(path).lower().split(".")[1:])
    return next((k for k, ends in names.ARCHIVE_ENDINGS.items() if suffixes.endswith(ends)), None)


def _walk(path: str, raw: bytes, depth: int, contents: bool, most: int) -> Iterator[tuple]:
    """``(archive, member, is_file, content, error)`` of an archive and those inside it.

    ``depth`` counts the levels that may still be opened.
    """
    kind = archive_kind(path)
    if kind not in SUPPORTED:
        yield path, None, False, None, f"unsupported archive type {kind}"
        return
    if depth == 0:
        yield path, None, False, None, "nested too deep"
        return
    try:
        for member, is_file, data, error in _members(path, kind, raw, contents, most):
            if data is not None and _wanted(member) and archive_kind(member):
                yield from _walk(f"{path}!/{member}", data, depth - 1, contents, most)
            else:
                yield path, member, is_file, data, error
    except _READ_ERRORS as problem:
        yield path, None, False, None, f"{type(problem).__name__}: {problem}"


def _wanted(member: str) -> bool:
    """Relative member path without a parent-directory step or macOS metadata."""
    return not (
        member.startswith(("/", "__MACOSX/"))
        or ".." in member.split("/")
        or posixpath.basename(member).startswith("._")
    )


def _grouped(
    uploads: pa.Array, found: Iterable[tuple[int, tuple]], fields: T.StructType, types: list, rows: int = 1000, size: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Rows found in the uploads, each with its upload's place, as record batches of bounded number and content size."""
    content = fields.names.index("content")

    def batch(places: list[int], group: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(values, t) for values, t in zip(zip(*group), types)]
        return pa.RecordBatch.from_arrays([uploads.take(pa.array(places)), *columns], ["upload", *fields.names])

    places, group, held = [], [], 0
    for place, row in found:
        places.append(place)
        group.append(row)
        held += len(row[content] or b"")
        if len(group) == rows or held >= size:
            yield batch(places, group)
            places, group, held = [], [], 0
    if group:
        yield batch(places, group)


def _deflated(raw: bytes, info: zipfile.ZipInfo) -> bytes | None:
    """The packed bytes of a member that is plainly deflated; any other is left to ``zipfile``."""
    at = info.header_offset
    if info.compress_type != zipfile.ZIP_DEFLATED or info.flag_bits & 1 or raw[at : at + 4] != b"PK\3\4":
        return None
    name, extra = struct.unpack_from("<HH", raw, at + 26)
    charset = "utf-8" if info.flag_bits & 0x800 else "cp437"
    if raw[at + 30 : at + 30 + name].decode(charset, "replace") != info.orig_filename:
        return None
    start = at + 30 + name + extra
    packed = raw[start : start + info.compress_size]
    return packed if len(packed) == info.compress_size else None


def _inflated(packed: bytes, crc: int, most: int) -> bytes:
    reader = zlib.decompressobj(-zlib.MAX_WBITS)
    data = reader.decompress(packed, most + 1)
    if len(data) > most:
        raise ValueError(f"unpacks to more than {most} bytes")
    if not reader.eof:
        raise EOFError("packed bytes end early")
    if zlib.crc32(data) != crc:
        raise zipfile.BadZipFile("bad checksum")
    return data


def _cut(path: str, raw: bytes, depth: int, most: int) -> Iterator[tuple]:
    """``(member, is_file, content, crc, error)`` of the archive itself, none inside it opened.

    A checksum tells that the content is still deflated. Taking a zip apart by its
    directory is quick, so the members can be unpacked wherever they are sent.
    """
    kind = archive_kind(path)
    if kind not in SUPPORTED:
        yield None, False, None, None, f"unsupported archive type {kind}"
        return
    if depth == 0:
        yield None, False, None, None, "nested too deep"
        return
    try:
        if kind != "zip":
            for member, is_file, data, error in _members(path, kind, raw, True, most):
                yield member, is_file, data, None, error
            return
        with zipfile.ZipFile(io.BytesIO(raw)) as box:
            for info in box.infolist():
                packed = None if info.is_dir() else _deflated(raw, info)
                if packed is not None or info.is_dir():
                    yield info.filename, not info.is_dir(), packed, info.CRC if packed is not None else None, None
                    continue
                try:
                    with box.open(info) as source:
                        yield info.filename, True, _bounded(source, most), None, None
                except _READ_ERRORS as problem:
                    yield info.filename, True, None, None, f"{type(problem).__name__}: {problem}"
    except _READ_ERRORS as problem:
        yield None, False, None, None, f"{type(problem).__name__}: {problem}"


def _unpack(archive: str, piece: tuple, depth: int, most: int) -> Iterator[tuple]:
    """``(archive, member, wanted, is_file, content, error)`` of one cut member and of what is inside it."""
    member, is_file, content, crc, error = piece
    if crc is not None:
        try:
            content = _inflated(content, crc, most)
        except _READ_ERRORS as problem:
            content, error = None, f"{type(problem).__name__}: {problem}"
    if content is not None and _wanted(member) and archive_kind(member):
        for inner, name, inner_file, data, problem in _walk(f"{archive}!/{member}", content, depth - 1, True, most):
            yield inner, name, _wanted(name or ""), inner_file, data, problem
    else:
        yield archive, member, _wanted(member or ""), is_file, content, error


def list_members(archives: DataFrame, max_depth: int = 3) -> DataFrame:
    """One row per member of the archives in ``(path, content, upload)``, contents left packed."""

    def list_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, blobs, uploads = (batch.column(c) for c in ("path", "content", "upload"))
            rows = (
                (i, (a, m, _wanted(m or ""), is_file, data, e))
                for i, path in enumerate(paths.to_pylist())
                for a, m, is_file, data, e in _walk(path, blobs[i].as_py(), max_depth, False, 0)
            )
            yield from _grouped(uploads, rows, _MEMBER_FIELDS, _MEMBER_TYPES)

    fields = T.StructType([archives.schema["upload"], *_MEMBER_FIELDS.fields])
    return archives.select("path", "content", "upload").mapInArrow(list_all, fields)


def open_archives(archives: DataFrame, max_depth: int = 3, max_member: int = MAX_MEMBER_BYTES) -> DataFrame:
    """One row per member of the archives in ``(path, content, upload)``; a member or an
    archive that cannot be read gives a row with its error.

    ``upload`` is passed on to every member. One task takes an archive apart; its members
    are dealt out over all tasks, those of a zip as they are packed, and unpacked there, with
    the archives nested in them. So an archive of many members keeps no other waiting.
    """
    def cut_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, blobs, uploads = (batch.column(c) for c in ("path", "content", "upload"))
            rows = (
                (i, (path, number, *piece))
                for i, path in enumerate(paths.to_pylist())
                for number, piece in enumerate(_cut(path, blobs[i].as_py(), max_depth, max_member))
            )
            yield from _grouped(uploads, rows, _PIECE_FIELDS, _PIECE_TYPES)

    def unpack_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_of = ("member", "is_file", "content", "crc", "error")
        for batch in batches:
            archive, columns = batch.column("archive"), [batch.column(c) for c in names_of]
            rows = (
                (i, row)
                for i in range(batch.num_rows)
                for row in _unpack(archive[i].as_py(), tuple(c[i].as_py() for c in columns), max_depth, max_member)
            )
            yield from _grouped(batch.column("upload"), rows, _MEMBER_FIELDS, _MEMBER_TYPES)

    upload = archives.schema["upload"]
    pieces = archives.select("path", "content", "upload").mapInArrow(
        cut_all, T.StructType([upload, *_PIECE_FIELDS.fields])
    )
    # A number of partitions of its own: packed bytes say little about what they grow to.
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.repartition(tasks, "archive", "number")
    return dealt.mapInArrow(unpack_all, T.StructType([upload, *_MEMBER_FIELDS.fields]))


def list_archive(files: DataFrame) -> DataFrame:
    """``(path, member, error)`` of every archive, without unpacking member contents.

    An archive that cannot be read has a row with its error.
    """
    archives = files.filter(names.is_archive(F.col("path"))).withColumn("upload", F.struct("path"))
    listed = list_members(archives)
    member = F.when(
        names.archive_type(F.col("archive")) == "gz", F.regexp_replace("archive", r"\.[^.]*\z", "")
    ).otherwise(F.col("member"))
    return listed.select(
        F.col("archive").alias("path"), F.when(F.col("member").isNotNull(), member).alias("member"), "error"
    )


def expand_archives(files: DataFrame, max_depth: int = 3, max_member: int = MAX_MEMBER_BYTES) -> DataFrame:
    """Files with archives replaced by their members, nested archives included.

    Adds ``upload_path`` (the scanned file), ``source_archive``, ``relative_path`` and
    ``error``; further columns of ``files`` ride along. Directories, unsafe paths and
    macOS metadata are left out. An archive that cannot be read, or lies deeper than
    ``max_depth`` levels, and every member that cannot be read, or unpacks to more than
    ``max_member`` bytes, give an error row.
    """
    others = [c for c in files.columns if c not in ("path", "content", "length", "modificationTime")]
    upload = F.struct(F.col("path").alias("upload_path"), *others)
    uploads = files.select("path", "content", upload.alias("upload"))
    packed = names.is_archive(F.col("path"))
    nothing = F.lit(None).cast("string")
    plain = uploads.filter(~packed).select(
        "path", "content", "upload.*", nothing.alias("source_archive"), nothing.alias("relative_path"),
        nothing.alias("error"),
    )
    members = open_archives(uploads.filter(packed), max_depth, max_member)
    unpacked = members.filter("member is null or (is_file and wanted)").select(
        F.when(F.col("member").isNull(), F.col("archive"))
        .otherwise(F.concat_ws("!/", "archive", "member"))
        .alias("path"),
        "content", "upload.*", F.col("archive").alias("source_archive"),
        F.col("member").alias("relative_path"), "error",
    )
    return plain.unionByName(unpacked)
