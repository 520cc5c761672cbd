"""File names: extensions, archive types, safe names and MIME types."""

from __future__ import annotations

import mimetypes
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions import jsontext as js
from corpusmill.functions import text as tx
from corpusmill.functions.binding import let, lookup

# Upload formats, archive endings, MIME types and their loaders.
UPLOAD_FORMATS = (
    "csv", "tsv", "json", "xlsx", "xls", "zip", "tar", "gz", "tar.gz", "tar.bz2", "html",
    "txt", "md", "rst", "eml", "msg", "pdf",
)
MIME_BY_EXTENSION = {
    ".csv": "text/csv",
    ".tsv": "text/tab-separated-values",
    ".json": "application/json",
    ".jsonl": "application/json",
    ".txt": "text/plain",
    ".md": "text/plain",
    ".rst": "text/plain",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".xls": "application/vnd.ms-excel",
    ".html": "text/html",
    ".htm": "text/html",
    ".xml": "application/xml",
    ".eml": "message/rfc822",
    ".msg": "application/vnd.ms-outlook",
}
ARCHIVE_ENDINGS = {
    "tar.z": (".tar.z", ".tar.zip"),
    "tar.bz2": (".tar.bz2", ".tbz2"),
    "tar.gz": (".tar.gz", ".tgz"),
    "tar": (".tar",),
    "zip": (".zip", ".zipx"),
    "gz": (".gz", ".gzip"),
}
COMPOUND_EXTENSIONS = (".tar.gz", ".tar.bz2", ".tar.xz")
LOADER_BY_MIME = {
    "text/csv": "csv",
    "text/tab-separated-values": "tsv",
    "application/json": "json",
    "text/json": "json",
    "text/plain": "text",
}
JSON_LINES_EXTENSIONS = (".jsonl", ".ndjson")
UNKNOWN_MIME = "application/octet-stream"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)\z", 1)


def extension(path: Column) -> Column:
    """Last suffix of the name in lower case, with its dot; empty without one.

    Leading dots belong to the name, a final dot starts no suffix.
    """
    return F.lower(F.regexp_extract(base_name(path), r"^\.*[^.].*?(\.[^.]+)\z", 1))


def detection_extension(path: Column) -> Column:
    """Like :func:`extension`, but the compound archive suffixes count as one."""
    lowered = F.lower(path)
    result = extension(path)
    for compound in reversed(COMPOUND_EXTENSIONS):
        result = F.when(F.endswith(lowered, F.lit(compound)), F.lit(compound)).otherwise(result)
    return result


def archive_type(path: Column) -> Column:
    """Archive type from everything after the first dot of the name, else ``unknown``."""
    suffixes = F.lower(F.regexp_extract(base_name(path), r"^[^.]*(\..*)\z", 1))

    def by_ending(suffixes: Column) -> Column:
        result = F.lit("unknown")
        for kind, endings in reversed(ARCHIVE_ENDINGS.items()):
            matches = [F.endswith(suffixes, F.lit(ending)) for ending in endings]
            result = F.when(reduce(Column.__or__, matches), F.lit(kind)).otherwise(result)
        return result

    return let(suffixes, by_ending)


def is_archive(path: Column) -> Column:
    return archive_type(path) != "unknown"


def is_allowed(name: Column) -> Column:
    """Whether the last suffix, or everything after the first dot, may be uploaded."""
    formats = sorted({*UPLOAD_FORMATS, *(e[1:] for e in MIME_BY_EXTENSION)})
    last = F.lower(F.regexp_extract(name, r"\.([^.]*)\z", 1))
    full = F.lower(F.regexp_extract(name, r"^[^.]*\.(.*)\z", 1))
    return F.contains(name, F.lit(".")) & (last.isin(formats) | full.isin(formats))


def safe_filename(name: Column) -> Column:
    """Everything but letters and digits becomes ``_``; no ``_`` at the end."""
    return F.rtrim(F.regexp_replace(name, F.lit(r"[^\p{L}\p{N}]"), F.lit("_")), F.lit("_"))


def _plain_letters() -> tuple[str, str]:
    """Accented characters whose compatibility form has one ASCII letter, and that letter."""
    pairs = []
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00)]:
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            pairs.append((chr(code), plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def upload_name(name: Column) -> Column:
    """ASCII file name without path separators, as uploads are stored."""
    accented, plain = _plain_letters()
    parts = F.split(tx.strip(F.translate(F.translate(name, accented, plain), "/", " ")), r"\s+")
    joined = F.regexp_replace(F.array_join(parts, "_"), F.lit(r"[^A-Za-z0-9_.-]"), F.lit(""))
    return F.btrim(joined, F.lit("._"))


def _has_loader(mime: Column) -> Column:
    return mime.isin(*LOADER_BY_MIME) | F.startswith(mime, F.lit("text/"))


def _guessed_from_name(path: Column) -> Column:
    """MIME type by file name, limited to types that have a loader."""
    types = mimetypes.MimeTypes(filenames=())
    known = {e: m for e, m in types.types_map[1].items() if m in LOADER_BY_MIME or m.startswith("text/")}
    packed = "|".join(sorted(e[1:] for e in types.encodings_map))
    bare = F.regexp_replace(path, F.lit(rf"(?<=[^/.])\.(?:{packed})\z"), F.lit(""))
    return lookup(known, extension(bare))


def _guessed_from_content(content: Column) -> Column:
    """JSON, then a comma in the first line, then mostly printable bytes; else null."""
    text = content.cast("string")
    valid = F.is_valid_utf8(text)
    looks_json = F.rlike(text, F.lit(rf"^[{tx.WHITESPACE_CLASS}]*[\{{\[]"))
    first_line = F.regexp_extract(text, r"^[^\r\n]*", 0)
    header = F.decode(F.substring(content, 1, 512), "ISO-8859-1")
    printable = F.length(F.regexp_replace(header, F.lit(r"[^\x20-\x7e\t\n\r]"), F.lit("")))
    return (
        F.when(valid & looks_json & js.is_json(text), F.lit("application/json"))
        .when(valid & F.contains(first_line, F.lit(",")), F.lit("text/csv"))
        .when((F.length(content) > 0) & (printable / F.length(header) > 0.7), F.lit("text/plain"))
    )


def mime_type(path: Column, content: Column | None = None, provided: Column | None = None) -> Column:
    """Provided type, then the name's, then the extension's, then the content's.

    The first two count only if a loader exists for them. Content is looked at only
    for rows that nothing else decides.
    """
    steps = [_guessed_from_name(path), lookup(MIME_BY_EXTENSION, detection_extension(path))]
    if provided is not None:
        steps.insert(0, F.when(_has_loader(provided), provided))
    if content is not None:
        steps.append(_guessed_from_content(content))
    return F.coalesce(*steps, F.lit(UNKNOWN_MIME))


def loader(path: Column, mime: Column) -> Column:
    """``csv``, ``tsv``, ``json``, ``jsonl`` or ``text``; null when there is none."""
    by_mime = F.coalesce(lookup(LOADER_BY_MIME, mime), F.when(F.startswith(mime, F.lit("text/")), "text"))
    lines = extension(path).isin(*JSON_LINES_EXTENSIONS)
    return let(by_mime, lambda name: F.when((name == "json") & lines, "jsonl").otherwise(name))
