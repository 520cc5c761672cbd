import mimetypes
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import names

PATHS = [
    "a.txt", "/x/A.CSV", "b.tar.gz", "b.TAR.BZ2", "c.tgz", "c.tbz2", "d.zipx", "d.zip", "e.gz", "e.gzip",
    "f.tar", "f.tar.z", "f.tar.zip", "g", ".hidden", ".csv", "..x.json", "h.", "i.v1.2.md", "/dir.zip/j.rst",
    "k.jsonl", "l.ndjson", "m.py", "n.xlsx", "o.eml", "p.html", "q.xml", "r.txt.gz", "s.csv.bz2", "t.tar.xz",
    "u.js", "/a.b/c", "v.TXT", "w.pdf",
]


def table(spark, column):
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    return {r.path: r.x for r in df.select("path", column.alias("x")).collect()}


def test_extension_is_the_suffix_of_pathlib(spark):
    found = table(spark, names.extension(F.col("path")))
    assert found == {p: Path(p).suffix.lower() for p in PATHS}


def test_archive_types(spark):
    found = table(spark, names.archive_type(F.col("path")))
    known = {
        "b.tar.gz": "tar.gz", "b.TAR.BZ2": "tar.bz2", "c.tgz": "tar.gz", "c.tbz2": "tar.bz2", "d.zipx": "zip",
        "d.zip": "zip", "e.gz": "gz", "e.gzip": "gz", "f.tar": "tar", "f.tar.z": "tar.z", "f.tar.zip": "tar.z",
        "r.txt.gz": "gz",
    }
    assert found == {p: known.get(p, "unknown") for p in PATHS}


def test_name_guess_is_that_of_mimetypes_where_a_loader_exists(spark):
    types = mimetypes.MimeTypes(filenames=())
    found = table(spark, names._guessed_from_name(F.col("path")))
    for path in PATHS:
        guess = types.guess_type(path)[0]
        has_loader = guess is not None and (guess in names.LOADER_BY_MIME or guess.startswith("text/"))
        assert found[path] == (guess if has_loader else None), path


def test_allowed(spark):
    found = table(spark, names.is_allowed(names.base_name(F.col("path"))))
    refused = {"g", ".hidden", "h.", "l.ndjson", "m.py", "d.zipx", "c.tgz", "c.tbz2", "e.gzip", "f.tar.z",
               "t.tar.xz", "u.js", "s.csv.bz2", "/a.b/c"}
    assert {p for p, ok in found.items() if not ok} == refused


CONTENTS = [
    ("noext_json", b' {"a": [1]} ', "application/json"), ("noext_list", b"[1, 2]", "application/json"),
    ("broken", b'{"a": 1, ', "text/csv"), ("noext_csv", b"a,b\n1,2\n", "text/csv"),
    ("plain", b"no comma here\nbut, here", "text/plain"), ("bin", bytes(range(256)), names.UNKNOWN_MIME),
    ("empty", b"", names.UNKNOWN_MIME), ("latin", "café au lait".encode("latin-1"), "text/plain"),
    ("long", b"x" * 600 + bytes(600), "text/plain"), ("x.md", b"a,b", "text/markdown"),
    ("x.jsonl", b"a,b", "application/json"), ("x.eml", b"a,b", "message/rfc822"),
]


def test_content_detection(spark):
    rows = [(p, bytearray(c)) for p, c, _ in CONTENTS]
    df = spark.createDataFrame(rows, "path string, content binary")
    found = {r.path: r.m for r in df.select("path", names.mime_type(F.col("path"), F.col("content")).alias("m")).collect()}
    assert found == {p: m for p, _, m in CONTENTS}


@pytest.mark.parametrize(
    "provided, expected", [("text/csv", "text/csv"), ("text/x-log", "text/x-log"), ("image/png", "text/plain"), (None, "text/plain")]
)
def test_provided_type_counts_only_with_a_loader(spark, provided, expected):
    df = spark.createDataFrame([("a.txt", provided)], "path string, given string")
    assert df.select(names.mime_type(F.col("path"), provided=F.col("given"))).collect()[0][0] == expected


def test_routing(spark):
    cases = [("a.csv", "text/csv", "csv"), ("a.tsv", "text/tab-separated-values", "tsv"), ("a.json", "application/json", "json"),
             ("a", "text/json", "json"), ("a.JSONL", "application/json", "jsonl"), ("a.ndjson", "application/json", "jsonl"),
             ("a.html", "text/html", "text"), ("a.xlsx", "application/vnd.ms-excel", None), ("a", None, None)]
    df = spark.createDataFrame(cases, "path string, mime string, want string")
    for r in df.select("want", names.loader(F.col("path"), F.col("mime")).alias("got")).collect():
        assert r.want == r.got


def test_safe_names(spark):
    cases = ["my file (1).txt", "été__", "日本語.md", "___", "../../etc/passwd", "a b\tc.txt", "Ünï cödé.csv", ".hidden"]
    df = spark.createDataFrame([(c,) for c in cases], "n string")
    rows = df.select("n", names.safe_filename(F.col("n")).alias("s"), names.upload_name(F.col("n")).alias("u")).collect()
    for r in rows:
        assert r.s == "".join(c if c.isalnum() else "_" for c in r.n).rstrip("_")
    uploads = {r.n: r.u for r in rows}
    assert uploads["my file (1).txt"] == "my_file_1.txt"
    assert uploads["../../etc/passwd"] == "etc_passwd"
    assert uploads["a b\tc.txt"] == "a_b_c.txt"
    assert uploads["Ünï cödé.csv"] == "Uni_code.csv"
    assert uploads[".hidden"] == "hidden"
