import bz2
import gzip
import hashlib
import io
import tarfile
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusmill.functions import names
from corpusmill.operators import manifest
from corpusmill.plans import ingest
from corpusmill.sources import archives, files, textual
from corpusmill.streaming import ingest as streaming


def zipped(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as box:
        for name, data in members.items():
            box.writestr(name, data)
    return out.getvalue()


def tarred(members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as box:
        folder = tarfile.TarInfo("folder")
        folder.type = tarfile.DIRTYPE
        box.addfile(folder)
        link = tarfile.TarInfo("link.txt")
        link.type, link.linkname = tarfile.SYMTYPE, "/etc/passwd"
        box.addfile(link)
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            box.addfile(info, io.BytesIO(data))
    return out.getvalue()


BUNDLE = {
    "a.txt": b"alpha", "d/b.csv": b"k,v\n1,2\n3,4\n", "d/": b"", "__MACOSX/x.txt": b"x", "._y.txt": b"y",
    "d/._z.txt": b"z", "../evil.txt": b"e", "/abs.txt": b"e", "a..b.txt": b"dots",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("uploads")
    deep = zipped({"deep.txt": b"level four"})
    for level in (3, 2, 1):
        deep = zipped({f"l{level}.zip": deep, f"at{level}.txt": f"level {level}".encode()})
    contents = {
        "bundle.zip": zipped(BUNDLE),
        "nested.tar.gz": gzip.compress(tarred({"inner.zip": deep, "n.md": b"note"})),
        "bz.tar.bz2": bz2.compress(tarred({"t.json": b'[{"a": 1}, {"a": 2}]'})),
        "one.txt.gz": gzip.compress(b"gz text"),
        "bad.zip": b"this is no archive",
        "old.tar.z": b"?",
        "only_bin.zip": zipped({"x.bin": bytes(range(256))}),
        "crlf.txt": b"one\r\ntwo\rthree\n",
        "lines.jsonl": b'{"t": 1}\n\nnope\n{"t": 2}\n',
        "broken.json": b"{broken",
        "latin.txt": "café".encode("latin-1"),
        "book.xlsx": b"PK..",
        "header.csv": b"a,b\n",
        "rows.tsv": b"a\tb\n1\t2\n",
    }
    for name, data in contents.items():
        (base / name).write_bytes(data)
    return base


def test_expand_archives(spark, folder):
    found = archives.expand_archives(files.scan_files(spark, str(folder)))
    rows = found.filter("source_archive is not null").collect()

    def short(path):
        return path.split("/uploads", 1)[-1].split("/", 1)[1]

    got = {(short(r.upload_path), r.relative_path): bytes(r.content) for r in rows if r.error is None}
    assert got == {
        ("bundle.zip", "a.txt"): b"alpha", ("bundle.zip", "d/b.csv"): BUNDLE["d/b.csv"],
        ("bundle.zip", "a..b.txt"): b"dots", ("nested.tar.gz", "n.md"): b"note",
        ("nested.tar.gz", "at1.txt"): b"level 1", ("nested.tar.gz", "at2.txt"): b"level 2",
        ("bz.tar.bz2", "t.json"): b'[{"a": 1}, {"a": 2}]', ("one.txt.gz", "one.txt"): b"gz text",
        ("only_bin.zip", "x.bin"): bytes(range(256)),
    }
    errors = {short(r.upload_path): r.error for r in rows if r.error is not None}
    assert errors["nested.tar.gz"] == "nested too deep"
    assert errors["bad.zip"].startswith("BadZipFile")
    assert errors["old.tar.z"] == "unsupported archive type tar.z"
    assert set(errors) == {"nested.tar.gz", "bad.zip", "old.tar.z"}


def damaged(box: bytes, name: str) -> bytes:
    """The zip with the packed bytes of one member overwritten."""
    with zipfile.ZipFile(io.BytesIO(box)) as archive:
        start = archive.getinfo(name).header_offset + 30 + len(name)
    return box[:start] + b"\xff" * 4 + box[start + 4 :]


def test_damaged_members_do_not_hide_others(spark):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as box:
        for name in ("a.txt", "b.txt", "c.txt"):
            box.writestr(name, name * 50)
    broken = damaged(out.getvalue(), "a.txt")
    tar = tarred({"x.txt": b"x" * 3000, "in.zip": broken, "y.txt": b"y" * 3000})
    cases = {
        "one.zip": broken, "whole.tar": tar, "cut.tar": tar[: tar.index(b"y" * 99) + 1000], "bad.txt.gz": gzip.compress(b"z" * 99)[:-9],
        "cut.tar.gz": gzip.compress(tar)[:-40], "named.tar.gz": tar, "bomb.txt.gz": gzip.compress(bytes(5000)),
    }
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in cases.items()], "path string, content binary")
    found = archives.open_archives(df.withColumn("upload", F.struct("path")), max_member=4000).collect()
    good = {(r.upload.path, r.archive, r.member) for r in found if r.error is None}
    bad = {(r.upload.path, r.member): r.error for r in found if r.error is not None}
    for name in ("b.txt", "c.txt"):
        assert ("one.zip", "one.zip", name) in good and ("whole.tar", "whole.tar!/in.zip", name) in good
    assert "invalid block type" in bad[("one.zip", "a.txt")]
    assert {("whole.tar", "whole.tar", "x.txt"), ("whole.tar", "whole.tar", "y.txt"), ("named.tar.gz", "named.tar.gz", "y.txt")} <= good
    assert ("cut.tar", "cut.tar", "x.txt") in good and any(k[0] == "cut.tar" for k in bad)
    assert any(k[0] == "cut.tar.gz" for k in bad) and ("bad.txt.gz", "bad.txt") in bad
    assert bad[("bomb.txt.gz", "bomb.txt")] == "ValueError: unpacks to more than 4000 bytes"


def test_members_of_one_zip_are_unpacked_by_many_tasks(spark):
    """Stored, deflated, LZMA, streamed, empty and repeated members; 10,000 in one archive."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as box:
        for n in range(10_000):
            box.writestr(f"d/é{n}.txt", f"text {n} " * (n % 7))
        box.writestr("stored.txt", b"as it is", zipfile.ZIP_STORED)
        box.writestr("other.txt", b"packed otherwise", zipfile.ZIP_LZMA)
        with box.open("streamed.txt", "w") as member:
            member.write(b"size unknown at first" * 100)
        box.writestr("in.zip", zipped({"deep.txt": b"deep"}))
    raw = b"something before" + out.getvalue()
    df = spark.createDataFrame([("/in/a.zip", raw)], "path string, content binary")
    found = archives.expand_archives(df).withColumn("task", F.spark_partition_id()).collect()
    with zipfile.ZipFile(io.BytesIO(raw)) as box:
        expected = {i.filename: box.read(i) for i in box.infolist() if i.filename != "in.zip"} | {"deep.txt": b"deep"}
    assert {r.relative_path: bytes(r.content) for r in found} == expected and len(found) == len(expected)
    assert all(r.error is None for r in found)
    tasks = [sum(r.task == t for r in found) for t in {r.task for r in found}]
    assert len(tasks) >= 4 and max(tasks) < len(found) / 2


def test_members_a_zip_does_not_describe_rightly(spark):
    """A directory that differs from the member's own head, an encrypted member, a cut one."""
    good = zipped({"a.txt": b"aa" * 50, "b.txt": b"bb" * 50})
    renamed = good.replace(b"a.txt", b"c.txt", 1)
    directory = good.index(b"PK\x01\x02")
    locked = bytearray(good)
    locked[directory + 8] |= 1
    rows = [("/in/renamed.zip", renamed), ("/in/locked.zip", bytes(locked)), ("/in/cut.zip", good[:-30]), ("/in/none.zip", b"")]
    found = archives.expand_archives(spark.createDataFrame(rows, "path string, content binary")).collect()
    by = {(r.upload_path, r.relative_path): (r.content, r.error) for r in found}
    assert len(by) == len(found) == 6
    for name in ("renamed", "locked"):
        assert by[(f"/in/{name}.zip", "a.txt")][0] is None and by[(f"/in/{name}.zip", "a.txt")][1]
        assert by[(f"/in/{name}.zip", "b.txt")] == (b"bb" * 50, None)
    assert by[("/in/cut.zip", None)][1] and by[("/in/none.zip", None)][1]


def test_list_of_an_unreadable_archive(spark, folder):
    rows = archives.list_archive(files.scan_files(spark, str(folder), glob="bad.zip")).collect()
    assert [(r.member, r.error.split(":")[0]) for r in rows] == [(None, "BadZipFile")]


def test_names_in_two_folders_and_second_uploads(spark):
    rows = [("x/d.txt", 1, bytearray(b"a")), ("y/d.txt", 1, bytearray(b"b"))]
    df = spark.createDataFrame(rows, "path string, length bigint, content binary")
    first, second = (manifest.build_manifest(df, uploaded_at=F.timestamp_seconds(F.lit(s))) for s in (100, 200))
    both = first.unionByName(second)
    assert both.select("upload_id").distinct().count() == 4
    documents, _ = ingest.process_files(df, both)
    assert sorted((r.source, r.upload_timestamp.minute, r.upload_timestamp.second) for r in documents.collect()) == [
        ("x/d.txt", 3, 20), ("y/d.txt", 3, 20)
    ]


def test_loader_options(spark):
    rows = [("a.csv", bytearray("id;né;c\n1;x;y\n".encode("latin-1"))), ("b.csv", bytearray(b"id;c\n1;2\n"))]
    df = spark.createDataFrame(rows, "path string, content binary")
    options = {"delimiter": ";", "encoding": "latin-1", "metadata_columns": ["id"], "content_columns": ["né"]}
    documents, outcomes = ingest.process_files(df, **options)
    assert [(r.page_content, r.metadata) for r in documents.collect()] == [("né: x", {"row": "0", "id": "1"})]
    assert {r.path: r.status for r in outcomes.collect()} == {"a.csv": "completed", "b.csv": "failed"}


def test_depth_limit(spark, folder):
    scanned = files.scan_files(spark, str(folder), glob="nested*")
    counts = [archives.expand_archives(scanned, d).filter("error is null").count() for d in (1, 2, 3, 4, 5)]
    assert counts == [1, 2, 3, 4, 5]


def test_list_archive(spark, folder):
    rows = archives.list_archive(files.scan_files(spark, str(folder))).collect()
    members = {}
    for r in rows:
        members.setdefault(r.path.rsplit("/", 1)[1], []).append(r.member)
    assert sorted(members["bundle.zip"]) == sorted(BUNDLE)
    assert sorted(members["nested.tar.gz"]) == ["folder", "inner.zip", "link.txt", "n.md"]
    assert members["one.txt.gz"][0].endswith("/one.txt")


def test_process_files(spark, folder):
    scanned = files.scan_files(spark, str(folder))
    known = manifest.build_manifest(scanned)
    running = manifest.mark_processing(known, known)
    documents, outcomes = ingest.process_files(scanned, known)

    by_file = {}
    for r in documents.collect():
        by_file.setdefault(r.source.rsplit("/", 1)[1], []).append(r)
    assert [r.page_content for r in by_file["crlf.txt"]] == ["one\ntwo\nthree\n"]
    assert [r.page_content for r in by_file["b.csv"]] == ["k: 1\nv: 2", "k: 3\nv: 4"]
    assert [r.page_content for r in by_file["t.json"]] == ['{\n  "a": 1\n}', '{\n  "a": 2\n}']
    assert [(r.seq_num, r.metadata) for r in by_file["lines.jsonl"]] == [(0, {"t": "1"}), (3, {"t": "2"})]
    assert [r.page_content for r in by_file["rows.tsv"]] == ["a: 1\nb: 2"]
    one = by_file["b.csv"][0]
    assert (one.original_filename, one.relative_path, one.detected_mime_type) == ("bundle.zip", "d/b.csv", "text/csv")
    assert "_bundle.zip_" in one.upload_id and len(one.file_checksum) == 64
    assert one.source_archive.endswith("/bundle.zip") and one.processing_timestamp is not None

    states = {r.path.rsplit("/", 1)[1]: (r.status, r.n_documents) for r in outcomes.collect()}
    assert states["broken.json"] == ("failed", 0)
    assert states["latin.txt"] == ("failed", 0)
    assert states["book.xlsx"] == ("unsupported", 0)
    assert states["header.csv"] == ("empty", 0)
    assert states["b.csv"] == ("completed", 2)

    final = {r.original_filename: (r.status, r.error_message) for r in manifest.apply_outcomes(running, outcomes).collect()}
    message = "No processable files found after extraction"
    for name in ("bad.zip", "old.tar.z", "only_bin.zip"):
        assert final[name] == ("failed", message)
    for name in ("bundle.zip", "broken.json", "book.xlsx", "crlf.txt", "one.txt.gz"):
        assert final[name] == ("completed", None)


def test_autodetect_and_custom_loader(spark, folder):
    scanned = files.scan_files(spark, str(folder), glob="{latin.txt,book.xlsx,crlf.txt}")

    def letters(text):
        one = lambda c, i: F.struct(
            i.cast("bigint").alias("seq_num"), c.alias("content"), F.lit(False).alias("is_json"),
            F.create_map().cast("map<string,string>").alias("metadata"),
        )
        return F.transform(F.split(text, ""), one)

    sheet = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"
    documents, _ = ingest.process_files(scanned, autodetect=True, custom={sheet: letters})
    found = sorted((r.source.rsplit("/", 1)[1], r.seq_num, r.page_content) for r in documents.collect())
    assert found == [
        ("book.xlsx", 0, "P"), ("book.xlsx", 1, "K"), ("book.xlsx", 2, "."), ("book.xlsx", 3, "."),
        ("crlf.txt", 0, "one\ntwo\nthree\n"), ("latin.txt", 0, "café"),
    ]


def test_stream_gives_the_batch_result_once(spark, folder, tmp_path):
    target, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "huge.txt").write_text("x" * 20_000)
    states = str(tmp_path / "states")
    uploads = sorted(p.name for p in folder.iterdir())
    for wave in (uploads[:7], uploads[7:]):
        for name in wave:
            (incoming / name).write_bytes((folder / name).read_bytes())
        streaming.ingest_available(spark, str(incoming), target, progress, max_size=10_000, outcomes=states)
    found = {r.path.rsplit("/", 1)[1]: (r.status, r.error) for r in spark.read.parquet(states).collect()}
    assert found["huge.txt"][0] == "failed" and found["huge.txt"][1].startswith("File too large: 20000 bytes")
    assert found["broken.json"] == ("failed", "invalid content") and found["crlf.txt"][0] == "completed"
    (incoming / "huge.txt").unlink()
    streamed = spark.read.parquet(target)
    batch, _ = ingest.process_files(files.scan_files(spark, str(incoming)))

    def key(r):
        return (r.source.replace("file://", "file:"), r.seq_num, r.page_content, r.relative_path)

    assert sorted(map(str, map(key, streamed.collect()))) == sorted(map(str, map(key, batch.collect())))


def test_text_documents(spark, folder):
    docs = textual.read_text_documents(spark, str(folder / "crlf.txt")).collect()
    assert [r.page_content for r in docs] == ["one\ntwo\nthree\n"]
    with pytest.raises(PySparkException, match="cannot decode"):
        textual.read_text_documents(spark, str(folder / "latin.txt")).collect()
    found = textual.read_text_documents(spark, str(folder / "latin.txt"), autodetect=True).collect()[0]
    assert (found.page_content, found.charset) == ("café", "iso8859-1")
    assert textual.read_text_documents(spark, str(folder / "latin.txt"), encoding="cp1252").collect()[0].page_content == "café"
    assert [r.page_content for r in textual.read_gzip_text(spark, str(folder / "one.txt.gz")).collect()] == ["gz text"]


def test_utf16_and_unknown_bytes(spark):
    rows = [("a", bytearray("héllo".encode("utf-16"))), ("b", bytearray(b"\xff\xfeabc")), ("c", bytearray(b""))]
    df = spark.createDataFrame(rows, "path string, content binary")
    got = {r.path: (r.d.text, r.d.charset) for r in df.select("path", files.decoded(F.col("content"), autodetect=True).alias("d")).collect()}
    assert got["a"] == ("héllo", "utf-16")
    assert got["b"] == ("ÿþabc", "iso8859-1")
    assert got["c"] == ("", "utf-8")


def test_manifest(spark, tmp_path):
    rows = [("/u/a b.txt", 5, bytearray(b"hello")), ("/u/big.txt", 9, bytearray(b"too large")), ("/u/x.exe", 2, bytearray(b"MZ"))]
    df = spark.createDataFrame(rows, "path string, length bigint, content binary")
    when = F.timestamp_seconds(F.lit(1_700_000_000))
    built = manifest.build_manifest(df, max_size=8, check_extension=True, uploaded_at=when)
    got = {r.original_filename: r for r in built.collect()}
    hashed = hashlib.md5(b"/u/a b.txt").hexdigest()[:12]
    assert got["a b.txt"].upload_id == f"20231114_221320_a_b.txt_{hashed}"
    assert got["a b.txt"].checksum == "2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c1fa7425e73043362938b9824"
    assert got["big.txt"].error_message == "File too large: 9 bytes (max: 8 bytes)"
    assert got["x.exe"].error_message == "File type not allowed: x.exe"
    assert [got[n].status for n in ("a b.txt", "big.txt", "x.exe")] == ["completed", "failed", "failed"]
    path = str(tmp_path / "manifest")
    assert manifest.read_manifest(spark, path).count() == 0
    manifest.append_manifest(built, path)
    stored = manifest.read_manifest(spark, path)
    assert manifest.list_uploads(stored).count() == 3
    ident = got["a b.txt"].upload_id
    assert manifest.upload_status(stored, ident).collect()[0].status == "completed"
    assert manifest.get_upload(stored, ident).count() == 1
    left = manifest.delete_uploads(stored, spark.createDataFrame([(ident,)], "upload_id string"))
    assert left.count() == 2
    manifest.delete_stored(spark, path, stored.filter(F.col("upload_id") == ident))
    assert {r.original_filename for r in manifest.read_manifest(spark, path).collect()} == {"big.txt", "x.exe"}
    kept = manifest.read_manifest(spark, path)
    running = kept.filter("original_filename = 'big.txt'")
    manifest.append_manifest(manifest.mark_processing(running, running), path)
    states = {("big.txt", "processing", None), ("x.exe", "failed", "File type not allowed: x.exe")}
    stored_states = lambda: {(r.original_filename, r.status, r.error_message) for r in manifest.read_manifest(spark, path).collect()}
    assert stored_states() == states
    manifest.compact_manifest(spark, path)
    assert manifest._committed(spark, path)[0] == 4 and len(manifest._committed(spark, path)[1]) == 1
    assert stored_states() == states
    manifest.append_manifest(built.filter("original_filename = 'a b.txt'"), path)
    assert stored_states() == states | {("a b.txt", "completed", None)}
    assert manifest.supported_extensions(spark).count() == 14
    assert manifest.supported_mime_types(spark).count() == 5


def test_manifest_survives_failed_changes(spark, tmp_path):
    path = str(tmp_path / "manifest")
    df = spark.createDataFrame([("/u/a.txt", 2, bytearray(b"ab"))], "path string, length bigint, content binary")
    built = manifest.build_manifest(df, uploaded_at=F.timestamp_seconds(F.lit(1)))
    manifest.append_manifest(built.limit(0), path)
    assert manifest.read_manifest(spark, path).count() == 0
    manifest.append_manifest(built, path)
    before = manifest.read_manifest(spark, path).collect()
    # A change that was written but not committed, and one that stopped while it was written.
    manifest._write_change(built.withColumn("removed", F.lit(True)), path, 3)
    with pytest.raises(Exception, match="stop"):
        manifest.append_manifest(built.withColumn("status", F.raise_error(F.lit("stop")).cast("string")), path)
    assert manifest.read_manifest(spark, path).collect() == before
    # Another writer has taken the number.
    with pytest.raises(Exception, match="(?i)exist"):
        manifest._commit(spark, path, 2, [])
    assert manifest.read_manifest(spark, path).collect() == before
    manifest.delete_stored(spark, path, built)
    assert manifest.read_manifest(spark, path).count() == 0


def test_router_takes_dialects_and_member_bounds(spark):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as bundle:
        bundle.writestr("small.txt", "x" * 10)
        bundle.writestr("large.txt", "x" * 11)
    rows = [("/in/a.csv", bytearray("1;'x;y'\n2;z\n".encode())), ("/in/b.zip", bytearray(packed.getvalue()))]
    scanned = spark.createDataFrame(rows, "path string, content binary")
    options = {"delimiter": ";", "quotechar": "'", "fieldnames": ["id", "name"], "max_member": 10}
    documents, outcomes = ingest.process_files(scanned, **options)
    got = sorted((r.source, r.seq_num, r.page_content) for r in documents.collect())
    assert got == [
        ("/in/a.csv", 0, "id: 1\nname: x;y"), ("/in/a.csv", 1, "id: 2\nname: z"), ("/in/b.zip!/small.txt", 0, "x" * 10),
    ]
    bad = outcomes.filter("status <> 'completed'").collect()
    assert [(r.path, "more than 10 bytes" in r.error) for r in bad] == [("/in/b.zip!/large.txt", True)]
    _, free = ingest.process_files(scanned, **options | {"max_member": 11})
    assert {r.status for r in free.collect()} == {"completed"}


def test_oversized_files_are_not_read(spark, folder):
    scanned = files.scan_files(spark, str(folder), max_size=10)
    assert "LessThanOrEqual(length,10)" in scanned._jdf.queryExecution().executedPlan().toString()
    assert all(r.length <= 10 for r in scanned.select("length").collect())


def test_blob_source(spark):
    df = spark.createDataFrame([({"source": "s"}, "p"), ({}, "p"), (None, "q")], "m map<string,string>, p string")
    got = [r[0] for r in df.select(files.blob_source(F.col("m"), F.col("p"))).collect()]
    assert got == ["s", "p", "q"]


def test_plain_files_and_archives_are_each_read_once(spark, folder):
    scanned = files.scan_files(spark, str(folder))
    packed = names.is_archive(F.col("path"))
    read = []
    for wanted in (packed, ~packed):
        df = scanned.filter(wanted).select("path", "content")
        df.collect()
        metrics = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics()
        read.append(metrics.apply("numFiles").value())
    assert sum(read) == len(list(folder.iterdir())) and min(read) > 0


def test_rejected_files_are_not_read(spark, tmp_path):
    (tmp_path / "small.txt").write_text("x" * 40)
    (tmp_path / "huge.txt").write_text("x" * 400)
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "100")
    try:
        rows = manifest.build_manifest(files.scan_files(spark, str(tmp_path)), max_size=50).collect()
    finally:
        spark.conf.unset(limit)
    assert {r.original_filename: (r.status, r.checksum is None) for r in rows} == {
        "small.txt": ("completed", False), "huge.txt": ("failed", True)
    }


def test_outcomes_leave_documents_unread(spark):
    rows = [("/in/a.txt", b"one\r\ntwo"), ("/in/b.zip", zipped({"c.csv": "x,y\n1,2\n3,4\n", "d.bin": b"\0"})), ("/in/e.json", b"{")]
    documents, outcomes = ingest.process_files(spark.createDataFrame(rows, "path string, content binary"))
    scans = outcomes._jdf.queryExecution().executedPlan().toString()
    assert "loader" in scans and "entries" not in scans
    assert {r.path: (r.status, r.n_documents) for r in outcomes.collect()} == {
        "/in/a.txt": ("completed", 1), "/in/b.zip!/c.csv": ("completed", 2), "/in/b.zip!/d.bin": ("unsupported", 0),
        "/in/e.json": ("failed", 0),
    }
    assert "n_documents" not in documents.columns
    assert sorted(r.page_content for r in documents.collect()) == ["one\ntwo", "x: 1\ny: 2", "x: 3\ny: 4"]


def test_members_of_many_uploads_share_batches():
    """A record batch for each member cost more than unpacking it."""
    uploads = archives.pa.array([{"upload_path": f"/in/{i}.zip"} for i in range(700)])
    rows = [(i, (f"/in/{i}.zip", f"{n}.txt", True, True, b"x" * (i % 7), None)) for i in range(700) for n in range(i % 4)]
    for most, size in ((1000, 8 << 20), (1000, 500), (3, 8 << 20)):
        batches = list(archives._grouped(uploads, iter(rows), archives._MEMBER_FIELDS, archives._MEMBER_TYPES, most, size))
        found = [r for b in batches for r in b.to_pylist()]
        assert [(r["upload"]["upload_path"], r["archive"], r["member"], r["content"]) for r in found] == [
            (a, a, member, content) for _, (a, member, _, _, content, _) in rows
        ]
        assert all(b.num_rows <= most and sum(map(len, b.column("content").to_pylist())) < size + 7 for b in batches)
        assert len(batches) == (-(-len(rows) // most) if size > 500 else len(batches))
    assert list(archives._grouped(uploads, iter(()), archives._MEMBER_FIELDS, archives._MEMBER_TYPES)) == []
