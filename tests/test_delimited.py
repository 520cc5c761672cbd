import csv
import io

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusmill.sources import delimited

BASIC = 'id,name,notes\n1," a, b ","line one\nline two"\n2, x ,\n'
RAGGED = 'id, name ,notes\n1,,n\n2,y\n\n3,z,q, extra ,"m""o,re"\n"4"\n'
TRICKY = 'k,v\n"a ""quoted"" word",1\n,\n" , ",x,"y, z",w\n'


def python_documents(text, **options):
    """What the csv module makes of a file: the expected content per record."""
    found = []
    for record in csv.DictReader(io.StringIO(text, newline=""), **options):
        lines = []
        for name, value in record.items():
            shown = ",".join(v.strip() for v in value) if isinstance(value, list) else value
            shown = shown.strip() if isinstance(shown, str) else shown
            lines.append(f"{name if name is None else name.strip()}: {shown}")
        found.append("\n".join(lines))
    return found


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def contents(df):
    return [r.page_content for r in df.orderBy("row").collect()]


@pytest.mark.parametrize("text", [BASIC, RAGGED, TRICKY])
def test_records_match_the_csv_module(spark, tmp_path, text):
    path = write(tmp_path, "f.csv", text)
    docs = delimited.csv_documents(spark, path)
    assert contents(docs) == python_documents(text)
    assert [r.row for r in docs.orderBy("row").collect()] == list(range(len(python_documents(text))))


@pytest.mark.parametrize("text", [BASIC, RAGGED, TRICKY])
def test_text_in_a_column_gives_the_same_records(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    entries = df.select(F.inline(delimited.csv_entries(F.col("t"), F.lit(",")))).collect()
    assert [e.content for e in entries] == python_documents(text)
    assert [e.metadata["row"] for e in entries] == [str(i) for i in range(len(entries))]


def test_column_roles(spark, tmp_path):
    path = write(tmp_path, "cols.csv", "id,body,author,url\n1,text one,ann,u1\n2,text two,,u2\n")
    docs = delimited.csv_documents(spark, path, source_column="url", metadata_columns=["author", "id"])
    rows = docs.orderBy("row").collect()
    assert [(r.source, r.page_content, r.metadata) for r in rows] == [
        ("u1", "body: text one\nurl: u1", {"author": "ann", "id": "1"}),
        ("u2", "body: text two\nurl: u2", {"author": "", "id": "2"}),
    ]
    only = delimited.csv_documents(spark, path, metadata_columns=["body"], content_columns=["body"])
    assert contents(only) == ["body: text one", "body: text two"]
    for option in ({"source_column": "nope"}, {"metadata_columns": ["nope"]}):
        with pytest.raises(ValueError, match="nope"):
            delimited.csv_documents(spark, path, **option)


def test_csv_arguments(spark, tmp_path):
    path = write(tmp_path, "semi.csv", "1;'a;b'\n2;c\n")
    docs = delimited.csv_documents(spark, path, delimiter=";", quotechar="'", fieldnames=["n", "v"])
    assert contents(docs) == ["n: 1\nv: a;b", "n: 2\nv: c"]


def test_tsv_and_latin1(spark, tmp_path):
    path = write(tmp_path, "data.tsv", "id\tname\n1\tcafé, crème\n", "iso-8859-1")
    assert contents(delimited.tsv_documents(spark, path, encoding="ISO-8859-1")) == ["id: 1\nname: café, crème"]


def test_files_have_their_own_headers(spark, tmp_path):
    files = {
        "a.csv": "id,name\n1,ann\n", "b.csv": "name,id,more\nbob,2,x\n", "c.csv": "id,id,name\n3,4,cy\n5\n",
        "d.csv": "", "e.csv": "id,,name,\n6,7,dee,8,9\n",
    }
    for name, text in files.items():
        write(tmp_path, name, text)
    docs = delimited.csv_documents(spark, str(tmp_path)).collect()
    for name, text in files.items():
        own = sorted((r for r in docs if r.source.endswith(name)), key=lambda r: r.row)
        assert [r.page_content for r in own] == python_documents(text)
    picked = delimited.csv_documents(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv", "c.csv")], source_column="id", metadata_columns=["name"])
    assert {(r.source, r.metadata["name"]) for r in picked.collect()} == {("1", "ann"), ("2", "bob"), ("4", "cy"), (None, None)}
    with pytest.raises(ValueError, match="more"):
        delimited.csv_documents(spark, str(tmp_path), metadata_columns=["more"])


AWKWARD = [
    'a,b\n"x\n\n,""y""\n",1\r\n\n"\n",2\n3,"never closed\n4,5\n',
    'h\n' + "".join(f'"line {i}\n{"more " * (i % 40)}\n""end"""\n' for i in range(60)),
    'k,v\n' + "".join(f"{i},plain{i}\n" for i in range(400)) + '"' + "long\n" * 400 + '",z\n' + "x,y\n" * 50,
    'a"b,c\n1,5" pipe\n2,"q"tail, "no quote"\n"3"",""\n",4\n',
    '"head\ner","' + "wide\n" * 300 + '"\n1,2\n3,"4\n"\n',
    "old,mac\r1,2\r3,4\r",
    '"",""\n"","\n"\n,\n\n',
]


@pytest.mark.parametrize("text", AWKWARD)
@pytest.mark.parametrize("size", ["700"])
def test_blocks_of_any_size_give_the_same_records(spark, tmp_path, text, size):
    write(tmp_path, "f.csv", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = delimited.csv_documents(spark, str(tmp_path)).orderBy("row").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.page_content for r in rows] == python_documents(text)
    assert [r.row for r in rows] == list(range(len(rows)))


def test_wide_encodings(spark, tmp_path):
    path = write(tmp_path, "wide.csv", 'id,name\n1,"caf\u00e9\n\u65e5"\n2,x\n', "utf-16")
    assert contents(delimited.csv_documents(spark, path, encoding="UTF-16")) == ["id: 1\nname: caf\u00e9\n\u65e5", "id: 2\nname: x"]


def test_undecodable_values_raise_or_fall_back(spark, tmp_path):
    write(tmp_path, "latin.csv", "idé,name\n1,café\n2,x\n", "iso-8859-1")
    with pytest.raises(PySparkException, match="cannot decode"):
        delimited.csv_documents(spark, str(tmp_path / "latin.csv"))
    write(tmp_path, "value.csv", "id,name\n1,café\n2,x\n", "iso-8859-1")
    with pytest.raises(PySparkException, match="cannot decode"):
        delimited.csv_documents(spark, str(tmp_path / "value.csv")).collect()
    assert contents(delimited.csv_documents(spark, str(tmp_path / "latin.csv"), autodetect=True)) == [
        "idé: 1\nname: café", "idé: 2\nname: x"
    ]
    write(tmp_path, "utf8.csv", "né,名\n1,日本\n")
    assert contents(delimited.csv_documents(spark, str(tmp_path / "utf8.csv"))) == ["né: 1\n名: 日本"]


def test_rows_are_numbered_per_file(spark, tmp_path):
    for name, n in [("a.csv", 5), ("b.csv", 3), ("c.csv", 700)]:
        write(tmp_path, name, "v\n" + "".join(f"{name}{i}\n" for i in range(n)))
    docs = delimited.csv_documents(spark, str(tmp_path)).collect()
    assert len(docs) == 708
    assert all(r.page_content == f"v: {r.source.rsplit('/', 1)[1]}{r.row}" for r in docs)


def test_rows_are_numbered_across_the_blocks_of_a_file(spark, tmp_path):
    path = write(tmp_path, "big.csv", "v\n" + "".join(f"{i}\n" for i in range(30_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        docs = delimited.csv_documents(spark, path)
        assert docs.select(F.spark_partition_id()).distinct().count() > 3
        assert docs.filter(F.col("page_content") != F.concat(F.lit("v: "), F.col("row"))).count() == 0
        assert docs.count() == 30_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_line_is_looked_at_once_when_both_starts_agree(monkeypatch):
    from corpusmill.sources import records

    asked = []
    stays_open = records.Dialect.stays_open
    monkeypatch.setattr(records.Dialect, "stays_open", lambda d, *a: asked.append(a) or stays_open(d, *a))
    lines = [b'a,"x', b'""1",z'] * 50 + [b'q,"never closed']
    batch = pa.RecordBatch.from_pydict({"file_path": ["f"] * 101, "_block": [0] * 101, "value": lines})
    found = pa.Table.from_batches(list(records._summed(records.Dialect(",", '"', "utf-8", False))([batch]))).to_pylist()
    assert [(r["end_outside"], r["end_inside"], r["rows_outside"], r["rows_inside"]) for r in found] == [(True, True, 51, 51)]
    assert found[0]["header"] == ["a", 'x\n"1', "z"]
    assert len(asked) < 110  # 202 when each line is looked at for both
