import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusmill.functions import jsontext
from corpusmill.plans import ingest
from corpusmill.sources import jsonlike


def files(spark, *texts):
    rows = [(f"/f{i}.json", bytearray(t, "utf-8")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "path string, content binary")


def documents(spark, text, **options):
    rows = jsonlike.json_documents(files(spark, text), **options).orderBy("seq_num").collect()
    return [(r.page_content, r.metadata) for r in rows]


def test_array_root(spark):
    items = [{"text": "é", "n": 1.50, "ok": True, "none": None, "l": [1]}, 3, 1e3, "s", None, [1, {"a": "b"}], False, {}]
    found = documents(spark, json.dumps(items))
    assert [c for c, _ in found] == [
        json.dumps(items[0], indent=2), "3", "1000.0", "s", "", json.dumps(items[5], indent=2), "False", "{}"
    ]
    assert found[0][1] == {"text": "é", "n": "1.5", "ok": "true", "none": None}
    assert all(m == {} for _, m in found[1:])


def test_object_root_unfolds_the_first_filled_list(spark):
    text = '{"meta": {"v": 1}, "z": 1, "empty": [ ], "items": [{"t": "a", "z": 9}, "b"], "a": [1], "name": "n"}'
    found = documents(spark, text)
    assert found[0] == (
        json.dumps({"t": "a", "z": 9}, indent=2),
        {"parent_key": "items", "context_z": "1", "context_name": "n", "t": "a", "z": "9"},
    )
    assert found[1] == ("b", {"parent_key": "items"})
    assert len(found) == 2


@pytest.mark.parametrize("text", ['{"a": 1, "b": {"c": []}}', '{"a": []}', "{}"])
def test_object_without_a_filled_list_is_one_document(spark, text):
    assert [c for c, _ in documents(spark, text)] == [json.dumps(json.loads(text), indent=2)]


@pytest.mark.parametrize("text, content", [("3", "3"), ('"x\\ny"', "x\ny"), ("null", ""), ("true", "True"), (" 2.5 ", "2.5")])
def test_scalar_root(spark, text, content):
    assert documents(spark, text) == [(content, {})]


def test_empty_list_has_no_documents(spark):
    assert documents(spark, "[]") == []


def test_content_key_and_metadata_keys(spark):
    items = [{"t": "x", "n": 1, "l": [1]}, {"n": 2}, {"t": {"deep": 1}}, {"t": None}, {"t": 4.0}, "plain"]
    found = documents(spark, json.dumps(items), content_key="t")
    assert [c for c, _ in found] == ["x", "", '{\n  "deep": 1\n}', "", "4.0", "plain"]
    assert [m for _, m in found] == [{"n": "1"}, {"n": "2"}, {}, {}, {}, {}]
    chosen = documents(spark, json.dumps(items), metadata_keys=["l", "n", "missing"])
    assert [m for _, m in chosen][:2] == [{"n": "1", "l": "[1]"}, {"n": "2"}]


def test_item_fields_replace_source_and_number(spark):
    rows = jsonlike.json_documents(files(spark, '[{"source": "elsewhere", "seq_num": 7}, {"seq_num": "x"}]')).collect()
    assert sorted((r.source, r.seq_num) for r in rows) == [("/f0.json", 1), ("elsewhere", 7)]


@pytest.mark.parametrize("text", ["{broken", '{"a":1} tail', "", "[1,2", "1]", "1, 2", "{'a': 1}"])
def test_invalid_json_fails(spark, text):
    with pytest.raises(PySparkException, match="invalid JSON"):
        documents(spark, text)


def test_duplicate_keys_keep_the_last(spark):
    assert documents(spark, '[{"a": 1, "a": 2, "b": {"c": 1, "c": 2}}]')[0][1] == {"a": "2"}


def test_json_lines(spark, tmp_path):
    lines = ['{"t": "one", "n": 1}', "", "{broken", '  {"t": "two"} ', "5", '{"a":1} x', '"s"']
    (tmp_path / "f.jsonl").write_text("\n".join(lines) + "\n")
    docs = jsonlike.jsonl_documents(spark, str(tmp_path), content_key="t").orderBy("seq_num").collect()
    assert [(r.seq_num, r.page_content, r.metadata) for r in docs] == [
        (0, "one", {"n": "1"}), (3, "two", {}), (4, "5", {}), (6, "s", {})
    ]
    bad = jsonlike.jsonl_rejects(spark, str(tmp_path)).orderBy("line_number").collect()
    assert [(r.line_number, r.line) for r in bad] == [(2, "{broken"), (5, '{"a":1} x')]


def test_rendering_matches_python(spark):
    values = [{"k": [1, 2.0, "é\"\\", None, True, {"e": {}}]}, [], [[]], -0.0, 10**20, 1e22]
    found = documents(spark, json.dumps(values))
    expected = [json.dumps(v, indent=2) if isinstance(v, (dict, list)) else str(v) for v in values]
    assert [c for c, _ in found] == expected


SAMPLES = [
    '[{"text": "\u00e9", "n": 1.5, "ok": true, "none": null, "l": [1]}, 3, "s", null, [1], {}]',
    '{"meta": {"v": 1}, "z": 1, "empty": [], "items": [{"t": "a", "z": 9, "t2": {"d": 1}}, "b"], "a": [1], "name": "n"}',
    '{"a": 1, "b": {"c": []}, "t": "x"}', "3", '"x"', "null", "[]", "{}", "{broken", "1, 2", "",
]


def entries_of(text, content_key=None, metadata_keys=None):
    """The documents of a JSON text by its rules, in Python."""
    try:
        root = json.loads(text)
    except ValueError:
        return None
    scalar = lambda v: not isinstance(v, (dict, list))
    told = lambda v: v if v is None or isinstance(v, str) else json.dumps(v, separators=(",", ":"), ensure_ascii=False)
    items, around, origin = root if isinstance(root, list) else [root], {}, {}
    if isinstance(root, dict):
        parent = next((k for k, v in root.items() if isinstance(v, list) and v), None)
        if parent is not None:
            items, origin = root[parent], {"parent_key": parent}
            around = {f"context_{k}": v for k, v in root.items() if k != parent and scalar(v)}
    found = []
    for i, item in enumerate(items):
        content, metadata = item, dict(origin)
        if isinstance(item, dict):
            metadata |= around | {k: v for k, v in item.items() if (k in metadata_keys if metadata_keys else k != content_key and scalar(v))}
            content = item if content_key is None else item.get(content_key, "")
        shown = "" if content is None else content if isinstance(content, str) else json.dumps(content, indent=2)
        found.append((i, shown, {k: told(v) for k, v in metadata.items()}))
    return found


@pytest.mark.parametrize("options", [{}, {"content_key": "t"}, {"metadata_keys": ["n", "t2", "l"]}])
def test_whole_texts_follow_the_rules(spark, options):
    df = spark.createDataFrame(list(enumerate(SAMPLES)), "id int, t string")
    found = df.select("id", jsontext.whole_text_entries(F.col("t"), **options).alias("e"))
    shown = F.when(F.col("is_json"), jsontext.rendered(F.when(F.col("is_json"), F.col("content"))))
    rows = found.select("id", F.col("e").isNull().alias("invalid"), F.inline_outer("e")).withColumn("content", shown.otherwise(F.col("content")))
    got = rows.orderBy("id", "seq_num").collect()
    for i, text in enumerate(SAMPLES):
        own = [r for r in got if r.id == i]
        expected = entries_of(text, **options)
        assert own[0].invalid == (expected is None)
        assert [(r.seq_num, r.content, r.metadata) for r in own if r.seq_num is not None] == (expected or [])


def nested(levels, inner):
    return '{"k": ' * levels + inner + "}" * levels


def test_deep_and_large_texts(spark):
    """They follow the same rules, and what can't be read stops nothing."""
    long_ = json.dumps({"items": [{"t": "x" * 1000, "n": i, "deep": {"l": [i]}} for i in range(20_000)], "c": 1})
    texts = [nested(990, "1"), "[" + nested(900, '"x"') + ", 2]", '{"a": ' + nested(950, "[1]") + ', "list": [1, "b"]}', long_, '["\\ud800", "ok"]', '{"n": 5}']
    found = {}
    for r in jsonlike.json_documents(files(spark, *texts)).collect():
        found.setdefault(int(r.source.removeprefix("/f").removesuffix(".json")), []).append(r)
    counts = {i: len(found.get(i, [])) for i in range(len(texts))}
    assert counts == {0: 1, 1: 2, 2: 2, 3: 20_000, 4: 2, 5: 1}
    assert found[0][0].page_content.count("{") == 990
    own = sorted(found[3], key=lambda r: r.seq_num)
    expected = entries_of(long_)
    assert [(r.seq_num, r.page_content, r.metadata) for r in (own[0], own[-1])] == [expected[0], expected[-1]]


def test_hostile_files_stop_no_others(spark):
    texts = [nested(3000, "1"), nested(990, "1"), '["\\ud800"]', '[{"n": 5}]', "[" * 100_000]
    rows = [(f"/f{i}.json", None, len(t), bytearray(t, "utf-8")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "path string, modificationTime timestamp, length bigint, content binary")
    documents, outcomes = ingest.process_files(df)
    assert {r.path: (r.status, r.n_documents) for r in outcomes.collect()} == {
        "/f0.json": ("failed", 0), "/f1.json": ("completed", 1), "/f2.json": ("completed", 1),
        "/f3.json": ("completed", 1), "/f4.json": ("failed", 0),
    }
    assert documents.count() == 3


def test_lines_that_are_not_utf8(spark, tmp_path):
    path = tmp_path / "latin.jsonl"
    path.write_bytes('{"t": "café"}\n{"t": "x"}\n'.encode("latin-1"))
    with pytest.raises(PySparkException, match="cannot decode"):
        jsonlike.jsonl_documents(spark, str(path), content_key="t").collect()
    found = jsonlike.jsonl_documents(spark, str(path), content_key="t", autodetect=True)
    assert sorted(r.page_content for r in found.collect()) == ["café", "x"]


def test_numbers_that_are_none(spark):
    text = '[{"a": NaN, "b": -Infinity, "c": "NaN", "d": 1.5}]'
    found = jsonlike.json_documents(files(spark, text)).collect()[0].metadata
    assert found == {"a": "NaN", "b": "-Infinity", "c": "NaN", "d": "1.5"}


NUMBERS = "0.0005 12345678.5 1e20 1.0E23 1e7 0.001 -1.5e-7 1.50 -0.0 1e400 5e-324 100000000000000000000 7".split()


@pytest.mark.parametrize("options", [{}, {"metadata_keys": ["a", "l", "o"]}, {"content_key": "o"}])
def test_numbers_have_one_spelling(spark, options):
    items = [f'{{"a": {n}, "l": [{n}, "é\\n"], "o": {{"{n}": {n}}}, "s": "{n}"}}' for n in NUMBERS if n != "1e400"]
    text = f'{{"c": 0.0005, "e": 1e400, "items": [{", ".join(items)}]}}'
    found = documents(spark, text, **options)
    assert len(found) == len(NUMBERS) - 1
    own = found[0][1]
    assert (own["a"], own["context_c"], own["context_e"]) == ("5.0E-4", "5.0E-4", "Infinity")
