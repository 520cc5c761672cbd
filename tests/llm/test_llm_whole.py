"""Rows on which operators once did less than the whole job."""

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import WORDS, hard_rows
from pyspark.sql import functions as F
from test_llm_native import _fill

import corpus_pipeline
from corpusmill.llm import language, mixing, queries, token_files

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
NAME = "<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary())


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


@given(st.lists(st.sampled_from(["a", "é", " ", "  ", "\n", "\x1c", ".", "1", "<|", "|>", NAME, "endoftext"]), max_size=12).map("".join))
@settings(max_examples=300, deadline=None)
def test_added_tokens(library, text):
    encode = token_files.byte_level_encoder(queries.vocabulary(), encode_special_tokens=False)
    assert np.frombuffer(encode(text), "<u2").tolist() == ids_of(library, text)


@pytest.mark.parametrize("options", [{"lstrip": True}, {"rstrip": True}, {"single_word": True}, {}])
def test_added_tokens_of_other_files(library, options, tmp_path):
    from tokenizers import AddedToken, Tokenizer

    own = Tokenizer.from_str(library.to_str())
    own.add_tokens([AddedToken("ab", normalized=False, **options), AddedToken("abc", normalized=False)])
    own.save(path := str(tmp_path / "words.json"))
    for special in (True, False):
        encode = token_files.byte_level_encoder(path, encode_special_tokens=special)
        own.encode_special_tokens = special
        for text in ("x ab y", "xab abc", f"ab{NAME}abcab  ", " ab ", ""):
            assert np.frombuffer(encode(text), "<u2").tolist() == ids_of(own, text)


def test_token_files_hold_added_tokens(spark, library, tmp_path):
    texts = [f"a {NAME} b", NAME, f"x{NAME}{NAME}  y\n", "none", None, ""]
    docs = spark.createDataFrame([(i, t, "en", "src1", 0) for i, t in enumerate(texts)], DOCUMENTS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ids = [[*ids_of(library, t or ""), 0] for t in texts]
    assert ids[0] == [64, 220, 50256, 275, 0]
    starts = np.cumsum([0, *map(len, ids)])[:-1].tolist()
    expected = [(i, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, x), s in zip(enumerate(ids), starts, strict=True)]
    for got in (queries.op5_token_files(spark, str(tmp_path)), corpus_pipeline.write_tokens(spark, docs, str(tmp_path))):
        assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got.collect()) == expected


def test_budget_passes_by_weights_of_zero(spark):
    rows = [("en", "srcA", 100), ("en", "srcB", 900), ("de", "srcC", 1000), ("fr", "srcB", 50), ("xx", "srcC", 70)]
    leaves = spark.createDataFrame(rows, "lang string, source string, tokens bigint")
    weights = [{"xx": 0.0}, {"srcB": 0.0}]
    for budget, wanted in ((1000, (100, 900)), (150, (75, 75)), (5000, (100, 1000))):
        got = mixing.budgets(leaves, ["lang", "source"], weights, budget, 1).collect()
        given = {(r.lang, r.source): r.budget for r in got}
        assert given == {("en", "srcA"): wanted[0], ("en", "srcB"): 0, ("de", "srcC"): wanted[1], ("fr", "srcB"): 0, ("xx", "srcC"): 0}


def test_mixture_passes_by_weights_of_zero(spark):
    docs = [("en", "srcA")] * 100 + [("en", "srcB")] * 900 + [("de", "srcC")] * 1000
    df = spark.createDataFrame([(i, "word", *d, 0) for i, d in enumerate(docs)], DOCUMENTS)
    taken = mixing.mixed(df, [F.col("lang"), F.col("source")], [{}, {"srcB": 0.0}], 1000, epochs=1)
    assert {r.source: r["count"] for r in taken.groupBy("source").count().collect()} == {"srcA": 100, "srcC": 900}


@pytest.mark.parametrize("budget", [0.3, 1.0, 2.5, 100.0])
def test_budgets_by_brute_force(spark, budget):
    """The weights of test_mixture, with caps that leave out what a weight of 0 shuts out."""
    weights, tokens = [{"x": 3.0, "y": 1.0}, {"src0": 0.0, "src1": 2.0}], Counter()
    for _, text, lang, source, *_ in hard_rows():
        tokens[(lang or "", source or "")] += len(WORDS.findall(text or ""))
    caps = {k: 0 if k[1] == "src0" else 3 * n for k, n in tokens.items()}
    total = min(budget * sum(tokens.values()), sum(caps.values()))
    top = _fill(total, {a: (sum(c for k, c in caps.items() if k[0] == a), weights[0].get(a, 1.0)) for a, _ in caps})
    expected = {}
    for a in top:
        expected |= _fill(top[a], {k: (caps[k], weights[1].get(k[1], 1.0)) for k in caps if k[0] == a})
    leaves = spark.createDataFrame([(*k, n) for k, n in tokens.items()], "lang string, source string, tokens bigint")
    got = mixing.budgets(leaves, ["lang", "source"], weights, budget * sum(tokens.values()), 3).collect()
    assert {(r.lang, r.source): r.budget for r in got} == {k: int(v + 1e-6) for k, v in expected.items()}


def test_domains_of_any_source(spark, tmp_path):
    sources = ["src7", "web", "", None, "src123456789012", "9" * 30]
    docs = spark.createDataFrame([(i, f"word {i}", "en", s, 0) for i, s in enumerate(sources * 2)], DOCUMENTS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.source: r.domain for r in docs.selectExpr("source", f"{queries.DOMAIN} as domain").collect()}
    assert found == {"src7": "d1", "web": None, "": None, None: None, "src123456789012": "d24691357802", "9" * 30: None}
    mixed = corpus_pipeline.mix_sources(spark, docs, str(tmp_path)).collect()
    assert sum(len(r.text.split()) for r in mixed) <= 2 * docs.count() and {r.source for r in mixed} == set(sources)
    assert {r.domain for r in queries.op9_weighted_mixture(spark, str(tmp_path)).collect()} <= set(found.values())


def _spoken(rng, letters, n):
    return " ".join("".join(rng.choice(list(letters), int(rng.integers(3, 8)))) for _ in range(n))


def test_texts_of_three_languages_are_kept(spark):
    rng, letters = np.random.default_rng(5), {"one": "abcde", "two": "ghijk", "three": "mnopq"}
    rows = [(i, _spoken(rng, letters[x], 40), x, "src1", 0) for i, x in enumerate(list(letters) * 30)]
    rows += [(200 + i, " ".join(_spoken(rng, x, 20) for x in letters.values()), None, "src1", 0) for i in range(5)]
    rows += [(300, None, "one", "src1", 0), (301, "12 34", "two", "src1", 0)]
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(3)
    scores = {r.doc_id: r.score for r in language.predict_languages(df).collect()}
    assert all(scores[200 + i] < 0.4 for i in range(5))
    kept = language.keep_identified(df)
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in rows[:-2]]
    for nothing in (F.lit(None).cast("string"), F.when(F.col("doc_id") >= 300, F.col("lang"))):
        unlabelled = df.withColumn("lang", nothing)
        assert language.keep_identified(unlabelled.filter("doc_id != 300")).count() == len(rows) - 1


def test_every_clean_document_is_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mute = spark.createDataFrame([(900, None, "en", "src1", 0), (901, "12 34", "en", "src1", 5)], docs.schema)
    kept = corpus_pipeline.identify_language(spark, docs.unionByName(mute), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.collect())
