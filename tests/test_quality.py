import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import bigrams, quality
from corpusmill.plans import evaluation
from corpusmill.sinks.documents import document_json
from corpusmill.sources import tables

TEXTS = ["a b c d", "a a a a a", "one two three", "", "   ", "x y x y x", "solo"]


def scores(text):
    words = text.split()
    repetition = len(set(words)) / len(words) if words else None
    diversity = len(set(zip(words, words[1:]))) / (len(words) - 1) if len(words) >= 4 else None
    return repetition, diversity


def test_scores(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for r in quality.score_texts(df).collect():
        assert (r.repetition_score, r.diversity_score) == scores(r.text)


def test_averages(spark):
    df = quality.score_texts(spark.createDataFrame([(t,) for t in TEXTS], "text string"))
    row = quality.coherence(df).collect()[0]
    found = [scores(t) for t in TEXTS]
    rep = [r for r, _ in found if r is not None]
    div = [d for _, d in found if d is not None]
    assert row.avg_repetition_score == pytest.approx(sum(rep) / len(rep))
    assert row.avg_diversity_score == pytest.approx(sum(div) / len(div))
    empty = quality.coherence(df.filter("text = ''")).collect()[0]
    assert (empty.avg_repetition_score, empty.avg_diversity_score, empty.scored_texts) == (0.0, 0.0, 0)


def blocks_frame(spark, train, val):
    rows = [("train", i, b) for i, b in enumerate(train)] + [("val", i, b) for i, b in enumerate(val)]
    return spark.createDataFrame(rows, "split string, block_id bigint, tokens array<int>")


def test_block_losses_match_brute_force(spark):
    train = [[1, 2, 1, 2, 3, 1, 2, 2], [2, 2, 2, 2, 2, 2, 2, 1], [3, 1]]
    val = [[1, 2, 2, 2, 2, 2, 2, 2], [3, 3, 4, 1, 2, 2, 9, 9], [2, 2, 2]]
    blocks = blocks_frame(spark, train, val)
    pairs = Counter(p for b in train for p in zip(b, b[1:]))
    contexts = Counter(a for b in train for a in b[:-1])
    chosen = bigrams.sample_blocks(blocks, 8, "val", None)
    losses = {r.block_id: r for r in bigrams.block_losses(blocks.filter("split = 'train'"), chosen, 10).collect()}
    assert set(losses) == {0, 1}
    for i in losses:
        steps = list(zip(val[i], val[i][1:]))
        expected = sum(-math.log((pairs[p] + 1) / (contexts[p[0]] + 10)) for p in steps) / len(steps)
        assert losses[i].loss == pytest.approx(expected)
        assert losses[i].n_tokens == 8


def test_frequent_transitions_go_through_the_broadcast_and_nothing_is_lost(spark, monkeypatch):
    val = [[1, 2] * 50 + [i, i + 1] for i in range(10, 40)]
    blocks = blocks_frame(spark, val, val)
    chosen = bigrams.sample_blocks(blocks, 102, "val", None)
    results = []
    for share in (1 / 4096, 0.1, 1.0):
        monkeypatch.setattr(bigrams, "_FREQUENT_SHARE", share)
        rows = bigrams.block_losses(blocks.filter("split = 'train'"), chosen, 100).collect()
        results.append(sorted((r.block_id, r.n_tokens, round(r.loss, 9)) for r in rows))
    assert len(results[0]) == 30 and results[0] == results[1] == results[2]


def test_sampling_is_seeded_and_bounded(spark):
    blocks = blocks_frame(spark, [], [[1, 2]] * 30 + [[1]])
    pick = lambda **k: {r.block_id for r in bigrams.sample_blocks(blocks, 2, **k).collect()}
    assert len(pick(max_samples=7)) == 7 and pick(max_samples=7) == pick(max_samples=7)
    assert pick(max_samples=7) != pick(max_samples=7, seed=1)
    assert pick(max_samples=1000) == pick(max_samples=None) == set(range(30))


def test_report(spark):
    log = spark.createDataFrame([("a b c d", 4, 2.0), ("a a", 2, 0.5)], "generated_text string, generated_tokens int, generation_time double")
    losses = spark.createDataFrame([(1.0, 8), (3.0, 8)], "loss double, n_tokens int")
    got = {r.metric: r.value for r in evaluation.report(log, losses).collect()}
    assert got["avg_generation_time"] == 1.25 and got["avg_tokens_per_second"] == 3.0
    assert got["avg_generated_length"] == 3.0 and got["total_prompts"] == 2.0
    assert got["avg_repetition_score"] == 0.75 and got["avg_diversity_score"] == 1.0
    assert got["perplexity"] == pytest.approx(math.exp(2)) and got["total_tokens"] == 16.0
    assert "perplexity" not in {r.metric for r in evaluation.report(log).collect()}


def elements(spark):
    rows = [("s", 0, None, "Title", "e0", "one"), ("s", 1, 1, "Text", None, "two"), ("s", 2, 2, "Text", "e2", "three"),
            ("t", 0, 7, None, None, "solo")] + [("big", i, 1, "Text", f"b{i}", f"p{i}") for i in range(100)]
    return spark.createDataFrame(rows, "source string, seq bigint, page_number int, category string, element_id string, text string")


@pytest.mark.parametrize("run", [4096, 7, 1])
def test_elements_join_whatever_the_runs(spark, run):
    single = tables.element_documents(elements(spark), "single", run=run).collect()
    assert {r.source: r.page_content for r in single} == {
        "s": "one\n\ntwo\n\nthree", "t": "solo", "big": "\n\n".join(f"p{i}" for i in range(100))
    }
    assert {r.source: r.n_elements for r in single} == {"s": 3, "t": 1, "big": 100}
    pages = {(r.source, r.page_number): r for r in tables.element_documents(elements(spark), "paged", run=run).collect()}
    texts = {k: r.page_content for k, r in pages.items()}
    assert texts["s", 1] == "one\n\ntwo\n\n" and texts["s", 2] == "three\n\n" and texts["t", 7] == "solo\n\n"
    first = pages["s", 1]
    assert (first.last_category, first.last_element_id) == ("Text", "e0")


def test_element_rows_and_modes(spark):
    rows = tables.element_documents(elements(spark), "elements", [F.upper, F.reverse]).filter("source = 's'").orderBy("seq").collect()
    assert [r.page_content for r in rows] == ["ENO", "OWT", "EERHT"]
    assert rows[1].metadata == {"category": "Text", "page_number": "1"}
    with pytest.raises(ValueError, match="mode"):
        tables.element_documents(elements(spark), "chapters")


def test_table_documents(spark):
    df = spark.createDataFrame([("body", 1, None)], "text string, n int, s string")
    row = tables.table_documents(df).collect()[0]
    assert (row.page_content, row.metadata) == ("body", {"n": "1", "s": None})
    with pytest.raises(ValueError, match="nope"):
        tables.table_documents(df, "nope")
    with pytest.raises(ValueError):
        tables.table_documents([1])


def test_document_json_leaves_out_empty_fields(spark):
    df = spark.createDataFrame([("x", {"k": "v"}, "7"), ("y", {}, None)], "c string, m map<string,string>, i string")
    got = [r[0] for r in df.select(document_json(F.col("c"), F.col("m"), F.col("i"))).collect()]
    start = '{"lc":1,"type":"constructor","id":["langchain","schema","document","Document"],"kwargs":{'
    assert got == [start + '"id":"7","metadata":{"k":"v"},"page_content":"x","type":"Document"}}', start + '"page_content":"y","type":"Document"}}']
