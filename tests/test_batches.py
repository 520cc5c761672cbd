import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusmill.functions import batches
from corpusmill.llm import decontamination, scoring
from corpusmill.operators import tokens
from corpusmill.sources import delimited


def test_pieces_are_the_rows_in_order():
    texts = pa.array(["x" * n if n % 5 else None for n in range(60)])
    found = list(batches.pieces((texts, pa.array(range(60))), 300))
    assert [v for t, _ in found for v in t.to_pylist()] == texts.to_pylist()
    assert [v for _, n in found for v in n.to_pylist()] == list(range(60))
    assert all(len(t) == 1 or t.nbytes + n.nbytes <= 300 for t, n in found)
    assert list(batches.pieces((texts.slice(0, 0),), 10)) == [(texts.slice(0, 0),)]


def test_functions_see_a_piece_at_a_time(spark):
    @batches.piecewise("long", 10_000)
    def seen(texts):
        return pa.array([texts.nbytes] * len(texts))

    rows = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("abcdefgh"), 100).alias("text"))
    assert rows.select(F.max(seen("text"))).first()[0] <= 10_000
    assert rows.select(F.count(seen("text"))).first()[0] == 3000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_built_in_functions_work_piece_by_piece(spark):
    words = spark.createDataFrame([(i, f"w{i % 7} ü{i} x") for i in range(3000)] + [(3000, None)], "doc_id bigint, text string")
    bytewise = tokens.utf8_tokenizer()
    wordwise = tokens.word_tokenizer(tokens.word_vocab(words, max_size=262))
    for tokenizer in (bytewise, wordwise):
        both = words.coalesce(1).select("text", tokenizer.encode(F.col("text")).alias("ids"))
        back = both.select("text", tokenizer.decode(F.col("ids")).alias("back"))
        assert back.filter("not (text <=> back)").isEmpty()
        assert ", 251" in _plan(back)  # functions over iterators
    files = words.select(F.concat(F.lit("a,b\n"), "doc_id", F.lit(",z\n")).alias("text"))
    parsed = files.select(delimited.csv_entries(F.col("text"), F.lit(",")).alias("e"))
    assert parsed.filter("e[0].content = concat('a: ', 1, '\nb: z')").count() == 1
    assert parsed.filter("size(e) = 1").count() == 3001
    assert ", 251" in _plan(parsed)


def _peak(work):
    """MB of Python and NumPy memory that a call takes at most."""
    work(1)  # tables that stay are filled
    tracemalloc.start()
    try:
        work(8)
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def _texts(megabytes):
    return pa.array([" ".join(f"w{(i * 31 + j) % 5000}" for j in range(200)) for i in range(900 * megabytes)])


def test_benchmark_items_are_searched_in_small_pieces():
    sketch = decontamination._sketch(["w1 w2 w3 w4 w5 w6", "a b"], 80)
    assert _peak(lambda n: decontamination.matches(_texts(n), sketch, 80)) < 120


def test_words_are_counted_in_bounded_memory():
    def count(megabytes):
        texts = _texts(megabytes)
        batch = pa.RecordBatch.from_pydict({"text": texts, "held_out": pa.array([i % 7 == 2 for i in range(len(texts))])})
        return sum(out.num_rows for out in scoring._counted(8)([batch]))

    assert _peak(count) < 80


def test_rows_of_one_slice_become_objects_at_a_time():
    keys = np.arange(20_000, dtype=np.uint64).tobytes()
    rows = pa.RecordBatch.from_pydict(
        {"slice": pa.array(np.repeat(np.arange(40), 4), pa.int32()), "kind": pa.array([0] * 160, pa.int32())}
        | {name: pa.array([keys] * 160) for name in ("keys", "total", "train")}
    )
    found = []

    def fill(n):
        found.extend(out.column("slice")[0].as_py() for out in scoring._slices([rows.slice(0, 20 * n)]))

    assert _peak(fill) < 40
    assert sorted(set(found)) == list(range(40))


def test_the_filter_passes_the_driver_in_parts(spark, monkeypatch):
    rows = [(i, 8 * i, bytes([i]) * i) for i in (0, 2, 3, 7, 9)]
    slices = spark.createDataFrame(rows, "slice int, size bigint, bits binary").repartition(3)
    fetched, fetch = [], type(slices).toArrow
    monkeypatch.setattr(type(slices), "toArrow", lambda df: fetched.append(fetch(df)) or fetched[-1])
    found = scoring._fetched(slices, 4, [0, 2, 3, 7, 9], 6)
    assert [t.num_rows for t in fetched] == [3, 1, 1]
    for number, size, own in rows:
        at = found.base[number]
        assert found.size[number] == size and found.bytes[at : at + len(own)].tobytes() == own
    assert (found.base >= 0).sum() == 5 and len(found.bytes) == 21
    assert len(scoring._fetched(slices, 4, []).bytes) == 0
