"""Every stage of the pipeline against brute force on what the stage before kept."""

import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import folded, shingle_set

import corpus_pipeline
from corpusmill.llm import language
from corpusmill.llm.queries import vocabulary

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and gave, over the small tables."""
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), []
    extra = spark.createDataFrame([(900, None, "en", "src1", 0), (901, "12 34", "en", "src1", 5)], docs.schema)
    docs = docs.unionByName(extra)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, DATA).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def test_stages(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near copies", "benchmark", "mixture", "tokens"]
    for given, kept in stages[:-1]:
        assert kept.dtypes == given.dtypes


def test_language(stages):
    given, kept = stages[0]
    # Only the two rows without a letter go; every clean document stays, code-switched ones too.
    lettered = [r.doc_id for r in given.collect() if any(c.isalpha() for c in r.text or "")]
    assert not {900, 901} & set(lettered) and len(lettered) == given.count() - 2
    assert sorted(r.doc_id for r in kept.collect()) == sorted(lettered)


def test_near_copies(stages):
    given, kept = stages[1]
    rows = sorted((r.doc_id, shingle_set(r.text)) for r in given.collect())
    group = {i: i for i, _ in rows}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if a and 100 * len(a & b) >= 80 * len(a | b):
                x, y = top(i), top(j)
                group[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _ in rows if top(i) == i]


def test_benchmark(spark, stages):
    given, kept = stages[2]
    items = [shingle_set(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    clean = [r.doc_id for r in given.collect() if not any(100 * len(s & shingle_set(r.text)) >= 80 * len(s) for s in items)]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(clean)


def test_mixture(stages):
    given, kept = stages[3]
    words = lambda rows: sum(len(folded(r.text)) for r in rows)
    before, after = given.collect(), kept.collect()
    by_domain = Counter()
    for r in after:
        by_domain[int(r.source[3:]) // 5] += len(folded(r.text))
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    assert max(Counter(r.doc_id for r in after).values()) > 1
    longest = max(len(folded(r.text)) for r in before)
    assert abs(words(after) - words(before)) <= longest * 80
    assert by_domain[0] > by_domain[1] > by_domain[2] > by_domain[3]


def test_tokens(stages):
    from tokenizers import Tokenizer

    given, kept = stages[4]
    encoder = Tokenizer.from_file(vocabulary())
    expected = Counter()
    for r in given.collect():
        ids = np.array([*encoder.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        expected[(r.doc_id, len(ids), zlib.crc32(ids.tobytes()))] += 1
    rows = sorted(kept.collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, DATA).count() > 100
