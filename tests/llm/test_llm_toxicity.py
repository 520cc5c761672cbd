"""The subsequence kernel against its definition, and scores on held-out texts."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import empty, hard, hard_rows, invented  # noqa: F401
from pyspark.sql import functions as F

from corpusmill.llm import toxicity

INSULTS = ["blockhead", "numbskull", "dimwitted"]


def _vector(word):
    """Weights of letter triples by their definition, of unit length."""
    found = {}
    for i, j, k in itertools.combinations(range(len(word)), 3):
        if k - i < toxicity.REACH:
            triple = word[i] + word[j] + word[k]
            found[triple] = found.get(triple, 0) + toxicity.DECAY ** (k - i - 2)
    size = sum(v * v for v in found.values()) ** 0.5
    return {key: v / size for key, v in found.items()}


def test_kernel_by_definition():
    strings = ["idiot", "iddiot", "banana", "aaaa", "abc", "thequickbrown", "zzz"]
    table = toxicity.sightings(pa.array([" ".join(strings)]))
    owner, triple, value = toxicity.features(table)
    letters = ["".join(chr(97 + x) for x in table.letters[b:e]) for b, e in itertools.pairwise(table.bounds)]
    assert sorted(letters) == sorted(strings)
    for i, string in enumerate(letters):
        own = {}
        for t, v in zip(triple[owner == i], value[owner == i], strict=True):
            own["".join(chr(97 + x) for x in (t // 1024, t // 32 % 32, t % 32))] = v
        expected = _vector(string)
        assert own.keys() == expected.keys() and all(abs(own[k] - expected[k]) < 1e-12 for k in own)


def test_sightings():
    def strings(*texts):
        table = toxicity.sightings(pa.array(texts, pa.string()))
        names = ["".join(chr(97 + x) if x < 26 else "*" for x in table.letters[b:e]) for b, e in itertools.pairwise(table.bounds)]
        return sorted((int(o), names[p]) for o, p in zip(table.owner, table.place, strict=True))

    assert strings("I-d.i_o,t!", None, "", "ab c") == [(0, "idiot")]
    assert strings("x i d i o t yes") == [(0, "xidiot"), (0, "yes")]
    assert strings("i d", "i o t") == [(1, "iot")]  # runs end with their text
    assert strings("1D10T") == [(0, "idiot")]
    long_ = "".join(invented(3, 40))
    pieces = strings(long_)
    assert all(len(p) <= toxicity.WINDOW for _, p in pieces) and len(pieces) > 5
    assert all(any(long_[i : i + 12] in p for _, p in pieces) for i in range(len(long_) - 11))


def _texts(seed, n, toxic):
    rng = random.Random(seed)
    vocabulary = invented(11, 400, "aeioustrnml")
    for _ in range(n):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))]
        if toxic:
            own.insert(rng.randrange(len(own)), rng.choice(INSULTS))
        yield " ".join(x + rng.choice(["", "", ".", ","]) for x in own)


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, t, 1) for i, t in enumerate(_texts(1, 300, True))]
    rows += [(1000 + i, t, 0) for i, t in enumerate(_texts(2, 300, False))]
    docs = spark.createDataFrame([(i, t, "xx", 7.0, 1) for i, t, _ in rows], "doc_id bigint, text string, lang string, score double, toxic int")
    labels = spark.createDataFrame([(i, 5, y) for i, _, y in rows], "doc_id bigint, text int, toxic int")
    return docs, labels


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    got = toxicity.score_toxicity(docs, labels).filter("held_out").collect()
    assert len(got) > 80 and sum(r.predicted == (r.doc_id < 1000) for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_gaps_and_inserted_letters(spark, labelled):
    docs, labels = labelled
    spoilt = ["you blockhead", "you block-head", "you b l o c k h e a d", "you bl0ckhead", "you blockkhead", "you numbskull", "num.bskull", "numbsxkull", "dimwwitted"]
    clean = list(_texts(9, 40, False))
    extra = spark.createDataFrame([(5000 + i, t, "xx", 0.0, 0) for i, t in enumerate([*spoilt, *clean])], docs.schema)
    got = {r.doc_id - 5000: r.predicted for r in toxicity.score_toxicity(docs.unionByName(extra), labels).collect() if r.doc_id >= 5000}
    assert [got[i] for i in range(len(spoilt))] == [1] * len(spoilt)
    assert sum(got[i] for i in range(len(spoilt), len(got))) <= 1


def test_awkward_rows(hard, labelled):
    labels = labelled[1]
    got = toxicity.score_toxicity(hard, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == len(hard_rows())
    # No text of these has a label of both kinds: every text gets the only label there is.
    assert {r.predicted for r in got.collect()} == {1}
    strange = hard.select(F.col("doc_id"), (F.col("doc_id") % 3 - 1).cast("int").alias("toxic"), F.lit("y").alias("text"))
    assert toxicity.score_toxicity(hard, strange).filter("score BETWEEN 0 AND 1").count() == len(hard_rows())


def test_no_labels_and_no_rows(hard, empty, labelled):
    docs, labels = labelled
    assert {r.predicted for r in toxicity.score_toxicity(docs, labels.filter("false")).collect()} == {0}
    assert {r.predicted for r in toxicity.score_toxicity(docs, labels.filter("toxic = 1")).collect()} == {1}
    assert toxicity.score_toxicity(empty, labels).count() == 0


def test_scores_do_not_depend_on_batches():
    machine = toxicity.fit([*_texts(1, 50, True), *_texts(2, 50, False)], [1] * 50 + [0] * 50)
    texts = [*_texts(5, 60, True), None, "", "x" * 5000]

    class Shared:
        value = machine

    def scores(size):
        batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[i : i + size], pa.string())}) for i in range(0, len(texts), size)]
        return np.concatenate([b.column("score").to_numpy() for b in toxicity._scored(Shared)(iter(batches))])

    assert np.allclose(scores(len(texts)), scores(3), atol=1e-12)
