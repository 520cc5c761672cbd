import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import bigrams, packing, tokens


def test_counts_meet_in_slices_and_only_wanted_transitions_go_on(spark, monkeypatch):
    rng = random.Random(5)
    train = [[rng.choice([0, 1, 2, 70_000, 2**31 - 1]) for _ in range(rng.randint(0, 30))] for _ in range(60)]
    other = [[1, 2, 70_000, 2**31 - 1, 0, 0, 5], [5], [], None]
    frame = lambda blocks: spark.createDataFrame(list(enumerate(blocks)), "block_id bigint, tokens array<int>")
    pairs = Counter(p for b in train for p in zip(b, b[1:]))
    contexts = Counter(a for b in train for a in b[:-1])
    for size in (1 << 21, 8):
        monkeypatch.setattr(bigrams, "_SLICE_PAIRS", size)
        scored = bigrams.score_transitions(frame(train), frame(other), 10)
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan  # counts are not joined pair by pair
        found = {(r.current, r.following): (r.times, r.nll) for r in scored.collect()}
        assert set(found) == set(zip(other[0], other[0][1:]))
        for pair, (times, nll) in found.items():
            assert times == 1
            assert nll == pytest.approx(-math.log((pairs[pair] + 1) / (contexts[pair[0]] + 10)))


def test_words_of_cleaned_texts_are_found_in_arrow(spark):
    rows = [(0, "a  bb a"), (1, ""), (2, None), (3, " ü  zz "), (4, "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    tokenizer = tokens.word_tokenizer(tokens.word_vocab(df, max_size=258, cleaned=True), cleaned=True)
    done = tokens.count_tokens(tokens.tokenize(df, tokenizer).drop("n_tokens"), tokenizer).collect()
    spelled = lambda word: [256, *word.encode()]
    assert {r.doc_id: r.tokens for r in done} == {
        0: [257, *spelled("bb"), 257], 1: [], 2: None, 3: [*spelled("ü"), *spelled("zz")], 4: [257],
    }
    assert {r.doc_id: r.n_tokens for r in done} == {0: 5, 1: 0, 2: None, 3: 6, 4: 1}
    plan = tokens.tokenize(df, tokenizer)._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan


@pytest.mark.parametrize("lengths", [[4], [3, 1], [5, 7], [1, 1, 1, 1, 9], [8, 8], [2, 4, 4, 3], [13, 0, 2]])
def test_blocks_begun_and_ended_in_documents(spark, lengths):
    rows = [("train", f"{i:04d}", i, list(range(100 * i, 100 * i + n)), n) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "split string, split_key string, doc_id bigint, tokens array<int>, n_tokens int")
    stream = [t for r in rows for t in r[3]]
    found = {r.block_id: r.tokens for r in packing.pack_blocks(df, 4).collect()}
    assert found == {i // 4: stream[i : i + 4] for i in range(0, len(stream), 4)}
    assert packing.pack_blocks(df, 4).agg(F.count("*")).first()[0] == len(found)
