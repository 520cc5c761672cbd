import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusmill.operators import chunks, packing, splits, tokens
from corpusmill.plans import corpus
from corpusmill.session import materialize
from corpusmill.sinks import documents as document_sinks
from corpusmill.sinks import tokens as sinks


def key(seed, ident):
    return hashlib.md5(f"{seed}:{ident}".encode()).hexdigest()


@pytest.mark.parametrize("n, fraction", [(0, 0.9), (1, 0.9), (10, 0.9), (997, 0.9), (997, 0.5), (3, 0.01), (1000, 0.999)])
def test_split_is_exact_and_seeded(spark, n, fraction):
    for seed in (42, 7):
        rows = splits.train_val_split(spark.range(n).withColumnRenamed("id", "doc_id"), "doc_id", fraction, seed).collect()
        order = sorted(range(n), key=lambda i: (key(seed, i), i))
        train = set(order[: int(n * fraction)])
        assert {r.doc_id for r in rows if r.split == "train"} == train
        assert {r.doc_id for r in rows} == set(range(n))


def test_split_does_not_shuffle_the_documents(spark):
    df = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    plan = splits.train_val_split(df)._jdf.queryExecution().optimizedPlan()
    assert "Join" not in plan.toString().split("scalar-subquery")[0]


def test_split_fraction_is_checked(spark):
    for fraction in (0, 1, -0.1, 1.5):
        with pytest.raises(ValueError):
            splits.train_val_split(spark.range(3).withColumnRenamed("id", "doc_id"), train_fraction=fraction)


def corpus_frame(spark, n=200, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), dict(rows)


def test_vocabulary_and_encoding(spark):
    df, texts = corpus_frame(spark)
    vocab = tokens.word_vocab(df, max_size=286)
    counts = Counter(w for t in texts.values() for w in t.split())
    ranked = sorted(counts, key=lambda w: (-counts[w], w))[:29]
    assert [(r.token_id, r.token, r["count"]) for r in vocab.orderBy("token_id").collect()] == [
        (i + 257, w, counts[w]) for i, w in enumerate(ranked)
    ]
    tokenizer = tokens.word_tokenizer(vocab)
    assert tokenizer.vocab_size == 286
    ids = {w: [i + 257] for i, w in enumerate(ranked)}
    rows = tokens.tokenize(df, tokenizer).select("doc_id", "tokens", "n_tokens", tokenizer.decode(F.col("tokens")).alias("d")).collect()
    for r in rows:
        assert r.tokens == [t for w in texts[r.doc_id].split() for t in ids.get(w, [256, *w.encode()])]
        assert r.n_tokens == len(r.tokens)
        assert r.d == " ".join(texts[r.doc_id].split())


def test_words_outside_the_vocabulary_are_spelled(spark):
    known = spark.createDataFrame([(257, "ja", 3)], "token_id bigint, token string, count bigint")
    tokenizer = tokens.word_tokenizer(known)
    values = ["ja né 日本 ja", None, "", "é", "ja"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, text string").coalesce(1)
    rows = tokens.tokenize(df, tokenizer).withColumn("d", tokenizer.decode(F.col("tokens"))).orderBy("id").collect()
    assert [r.d for r in rows] == values
    assert rows[0].tokens == [257, 256, *"né".encode(), 256, *"日本".encode(), 257]
    # From inside one character to inside another.
    cut = df.filter("id = 0").select(tokenizer.decode(F.slice(tokenizer.encode(F.col("text")), 5, 7)).alias("d"))
    assert cut.collect()[0].d == " 日"
    with pytest.raises(ValueError):
        tokens.word_vocab(df, max_size=257)


def test_byte_and_rank_tokenizers(spark):
    values = ["", "héllo wörld", "日本 😀", None, "aab ab"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, text string")
    byte = tokens.utf8_tokenizer()
    for r in df.select("text", byte.encode(F.col("text")).alias("t"), byte.decode(byte.encode(F.col("text"))).alias("d")).collect():
        assert r.t == (None if r.text is None else list(r.text.encode()))
        assert r.d == r.text
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b" ab": 257}
    pairs = tokens.rank_file_tokenizer(spark, ranks)
    found = {r.id: (r.t, r.d) for r in df.select("id", pairs.encode(F.col("text")).alias("t"), pairs.decode(pairs.encode(F.col("text"))).alias("d")).collect()}
    assert found[4] == ([97, 256, 257], "aab ab")
    assert found[1][1] == "héllo wörld" and found[3] == (None, None)
    assert pairs.vocab_size == 258


def test_chunks_measured_in_byte_pairs(spark):
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b" ab": 257}
    df = spark.createDataFrame([(1, "ab ab ab xyz xyz")], "id int, text string")
    splitter = chunks.recursive(4, 0, length=tokens.rank_file_length(ranks))
    found = [r.chunk for r in chunks.split_documents(df, splitter).orderBy("chunk_index").collect()]
    assert found == ["ab ab ab", "xyz", "xyz"]


def test_vocab_must_fit_the_token_type(spark):
    tokens.check_vocab_size(65_535)
    for size, dtype in [(65_536, "uint16"), (300, "uint8"), (5, "float16")]:
        with pytest.raises(ValueError):
            tokens.check_vocab_size(size, dtype)


@pytest.fixture(scope="module")
def packed(spark):
    df, texts = corpus_frame(spark, 300)
    vocab = tokens.word_vocab(df)
    tokenizer = tokens.word_tokenizer(vocab)
    labelled = materialize(splits.train_val_split(tokens.tokenize(df, tokenizer)), "labelled")
    ids = {r.token: r.token_id for r in vocab.collect()}
    streams = {"train": [], "val": []}
    order = sorted(texts, key=lambda i: (key(42, i), i))
    for place, i in enumerate(order):
        streams["train" if place < int(len(order) * 0.9) else "val"] += [ids[w] for w in texts[i].split()]
    return labelled, streams, tokenizer


@pytest.mark.parametrize("size", [1, 7, 64, 100_000])
def test_packing_keeps_the_stream(spark, packed, size):
    labelled, streams, _ = packed
    rows = packing.pack_blocks(labelled, size).orderBy("split", "block_id").collect()
    for split, stream in streams.items():
        blocks = [r.tokens for r in rows if r.split == split]
        assert [t for b in blocks for t in b] == stream
        assert all(len(b) == size for b in blocks[:-1])
        assert [r.block_id for r in rows if r.split == split] == list(range(len(blocks)))


def test_windows(spark, packed):
    labelled, streams, _ = packed
    blocks = packing.pack_blocks(labelled, 16)
    for context in (5, 16, 40):
        for split in ("train", "val"):
            rows = packing.sample_windows(blocks, 16, context, 50, split).collect()
            stream = streams[split]
            assert len(rows) == 50
            for r in rows:
                expected = int(key(42, r.window_id)[:12], 16) % (len(stream) - context)
                assert r.start == expected
                assert r.x == stream[r.start : r.start + context]
                assert r.y == stream[r.start + 1 : r.start + 1 + context]
    with pytest.raises(PySparkException, match="has no window"):
        packing.sample_windows(blocks, 16, 10**6, 3).collect()


def test_token_stream_on_disk(spark, packed, tmp_path):
    labelled, streams, tokenizer = packed
    blocks = packing.pack_blocks(labelled, 32)
    path = tmp_path / "train.bin"
    sinks.write_token_stream(blocks, str(path), "train", 32, tokenizer.vocab_size)
    parts = sorted(p for p in path.iterdir() if not p.name.startswith("."))
    assert all(p.name.startswith("part-") for p in parts)
    on_disk = np.concatenate([np.fromfile(p, "<u2") for p in parts])
    assert on_disk.tolist() == streams["train"]
    back = sinks.read_token_stream(spark, str(path)).orderBy("position").collect()
    assert [r.token for r in back] == streams["train"]
    single = tmp_path / "one.bin"
    np.array([5, 65_535, 7], "<u2").tofile(single)
    ranged = spark.read.format("tokenstream").option("rangeTokens", "2").load(str(single))
    assert [tuple(r) for r in ranged.orderBy("position").collect()] == [(0, 5), (1, 65_535), (2, 7)]
    assert ranged.rdd.getNumPartitions() == 2
    with pytest.raises(ValueError):
        sinks.write_token_stream(blocks, str(tmp_path / "x"), "train", 32, 70_000)


def test_statistics_and_checks(spark, packed):
    labelled, streams, tokenizer = packed
    stats = {r.split: r for r in tokens.token_stats(labelled).collect()}
    for split, stream in streams.items():
        assert stats[split].total_tokens == len(stream)
        assert stats[split].avg_tokens_per_doc == len(stream) / stats[split].num_documents
        assert stats[split].file_size_mb == 2 * len(stream) / 1024 / 1024
    checks = {r.split: r.ok for r in tokens.verify_tokens(labelled, tokenizer.vocab_size).collect()}
    assert checks == {"train": True, "val": True}
    assert not any(r.ok for r in tokens.verify_tokens(labelled, 10).collect())
    short = labelled.filter("split = 'val'").limit(1)
    assert [r.ok for r in tokens.verify_tokens(short, tokenizer.vocab_size).collect()] == [False]
    total = len(streams["train"])
    for iters, batch in [(10, 2), (10_000, 8), (500, 400)]:
        row = tokens.training_budget(tokens.token_stats(labelled), iters, batch, 16).collect()[0]
        enough = total >= iters * batch * 16
        assert row.max_iters == (iters if enough else max(100, total // (batch * 16)))
        assert row.required_tokens == iters * batch * 16


def test_published_figures_hold_for_the_formulas(spark):
    kept = 8_093_029
    row = spark.range(1).select(F.floor(F.lit(kept) * F.lit(0.9)).alias("train")).collect()[0]
    assert (row.train, kept - row.train) == (7_283_726, 809_303)
    frame = spark.createDataFrame([("train", 262_344_637)], "split string, n_tokens bigint")
    assert tokens.token_stats(frame).collect()[0].file_size_mb == 500.3826847076416


def test_text_splits(spark, packed, tmp_path):
    df, texts = corpus_frame(spark, 300)
    df = df.filter("text <> ''")
    document_sinks.write_text_splits(splits.train_val_split(df), str(tmp_path / "splits"))
    n = sum(1 for t in texts.values() if t)
    order = sorted((i for i, t in texts.items() if t), key=lambda i: (key(42, i), i))
    train = "".join(p.read_text() for p in sorted((tmp_path / "splits" / "split=train").glob("part-*")))
    assert train.split("\n\n") == [texts[i] for i in order[: int(n * 0.9)]] + [""]


def test_plan_counts_before_it_splits(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * 20) for i in range(50)], "doc_id bigint, text string")
    rows = {r.split: r for r in corpus.corpus_token_stats(docs).collect()}
    assert (rows["train"].num_documents, rows["val"].num_documents) == (45, 5)
    assert rows["train"].total_tokens == 900


def test_counts_without_ids(spark, texts):
    df = texts(["a a b", "", None, "caf\u00e9 a zz", "  ", "\u4e2d\u6587 b a"])
    vocab = tokens.word_vocab(texts(["a a a b b"]), max_size=tokens.FIRST_WORD_ID + 2)
    for tokenizer in (tokens.word_tokenizer(vocab), tokens.utf8_tokenizer(), tokens.word_tokenizer(vocab)._replace(count=None)):
        built = {r.id: r.n_tokens for r in tokens.tokenize(df, tokenizer).collect()}
        assert {r.id: r.n_tokens for r in tokens.count_tokens(df, tokenizer).collect()} == built


def test_known_lengths_spare_a_pass_over_the_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "_FILE_TOKENS", 64)
    rows = [(s, b, list(range(b * 4, min(b * 4 + 4, n)))) for s, n in (("train", 321), ("val", 7)) for b in range((n + 3) // 4)]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    blocks = spark.createDataFrame(rows, "split string, block_id bigint, tokens array<int>")
    watched = blocks.mapInArrow(counted, blocks.schema)
    for i, lengths in enumerate((None, {"train": 321, "val": 7, "none": 0})):
        folders = {split: str(tmp_path / f"{split}{i}") for split in ("train", "val", "none")}
        seen.value = 0
        sinks.write_token_streams(watched, folders, 4, 1000, lengths=lengths)
        assert seen.value == (len(rows) if lengths else 2 * len(rows))
        for split, n in (("train", 321), ("val", 7)):
            got = sinks.read_token_stream(spark, folders[split]).orderBy("position").collect()
            assert [(r.position, r.token) for r in got] == [(k, k) for k in range(n)]
    names = lambda i: sorted(p.name for p in (tmp_path / f"train{i}").glob("*.bin"))
    assert names(0) == names(1) and len(names(0)) == 6
