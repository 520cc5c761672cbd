"""Exact copies, shards, quotes and mixtures against brute force."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from llm_cases import WORDS, empty, hard, hard_rows  # noqa: F401
from pyspark.sql import functions as F

from corpusmill.llm import exact_dedup, mixing, quotes, sharding
from corpusmill.llm.common import rank_within


def _normal(text):
    return "".join(WORDS.findall(text or ""))


@pytest.mark.parametrize("support", [0.3, 1 / 2000])
def test_exact_copies(hard, support):
    rows = exact_dedup.duplicate_groups(hard, support=support).collect()
    groups = defaultdict(list)
    for i, t, *_ in hard_rows():
        groups[hashlib.sha256(_normal(t).encode()).hexdigest()].append((-len(t or ""), i is None, i if i is not None else 0))
    assert len(rows) == len(hard_rows())
    for digest, members in groups.items():
        own = [r for r in rows if r.text_sha256 == digest]
        best = min(members)
        assert len(own) == len(members) and {r.group_size for r in own} == {len(members)}
        assert {r.keep_id for r in own} == {None if best[1] else best[2]}
        assert [r.doc_id for r in own if r.kept] == [None if best[1] else best[2]]


def test_kept_rows_have_all_columns(hard):
    kept = exact_dedup.drop_duplicates(hard)
    assert kept.columns == hard.columns
    assert kept.count() == len({_normal(t) for _, t, *_ in hard_rows()})


def test_byte_shards(hard):
    n = 5
    rows = sorted(sharding.byte_shards(hard, n).collect(), key=lambda r: (r.shard, r.slot))
    expected = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, *_ in hard_rows())
    assert sorted((r["size"], r.text_crc32) for r in rows) == expected
    order = [(r.doc_id is not None, r.doc_id or 0, r.text_crc32) for r in rows]
    assert order == sorted(order)
    total, place = sum(r["size"] for r in rows), 0
    slots = defaultdict(list)
    for r in rows:
        assert r.shard == min(n - 1, (2 * place + r["size"]) * n // (2 * total))
        place += r["size"]
        slots[r.shard].append(r.slot)
    assert all(v == list(range(len(v))) for v in slots.values())


def test_shards_are_nearly_equal(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("text"))
    sizes = defaultdict(int)
    for r in sharding.byte_shards(df).collect():
        sizes[r.shard] += r["size"]
    assert sorted(sizes) == list(range(40)) and max(sizes.values()) - min(sizes.values()) <= 2 * 106


def test_written_shards(hard, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(hard.drop("shard"), path, 4)
    back = hard.sparkSession.read.parquet(path)
    assert sorted(back.columns) == sorted([*hard.drop("shard").columns, "_shard"])
    assert back.count() == hard.count()


def test_rank_within_groups(spark):
    rows = [(None if i % 3 == 0 else i % 3, i * 37 % 50, i) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, v int, i int")
    got = rank_within(df, ["g"], ["v", "i"], F.floor(F.col("v") / 7), "place").collect()
    for g in (None, 1, 2):
        own = sorted((r for r in got if r.g == g), key=lambda r: (r.v, r.i))
        assert [r.place for r in own] == list(range(len(own)))


MAIL = [
    (1, 0, "user", "Where is the\nblue house?\n\nI can't find it."),
    (1, 1, "bot", "On Monday Ann wrote:\n> Where is the blue\n> house?\n\nNext to the lake."),
    (1, 2, "user", "Some other question"),
    (1, 3, "bot", "> > Where is the blue house?\n> Next to the lake.\nOn which side?"),
    (1, 4, "bot", "> some OTHER question\nAn answer"),
    (1, 5, "bot", "> nobody said this\nHm"),
    (2, 0, "user", "> Next to the lake.\nA quote of another conversation"),
    (2, None, "user", "> A quote of another conversation\nlast"),
    (2, 1, None, None),
    (None, 3, "user", "alone"),
    (None, 7, "user", ">alone\nnot any more"),
    (None, 7, "user", ">alone\nnot any more"),
    (3, 2000, "user", "> far away\nyes"),
    (3, 1, "user", "far away"),
]


def test_quotes(spark):
    df = spark.createDataFrame([(*m, 1, 2) for m in MAIL], "conv_id int, turn int, role string, text string, row int, hash int")
    rows = quotes.reply_ordered(df).collect()
    got = {(r.conv_id, r.turn): r for r in rows}
    parents = {k: r.parent_turn for k, r in got.items()}
    assert parents == {
        (1, 0): None, (1, 1): 0, (1, 2): None, (1, 3): 1, (1, 4): 2, (1, 5): None,
        (2, 0): None, (2, None): 0, (2, 1): None, (None, 3): None, (None, 7): 3, (3, 2000): 1, (3, 1): None,
    }
    first = sorted((r for r in rows if r.conv_id == 1), key=lambda r: r.position)
    assert [r.turn for r in first] == [0, 1, 3, 2, 4, 5] and [r.position for r in first] == list(range(6))
    assert [r.depth for r in first] == [0, 1, 2, 0, 1, 0]
    assert got[(1, 1)].text == "Next to the lake." and got[(1, 3)].text == "On which side?"
    assert got[(2, 1)].text == "" and len(rows) == len(MAIL)
    assert sorted(r.position for r in rows if r.conv_id is None) == [0, 1, 2]


def test_quotes_of_an_empty_table(spark):
    assert quotes.reply_ordered(spark.createDataFrame([], "conv_id int, turn int, role string, text string")).count() == 0


def _fill(budget, children):
    """Water-filling by repeated rounds: ``name -> (cap, weight)``."""
    given, open_ = {}, {k: v for k, v in children.items() if v[1] > 0}
    given |= {k: 0.0 for k in children if k not in open_}
    while open_:
        share = sum(w for _, w in open_.values())
        over = {k for k, (cap, w) in open_.items() if cap <= budget * w / share + 1e-9}
        if not over:
            return given | {k: budget * w / share for k, (_, w) in open_.items()}
        for k in over:
            given[k] = open_.pop(k)[0]
            budget -= given[k]
    return given


@pytest.mark.parametrize("budget", [0.3, 1.0, 2.5, 100.0, 37])
def test_mixture(hard, budget):
    weights = [{"x": 3.0, "y": 1.0}, {"src0": 0.0, "src1": 2.0}]
    got = mixing.mixed(hard, [F.col("lang"), F.col("source")], weights, budget, epochs=3, seed=7)
    assert got.columns == [*hard.columns, "epoch"]
    rows = got.toPandas()
    leaves = defaultdict(list)
    for i, t, lang, source, *_ in hard_rows():
        leaves[(lang, source)].append(("" if i is None else str(i), len(WORDS.findall(t or ""))))
    # A leaf of weight 0 may give nothing, so it counts for no cap above it.
    words = {k: sum(n for _, n in v) for k, v in leaves.items()}
    caps = {k: 3 * n if weights[1].get(k[1], 1.0) else 0 for k, n in words.items()}
    total = budget * sum(words.values()) if isinstance(budget, float) else budget
    langs = {lang for lang, _ in leaves}
    top = _fill(min(total, sum(caps.values())), {a: (sum(c for k, c in caps.items() if k[0] == a), weights[0].get(a, 1.0)) for a in langs})
    expected = 0
    for a in langs:
        own = _fill(top[a], {k: (caps[k], weights[1].get(k[1], 1.0)) for k in leaves if k[0] == a})
        for k, amount in own.items():
            n = sum(x for _, x in leaves[k])
            whole, left = divmod(int(amount + 1e-6), n) if n else (0, 0)
            expected += whole * len(leaves[k])
            if left:
                order = lambda d: (hashlib.md5(f"7:{whole}:{d}".encode()).hexdigest(), d)  # noqa: B023, E731
                used = 0
                for ident in sorted({d for d, _ in leaves[k]}, key=order):
                    mine = [x for d, x in leaves[k] if d == ident]
                    used += sum(mine)
                    if used > left:
                        break
                    expected += len(mine)
    assert len(rows) == expected


def test_empty_tables(empty):
    assert exact_dedup.duplicate_groups(empty).count() == 0
    assert sharding.byte_shards(empty).count() == 0
    assert mixing.mixed(empty, [F.col("lang")], [{}], 0.5).count() == 0
