"""Importance resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from llm_cases import empty, hard, hard_rows, items  # noqa: F401
from pyspark.sql import functions as F

from corpusmill.llm import resampling

_RUN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return _RUN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _features(text, longest):
    own = _words(text)
    return [" ".join(own[i : i + n]) for n in range(1, longest + 1) for i in range(len(own) - n + 1)]


def _brute(rows, target, longest, buckets, min_words, percent, seed):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(zlib.crc32(f.encode()) % buckets for f in _features(text, longest))
    for text in target:
        t.update(zlib.crc32(f.encode()) % buckets for f in _features(text, longest))
    total_s, total_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((float(t[b] + 1) * (total_s + buckets)) / (float(s[b] + 1) * (total_t + buckets))))

    out = []
    for ident, text in rows:
        own = _features(text, longest)
        weight = sum(gain(zlib.crc32(f.encode()) % buckets) for f in own)
        h = int(hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([ident, len(own), weight, weight + noise, len(_words(text)) >= min_words])
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    drawn = order[: len(order) * percent // 100]
    ranks = {id(r): n for n, r in enumerate(drawn, 1)}
    return Counter((r[0], r[1], r[2], r[3], ranks.get(id(r))) for r in out)


@pytest.mark.parametrize(
    ("longest", "entries", "share", "percent"), [(1, 1 << 16, 1e-5, 50), (1, 0, 1.0, 10), (2, 40, 1e-3, 50), (3, 1 << 16, 1e-5, 100)]
)
def test_resampling(hard, spark, longest, entries, share, percent):
    target = spark.createDataFrame(items(), "item_id int, text string")
    got = resampling.resample(
        hard, target, longest=longest, buckets=97, min_words=5, percent=percent, seed=3, head_entries=entries, head_share=share
    )
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in got.dtypes} == {"bigint"}
    rows = [(i, t) for i, t, *_ in hard_rows()]
    assert Counter(map(tuple, got.collect())) == _brute(rows, [t for _, t in items()], longest, 97, 5, percent, 3)


def test_characters_of_words(spark):
    rows = [(i, f"aB{chr(c)}c1 É") for i, c in enumerate([*range(1, 0x250), 0x2028, 0x1F389])]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r.doc_id: r.n_features for r in resampling.resample(df, df.filter("false"), longest=1).collect()}
    assert got == {i: len(_words(t)) for i, t in rows}


def test_empty_tables(empty, hard):
    assert resampling.resample(empty, empty).count() == 0
    assert resampling.drawn_rows(empty, empty).columns == empty.columns


def test_drawn_rows_keep_their_columns(hard, spark):
    target = spark.createDataFrame(items(), "item_id int, text string")
    drawn = resampling.drawn_rows(hard, target, percent=60, min_words=1)
    ids = {r.doc_id for r in resampling.resample(hard, target, percent=60, min_words=1).filter("rank IS NOT NULL").collect()}
    assert drawn.columns == hard.columns and {r.doc_id for r in drawn.collect()} == ids
    assert drawn.count() == hard.filter(F.coalesce("doc_id", F.lit(-99)).isin([-99 if i is None else i for i in ids])).count()
