"""Conversation tries against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from corpusmill.llm import tries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, d int, pos int, top int, size string"


def _rebuilt(rows, family=100, choices=6):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    told = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in told.items():
        h = zlib.crc32(str(c).encode()) % choices
        base = c - (c % family if c >= 0 else -(-c % family))
        out[c] = told.get(base, [])[:h] + turns[h:]
    return out


def _brute(rows):
    paths = _rebuilt(rows)
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in sorted(paths.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        saved[node] = sum(saved[x] for x in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (
            min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest(),
        )
        for n, m in members.items()
    )


def _got(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3, "y") for r in rows], SCHEMA)
    turns, convs = tries.with_borrowed_heads(tries.ordered_turns(df))
    got = tries.with_end_digests(tries.prefix_trie(turns, convs))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(got.columns) == sorted(names)
    assert {t for n, t in got.dtypes if n != "ends_sha256"} == {"bigint"}
    return sorted(map(tuple, got.select(*names).collect()))


def _random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 8), *range(100, 130), *range(203, 215), -105, -100, -3]:
        for turn in range(rng.randint(1, 9)):
            # Few different texts, so that paths are shared beyond the borrowed turns.
            rows.append((c, rng.choice([turn, turn, 2, None]), rng.choice(["a", "b", None]), rng.choice(["", "x", "yy", None, "é漢\U0001f389"])))
    return rows + rng.sample(rows, 10) + [(None, 1, "a", "nobody")]


@pytest.mark.parametrize("seed", [1, 2])
def test_tries(spark, seed):
    rows = _random_rows(seed)
    assert _got(spark, rows) == _brute(rows)


def test_long_conversations_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(tries, "BLOCK_BITS", 3)
    # Copies that stay together for 90 turns, two that part at the 40th, and a family without a first one.
    rows = [(c, t, "r", f"t{t if t < 40 or c != 4 else t + 1000}") for c in (1, 2, 3, 4) for t in range(90)]
    rows += [(c, t, "r", "same") for c in (301, 302) for t in range(3)]
    assert _got(spark, rows) == _brute(rows)


def test_large_lookups_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(tries, "BROADCAST_KEYS", 2)
    monkeypatch.setattr(tries, "HOT_SHARE", 0.3)
    rows = _random_rows(5)
    assert _got(spark, rows) == _brute(rows)


def test_empty_table(spark):
    assert _got(spark, []) == [] and _got(spark, [(None, 1, "a", "b")]) == []


def test_only_short_conversations(spark):
    # All turns are before the h-th and there is no first conversation of the family: all end at the root.
    rows = [(c, 0, "r", "x") for c in range(901, 940) if zlib.crc32(str(c).encode()) % 6 > 0]
    got = _got(spark, rows)
    assert got == _brute(rows) and len(got) == 1
