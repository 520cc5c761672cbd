"""Operators on words against brute force: links, passages, benchmark items, scores, languages, files."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import WORDS, empty, folded, hard, hard_rows, items, shingle_set  # noqa: F401
from pyspark.sql import functions as F

from corpusmill.llm import components, decontamination, jaccard, language, scoring, substrings, token_files
from corpusmill.llm import words as w
from corpusmill.llm.queries import vocabulary

LETTERS = ["a", "B", "c", " ", "  ", "\n", "\t", "\x0b", "\x1c", "é", "\xa0", "漢"]


@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(LETTERS), max_size=9).map("".join)), max_size=12), st.integers(0, 3))
@settings(max_examples=150, deadline=None)
def test_words_and_windows(texts, skip):
    table = w.words(pa.array(texts, pa.string()).slice(min(skip, len(texts))), fold=True)
    texts = texts[min(skip, len(texts)) :]
    names, windows = {}, {}
    for i, text in enumerate(texts):
        own = folded(text)
        hashes = table.hashes[table.bounds[i] : table.bounds[i + 1]]
        assert len(own) == len(hashes)
        for x, h in zip(own, hashes, strict=True):
            assert names.setdefault(x, h) == h
        for n in (2, 9):
            for j, h in enumerate(w.window_hashes(hashes, n)):
                assert windows.setdefault(tuple(own[j : j + n]), h) == h
    assert len(set(names.values())) == len(names) and len(set(windows.values())) == len(windows)
    found, bounds = w.shingles(table, 5)
    assert np.diff(bounds).tolist() == [len(shingle_set(t)) for t in texts]


def _components(n, links):
    root = list(range(n))
    for _ in range(n):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(i, i + 1) for i in range(0, 60)] + [tuple(map(int, rng.integers(100, 180, 2))) for _ in range(60)] + [(90, 90)]
    got = dict(components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    root = _components(180, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}


@pytest.fixture(scope="module")
def links():
    rows = hard_rows()
    sets = [shingle_set(t) for _, t, *_ in rows]
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    return sets, _components(len(rows), pairs)


def test_links(hard, links):
    sets, root = links
    rows = hard_rows()
    expected = []
    for n, (i, *_) in enumerate(rows):
        group = [rows[m][0] for m in range(len(rows)) if root[m] == root[n] and rows[m][0] is not None]
        expected.append((i, len(sets[n]), min(group, default=None)))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link_groups(hard).collect()]
    assert Counter(got) == Counter(expected)


def test_one_of_each(hard, links):
    sets, root = links
    rows = hard_rows()
    kept = jaccard.one_of_each(hard)
    assert kept.columns == hard.columns
    expected = set()
    for n, (i, t, *_) in enumerate(rows):
        group = [rows[m][0] for m in range(len(rows)) if root[m] == root[n] and rows[m][0] is not None]
        if not sets[n] or i == min(group, default=None):
            expected.add((i, t or ""))
    assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == Counter(expected)


def _near_copies(n_groups, size, seed):
    """Groups of documents a few changes from one text, or each from the one before."""
    rng, out = np.random.default_rng(seed), []
    for g in range(n_groups):
        base = [f"w{rng.integers(500)}" for _ in range(int(rng.integers(8, 60)))]
        for _ in range(size):
            own = list(base)
            own[int(rng.integers(len(own)))] = f"w{rng.integers(500)}"
            out.append(" ".join(own))
            if g % 2:
                base = own
    return out


@pytest.mark.parametrize("hot_rows, light, block", [(20_000, 16, 256), (2, 1, 5), (2, 0, 1)])
def test_links_of_near_copies(spark, monkeypatch, hot_rows, light, block):
    for name, value in (("HOT_ROWS", hot_rows), ("LIGHT", light), ("BLOCK", block)):
        monkeypatch.setattr(jaccard, name, value)
    texts = _near_copies(6, 12, 5)
    sets = [shingle_set(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in jaccard.link_groups(df).collect()}
    assert got == dict(enumerate(_components(len(texts), pairs)))


def _passages(rows, n):
    first = {}
    for i, own in rows:
        if i is not None:
            for j in range(len(own) - n + 1):
                key = tuple(own[j : j + n])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, own in rows:
        gone = set()
        if i is not None:
            for j in range(len(own) - n + 1):
                if first[tuple(own[j : j + n])] < i:
                    gone.update(range(j, j + n))
        kept = " ".join(x for j, x in enumerate(own) if j not in gone)
        out.append((i, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window", [50, 7])
def test_repeated_passages(hard, window):
    got = substrings.repeated_spans(hard, window).drop("spans", "text_key").collect()
    expected = _passages([(i, WORDS.findall(t or "")) for i, t, *_ in hard_rows()], window)
    assert Counter(map(tuple, got)) == Counter(expected)


def test_random_passages(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(40):
        own = [f"v{x}" for x in rng.integers(0, 10**6, 30)]
        for _ in range(int(rng.integers(0, 3))):
            if rows:
                other = rows[int(rng.integers(len(rows)))][1].split()
                at = int(rng.integers(len(other)))
                own[5:5] = other[at : at + int(rng.integers(5, 40))]
        rows.append((int(rng.integers(0, 60)), " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = substrings.repeated_spans(df, 12, shortest=3).drop("spans", "text_key").collect()
    assert Counter(map(tuple, got)) == Counter(_passages([(i, t.split()) for i, t in rows], 12))


def test_cut_texts(hard):
    got = substrings.without_repeats(hard)
    digests = {r.kept_sha256 for r in substrings.repeated_spans(hard).collect()}
    assert got.columns == hard.columns and got.count() == len(hard_rows())
    assert {hashlib.sha256(" ".join(WORDS.findall(r.text or "")).encode()).hexdigest() for r in got.collect()} == digests


@pytest.mark.parametrize("block_bytes", [16 << 20, 60])
def test_benchmark_items(spark, hard, block_bytes):
    bench = spark.createDataFrame([(i, t, 5) for i, t in items()], "item_id bigint, text string, id int")
    got = decontamination.contained_items(hard, bench, block_bytes=block_bytes).collect()
    expected = Counter()
    for i, t, *_ in hard_rows():
        own = folded(t)
        for item, text in items():
            wanted = shingle_set(text)
            n = min(5, len(folded(text)))
            held = {tuple(own[j : j + n]) for j in range(len(own) - n + 1)} if n else set()
            if wanted and 100 * len(wanted & held) >= 80 * len(wanted):
                expected[(i, item, len(wanted), len(wanted & held))] += 1
    assert Counter(tuple(r)[:4] for r in got) == expected and expected
    left = decontamination.without_items(hard, bench, block_bytes=block_bytes)
    assert left.columns == hard.columns and left.count() == len(hard_rows()) - sum(
        any(len(shingle_set(x)) and 100 * len(shingle_set(x) & s) >= 80 * len(shingle_set(x)) for _, x in items() for s in [_grams(t, x)])
        for _, t, *_ in hard_rows()
    )


def _grams(text, item):
    own, n = folded(text), min(5, len(folded(item)))
    return {tuple(own[j : j + n]) for j in range(len(own) - n + 1)} if n else set()


@given(st.integers(1, 400), st.integers(1, 100))
def test_enough_minima(size, percent):
    # A set that shares enough misses fewer than the minima that are looked for.
    assert decontamination.minima(size, percent) > size - decontamination.needed(size, percent)


@pytest.mark.parametrize("group_bytes", [256 << 20, 2500])
def test_scores(hard, group_bytes):
    got = scoring.score_texts(hard, group_bytes=group_bytes, hot_words=50)
    rows = [("" if i is None else str(i), [*folded(t), ""]) for i, t, *_ in hard_rows()]
    held = [zlib.crc32(i.encode()) % 7 == 2 for i, _ in rows]
    counts, pairs = Counter(), Counter()
    for (_, own), out in zip(rows, held, strict=True):
        if not out:
            counts.update(own)
            pairs.update(zip(["^", *own], own, strict=False))
    n, v, starts = sum(counts.values()), len(counts), counts[""]
    expected, exact = [], defaultdict(list)
    for (i, own), out in zip(rows, held, strict=True):
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in own)
        expected.append((int(i) if i else None, out, len(own), sum(counts[x] > 0 for x in own), n, round(base, 6)))
        score = 0.0
        for before, x in zip(["^", *own], own, strict=False):
            c = counts[before] if before != "^" else starts
            score += math.log10((min(pairs[(before, x)], c) + scoring.PRIOR * (counts[x] + 1) / (n + v + 1)) / (c + scoring.PRIOR))
        exact[expected[-1]].append(score)
    found = got.collect()
    key = lambda r: (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
    assert Counter(map(key, found)) == Counter(expected)
    for r in found:  # counts are quantised and one probe in a hundred is wrong
        assert min(abs(r.score - s) for s in exact[key(r)]) <= 0.02 * abs(r.score) + 0.5 * r.n_tokens / 10 + 0.3


def test_filter_levels():
    rng = np.random.default_rng(4)
    keys, counts = rng.integers(0, 2**63, 4000).astype(np.uint64), rng.integers(1, 3000, 4000)
    bits, size = scoring._filled(keys, counts)
    group = scoring._Filter(8, list(range(256)), [size] * 256, [b""] * 255 + [bits.tobytes()])
    group.base[:] = 0
    levels = np.searchsorted(scoring.level_starts(), counts, "right")
    got = group.levels(keys)
    assert (got >= levels).all() and (got == levels).mean() > 0.97
    assert (group.levels(rng.integers(0, 2**63, 4000).astype(np.uint64)) == 0).mean() > 0.97


def test_filter_keeps_levels_of_frequent_keys(monkeypatch):
    monkeypatch.setattr(scoring, "MEMO_KEYS", 1 << 10)
    rng = np.random.default_rng(5)
    keys, counts = rng.integers(0, 2**63, 6000).astype(np.uint64), rng.integers(1, 3000, 6000)
    bits, size = scoring._filled(keys, counts)
    make = lambda: scoring._Filter(8, list(range(256)), [size] * 256, [b""] * 255 + [bits.tobytes()])
    group = make()
    group.base[:] = 0
    asked = [rng.choice(np.concatenate([keys, [np.uint64(0)], rng.integers(0, 2**63, 3000).astype(np.uint64)]), 4000) for _ in range(8)]
    expected = [group._probed_levels(some) for some in asked]
    for some, levels in zip(asked, expected, strict=True):
        assert (group.levels(some) == levels).all()
    # Of the keys of one place that of the highest level is not probed again.
    best = {}
    for key, level in zip(np.concatenate(asked).tolist(), np.concatenate(expected).tolist(), strict=True):
        best[key % 1024] = max(best.get(key % 1024, (0, 0)), (level, key))
    group._probed_levels = lambda some: np.zeros(len(some), np.uint8)
    again = group.levels(np.concatenate(asked))
    expected = np.concatenate(expected)
    places = np.concatenate(asked) % np.uint64(1024)
    for place, (level, _) in best.items():
        assert again[places == place].max() == level
    other = make()  # holds no slice
    other.base[:] = -1
    assert not other.levels(keys).any() and not other.memo[1].any()


def _speech(rng, letters, n):
    return " ".join("".join(rng.choice(list(letters), int(rng.integers(2, 7)))) for _ in range(n))


def test_languages(spark):
    rng = np.random.default_rng(6)
    rows = [(i, _speech(rng, "abcde" if i % 2 else "cdefgé", 40), "one" if i % 2 else "two", i) for i in range(80)]
    mixed = _speech(rng, "abab", 30) + " 77 " + _speech(rng, "gféf", 20)
    rows += [(200, None, "one", 0), (201, "", None, 0), (202, "12 34 !!", "two", 0), (203, mixed, None, 0), (None, mixed, None, 0), (204, "中文", None, 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int").repartition(3)
    got = language.predict_languages(df, word_labels=True).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    tests = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 80]
    assert tests and all(r.lang_pred == ("one" if r.doc_id % 2 else "two") and 0.5 < r.score <= 1 for r in tests)
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (200, 201, 202))
    assert by_id[204].lang_pred in ("one", "two")
    switched = by_id[203].word_langs
    assert switched[30] == "und" and switched[:30].count("one") >= 28 and switched[31:].count("two") >= 18
    assert by_id[203].lang_pred == by_id[None].lang_pred == "one"
    kept = language.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 3


def test_nothing_to_learn_from(hard):
    got = language.predict_languages(hard.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(got) == len(hard_rows()) and {r.lang_pred for r in got} == {"und"}


def test_marginals_are_exact():
    rng = np.random.default_rng(1)
    scores, steps, first = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    total, each = 0.0, np.zeros((4, 3))
    for path in np.ndindex(3, 3, 3, 3):
        p = math.exp(first[path[0]] + sum(scores[0, t, y] for t, y in enumerate(path)) + sum(steps[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += p
        for t, y in enumerate(path):
            each[t, y] += p
    padded = np.concatenate([scores, rng.normal(size=(1, 3, 3))], 1)
    got, _, _ = language._marginals(padded, np.array([4]), steps, first)
    assert np.allclose(got[0, :4], each / total)


def test_texts_are_one_chain():
    """Texts of any length, side by side, against one padded sequence each."""
    rng = np.random.default_rng(2)
    lengths = [0, 1, 150, 2, 0, 65, 64, 1]
    bounds = np.cumsum([0, *lengths])
    scores, steps, first = rng.normal(size=(bounds[-1], 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got = language._chained(scores, bounds, steps, first)
    for n, b in zip(lengths, bounds[:-1], strict=True):
        if n:
            each, _, _ = language._marginals(scores[None, b : b + n], np.array([n]), steps, first)
            assert np.allclose(got[b : b + n], each[0])
    assert language._chained(scores[:0], np.zeros(3, int), steps, first).shape == (0, 3)


SPELLED = [*"ab'stlmre1½ .,!?\n\t\r\x0b\x1c\x85\xa0é漢", " ", "\n", " ", "　", "​", "'ll", "<|endoftext|>", "\U0001f389"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@given(st.lists(st.sampled_from(SPELLED), max_size=14).map("".join))
@settings(max_examples=400, deadline=None)
def test_encoder(library, text):
    encode = token_files.byte_level_encoder(vocabulary())
    assert np.frombuffer(encode(text), "<u2").tolist() == library(text)


def test_encoder_knows_every_character(library):
    """Each code point, assigned or not, beside what the pattern looks at."""
    encode = token_files.byte_level_encoder(vocabulary())
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000 and (p < 0x3400 or p % 7 == 0 or 0xA000 <= p < 0x20000)]
    for start in range(0, len(points), 512):
        text = "".join(f"{chr(p)}'s a{chr(p)} {chr(p)}1 \u0301{chr(p)}\n" for p in points[start : start + 512])
        assert np.frombuffer(encode(text), "<u2").tolist() == library(text), hex(points[start])


def test_encoder_looks_at_characters_once(library):
    encoder = token_files._Encoder(vocabulary(), "uint16", False)
    pattern, looked = encoder.disputed, []

    class Counted:
        def search(self, chunk):
            looked.append(chunk)
            return pattern.search(chunk)

    encoder.disputed = Counted()
    for text in ("é漢 aé éb é漢a,", "漢é 漢1", "\U0001f389é é", "b\U0001f389é é"):
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == library(text)
    assert looked == ["é漢", "\U0001f389é", "b\U0001f389é"]  # a disputed one each time


def test_other_patterns_are_left_to_the_library(tmp_path):
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    texts = ["It's  Ünïcode 123\n", "", " x", "don't"]
    for n, change in enumerate((("pre_tokenizer", pre_tokenizers.ByteLevel(add_prefix_space=True)), ("normalizer", normalizers.Lowercase()))):
        other = Tokenizer.from_file(vocabulary())
        setattr(other, *change)
        path = str(tmp_path / f"{n}.json")
        other.save(path)
        encode = token_files.byte_level_encoder(path)
        for text in texts:
            assert np.frombuffer(encode(text), "<u2").tolist() == other.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("dtype", ["uint16", "uint32"])
def test_token_files(hard, library, tmp_path, dtype):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(hard, path, token_files.byte_level_encoder(vocabulary(), dtype), dtype)
    spark = hard.sparkSession
    rows = sorted(hard_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    ids = [[*library(t or ""), 0] for _, t, *_ in rows]
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    assert [r.start for r in got] == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert Counter(tuple(r.tokens) for r in got) == Counter(map(tuple, ids))
    short = token_files.read_token_files(spark, path, tokens=False).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in short) == Counter(
        (r.doc_id, len(r.tokens), zlib.crc32(np.array(r.tokens, "<u4").tobytes())) for r in got
    )


def test_empty_tables(spark, empty, hard, tmp_path):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert jaccard.link_groups(empty).count() == 0
    assert jaccard.one_of_each(empty).count() == 0
    assert substrings.repeated_spans(empty).count() == 0
    assert scoring.score_texts(empty).count() == 0
    assert language.predict_languages(empty).count() == 0
    assert decontamination.contained_items(empty, none).count() == 0
    assert decontamination.contained_items(hard, none).count() == 0
    assert decontamination.without_items(hard, none).count() == len(hard_rows())
    path = str(tmp_path / "tokens")
    token_files.write_token_files(empty, path, token_files.byte_level_encoder(vocabulary()))
    assert token_files.read_token_files(spark, path).count() == 0
