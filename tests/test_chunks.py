import random
import re

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import chunker
from corpusmill.functions.separators import DEFAULT_SEPARATORS, LANGUAGE_SEPARATORS, separators_for
from corpusmill.operators import chunks


def rules(size, overlap, separators=None, keep="start", is_regex=False, strip=True, length=len):
    return chunker.rules(size, overlap, separators or DEFAULT_SEPARATORS, keep, is_regex, strip, length)


def longest_runs(pieces, size, overlap, glue=""):
    """Merging stated as a search: each chunk is the longest run that fits, the next one
    starts as early as overlap and size allow."""
    def width(a, b):
        return len(glue.join(pieces[a:b]))

    a, found = 0, []
    while True:
        b = max(b for b in range(a + 1, len(pieces) + 1) if b == a + 1 or width(a, b) <= size)
        found.append(glue.join(pieces[a:b]).strip())
        if b == len(pieces):
            return [f for f in found if f]
        a = min(
            s for s in range(a, b + 1)
            if s == b or (width(s, b) <= overlap and width(s, b + 1) <= size)
        )


def by_brute_force(text, size, overlap, separators):
    """Single-character separators kept at the start, cut with a look-ahead."""
    here = next((i for i, s in enumerate(separators) if s == "" or s in text), None)
    if here is None:
        return [text.strip()] if len(text) < size else [text]
    sep, rest = separators[here], separators[here + 1 :]
    pieces = list(text) if sep == "" else [p for p in re.split(f"(?={re.escape(sep)})", text) if p]
    found, run = [], []
    for piece in pieces + [None]:
        if piece is not None and len(piece) < size:
            run.append(piece)
            continue
        if run:
            found += longest_runs(run, size, overlap)
            run = []
        if piece is not None:
            found += by_brute_force(piece, size, overlap, rest) if rest and sep else [piece]
    return found


def test_recursive_chunks_match_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choices("abc \n", weights=[4, 4, 4, 3, 1], k=rng.randint(1, 80)))
        size = rng.randint(1, 20)
        overlap = rng.randint(0, size)
        expected = by_brute_force(text, size, overlap, ["\n", " ", ""])
        assert list(chunker.chunks(text, rules(size, overlap, ["\n", " ", ""]))) == expected, (text, size, overlap)


def test_merge_with_a_joining_separator_matches_brute_force():
    rng = random.Random(4)
    for _ in range(1500):
        pieces = ["".join(rng.choices("xyz", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 15))]
        size = rng.randint(6, 20)
        overlap = rng.randint(0, size)
        r = rules(size, overlap, keep=None)
        assert list(filter(None, chunker.merge(pieces, ", ", r))) == longest_runs(pieces, size, overlap, ", ")


def test_separators_do_not_overlap():
    text = "a\n\n\nb"
    sep = chunker.Separator("\n\n", re.compile("\n\n"))
    assert chunker.cut(text, sep, "start") == ["a", "\n\n\nb"]
    assert chunker.cut(text, sep, "end") == ["a\n\n", "\nb"]
    assert chunker.cut(text, sep, None) == ["a", "\nb"]


def test_a_piece_of_exactly_the_chunk_size_goes_on_alone():
    assert list(chunker.chunks("abcd efg", rules(4, 0, [" "]))) == ["abcd", " efg"]
    assert list(chunker.chunks("abc ef", rules(4, 0, [" "]))) == ["abc", "ef"]


def test_oversized_piece_without_separator_is_kept_unstripped():
    assert list(chunker.chunks("  toolong", rules(3, 0, ["\n"]))) == ["  toolong"]


def test_dropped_separator_is_used_to_join():
    assert list(chunker.chunks("a,,b,c", rules(10, 0, [","], keep=None))) == ["a,b,c"]


def test_start_index_searches_forward(spark):
    df = spark.createDataFrame([(1, "foo bar foo bar foo")], "id int, text string")
    rows = chunks.split_documents(df, chunks.recursive(8, 4)).orderBy("chunk_index").collect()
    assert [(r.id, r.chunk_index, r.chunk, r.start_index) for r in rows] == [
        (1, 0, "foo bar", 0), (1, 1, "bar foo", 4), (1, 2, "foo bar", 8), (1, 3, "bar foo", 12),
    ]


def test_nulls_and_empty_texts_give_no_chunks(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "id int, text string")
    assert [r.id for r in chunks.split_documents(df, chunks.recursive(8, 2)).collect()] == [3]


def test_language_column_and_custom_length(spark):
    python = "import os\n\nclass A:\n    pass\n\ndef f():\n    return 1\n"
    df = spark.createDataFrame([(1, "python", python), (2, "html", "<p>one</p><p>two</p>")], "id int, lang string, text string")
    rows = chunks.split_documents(df, chunks.recursive(22, 0, language=F.col("lang"))).orderBy("id", "chunk_index").collect()
    assert [r.chunk for r in rows if r.id == 1] == ["import os", "class A:\n    pass", "def f():\n    return 1"]
    assert [r.chunk for r in rows if r.id == 2] == ["<p>one</p><p>two</p>"]
    by_words = chunks.split_documents(df.filter("id = 1"), chunks.recursive(3, 0, length=lambda s: len(s.split())))
    assert max(len(r.chunk.split()) for r in by_words.collect()) <= 3


def test_every_preset_compiles_and_covers_the_text():
    text = "\n".join(["class A", "  def f ", "$x$ {y}", "IF a", "<div>z</div>", "# head", "| guard"]) * 3
    assert len(LANGUAGE_SEPARATORS) == 26
    for language, separators in LANGUAGE_SEPARATORS.items():
        found = list(chunker.chunks(text, rules(12, 0, separators, is_regex=True, strip=False)))
        assert "".join(found) == text, language


def test_presets():
    assert separators_for("python") == ["\nclass ", "\ndef ", "\n\tdef ", "\n\n", "\n", " ", ""]
    assert separators_for("cobol")[-4:] == ["\nSTOP RUN.", "\n", " ", ""]
    assert separators_for("haskell")[-7:] == ["\ndata ", "\n= {", "\n, ", "\n\n", "\n", " ", ""]
    assert separators_for("latex")[-4:] == ["$$", "$", " ", ""]
    assert len(separators_for("html")) == 27 and separators_for("html")[-1] == ""
    assert separators_for("visualbasic6")[0] == r"\n(?!End\s)(?:Public|Private|Friend|Global|Static)\s+?Sub\s+"
    for unknown in ("perl", "klingon"):
        with pytest.raises(ValueError):
            separators_for(unknown)


def test_regex_split_agrees_with_the_row_helper(spark):
    rng = random.Random(5)
    values = ["".join(rng.choices("ab\n. ", k=rng.randint(0, 20))) for _ in range(300)] + ["", "\n\n\n"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, text string")
    for pattern, is_regex in [("\n\n", False), (r"\s+", True), (".", False), (r"[a.]b?", True), ("", False)]:
        for keep in (False, "start", "end"):
            got = {r.id: r.p for r in df.select("id", chunks.separated(pattern, keep, is_regex)(F.col("text")).alias("p")).collect()}
            source = pattern if is_regex else re.escape(pattern)
            sep = chunker.Separator(pattern, re.compile(source) if pattern else None)
            for i, text in enumerate(values):
                assert got[i] == chunker.cut(text, sep, keep or None), (pattern, keep, text)


def test_regex_split_survives_marker_characters(spark):
    marks = "\ufdd0\ufdd1\ufdd1\ufdd0\ufdd1\ufdd0\ufdd2\ufdd3"
    df = spark.createDataFrame([("a\ufdd0b c",), (f"{marks} {marks}\ufdd1 \ufdd1{marks}",)], "text string")
    got = [r[0] for r in df.select(chunks.separated(" ")(F.col("text"))).collect()]
    assert got == [["a\ufdd0b", "c"], [marks, f"{marks}\ufdd1", f"\ufdd1{marks}"]]


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 9, 10, 23])
def test_token_windows(spark, n):
    df = spark.range(1).select(F.when(F.lit(n > 0), F.sequence(F.lit(0), F.lit(max(n - 1, 0)))).otherwise(F.array().cast("array<int>")).alias("t"))
    windows = df.select(chunks.token_windows(F.col("t"), 5, 2)).collect()[0][0]
    tokens = list(range(n))
    expected = []
    for start in range(0, n, 3):
        expected.append(tokens[start : start + 5])
        if start + 5 >= n:
            break
    assert windows == expected


def test_parameters_are_checked():
    for size, overlap in [(0, 0), (5, -1), (5, 6)]:
        with pytest.raises(ValueError):
            chunks.recursive(size, overlap)
    with pytest.raises(ValueError):
        chunks.check_sizes(5, 6)
    with pytest.raises(ValueError):
        chunks.separated(",", keep="middle")


def test_custom_splitter(spark):
    df = spark.createDataFrame([(1, "a-b")], "id int, text string")
    rows = chunks.split_documents(df, lambda text: F.split(text, "-")).collect()
    assert [(r.id, r.chunk_index, r.chunk) for r in rows] == [(1, 0, "a"), (1, 1, "b")]


def test_word_windows_are_slices(texts):
    rng = random.Random(5)
    values = ["".join(rng.choices(["a", "bé", "\u4e2d", " ", "\n", "\u2003", "\u3000", "\x1c", "\u200b"], k=rng.randint(0, 40))) for _ in range(300)]
    values += ["", " ", "\u3000\n", "x", " x ", "x" * 100_000, " " * 100_000]
    df = texts(values)
    rows = df.select("id", chunks.word_windows(3, 0)(F.col("text")).alias("w"), chunks.word_windows(3, 1)(F.col("text")).alias("o"))
    for r in rows.collect():
        text = values[r.id]
        assert "".join(r.w) == text
        n = len(text.split()) or int(text != "")
        assert len(r.w) == -(-n // 3)
        assert [len(w.split()) for w in r.w[:-1]] == [3] * max(len(r.w) - 1, 0)
        spaced = re.findall(r"\s*\S+(?:\s+\Z)?|\s+\Z", text)
        expected = []
        for start in range(0, len(spaced), 2):
            expected.append("".join(spaced[start : start + 3]))
            if start + 3 >= len(spaced):
                break
        assert r.o == expected
