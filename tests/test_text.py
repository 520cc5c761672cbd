import random
import re

from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import clean


def python_clean(text):
    text = re.sub(r"\s+", " ", text)
    return re.sub(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "", text).strip()


CASES = [
    "", "   ", "a\x00 \x01 b", " \x07 x", "a\u00a0\u3000b", "\u2028a\x85", "tab\t\tnew\nline\r\n",
    "emoji 😀 é", "a\u200bb", "\x1c\x1d a \x1e", "x" * 50, "word  word",
]


def collected(df, column):
    return [r[0] for r in df.orderBy("id").select(column).collect()]


def test_clean_agrees_with_python_on_every_low_code_point(texts):
    values = CASES + [f"a{chr(c)}b{chr(c)}" for c in range(1, 0x3101)]
    assert collected(clean.clean_text(texts(values)), "text") == [python_clean(v) for v in values]


def test_words_and_strip_agree_with_python(texts):
    df = texts(CASES).select("id", tx.words(F.col("text")).alias("w"), tx.strip(F.col("text")).alias("s"))
    assert collected(df, "w") == [v.split() for v in CASES]
    assert collected(df, "s") == [v.strip() for v in CASES]


def test_words_of_cleaned_text_are_its_words(texts):
    df = clean.clean_text(texts(CASES)).select("id", tx.words_of_cleaned(F.col("text")).alias("w"))
    assert collected(df, "w") == [python_clean(v).split() for v in CASES]


def test_clean_random_strings(texts):
    rng = random.Random(7)
    values = ["".join(rng.choices(" \t\n\x00\x1f\x7f\u00a0\u2003ab", k=rng.randint(0, 15))) for _ in range(500)]
    assert collected(clean.clean_text(texts(values)), "text") == [python_clean(v) for v in values]


def test_length_filter_counts_code_points_after_cleaning(texts):
    values = ["x" * 49 + "  ", "x" * 50, "é" * 50, "😀" * 49, " " + "y" * 51]
    kept = clean.drop_short(clean.clean_text(texts(values)), 50)
    assert [r.id for r in kept.orderBy("id").collect()] == [1, 2, 4]


def test_truncate_keeps_the_cut_unstripped(texts):
    df = texts(["ab cd ef"])
    assert collected(clean.truncate(df, 3), "text") == ["ab "]
    assert collected(clean.truncate(df, 0), "text") == ["ab cd ef"]
    assert collected(clean.truncate(df, None), "text") == ["ab cd ef"]


def test_newlines(texts):
    df = texts(["a\r\nb\rc\nd"]).select("id", tx.unix_newlines(F.col("text")).alias("t"))
    assert collected(df, "t") == ["a\nb\nc\nd"]


def test_cleaning_is_not_repeated_for_the_filter(texts):
    plan = clean.prepare(texts(["a"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 2


def test_funnel(texts):
    row = clean.funnel(texts(["x" * 60] * 7 + ["short"])).collect()[0]
    assert tuple(row) == (8, 7, 6, 1)
