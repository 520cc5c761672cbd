"""Texts that are encoded together, against the tokenizers library."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from corpusmill.llm import token_files
from corpusmill.llm.queries import vocabulary

PARTS = [
    *"aZé漢1.,!'?$\x00\x01\n ", " ", " ", " ", "  ", "\t", "word", "naïve", "It's", "don'", "<|endoftext|>", "\xa0", "͸",
    "a" * 22, "b" * 23, "c" * 24, "b" * 23 + ".", "é" * 12, "averyveryverylongword,", "x" * 70, "\U0001f389",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def check(encode, library, texts, end_id, kind):
    got, counts = encode.together(texts, end_id)
    wanted = [[*library(text), end_id] for text in texts]
    assert counts.tolist() == [len(ids) for ids in wanted]
    assert np.frombuffer(got, kind).tolist() == [i for ids in wanted for i in ids]


@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_texts_together(library, texts):
    check(token_files.byte_level_encoder(vocabulary()), library, texts, 0, "<u2")


@pytest.mark.parametrize("kept", [1, 50, 100_000])
def test_table_of_chunks(library, monkeypatch, kept):
    """Tables that are emptied again and again, and one that grows many times."""
    monkeypatch.setattr(token_files, "_KEPT", kept)
    monkeypatch.setattr(token_files, "_PIECE_CHARS", 2000)
    monkeypatch.setattr(token_files, "_encoders", {})
    encode = token_files.byte_level_encoder(vocabulary(), "uint32")
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice([*"abcdeéñ.,"], n)) for n in rng.integers(1, 30, 3000)]
    for _ in range(40):
        check(encode, library, [" ".join(rng.choice(words, n)) for n in rng.integers(0, 150, 8)], 7, "<u4")
    for lines in (["one\ntwo. three"], ["", ""], ["y" * 3000 + " z", "a", "p  q", "b."]):
        check(encode, library, lines, 7, "<u4")


def test_tasks_share_what_is_known(monkeypatch):
    """Workers load what is sent to them anew for each task."""
    monkeypatch.setattr(token_files, "_encoders", {})
    sent = cloudpickle.dumps(token_files.byte_level_encoder(vocabulary()))
    first = cloudpickle.loads(sent)("a b")
    (known,) = token_files._encoders.values()
    assert cloudpickle.loads(sent)("a b") == first and [*token_files._encoders.values()] == [known]
