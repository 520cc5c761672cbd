"""Tables with every awkward case, and brute-force helpers."""

import random
import re

import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "id string, row int, text_key string, `key.part` int, size int, h int, cid int, a int, b int, epoch int, shard int"
)


def invented(seed, n, letters="abcdefgh"):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n)]


def hard_rows():
    base, long_ = invented(1, 200), invented(2, 20_000)
    near = base[:60] + ["changed"] + base[61:]
    apart = base[:100] + invented(3, 100)
    texts = [
        (1, " ".join(base)), (2, " ".join(base)), (3, "\n ".join(base) + "\t"), (4, " ".join(near)),
        (5, None), (6, ""), (7, " \n\t"), (8, "One two"), (9, "one  TWO"), (10, " ".join(long_)),
        (11, " ".join(invented(4, 30) + long_[500:560] + invented(5, 40))),
        (12, " ".join(invented(6, 40) + item_words(0) + invented(7, 400))),
        (12, " ".join(invented(6, 40) + item_words(0) + invented(7, 400))),
        (12, " ".join(apart)), (13, "123 456 ... !"), (14, " ".join(base[:100] + base[:100])),
        (None, " ".join(base)), (None, " ".join(invented(8, 80))), (None, None),
        (15, "é ü 漢字 \U0001f389 'll x1 <|endoftext|>"), (16, " ".join(["same"] * 300)), (17, " ".join(["same"] * 299)),
        (-3, " ".join(invented(9, 55))), (18, " ".join(invented(9, 55) + invented(10, 5))),
    ]
    return [
        (i, t, None if n % 5 == 0 else "xy"[n % 2], None if n % 7 == 0 else f"src{n % 3}", None, "id", 1, "k", 2, 3, 4, 5, 6, 7, 8, 9)
        for n, (i, t) in enumerate(texts)
    ]


def item_words(n):
    return invented(100 + n, 30)


def items():
    return [(0, " ".join(item_words(0))), (1, " ".join(item_words(1))), (2, None), (3, ""), (4, "one two"), (4, "one two"), (None, "456")]


def folded(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORDS.findall(text or "")]


def shingle_set(text):
    own = folded(text)
    n = min(5, len(own))
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()


@pytest.fixture(scope="session")
def hard(spark, tmp_path_factory):
    """The awkward rows, in several files so that they come from several tasks."""
    path = str(tmp_path_factory.mktemp("hard") / "documents.parquet")
    spark.createDataFrame(hard_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(hard):
    return hard.filter("doc_id = 999")
