"""Toxicity by a support vector machine over a gap-weighted subsequence kernel.

Two strings are alike as far as they share subsequences of three letters, each weighted by
how far it is spread (a gap costs a factor of ``DECAY``), so insults with inserted characters, gaps
or other endings stay close to the ones learned. Strings are *sightings*: a word's letters,
and runs of single letters read as one word. A text is a bag of them: it is toxic if one
sighting is. The machine is fitted on the sentences of labelled documents in the space that a
bounded number of landmark strings span (Nyström); every round, each toxic document
points out the sighting that speaks for it most, and the clean ones the sightings
that come out wrong.

Decisions in the landmark space are sums over the landmarks' kernel values. The kernel has
a finite feature map (letter triples within ``REACH`` letters), so the sum is folded into one weight for each triple: scoring a
new string costs as much as listing its triples, however many landmarks there are.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words as w
from corpusmill.llm.common import column
from corpusmill.session import materialize

DOCS_PER_CLASS = 1500
SAMPLE_CHARS = 20_000
LANDMARKS = 256
DECAY, REACH = 0.75, 7
WINDOW, STEP = 32, 16  # letters of a piece of a longer string
ROUNDS = 3
# A certain insult is more frequent in suspect sentences by so many standard deviations, and so many times.
CERTAIN, LIFT = 4.0, 4.0
SPOILT, SPOILT_SHARE = 4, 1.0  # copies of a certain insult with a letter put in, and their weight
CLEAN_SHARE = 0.75  # weight of the clean texts where decisions become scores
AGAINST = 6000  # clean sightings drawn, and as many that came out wrong, in each round
_END = re.compile(r"[.!?\n]+")
PENALTY = 3e-5
CACHE = 1 << 20
_SYMBOLS = 32
# Letters 0-25; digits and signs that stand for letters; other bytes of letters in five
# classes; everything else is left out, so separators inside a word are no letters.
_LETTER = np.full(256, 255, np.uint8)
_LETTER[97:123] = np.arange(26)
_LETTER[65:91] = np.arange(26)
for _sign, _letter in zip("013457@$", "oieastas", strict=True):
    _LETTER[ord(_sign)] = ord(_letter) - 97
_LETTER[128:192] = 26 + np.arange(64) % 5
_LETTER[192:] = 31
_GAPS = [(a, b) for a in range(1, REACH - 1) for b in range(a + 1, REACH)]


class Machine(NamedTuple):
    """Weights of the letter triples, bias, and the logistic curve of a text's best decision."""

    triples: np.ndarray
    bias: float
    slope: float
    shift: float


class Sightings(NamedTuple):
    """Distinct strings of letters, where each text's are, and a key of each."""

    letters: np.ndarray
    bounds: np.ndarray
    keys: np.ndarray
    place: np.ndarray  # the distinct string of each sighting
    owner: np.ndarray  # the text of each sighting


def sightings(texts: pa.Array) -> Sightings:
    """The strings of ``texts``: words, long words in overlapping pieces, runs of single letters."""
    table = w.words(texts, fold=True)
    symbols = _LETTER[table.data]
    kept = np.flatnonzero(symbols < _SYMBOLS)
    letters = symbols[kept]
    begin, end = np.searchsorted(kept, table.starts), np.searchsorted(kept, table.ends)
    owner = table.owners
    size = end - begin
    single = size == 1
    # Runs of at least three words of one letter in a text, nothing longer between them.
    linked = np.zeros(len(size) + 1, bool)
    linked[1:-1] = single[1:] & single[:-1] & (owner[1:] == owner[:-1])
    runs = np.stack([np.flatnonzero(single & ~linked[:-1]), np.flatnonzero(single & ~linked[1:]) + 1], 1)
    runs = runs[runs[:, 1] - runs[:, 0] >= 3]
    begin = np.concatenate([begin, begin[runs[:, 0]]])
    end = np.concatenate([end, end[runs[:, 1] - 1]])
    owner = np.concatenate([owner, owner[runs[:, 0]]])
    real = end - begin >= 3
    begin, end, owner = begin[real], end[real], owner[real]
    pieces = np.maximum(-(-(end - begin - WINDOW) // STEP), 0) + 1
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(begin, pieces) + nth * STEP
    end, owner = np.minimum(np.repeat(end, pieces), begin + WINDOW), np.repeat(owner, pieces)
    keys = _string_keys(letters, begin, end)
    keys, first, place = np.unique(keys, return_index=True, return_inverse=True)
    begin, size = begin[first], (end - begin)[first]
    bounds = np.concatenate([[0], np.cumsum(size)])
    inside = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size) + np.repeat(begin, size)
    return Sightings(letters[inside], bounds, keys, place, owner)


def _string_keys(letters: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = w._power_table(w._BASE, len(letters) + 1)
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(w._BYTE_VALUES[letters] * up[: len(letters)], out=sums[1:])
    return w.mixed((sums[end] - sums[begin]) * down[begin]) + (end - begin).astype(np.uint64)


def _part(table: Sightings, at: np.ndarray) -> Sightings:
    """Only the distinct strings ``at``, in that order."""
    size = np.diff(table.bounds)[at]
    bounds = np.concatenate([[0], np.cumsum(size)])
    inside = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size) + np.repeat(table.bounds[at], size)
    none = np.zeros(0, np.int64)
    return Sightings(table.letters[inside], bounds, table.keys[at], none, none)


def features(table: Sightings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, triple and value of the unit-length feature vector of each distinct string."""
    n = len(table.letters)
    text = table.letters.astype(np.int64)
    left = np.repeat(table.bounds[1:], np.diff(table.bounds)) - np.arange(n)
    string = np.repeat(np.arange(len(table.keys)), np.diff(table.bounds))
    keys, values = [], []
    for a, b in _GAPS:
        at = np.flatnonzero(left > b)
        triple = (text[at] * _SYMBOLS + text[at + a]) * _SYMBOLS + text[at + b]
        keys.append(string[at] * _SYMBOLS**3 + triple)
        values.append(np.full(len(at), DECAY ** (b - 2)))
    keys, place = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(place, np.concatenate(values), len(keys))
    owner = keys // _SYMBOLS**3
    length = np.sqrt(np.bincount(owner, sums**2, len(table.keys)))
    return owner, keys % _SYMBOLS**3, sums / length[owner]


def decisions(table: Sightings, machine: Machine, step: int = 1 << 14) -> np.ndarray:
    """The machine's decision on each distinct string, a bounded number at a time."""
    found = np.empty(len(table.keys))
    for start in range(0, len(found), step):
        at = np.arange(start, min(start + step, len(found)))
        owner, triple, value = features(_part(table, at))
        found[at] = np.bincount(owner, value * machine.triples[triple], len(at)) + machine.bias
    return found


def _dense(table: Sightings, at: np.ndarray) -> np.ndarray:
    owner, triple, value = features(_part(table, at))
    rows = np.zeros((len(at), _SYMBOLS**3), np.float32)
    rows[owner, triple] = value
    return rows


def _kernel(table: Sightings, at: np.ndarray, landmarks: np.ndarray, step: int = 512) -> np.ndarray:
    """Kernel values of the strings ``at`` with the landmarks' feature rows."""
    parts = [_dense(table, at[i : i + step]) @ landmarks.T for i in range(0, len(at), step)]
    return np.concatenate([np.zeros((0, len(landmarks)), np.float32), *parts])


def _shares(weight: np.ndarray) -> np.ndarray:
    return weight / max(weight.sum(), 1e-9)


def _machine(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by Newton steps over the rows short of the margin."""
    z1 = np.concatenate([z, np.ones((len(z), 1))], 1)
    ridge = np.full(z1.shape[1], PENALTY)
    ridge[-1] = 1e-9
    u, before = np.zeros(z1.shape[1]), None
    for _ in range(50):
        short = y * (z1 @ u) < 1
        if before is not None and np.array_equal(short, before):
            break
        near, pull = z1[short], weight[short] / weight.sum()
        fresh = np.linalg.solve(near.T @ (near * pull[:, None]) + np.diag(ridge), near.T @ (pull * y[short]))
        u, before = u + _step(z1, y, weight / weight.sum(), ridge, u, fresh - u) * (fresh - u), short
    return u[:-1], u[-1]


def _step(z, y, weight, ridge, u, move) -> float:
    """The longest of some halved steps that lowers the loss."""
    at, along = z @ u, z @ move
    losses = {}
    for k in range(12):
        size = 0.5**k
        losses[size] = weight @ np.maximum(1 - y * (at + size * along), 0) ** 2 + ridge @ (u + size * move) ** 2
    return min(losses, key=losses.get)


def _curve(best: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic curve of the texts' best decisions, clean ones weighted more, by Newton steps."""
    x = np.stack([best, np.ones(len(best))], 1)
    target = np.where(toxic, (toxic.sum() + 1) / (toxic.sum() + 2), 1 / ((~toxic).sum() + 2))
    weight = np.where(toxic, (1 - CLEAN_SHARE) / toxic.sum(), CLEAN_SHARE / (~toxic).sum())
    u = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ u, -30, 30)))
        slope = x.T @ (weight * (p - target)) + 1e-4 * u
        u -= np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + 1e-4 * np.eye(2), slope)
    return float(u[0]), float(u[1])


def _spoilt(table: Sightings, at: np.ndarray, rng) -> Sightings:
    """Copies of the strings ``at``, each with a random letter put in between its letters."""
    size = np.diff(table.bounds)[at]
    strings = [table.letters[table.bounds[i] : table.bounds[i + 1]] for i in at]
    where, which = rng.integers(1, size), rng.integers(0, 26, len(at))
    letters = [np.insert(s, p, x) for s, p, x in zip(strings, where, which, strict=True)]
    none = np.zeros(0, np.int64)
    flat = np.concatenate(letters) if letters else np.zeros(0, np.uint8)
    return Sightings(flat, np.concatenate([[0], np.cumsum(size + 1)]), np.zeros(len(at), np.uint64), none, none)


def _best(table: Sightings, found: np.ndarray, texts: int, lowest: float) -> np.ndarray:
    best = np.full(texts, lowest)
    np.maximum.at(best, table.owner, found[table.place])
    return best


def _sentences(texts: list[str], labels: list[int]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct sentences, whether each is in toxic texts only, and the (text, sentence) pairs."""
    seen: dict[str, int] = {}
    clean, pairs = [], []
    for i, (text, label) in enumerate(zip(texts, labels, strict=True)):
        for sentence in _END.split(text):
            at = seen.setdefault(sentence, len(seen))
            if at == len(clean):
                clean.append(False)
            clean[at] |= not label
            pairs.append((i, at))
    return list(seen), ~np.array(clean, bool), np.array(pairs, np.int64).reshape(-1, 2)


def fit(texts: list[str], labels: list[int], landmarks: int = LANDMARKS) -> Machine:
    """A machine fitted on the sentences of labelled texts, all of whose sightings are seen.

    A sentence counts once, however many texts repeat it, and as clean if a clean text has
    it. With labels of one kind only, every text gets that label; without texts, label 0.
    """
    toxic = np.array(labels, bool)
    if not toxic.any() or toxic.all():
        return Machine(np.zeros(_SYMBOLS**3), 0.0, 0.0, 5.0 if len(toxic) and toxic.all() else -5.0)
    sentences, suspect, held = _sentences(texts, labels)
    table = sightings(pa.array(sentences, pa.large_string()))
    kinds = len(table.keys)
    if not kinds or not suspect.any():
        return Machine(np.zeros(_SYMBOLS**3), 0.0, 0.0, float(np.log(toxic.mean() / (1 - toxic.mean()))))
    pairs = np.unique(table.owner * kinds + table.place)
    of_sentence, of_kind = pairs // kinds, pairs % kinds
    in_toxic = np.bincount(of_kind, suspect[of_sentence], kinds)
    in_clean = np.bincount(of_kind, ~suspect[of_sentence], kinds)
    # The sightings of each toxic text in its suspect sentences.
    order = np.argsort(table.owner, kind="stable")
    bounds = np.searchsorted(table.owner[order], np.arange(len(sentences) + 1))
    mine = held[toxic[held[:, 0]] & suspect[held[:, 1]]]
    many = bounds[mine[:, 1] + 1] - bounds[mine[:, 1]]
    inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(bounds[mine[:, 1]], many)
    bag, bag_kind = np.repeat(mine[:, 0], many), table.place[order][inside]
    rng = np.random.default_rng(7)
    # At first, what suspect sentences hold more often than clean ones speaks for them.
    n_toxic, n_clean = suspect.sum(), max((~suspect).sum(), 1)
    odds = np.log((in_toxic + 0.1) / (n_toxic + 1)) - np.log((in_clean + 0.1) / (n_clean + 1))
    spread = np.sqrt(np.maximum((in_toxic + in_clean) * n_toxic * n_clean, 1))
    lifted = in_toxic * n_clean > LIFT * in_clean * n_toxic
    certain = np.flatnonzero(lifted & (in_toxic * n_clean - in_clean * n_toxic > CERTAIN * spread))
    spoilt = _spoilt(table, np.repeat(certain, SPOILT), rng)
    hard, found = np.zeros(0, np.int64), np.zeros(kinds)
    for _ in range(ROUNDS):
        # Later the decisions help to tell rare insults from other rare sightings.
        for_count = np.bincount(_speaking(bag, bag_kind, odds + found, in_clean), minlength=kinds)
        for_count[certain] = np.maximum(for_count, in_toxic.astype(int))[certain]
        speaking = np.flatnonzero(for_count)
        clean = np.flatnonzero(in_clean > 0)
        drawn = rng.choice(clean, min(len(clean), AGAINST), replace=False, p=in_clean[clean] / in_clean.sum())
        against = np.setdiff1d(np.union1d(drawn, hard), speaking)
        chosen = np.concatenate([
            speaking[np.argsort(-for_count[speaking], kind="stable")][: landmarks // 2],
            rng.permutation(against)[: landmarks - min(landmarks // 2, len(speaking))],
        ])
        rows = _dense(table, chosen)
        values, vectors = np.linalg.eigh((rows @ rows.T).astype(float))
        kept = values > 1e-6 * values.max()
        project = vectors[:, kept] / np.sqrt(values[kept])
        at = np.concatenate([speaking, against])
        z = np.concatenate([_kernel(table, at, rows), _kernel(spoilt, np.arange(len(spoilt.keys)), rows)]) @ project
        y = np.concatenate([np.ones(len(speaking)), -np.ones(len(against)), np.ones(len(spoilt.keys))])
        weight = np.concatenate([
            _shares(np.sqrt(for_count[speaking])), _shares(np.sqrt(in_clean[against])),
            SPOILT_SHARE * _shares(np.ones(len(spoilt.keys))),
        ])
        direction, bias = _machine(z, y, weight)
        machine = Machine(((project @ direction) @ rows).astype(np.float64), float(bias), 1.0, 0.0)
        found = decisions(table, machine)
        wrong = np.flatnonzero((in_clean > 0) & (found > -0.5))
        hard = np.union1d(hard, wrong[np.argsort(-found[wrong], kind="stable")][:AGAINST])
    of_each = _best(table, found, len(sentences), float(found.min()))
    best = np.full(len(texts), float(found.min()))
    np.maximum.at(best, held[:, 0], of_each[held[:, 1]])
    return machine._replace(**dict(zip(("slope", "shift"), _curve(best, toxic), strict=True)))


def _speaking(bag: np.ndarray, kind: np.ndarray, odds: np.ndarray, in_clean: np.ndarray) -> np.ndarray:
    """For each toxic text, its sighting of the highest odds (ties to the rarer in clean sentences)."""
    order = np.lexsort((kind, in_clean[kind], -odds[kind], bag))
    bag, kind = bag[order], kind[order]
    first = np.ones(len(bag), bool)
    first[1:] = bag[1:] != bag[:-1]
    return kind[first]


def _scored(shared):
    """Score of each text; decisions on strings seen before are kept, up to ``CACHE`` strings."""

    def run(batches):
        machine: Machine = shared.value
        keys, known = np.zeros(0, np.uint64), np.zeros(0)
        for batch in batches:
            for begin, texts in w.pieces(batch.column("text"), 1 << 20):
                table = sightings(texts)
                at = np.minimum(np.searchsorted(keys, table.keys), max(len(keys) - 1, 0))
                seen = keys[at] == table.keys if len(keys) else np.zeros(len(table.keys), bool)
                found = np.empty(len(table.keys))
                found[seen] = known[at[seen]]
                fresh = np.flatnonzero(~seen)
                found[fresh] = decisions(_part(table, fresh), machine)
                if len(keys) + len(fresh) > CACHE:
                    keys, known = table.keys, found
                else:
                    keys, known = np.concatenate([keys, table.keys[fresh]]), np.concatenate([known, found[fresh]])
                    order = np.argsort(keys, kind="stable")
                    keys, known = keys[order], known[order]
                best = _best(table, found, len(texts), -1.0)
                score = 1 / (1 + np.exp(-np.clip(machine.slope * best + machine.shift, -30, 30)))
                part = batch.slice(begin, len(texts))
                out = {name: part.column(name) for name in part.schema.names if name != "text"}
                out["score"] = pa.array(score)
                out["predicted"] = pa.array((score >= 0.5).astype(np.int32))
                yield pa.RecordBatch.from_pydict(out)

    return run


def held_out(ident: Column, parts: int = 5, part: int = 0) -> Column:
    digits = F.coalesce(ident.cast("string"), F.lit("")).cast("binary")
    return F.crc32(digits) % parts == part


def training_sample(
    df: DataFrame, labels: DataFrame, docs_per_class: int, id_column: str, text_column: str, label_column: str
) -> DataFrame:
    """``text, toxic``: some ``docs_per_class`` labelled texts of each kind, drawn by a hash of the id."""
    ident = column(id_column)
    known = labels.filter(~held_out(ident) & ident.isNotNull() & column(label_column).isNotNull())
    known = known.groupBy(ident.alias("id")).agg(F.max(column(label_column) > 0).alias("toxic"))
    known = materialize(known.withColumn("draw", F.pmod(F.xxhash64("id"), F.lit(1_000_000))), "labels")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic"), sizes.get(True, 0)).otherwise(sizes.get(False, 0))
    # About docs_per_class ids of each kind, so few that they are broadcast.
    drawn = known.filter(F.col("draw") * share <= 1_000_000 * docs_per_class).select("id", "toxic")
    rows = df.filter(F.length(column(text_column)) <= SAMPLE_CHARS).select(ident.alias("id"), column(text_column).alias("text"))
    return rows.join(F.broadcast(drawn), "id").select("text", "toxic")


def score_toxicity(
    df: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    docs_per_class: int = DOCS_PER_CLASS,
    landmarks: int = LANDMARKS,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``df``, on its whole text.

    Learned from labels (above 0 is toxic, any toxic row of an id counts) of ids that are not held
    out, on texts of up to ``SAMPLE_CHARS``; a score sees the text alone. Null and empty
    texts and texts without words of three letters get the lowest score. Null ids and labels
    teach nothing; repeated rows are scored each; an empty table gives no rows. Labels of
    one kind give that kind to all texts, no labels give 0.
    """
    sample = training_sample(df, labels, docs_per_class, id_column, text_column, label_column)
    found = sample.orderBy(F.xxhash64("text"), "text", "toxic").toArrow()
    machine = fit(found.column("text").to_pylist(), found.column("toxic").to_pylist(), landmarks)
    rows = df.select(
        column(id_column).alias("doc_id"), held_out(column(id_column)).alias("held_out"), column(text_column).alias("text")
    )
    kind = dict(rows.dtypes)["doc_id"]
    shared = df.sparkSession.sparkContext.broadcast(machine)  # one number for each of 2**15 triples
    return rows.mapInArrow(_scored(shared), f"doc_id {kind}, held_out boolean, score double, predicted int")
