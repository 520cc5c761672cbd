"""Languages of words and texts by a linear-chain conditional random field.

A word's features are its affixes and inner byte n-grams (hashed) and its entry in a
lexicon of training words; transitions between the languages of neighbouring words are
learned with them. Forward-backward gives every word of a text a distribution over the
languages, also where languages are mixed; a text's language is the one with the largest
share of its words.

The field is fitted on a bounded sample of labelled rows: at most ``docs_per_language`` rows
of each of the ``MAX_LANGUAGES`` most frequent labels, by a hash of the id, of texts up to
``SAMPLE_CHARS``; rarer labels are not learned. The sampled texts are cut into short spans and spliced in random order, so that the transitions see changes of language.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm import words as w
from corpusmill.llm.common import column
from corpusmill.session import materialize

DOCS_PER_LANGUAGE = 200
MAX_LANGUAGES = 200
SAMPLE_CHARS = 20_000
SEQUENCE = 64
SPAN = (4, 16)
GRAMS = (2, 3, 4)
TABLE_BITS = 17
LEXICON_COUNT = 3
ROUNDS, RATE, DECAY = 40, 0.15, 1e-3
UNKNOWN = "und"
FIELD_BYTES = 1 << 20  # of text looked at together: features take some hundred bytes a letter
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


class Field(NamedTuple):
    """A fitted field; scores are natural logarithms of potentials."""

    languages: list[str]
    grams: np.ndarray
    lexicon: np.ndarray  # sorted word hashes
    entries: np.ndarray
    steps: np.ndarray
    first: np.ndarray


def held_out(ident: Column, parts: int = 4, part: int = 2) -> Column:
    digits = F.coalesce(ident.cast("string"), F.lit("")).cast("binary")
    return F.crc32(digits) % parts == part


class _Distinct(NamedTuple):
    """The distinct words of some texts, with their features."""

    hashes: np.ndarray
    at: np.ndarray  # of each word, its place among the distinct ones
    letters: np.ndarray
    owner: np.ndarray  # of each n-gram, the distinct word
    grams: np.ndarray


def _distinct(table: w.Words) -> _Distinct:
    hashes, first, at = np.unique(table.hashes, return_index=True, return_inverse=True)
    starts, lengths = table.starts[first], table.ends[first] - table.starts[first]
    # Words side by side, each between a start and an end mark, which make affixes of n-grams.
    wide = lengths + 2
    begin = np.cumsum(wide) - wide
    word = np.repeat(np.arange(len(hashes)), wide)
    inside = np.arange(wide.sum()) - begin[word]
    source = np.clip(starts[word] + inside - 1, 0, max(len(table.data) - 1, 0))
    text = w._FOLD[table.data[source]].astype(np.uint32)
    text[begin] = 1
    text[begin + wide - 1] = 2
    letters = np.zeros(len(hashes), bool)
    letters[word[_LETTER[text.astype(np.uint8)]]] = True
    owners, grams = [], []
    for n in GRAMS:
        code = np.zeros(max(len(text) - n + 1, 0), np.uint32)
        for i in range(n):
            code = code * np.uint32(257) + text[i : i + len(code)]
        fits = wide[word[: len(code)]] - inside[: len(code)] >= n
        owners.append(word[: len(code)][fits])
        code = (code[fits] + np.uint32(n * 0x3C6EF372 % 2**32)) * np.uint32(0x9E3779B1)
        grams.append(((code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - TABLE_BITS))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return _Distinct(hashes, at, letters, owner[order], np.concatenate(grams)[order])


def _word_scores(own: _Distinct, grams: np.ndarray, place: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Score of each distinct word for each language; words without letters say nothing."""
    scores = np.add.reduceat(grams[own.grams], np.searchsorted(own.owner, np.arange(len(own.hashes)))) if len(own.hashes) else np.zeros((0, grams.shape[1]))
    known = place >= 0
    scores[known] += entries[place[known]]
    scores[~own.letters] = 0
    return scores


def _find(lexicon: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(lexicon):
        return np.full(len(hashes), -1)
    place = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return np.where(lexicon[place] == hashes, place, -1)


def _padded(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts cut into sequences: positions of their words (0 beyond the end), and lengths."""
    counts = np.diff(bounds)
    parts = -(-counts // SEQUENCE)
    text = np.repeat(np.arange(len(counts)), parts)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = bounds[:-1][text] + nth * SEQUENCE
    lengths = np.minimum(SEQUENCE, bounds[1:][text] - begin)
    steps = np.arange(SEQUENCE)
    return np.where(steps < lengths[:, None], begin[:, None] + steps, 0), lengths


def _marginals(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray, first: np.ndarray):
    """Forward-backward over padded sequences ``(sequence, step, language)``.

    Gives each word's distribution, the expected transitions summed over all sequences,
    and the distributions of first words summed.
    """
    e = np.exp(scores - scores.max(2, keepdims=True))
    move, start = np.exp(steps), np.exp(first)
    n, longest, k = e.shape
    ahead, back = np.empty_like(e), np.empty_like(e)
    a = start * e[:, 0]
    ahead[:, 0] = a / a.sum(1, keepdims=True)
    for t in range(1, longest):
        a = (ahead[:, t - 1] @ move) * e[:, t]
        ahead[:, t] = a / a.sum(1, keepdims=True)
    back[:, -1] = 1 / k
    pairs = np.zeros_like(move)
    for t in range(longest - 2, -1, -1):
        later = e[:, t + 1] * back[:, t + 1]
        inside = (t + 1 < lengths)[:, None]
        b = np.where(inside, later @ move.T, 1.0)
        back[:, t] = b / b.sum(1, keepdims=True)
        norm = ((ahead[:, t] @ move) * later).sum(1, keepdims=True)
        pairs += np.where(inside, ahead[:, t] / norm, 0).T @ later
    each = ahead * back
    each /= each.sum(2, keepdims=True)
    return each, pairs * move, each[:, 0].sum(0)


def _chained(scores: np.ndarray, bounds: np.ndarray, steps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Forward-backward over whole texts: the distribution of each word, text ``i`` at ``bounds[i]:bounds[i + 1]``.

    Each step takes the next word of all texts that are long enough, the longest first.
    """
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    begin = bounds[:-1][order]
    active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(lengths.max(initial=0) + 1), "right")
    e = np.exp(scores - scores.max(1, keepdims=True))
    move, start = np.exp(steps), np.exp(first)
    ahead, back = np.empty_like(e), np.full_like(e, 1 / max(e.shape[1], 1))
    for t in range(len(active) - 1):
        at = begin[: active[t]] + t
        a = ((ahead[at - 1] @ move) if t else start) * e[at]
        ahead[at] = a / a.sum(1, keepdims=True)
    for t in range(len(active) - 3, -1, -1):
        at = begin[: active[t + 1]] + t
        b = (e[at + 1] * back[at + 1]) @ move.T
        back[at] = b / b.sum(1, keepdims=True)
    each = ahead * back
    return each / each.sum(1, keepdims=True)


def _spliced(texts: list[str], labels: list[int]) -> tuple[list[str], list[np.ndarray]]:
    """Training sequences: spans of all sampled texts, in random order, one after the other."""
    rng = np.random.default_rng(17)
    spans = []
    for text, label in zip(texts, labels, strict=True):
        own, i = text.encode().split(), 0
        while i < len(own):
            n = int(rng.integers(*SPAN))
            spans.append((own[i : i + n], label))
            i += n
    spans = [spans[i] for i in rng.permutation(len(spans))]
    flat = [x for span, _ in spans for x in span]
    gold = np.repeat([label for _, label in spans], [len(span) for span, _ in spans]).astype(np.int64)
    cuts = range(0, len(flat), SEQUENCE)
    return [b" ".join(flat[i : i + SEQUENCE]).decode() for i in cuts], [gold[i : i + SEQUENCE] for i in cuts]


def fit(texts: list[str], labels: list[str]) -> Field:
    """A field fitted by gradient steps on the conditional likelihood of spliced sequences.

    Languages are the labels in code-point order. With one language every word is in it.
    """
    languages = sorted(set(labels))
    k = len(languages)
    sequences, gold = _spliced(texts, [languages.index(x) for x in labels])
    table = w.words(pa.array(sequences, pa.string()), fold=True)
    if not len(table.hashes):
        empty = np.zeros((0, k))
        return Field(languages, np.zeros((1 << TABLE_BITS, k), np.float32), np.zeros(0, np.uint64), empty, np.zeros((k, k)), np.zeros(k))
    own = _distinct(table)
    counts = np.bincount(own.at)
    lexicon = own.hashes[counts >= LEXICON_COUNT]
    place = _find(lexicon, own.hashes)
    known = np.flatnonzero(place >= 0)
    positions, lengths = _padded(table.bounds)
    real = np.arange(SEQUENCE) < lengths[:, None]
    truth = np.concatenate(gold)
    hot = np.zeros((len(truth), k))
    hot[np.arange(len(truth)), truth] = 1
    follows = np.ones(len(truth) - 1, bool)
    follows[table.bounds[1:-1] - 1] = False
    seen_steps = np.zeros((k, k))
    np.add.at(seen_steps, (truth[:-1][follows], truth[1:][follows]), 1)
    seen_first = np.bincount(truth[table.bounds[:-1]], minlength=k)

    weights = {
        "grams": np.zeros((1 << TABLE_BITS, k)), "entries": np.zeros((len(lexicon), k)),
        "steps": np.zeros((k, k)), "first": np.zeros(k),
    }
    mean = {name: np.zeros_like(v) for name, v in weights.items()}
    square = {name: np.zeros_like(v) for name, v in weights.items()}
    for number in range(1, ROUNDS + 1):
        scores = _word_scores(own, weights["grams"], place, weights["entries"])
        each, steps, first = _marginals(scores[own.at][positions], lengths, weights["steps"], weights["first"])
        off = hot - each[real]
        by_word = np.stack([np.bincount(own.at, off[:, c], len(own.hashes)) for c in range(k)], 1)
        by_word[~own.letters] = 0
        slopes = {
            "grams": np.stack([np.bincount(own.grams, by_word[own.owner, c], 1 << TABLE_BITS) for c in range(k)], 1),
            "entries": by_word[known],
            "steps": seen_steps - steps,
            "first": seen_first - first,
        }
        for name, slope in slopes.items():  # Adam
            slope = slope / len(truth) - DECAY * weights[name] / len(truth)
            mean[name] = 0.9 * mean[name] + 0.1 * slope
            square[name] = 0.99 * square[name] + 0.01 * slope**2
            size = np.sqrt(square[name] / (1 - 0.99**number)) + 1e-8
            weights[name] += RATE * mean[name] / (1 - 0.9**number) / size
    return Field(
        languages, weights["grams"].astype(np.float32), lexicon, weights["entries"].astype(np.float32),
        weights["steps"].astype(np.float32), weights["first"].astype(np.float32),
    )


def _texts_without_letters(texts: pa.Array, table: w.Words) -> np.ndarray:
    """Texts in which no character is a letter."""
    plain = np.concatenate([[0], np.cumsum(_LETTER[table.data] & (table.data < 128))])
    high = np.concatenate([[0], np.cumsum(table.data >= 128)])
    ends = np.cumsum([0, *(len(t.as_buffer()) if t.is_valid else 0 for t in texts.cast(pa.large_binary()))])
    none = plain[ends[1:]] == plain[ends[:-1]]
    for i in np.flatnonzero(none & (high[ends[1:]] > high[ends[:-1]])):
        none[i] = not any(c.isalpha() for c in texts[i].as_py())
    return none


def _predicted(shared, labels: bool, certainty: bool = False):
    def run(batches):
        field: Field = shared.value
        k = len(field.languages)
        names = np.array([*field.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for begin, texts in w.pieces(batch.column("text"), FIELD_BYTES):
                table = w.words(texts, fold=True)
                part = batch.slice(begin, len(texts))
                share = np.zeros((len(texts), k))
                spoken, sure = np.zeros(len(texts)), np.zeros(len(texts))
                by_word = np.full(len(table.hashes), k)
                if k and len(table.hashes):
                    own = _distinct(table)
                    scores = _word_scores(own, field.grams, _find(field.lexicon, own.hashes), field.entries)
                    flat = _chained(scores.astype(np.float32)[own.at], table.bounds, field.steps, field.first)
                    lettered = own.letters[own.at]
                    by_word[lettered] = flat[lettered].argmax(1)
                    owner = table.owners[lettered]
                    spoken = np.bincount(owner, minlength=len(texts))
                    sure = np.bincount(owner, flat[lettered].max(1), len(texts))
                    share = np.stack([np.bincount(owner, flat[lettered, c], len(texts)) for c in range(k)], 1)
                best = share.argmax(1) if k else np.zeros(len(texts), int)
                mute = _texts_without_letters(texts, table) | (spoken == 0)
                top = share[np.arange(len(texts)), best] if k else np.zeros(len(texts))
                score = np.where(mute, 0.0, np.clip(top / np.maximum(spoken, 1), 0, 1))
                out = {name: part.column(name) for name in part.schema.names if name != "text"}
                out["lang_pred"] = pa.array(np.where(mute, UNKNOWN, names[best]), pa.string())
                out["score"] = pa.array(score)
                if certainty:
                    out["certainty"] = pa.array(np.where(mute, 0.0, np.clip(sure / np.maximum(spoken, 1), 0, 1)))
                if labels:
                    out["word_langs"] = pa.ListArray.from_arrays(pa.array(table.bounds.astype(np.int32)), pa.array(names[by_word], pa.string()))
                yield pa.RecordBatch.from_pydict(out)

    return run


def _identified(shared, min_score: float, at: int):
    """The rows whose text, the column at ``at``, is certain enough."""

    def run(batches):
        certainty = _predicted(shared, False, certainty=True)
        for batch in batches:
            parts = certainty([pa.RecordBatch.from_arrays([batch.column(at)], names=["text"])])
            sure = [pc.greater_equal(part.column("certainty"), min_score) for part in parts]
            if sure:
                yield batch.filter(pa.concat_arrays(sure))

    return run


def training_sample(
    df: DataFrame, learn: Column, docs_per_language: int, id_column: str, text_column: str, lang_column: str
) -> DataFrame:
    """``text, lang`` of at most ``docs_per_language`` labelled rows of each language, by a hash of the id."""
    rows = df.filter(learn & column(lang_column).isNotNull() & (F.length(column(text_column)) <= SAMPLE_CHARS))
    rows = rows.select(
        column(lang_column).alias("lang"), column(text_column).alias("text"),
        F.pmod(F.xxhash64(column(id_column)), F.lit(1_000_000)).alias("draw"), column(id_column).alias("id"),
    )
    sizes = materialize(rows.groupBy("lang").agg(F.count("*").alias("rows")), "labels")
    sizes = sizes.orderBy(F.desc("rows"), "lang").limit(MAX_LANGUAGES)
    # Twice the rows wanted are drawn by hash, so that only few are sorted.
    drawn = rows.join(F.broadcast(sizes), "lang").filter(F.col("draw") * F.col("rows") <= 2_000_000 * docs_per_language)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id", "text"))
    return drawn.withColumn("nth", nth).filter(F.col("nth") <= docs_per_language).select("text", "lang")


def predict_languages(
    df: DataFrame,
    held: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE,
    word_labels: bool = False,
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``df``, on its whole text.

    Learned from text and non-null language of rows that ``held`` does not hold out; a
    prediction sees the text alone. ``lang_pred`` is ``und`` with score 0 for texts that are
    null or have no letter, and for all texts if nothing could be learned. ``score`` is the
    share of the language among the words that have letters. ``word_labels`` adds
    ``word_langs``, the language of each word (``und`` without letters). Null ids and
    languages, repeated rows and texts of any length are fine; an empty table gives no rows.
    """
    chosen = F.coalesce(held_out(column(id_column)) if held is None else held, F.lit(False))
    field = _fitted(df, ~chosen, docs_per_language, id_column, text_column, lang_column)
    rows = df.select(column(id_column).alias("doc_id"), chosen.alias("held_out"), column(text_column).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    extra = ", word_langs array<string>" if word_labels else ""
    shared = df.sparkSession.sparkContext.broadcast(field)  # as large as the bounded sample allows
    return rows.mapInArrow(
        _predicted(shared, word_labels), f"doc_id {kind}, held_out boolean, lang_pred string, score double{extra}"
    )


def _fitted(df, learn, docs_per_language, id_column, text_column, lang_column) -> Field:
    sample = training_sample(df, learn, docs_per_language, id_column, text_column, lang_column)
    found = sample.orderBy("lang", F.xxhash64("text"), "text").toArrow()
    return fit(found.column("text").to_pylist(), found.column("lang").to_pylist())


def keep_identified(
    df: DataFrame,
    min_score: float = 0.4,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE,
) -> DataFrame:
    """The rows, with all columns, whose words have a language with a certainty of ``min_score``.

    A text's certainty is the mean, over its words that have letters, of the largest
    probability of a language. It is no share: a text of several languages is as certain as
    its words are. Texts that are null or have no letter have none and are left out. All
    rows are kept if nothing could be learned. Decided where the rows are read, without a shuffle.
    """
    field = _fitted(df, ~held_out(column(id_column)), docs_per_language, id_column, text_column, lang_column)
    if len(field.languages) != 1 and not field.grams.any():
        return df
    shared = df.sparkSession.sparkContext.broadcast(field)
    return df.mapInArrow(_identified(shared, min_score, df.columns.index(text_column)), df.schema)
