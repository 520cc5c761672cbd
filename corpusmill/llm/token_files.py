"""Token ids as flat unsigned integer files with 64-bit document offsets.

Documents are sorted by id into ranges. Each range is one part of three headerless
little-endian files: the ids of its tokens, the offset of each document among them (and
the end), and the document ids. A manifest row per part holds its base among all tokens,
a prefix sum of the parts' totals, so parts are written without knowing one another.
Readers map the files into memory and touch only the documents they are asked for.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import column

# The splitting pattern of byte-level vocabularies of this kind.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Spaces and what follows them: no piece of the pattern above reaches across such a cut.
# The separators x1C-x1F count as spaces in Python only.
CHUNK = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
NULL_ID = -(2**63)
DTYPES = {"uint16": "H", "uint32": "I"}
_CACHED, _CACHED_CHARS = 1_500_000, 64
# Characters of the texts that are looked up at once; a longer text is encoded by itself.
_PIECE_CHARS = 1 << 18
# Chunks in a table of ids, their bytes in 64-bit numbers, and the lowest bytes of such a number.
_KEPT, _KEYS = 1_000_000, 3
_LOWEST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
# All spaces of Unicode but the blank and the line feed.
_ODD_SPACES = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_RUNS = ("  ", " \n", "\n ", "\n\n", *_ODD_SPACES)
_ASCII_RUNS = tuple(run for run in _RUNS if run.isascii())
_MARKS = ".,;:!?"
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[65:91] = _IS_LETTER[97:123] = True
# What a vocabulary file says when PIECES is its pattern and nothing else is done to a text.
_USUAL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
_encoders: dict[tuple[str, str, bool], _Encoder] = {}


def has_runs(text: str) -> bool:
    """Whether a text has spaces at its ends, beside one another, or others than blanks and line feeds."""
    runs = _ASCII_RUNS if text.isascii() else _RUNS
    return text[0].isspace() or text[-1].isspace() or any(run in text for run in runs)


def _byte_letters() -> str:
    """The printable characters that byte-level vocabularies use for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    letters = dict(zip(plain, plain, strict=True)) | {b: 256 + i for i, b in enumerate(others)}
    return "".join(chr(letters[b]) for b in range(256))


def _disputed() -> re.Pattern:
    """Characters that versions of Unicode may put into different classes of ``PIECES``.

    Those of one class in Unicode 3.2 and in Python's version are in that class in the
    versions between, which the library and ``regex`` have; all others are disputed.
    """
    kind = lambda data, c: "S" if c.isspace() else data.category(c)[0] if data.category(c)[0] in "LN" else data.category(c) == "Cn"
    old, flags, points = unicodedata.ucd_3_2_0, bytearray(0x110000), range(128, 0x110000)
    for point, before, now in zip(points, *(map(data.category, map(chr, points)) for data in (old, unicodedata))):
        if before == "Cn" or before != now and kind(old, chr(point)) != kind(unicodedata, chr(point)):
            flags[point] = 1
    ranges = [(found.start(), found.end() - 1) for found in re.finditer(b"\1+", flags)]
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]")


class _Chunks(dict):
    """Ids of chunks that follow ``lead``, as bytes; a bounded number of short ones is kept."""

    def __init__(self, encoder: _Encoder, lead: str):
        self.pieces, self.word, self.lead = encoder.pieces, encoder.word, lead
        self.marks = {m: encoder.pieces(m) for m in _MARKS}
        self.encoder = encoder
        self.code, self.tokenize = encoder.code, encoder.model.tokenize
        self.letter = encoder.blank if lead == " " else lead

    def __missing__(self, chunk: str) -> bytes:
        encoded = self.encoded(chunk)
        if len(chunk) <= _CACHED_CHARS:
            if len(self) >= _CACHED:
                self.clear()
            self[chunk] = encoded
        return encoded

    def encoded(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():  # most words
            return array(self.code, [t.id for t in self.tokenize(self.letter + chunk)]).tobytes()
        mark = self.marks.get(chunk[-1:])
        if not chunk.isascii() and self.encoder.is_disputed(chunk):
            return self.encoder.library(self.lead + chunk)
        if mark is not None and chunk[:-1].isalpha():  # a word and the mark after it never merge
            return self[chunk[:-1]] + mark
        return (self.word if chunk.isalpha() else self.pieces)(self.lead + chunk)


class _Table:
    """Ids of chunks of up to ``8 * _KEYS`` bytes, looked up many at a time.

    The bytes of a chunk are its key, so nothing rests on hashes being different. A bounded
    number of chunks is kept.
    """

    def __init__(self, dtype: str):
        self.ids = np.zeros(1 << 12, dtype)
        self.clear()

    def clear(self, room: int = 1 << 10) -> None:
        """Forget all chunks; there is room for ``room`` of them, a power of 2, until it is made larger."""
        self.count, self.used = 0, 0
        self.keys = [np.zeros(room, np.uint64) for _ in range(_KEYS)]
        self.firsts, self.sizes = np.zeros(room, np.int64), np.zeros(room, np.int64)
        self._make_slots()

    def _make_slots(self) -> None:
        bits = len(self.firsts).bit_length()  # at most half of the slots are taken
        self.shift, self.slots = np.uint64(64 - bits), np.full(1 << bits, -1, np.int32)

    def _slot(self, keys: list[np.ndarray]) -> np.ndarray:
        mixed = keys[0] * _FACTORS[0]
        for key, factor in zip(keys[1:], _FACTORS[1:]):
            mixed ^= mixed >> np.uint64(32)
            mixed = (mixed + key) * factor
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * _FACTORS[0]) >> self.shift).astype(np.int64)

    def find(self, keys: list[np.ndarray]) -> np.ndarray:
        """Number of each chunk, -1 for those that are not kept."""
        slots = self._slot(keys)
        found = self.slots.take(slots)
        left = np.flatnonzero(found >= 0)
        at = found.take(left)
        while left.size:
            other = self.keys[0].take(at) != keys[0].take(left)
            for own, key in zip(self.keys[1:], keys[1:]):
                other |= own.take(at) != key.take(left)
            left = left[other]
            slots[left] = after = (slots.take(left) + 1) & (len(self.slots) - 1)
            found[left] = at = self.slots.take(after)
            left, at = left[at >= 0], at[at >= 0]
        return found

    def _place(self, first: int) -> None:
        """Give a slot to each chunk from number ``first`` on."""
        numbers = np.arange(first, self.count, dtype=np.int32)
        slots = self._slot([key[first : self.count] for key in self.keys])
        while numbers.size:
            free = self.slots[slots] < 0
            self.slots[slots[free]] = numbers[free]
            homeless = self.slots[slots] != numbers
            numbers, slots = numbers[homeless], (slots[homeless] + 1) & (len(self.slots) - 1)

    def hold(self, encoded: bytes) -> None:
        """Put ids behind those of the chunks that are kept; they stay if :meth:`add` says so."""
        new = np.frombuffer(encoded, self.ids.dtype)
        if self.used + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(new)), self.ids.dtype)])
        self.ids[self.used : self.used + len(new)] = new

    def add(self, keys: list[np.ndarray], firsts: np.ndarray, sizes: np.ndarray) -> None:
        """Keep distinct chunks that were not found; their ids are held already."""
        first, self.count = self.count, self.count + len(firsts)
        grown = self.count > len(self.firsts)
        if grown:
            more = np.zeros((1 << self.count.bit_length()) - len(self.firsts), np.int64)
            self.keys = [np.concatenate([key, more.view(np.uint64)]) for key in self.keys]
            self.firsts, self.sizes = np.concatenate([self.firsts, more]), np.concatenate([self.sizes, more])
            self._make_slots()
        for own, new in zip((*self.keys, self.firsts, self.sizes), (*keys, firsts, sizes)):
            own[first : self.count] = new
        self.used = int(firsts[-1] + sizes[-1])
        self._place(0 if grown else first)


class _Encoder:
    def __init__(self, path: str, dtype: str, encode_special_tokens: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = encode_special_tokens
        self.model, self.code = self.tokenizer.model, DTYPES[dtype]
        whole = json.loads(self.tokenizer.to_str())
        pattern, model = whole["pre_tokenizer"] or {}, whole["model"]
        usual = {k: v for k, v in pattern.items() if k in _USUAL} == _USUAL and whole["normalizer"] is None
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
        # Another pattern, normaliser or model leaves the cutting to the library.
        self.usual = usual and model["type"] == "BPE" and not odd
        self.disputed, self.undisputed = _disputed(), set(map(chr, range(128)))
        self.split, self.letters = regex.compile(PIECES).findall, _byte_letters()
        self.blank = self.letters[32]
        self.after_blank, self.at_start, self.others = _Chunks(self, " "), _Chunks(self, ""), _Chunks(self, "")
        self.line_end = self.pieces("\n")
        self.table = _Table("<u2" if dtype == "uint16" else "<u4")
        self.is_mark, self.mark_ids = np.zeros(256, bool), np.zeros(256, self.table.ids.dtype)
        for mark, encoded in self.after_blank.marks.items():
            if len(encoded) == self.mark_ids.itemsize:
                self.is_mark[ord(mark)], self.mark_ids[ord(mark)] = True, np.frombuffer(encoded, self.mark_ids.dtype)[0]
        added = self.tokenizer.get_added_tokens_decoder().items()
        found = {t.content: (i, t) for i, t in added if not (t.special and encode_special_tokens)}
        self.added = {name: i for name, (i, _) in found.items()}
        # Of names that begin at one place the library takes the longest.
        longest_first = sorted(map(re.escape, found), key=len, reverse=True)
        self.names = re.compile(f"({'|'.join(longest_first)})") if found else None
        self.plain = not any(t.single_word or t.lstrip or t.rstrip for _, t in found.values())

    def is_disputed(self, chunk: str) -> bool:
        if self.undisputed.issuperset(chunk):
            return False
        if self.disputed.search(chunk):
            return True
        self.undisputed.update(chunk)  # at most the characters of Unicode
        return False

    def spelled(self, piece: str) -> str:
        return codecs.charmap_decode(piece.encode(), "strict", self.letters)[0]

    def word(self, piece: str) -> bytes:
        """Ids of one piece of the pattern."""
        return array(self.code, [t.id for t in self.model.tokenize(self.spelled(piece))]).tobytes()

    def pieces(self, chunk: str) -> bytes:
        ids = array(self.code)
        for piece in self.split(chunk):
            ids.extend([t.id for t in self.model.tokenize(self.spelled(piece))])
        return ids.tobytes()

    def library(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        if not self.usual:
            return self.library(text)
        if not any(name in text for name in self.added):
            return self.ordinary(text)
        if not self.plain:  # names that look at or take what is beside them
            return self.library(text)
        named = lambda name: array(self.code, [self.added[name]]).tobytes()
        return b"".join(named(part) if i % 2 else self.ordinary(part) for i, part in enumerate(self.names.split(text)))

    def ordinary(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if not text:
            return b""
        if has_runs(text):
            return b"".join(map(self.chunk, CHUNK.findall(text)))
        # Blanks and line feeds stand alone here, so the pattern cuts at each of them.
        spaced, lines = self.after_blank.__getitem__, []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            lines.append(self.at_start[first] + b"".join(map(spaced, rest)))
        return self.line_end.join(lines)

    def is_plain(self, text: str) -> bool:
        """Whether single blanks and line feeds are the only spaces and all ids are found by chunk."""
        if not self.usual or len(text) > _PIECE_CHARS or "\0" in text or any(name in text for name in self.added):
            return False
        return not text or not has_runs(text)

    def together(self, texts: list[str], end_id: int) -> tuple[bytes, np.ndarray]:
        """Ids of texts of some ``_PIECE_CHARS`` characters, ``end_id`` after each, and how many each has.

        A chunk here is a blank or line feed, or the zero byte before each text, with what
        follows up to the next; equal chunks have equal ids. A mark at its end after a letter
        is a piece of its own and set apart.
        """
        plain = [self.is_plain(text) for text in texts]
        joined = "\0".join(["", *(text if ok else "" for text, ok in zip(texts, plain)), ""])
        data = joined.encode() + bytes(8 * _KEYS)
        raw = np.frombuffer(data, np.uint8)[: len(data) - 8 * _KEYS]
        starts = np.flatnonzero((raw == 32) | (raw == 10) | (raw == 0))
        lengths = np.diff(starts, append=len(raw))
        last = raw.take(starts + lengths - 1)
        marked = self.is_mark.take(last) & _IS_LETTER.take(raw.take(starts + lengths - 2)) & (lengths > 2)
        lengths -= marked
        keys = []
        for k in range(_KEYS):
            eight = np.ndarray((len(raw),), "<u8", data, 8 * k, (1,))
            keys.append(eight.take(starts) & _LOWEST.take(lengths - 8 * k, mode="clip"))
        firsts, sizes = self.places(data, starts, lengths, keys)
        sizes += marked
        ends = np.cumsum(sizes)
        ids = self.table.ids.take(np.repeat(firsts - ends + sizes, sizes) + np.arange(ends[-1]), mode="clip")
        ids[ends[marked] - 1] = self.mark_ids.take(last[marked])
        borders = np.flatnonzero(raw.take(starts) == 0)
        borders = ends.take(borders) - sizes.take(borders)
        ids[borders] = end_id
        counts = np.diff(borders)
        if all(plain):
            return ids[1:].tobytes(), counts
        parts = []
        for i, text in enumerate(texts):
            if not plain[i]:
                parts.append(self.encode(text))
                counts[i] += len(parts[-1]) // ids.itemsize
            parts.append(ids[borders[i] + 1 : borders[i + 1] + 1].tobytes())
        return b"".join(parts), counts

    def places(self, data: bytes, starts: np.ndarray, lengths: np.ndarray, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Where in the table's ids those of each chunk begin, and how many there are."""
        table = self.table
        if table.count >= _KEPT:
            table.clear()
        found = table.find(keys)
        found[lengths > 8 * _KEYS] = -1  # their keys are cut
        missing = np.flatnonzero(found < 0)
        firsts, sizes = table.firsts.take(found, mode="clip"), table.sizes.take(found, mode="clip")
        if not missing.size:
            return firsts, sizes
        chunks = [data[a : a + n] for a, n in zip(starts.take(missing).tolist(), lengths.take(missing).tolist())]
        # One place where each chunk is; the long ones last, as they are not kept.
        rows = dict(zip(chunks, missing.tolist()))
        new = sorted(rows, key=lambda chunk: len(chunk) > 8 * _KEYS)
        encoded = [self.led(chunk) for chunk in new]
        at = np.array([rows[chunk] for chunk in new])
        sizes[at] = np.array([len(ids) for ids in encoded]) // table.ids.itemsize
        firsts[at] = table.used + np.cumsum(sizes[at]) - sizes[at]
        table.hold(b"".join(encoded))
        same = np.array([rows[chunk] for chunk in chunks])
        firsts[missing], sizes[missing] = firsts[same], sizes[same]
        kept = at[lengths[at] <= 8 * _KEYS]
        if kept.size:
            table.add([key.take(kept) for key in keys], firsts.take(kept), sizes.take(kept))
        return firsts, sizes

    def led(self, chunk: bytes) -> bytes:
        """Ids of a chunk of :meth:`together`; any one stands for the zero byte."""
        lead, word = chunk[0], chunk[1:].decode()
        known = self.after_blank if lead == 32 else self.at_start
        ids = known[word] if len(chunk) > 8 * _KEYS else known.encoded(word) if word else b""
        return {32: b"", 10: self.line_end, 0: bytes(self.table.ids.itemsize)}[lead] + ids

    def chunk(self, chunk: str) -> bytes:
        if chunk[0] == " " and not chunk[1:2].isspace() and len(chunk) > 1:
            return self.after_blank[chunk[1:]]
        return self.others[chunk] if chunk[0].isspace() else self.at_start[chunk]


class ByteLevelEncoder:
    """A function from a text to its ids that may be sent to workers.

    What it loads and remembers belongs to this module, so tasks of one worker share it. (The
    globals of a function sent by value, as one inside a function is, are new for each task.)
    """

    def __init__(self, path: str, dtype: str, encode_special_tokens: bool):
        self.key = (path, dtype, encode_special_tokens)

    def _loaded(self) -> _Encoder:
        if self.key not in _encoders:
            _encoders[self.key] = _Encoder(*self.key)
        return _encoders[self.key]

    def __call__(self, text: str) -> bytes:
        return self._loaded().encode(text)

    def together(self, texts: list[str], end_id: int) -> tuple[bytes, np.ndarray]:
        """Ids of all texts, ``end_id`` after each, and the number of ids of each text and its end."""
        return self._loaded().together(texts, end_id)


def byte_level_encoder(path: str, dtype: str = "uint16", encode_special_tokens: bool = False) -> ByteLevelEncoder:
    """Ids of a text under a byte-level vocabulary file, as little-endian bytes.

    The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``. As in the
    library, ``encode_special_tokens`` reads the names of special tokens as ordinary text;
    without it (the default) each name gives the id of its token. Texts are cut at the
    names of added tokens, and where the vocabulary's own pattern always cuts, so that every
    distinct chunk is encoded once per worker. The library itself encodes chunks with
    characters on whose class versions of Unicode disagree, and whole texts if the
    file has a normaliser, another pattern or another model.
    """
    return ByteLevelEncoder(path, dtype, encode_special_tokens)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def _gathered(texts: pa.Array) -> Iterator[list[str]]:
    """Runs of texts (null: empty) of some ``_PIECE_CHARS`` characters, or of one longer text."""
    piece, held = [], 0
    for value in texts:
        text = value.as_py() or ""
        if piece and held + len(text) > _PIECE_CHARS:
            yield piece
            piece, held = [], 0
        piece.append(text)
        held += len(text) + 1
    if piece:
        yield piece


def _written(batches: Iterator[pa.RecordBatch], folder: str, encode, dtype: str, end_id: int):
    """Write one part from rows in id order; give its manifest row."""
    filesystem, where = _open(folder)
    part = TaskContext.get().partitionId()
    # A repeated task writes other files; only those named in the manifest count.
    name = f"part-{part:06d}-{uuid.uuid4().hex}"
    end = np.array([end_id], "<u2" if dtype == "uint16" else "<u4").tobytes()
    out, docs, tokens = None, 0, 0
    together = getattr(encode, "together", None)
    try:
        for batch in batches:
            if batch.num_rows and out is None:
                filesystem.create_dir(where, recursive=True)
                out = [filesystem.open_output_stream(f"{where}/{name}.{x}") for x in ("ids", "offsets", "docs")]
            if not batch.num_rows:
                continue
            lengths = []
            for texts in _gathered(batch.column("text")):
                if together is None:
                    encoded = [encode(text) + end for text in texts]
                    lengths += [len(ids) // len(end) for ids in encoded]
                    out[0].write(b"".join(encoded))
                else:
                    encoded, counts = together(texts, end_id)
                    lengths += counts.tolist()
                    out[0].write(encoded)
            starts = np.cumsum([tokens, *lengths], dtype="<i8")
            ids = batch.column("id").fill_null(NULL_ID).to_numpy()
            out[1].write(starts[:-1].tobytes())
            out[2].write(ids.astype("<i8").tobytes())
            docs, tokens = docs + len(lengths), int(starts[-1])
        if out is not None:
            out[1].write(np.array([tokens], "<i8").tobytes())
    finally:
        for stream in out or ():
            stream.close()
    if out is not None:
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "file": [name], "n_docs": [docs], "n_tokens": [tokens]}
        )


def write_token_files(
    df: DataFrame,
    path: str,
    encode: Callable[[str], bytes],
    dtype: str = "uint16",
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Write the ids of all texts, each followed by ``end_id``, to the new folder ``path``.

    Documents follow ascending id, null ids first, equal ids by text. Null and empty texts
    are the end id alone; repeated rows are written repeatedly. Texts may be of any length,
    one at a time is held. An empty table gives an empty manifest. A null id is stored as
    the smallest 64-bit number. The folder must be reachable by all workers.
    """
    rows = df.select(column(id_column).cast("bigint").alias("id"), column(text_column).alias("text"))
    ordered = rows.repartitionByRange("id", F.crc32(F.col("text").cast("binary"))).sortWithinPartitions("id", "text")
    ordered.mapInArrow(
        lambda batches: _written(batches, path, encode, dtype, end_id),
        "part int, file string, n_docs bigint, n_tokens bigint",
    ).write.parquet(f"{path}/parts")
    parts = df.sparkSession.read.parquet(f"{path}/parts")
    # One row for each part, as many as shuffle partitions: one task may add them up.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast("bigint")
    bases = parts.withColumns({"doc_base": before("n_docs"), "token_base": before("n_tokens")})
    bases.withColumn("dtype", F.lit(dtype)).coalesce(1).write.parquet(f"{path}/manifest")


def _mapped(path: str, kind: str) -> np.ndarray:
    filesystem, where = _open(path)
    if isinstance(filesystem, fs.LocalFileSystem):
        return np.memmap(where, kind, "r")
    with filesystem.open_input_file(where) as source:  # stores that can't be mapped
        return np.frombuffer(source.read(), kind)


_READ_TOKENS = 1 << 20


def _documents(batches: Iterator[pa.RecordBatch], folder: str, tokens: bool):
    _encoders.clear()  # files are read when they are written: later tasks get the memory back
    for part in (row for batch in batches for row in batch.to_pylist()):
        base = f"{folder}/{part['file']}"
        ids = _mapped(f"{base}.ids", "<u2" if part["dtype"] == "uint16" else "<u4")
        offsets, docs = _mapped(f"{base}.offsets", "<i8"), _mapped(f"{base}.docs", "<i8")
        first = 0
        while first < len(docs):
            last = int(np.searchsorted(offsets, offsets[first] + _READ_TOKENS, "right")) - 1
            last = min(max(last, first + 1), len(docs))
            own = np.asarray(docs[first:last])
            out = {
                "doc_id": pa.array(own, mask=own == NULL_ID),
                "start": pa.array(part["token_base"] + np.asarray(offsets[first:last])),
                "n_tokens": pa.array(np.diff(offsets[first : last + 1])),
            }
            if tokens:
                flat = np.asarray(ids[offsets[first] : offsets[last]]).astype("<i4")
                bounds = (offsets[first : last + 1] - offsets[first]).astype(np.int32)
                out["tokens"] = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
            else:
                wide = memoryview(np.asarray(ids[offsets[first] : offsets[last]]).astype("<u4"))
                cuts = (offsets[first : last + 1] - offsets[first]).tolist()
                out["ids_crc32"] = pa.array([zlib.crc32(wide[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.int64())
            yield pa.RecordBatch.from_pydict(out)
            first = last


def read_token_files(spark: SparkSession, path: str, tokens: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, tokens`` of all documents, read from the files.

    ``start`` counts the ids of all documents before. With ``tokens=False`` the ids stay in
    the files and ``ids_crc32`` has their checksum as 32-bit little-endian numbers.
    """
    manifest = spark.read.parquet(f"{path}/manifest")
    values = "tokens array<int>" if tokens else "ids_crc32 bigint"
    # Each part is one small row here; a part's files are read by one task.
    return manifest.repartition(max(1, manifest.count()), "part").mapInArrow(
        lambda batches: _documents(batches, path, tokens),
        f"doc_id bigint, start bigint, n_tokens bigint, {values}",
    )
