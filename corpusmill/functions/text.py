"""String expressions with the whitespace rules of Python's ``str``.

Java's ``\\s`` and ``trim`` know fewer whitespace characters than Python, so every
expression here names the characters explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python treats as whitespace.
_WHITESPACE_RANGES = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
    (0x3000, 0x3000),
)
WHITESPACE = "".join(chr(c) for lo, hi in _WHITESPACE_RANGES for c in range(lo, hi + 1))


def _regex_class(ranges) -> str:
    """Character class that decides ordinary text quickly.

    Latin-1 members are listed one by one, which Java keeps in a bit table; the rest
    sits behind one range check.
    """
    points = [(lo, hi) for lo, hi in ranges if hi > 0xFF]
    low = "".join(f"\\x{c:02x}" for lo, hi in ranges if hi <= 0xFF for c in range(lo, hi + 1))
    high = "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in points)
    return f"{low}[\\x{{{points[0][0]:x}}}-\\x{{{points[-1][1]:x}}}&&[{high}]]"


# Class of all whitespace, to be put between square brackets.
WHITESPACE_CLASS = _regex_class(_WHITESPACE_RANGES)
# Controls that are not whitespace; the others were turned into spaces before.
_CONTROLS = "[" + "".join(f"\\x{c:02x}" for c in [*range(0x09), *range(0x0E, 0x1C), 0x7F]) + "]"


def strip(text: Column) -> Column:
    """``str.strip()``."""
    return F.btrim(text, F.lit(WHITESPACE))


def squash_whitespace(text: Column) -> Column:
    """Every whitespace run becomes one space."""
    return F.regexp_replace(text, F.lit(f"[{WHITESPACE_CLASS}]+"), F.lit(" "))


def cleaned(text: Column) -> Column:
    """Squash whitespace, then drop control characters, then trim.

    The order matters: a control character between two spaces leaves both spaces.
    """
    printable = F.regexp_replace(squash_whitespace(text), F.lit(_CONTROLS), F.lit(""))
    return F.btrim(printable)


def words(text: Column) -> Column:
    """``str.split()``: whitespace-separated words, none for a blank text."""
    return F.array_remove(F.split(text, f"[{WHITESPACE_CLASS}]+"), "")


def words_of_cleaned(text: Column) -> Column:
    """:func:`words` of a text from :func:`cleaned`, whose only whitespace is the space."""
    return F.array_remove(F.split(text, " "), "")


def unix_newlines(text: Column) -> Column:
    """Universal-newline reading: ``\\r\\n`` and ``\\r`` become ``\\n``."""
    changed = F.regexp_replace(text, F.lit("\r\n?"), F.lit("\n"))
    # Few texts need it, and a pattern costs many times as much as looking for one byte.
    return F.when(F.contains(text, F.lit("\r")), changed).otherwise(text)
