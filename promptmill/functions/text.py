"""Text expressions with Python string semantics, built from Spark functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python treats as whitespace in str.strip() and
# in the regex class \s. Spark's own trim() removes U+0020 only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set as the inside of a Java regex character class. Characters beyond
# Latin-1 stand in a nested class behind one range check, which makes matching
# of ordinary text about twice as fast as a plain list of ranges.
WHITESPACE_CLASS = (
    r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
)

# Characters that are digits to Python's str.isdigit() without
# being decimal digits (superscripts, circled and historic digits).
EXTRA_DIGITS_CLASS = (
    r"\u00b2-\u00b3\u00b9\u1369-\u1371\u19da\u2070\u2074-\u2079\u2080-\u2089"
    r"\u2460-\u2468\u2474-\u247c\u2488-\u2490\u24ea\u24f5-\u24fd\u24ff"
    r"\u2776-\u277e\u2780-\u2788\u278a-\u2792"
    r"\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
)

_DIGITS_ONLY = r"\A[\p{Nd}" + EXTRA_DIGITS_CLASS + r"]+\z"


def py_strip(text: Column) -> Column:
    """Drop leading and trailing Unicode whitespace."""
    return F.btrim(text, F.lit(WHITESPACE))


def tail_after_last(text: Column, separator: str) -> Column:
    """Text behind the last ``separator``, counted from the left without overlaps.

    The whole text when the separator is absent. Searching from the right finds
    the same place unless two occurrences overlap; only a text with such a pair
    is split from the left.
    """
    from_right = F.substring_index(text, separator, -1)
    overlapping = [
        F.contains(text, F.lit(separator + separator[n:]))
        for n in range(1, len(separator))
        if separator[:n] == separator[-n:]
    ]
    if not overlapping:
        return from_right
    from_left = F.try_element_at(F.split(text, rf"\Q{separator}\E", -1), F.lit(-1))
    return F.when(reduce(Column.__or__, overlapping), from_left).otherwise(from_right)


def extract_xml_answer(completion: Column) -> Column:
    """Body of the last ``<answer>`` element, stripped; whole text without tags."""
    body = F.substring_index(tail_after_last(completion, "<answer>"), "</answer>", 1)
    return py_strip(body)


def extract_hash_answer(solution: Column) -> Column:
    """Stripped second ``####``-separated piece; null without the marker.

    The piece ends at the next marker, so ``a #### 18 #### 20`` gives ``18``.
    """
    behind_first = F.substring(
        solution,
        F.instr(solution, "####") + F.lit(4),
        F.length(solution),
    )
    piece = F.substring_index(behind_first, "####", 1)
    return F.when(F.contains(solution, F.lit("####")), py_strip(piece))


def extract_response(decoded: Column, marker: str = "### Response:") -> Column:
    """Stripped text behind the first marker; the input unchanged without one."""
    at = F.instr(decoded, marker)
    behind = F.substring(decoded, at + F.lit(len(marker)), F.length(decoded))
    return F.when(at == 0, decoded).otherwise(py_strip(behind))


def is_digit(text: Column) -> Column:
    """True for a non-empty text of digits of any script; signs and points fail."""
    return F.rlike(text, F.lit(_DIGITS_ONLY))


def count_occurrences(text: Column, needle: str) -> Column:
    """Number of non-overlapping occurrences of ``needle``."""
    removed = F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))
    return (removed / F.lit(len(needle))).cast("int")


def to_text(value: Column) -> Column:
    """Any cell as string; null stays null."""
    return value.cast("string")


def is_missing(value: Column, floating: bool = False) -> Column:
    """Null, or NaN when the column is a floating point one."""
    return (value.isNull() | F.isnan(value)) if floating else value.isNull()


def preview_text(text: Column, n_chars: int = 1000) -> Column:
    """Leading characters, for showing a sample on a terminal."""
    return F.substring(text, 1, n_chars)


def first_message_content(messages: Column) -> Column:
    """Content of the first message of a completion."""
    return F.try_element_at(messages, F.lit(1))["content"]


def last_message_content(messages: Column) -> Column:
    """Content of the last message of a prompt."""
    return F.try_element_at(messages, F.lit(-1))["content"]


def whitespace_tokens(text: Column) -> Column:
    """Whitespace-separated words; an empty array for blank text."""
    stripped = py_strip(text)
    return F.when(F.length(stripped) == 0, F.array().cast("array<string>")).otherwise(
        F.split(stripped, f"[{WHITESPACE_CLASS}]+")
    )
