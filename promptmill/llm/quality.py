"""Quality rules: repetition inside a text by a suffix array over its words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.shared import forget_state, ready, schema_with, slices, utf8, with_columns

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"
#: Bytes of text whose words are sorted together.
SORT_BYTES = 1 << 20


@dataclass(frozen=True)
class QualityLimits:
    """A text fails the base rules with too few words or too many in repeated windows, and the method's
    with too much of it (in words) inside maximal repeats or with too long a repeat."""

    least_words: int = 20
    most_repeat_percent: int = 30
    least_repeat: int = 5
    most_covered: float = 0.3
    longest_repeat: int = 100


def suffix_array(words: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, longest common prefix with the one before), for many texts at once.

    ``words`` are word numbers of several texts in a row and ``text_of`` the text
    each word is in (ascending). Prefix doubling: ranks of 2**k words come from
    pairs of ranks of half that length; from the third round on only suffixes
    that are not yet alone with their rank are sorted again. Prefixes end with
    the text and the text counts first, so suffixes of different texts share
    nothing. Common prefixes are read off the ranks of all lengths, longest first.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # ranks are 1..; 0 stands for the end of the text
    last = np.flatnonzero(np.append(text_of[1:] != text_of[:-1], True))
    left = last[np.searchsorted(last, np.arange(n))] - np.arange(n) + 1
    rank = np.unique(words.astype(np.int64) + text_of.astype(np.int64) * (int(words.max()) + 1), return_inverse=True)[1] + 1
    levels, length = [rank], 1
    while True:
        second = np.zeros(n, np.int64)
        inside = np.flatnonzero(left > length)
        second[inside] = rank[inside + length]
        pair = rank * (n + 2) + second
        if length < 4:
            order = np.argsort(pair, kind="stable")
            sorted_pair = pair[order]
            fresh = np.append(True, sorted_pair[1:] != sorted_pair[:-1])
            new = np.empty(n, np.int64)
            new[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] + 1
        else:
            # a rank is the first place of its group, so a group is resorted within its own places
            counts = np.bincount(rank, minlength=n + 2)
            open_ = np.flatnonzero(counts[rank] > 1)
            order = open_[np.argsort(pair[open_], kind="stable")]
            sorted_rank, sorted_pair = rank[order], pair[order]
            group = np.append(True, sorted_rank[1:] != sorted_rank[:-1])
            within = np.arange(len(order)) - np.flatnonzero(group)[np.cumsum(group) - 1] if len(order) else order
            fresh = np.append(True, sorted_pair[1:] != sorted_pair[:-1])
            place = sorted_rank + within
            new = rank.copy()
            new[order] = place[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] if len(order) else place
        if length > 1 and np.array_equal(new, rank):
            break
        rank, length = new, length * 2
        levels.append(rank)
        if len(np.unique(rank)) == n:
            break
    order = np.argsort(rank, kind="stable")
    before, after = order[:-1], order[1:]
    common = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        step = 1 << level
        fits = np.flatnonzero((left[before] - common >= step) & (left[after] - common >= step))
        a, b = before[fits] + common[fits], after[fits] + common[fits]
        same = fits[levels[level][a] == levels[level][b]]
        common[same] += step
    return order, np.append(0, common)


def longest_repeats(words: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """For every word the length of the longest prefix of its suffix that occurs again in the same text.

    A place's longest repeat is the higher of the two common prefixes beside it:
    the LCP intervals that hold a suffix are nested, and their union of spans is
    that of the deepest one.
    """
    order, common = suffix_array(words, text_of)
    longest = np.zeros(len(words), np.int64)
    longest[order] = np.maximum(common, np.append(common[1:], 0))
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of at least ``least`` words (spans never cross texts)."""
    reach = np.where(longest >= least, np.arange(len(longest)) + longest, 0)
    return np.maximum.accumulate(reach) > np.arange(len(longest)) if len(longest) else np.zeros(0, bool)


def _measures(texts: list[bytes], limits: QualityLimits) -> dict[str, list]:
    split = [text.split() for text in texts]
    sizes = np.array([len(words) for words in split], np.int64)
    starts = np.cumsum(sizes) - sizes
    numbers: defaultdict = defaultdict()
    numbers.default_factory = numbers.__len__
    words = np.fromiter((numbers[w] for own in split for w in own), np.int64, int(sizes.sum()))
    text_of = np.repeat(np.arange(len(texts)), sizes)
    longest = longest_repeats(words, text_of)
    some = np.flatnonzero(sizes)

    def per_text(values: np.ndarray, how) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        if len(some):
            out[some] = how.reduceat(values, starts[some])
        return out

    in_windows = per_text(covered(np.where(longest >= WINDOW, WINDOW, 0), WINDOW), np.add)
    in_repeats = per_text(covered(longest, limits.least_repeat), np.add)
    most = per_text(longest, np.maximum)
    out: dict[str, list] = {name: [] for name in ("word_chars", "n_symbols", "n_dup_lines")}
    for text in texts:
        solid = text.translate(None, BLANKS)
        out["word_chars"].append(len(solid.decode()))
        out["n_symbols"].append(len(text) - len(text.translate(None, SYMBOLS)))
        lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
    failed = (sizes < limits.least_words) | (100 * in_windows > limits.most_repeat_percent * sizes)
    repetitive = (in_repeats > limits.most_covered * sizes) | (most > limits.longest_repeat)
    return out | {
        "n_words": sizes.tolist(),
        "n_repeat_words": in_windows.tolist(),
        "n_covered_words": in_repeats.tolist(),
        "longest_repeat": most.tolist(),
        "base_failed": failed.tolist(),
        "kept": (~failed & ~repetitive).tolist(),
    }


COLUMNS = {
    "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
    "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    "n_covered_words": "bigint", "longest_repeat": "bigint",
}


def judge_quality(docs: DataFrame, limits: QualityLimits = QualityLimits(), text: str = "text") -> DataFrame:
    """``docs`` with counts of every whole text and the verdict ``kept``.

    Words are runs of other than ``[\\x20\\x09-\\x0D]``. ``n_repeat_words`` counts
    words in windows of 8 words found twice or more in the text; ``n_covered_words``
    those in maximal repeats of ``least_repeat`` words or more (the union of their
    spans, overlaps counted once); ``longest_repeat`` is the longest one's length.
    A text fails (``kept`` false) by the base rules (``base_failed``) or by the
    limits on the covered share and the longest repeat. A null or empty text has
    no words and fails. Rows are independent: repeated rows get the same result,
    other columns stay, columns named like the results are replaced.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        for batch in slices(batches, text, SORT_BYTES):
            found = _measures([value or b"" for value in utf8(batch, text)], limits)
            kinds = {name: pa.bool_() if kind == "boolean" else pa.int64() for name, kind in COLUMNS.items()}
            yield with_columns(batch, **{name: pa.array(found[name], kinds[name]) for name in COLUMNS})

    return docs.mapInArrow(run, schema_with(docs, **COLUMNS))


def repeated_spans(docs: DataFrame, least_repeat: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` with the spans (code points, end exclusive) that maximal repeats of ``least_repeat`` words cover."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        import re

        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches, text, SORT_BYTES):
            spans = []
            for value in batch.column(text).to_pylist():
                found = list(re.finditer(r"[^\x20\x09-\x0D]+", value or ""))
                numbers: defaultdict = defaultdict()
                numbers.default_factory = numbers.__len__
                words = np.array([numbers[m.group()] for m in found], np.int64)
                inside = covered(longest_repeats(words, np.zeros(len(words), np.int64)), least_repeat)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))).reshape(-1, 2)
                spans.append([{"begin": found[b].start(), "end": found[e - 1].end()} for b, e in edges])
            yield with_columns(batch.select([key]), spans=pa.array(spans, kind))

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, spans array<struct<begin: bigint, end: bigint>>")


def quality_report(docs: DataFrame) -> DataFrame:
    return judge_quality(docs.select("doc_id", "text")).select("doc_id", *COLUMNS)

