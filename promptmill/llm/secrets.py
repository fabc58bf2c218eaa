"""Secrets in texts: fixed patterns, and values in credential contexts that are hard to guess."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.shared import forget_state, ready, schema_with, slices, strings, with_columns

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: More places where a credential's value stands: the name and what leads to its value, or (with the value as group 1)
#: an Authorization header. A name is taken whole and from its start, so it is looked through once. Words that only
#: begin like a credential word (passage, secretary, tokenizer) are none.
CONTEXT = re.compile(
    r"""(?<![\w-])(?>[\w-]*?(?:pass(?:word|wd|phrase|code|key|(?![a-z]))|pwd|secret(?!ar|ion)|token(?!i[sz][aei])|credential"""
    r"""|(?:api|access|private|auth|encrypt(?:ion)?|sign(?:ing)?|account|master|shared|storage)[_-]?key))[\w-]*+"""
    r"""["']?[\x20\t]*+(?:=>|:=|[:=])[\x20\t]*+(?:(?:bearer|basic)\x20++)?+"""
    r"""|\b(?:bearer|basic)\x20+([A-Za-z0-9+/_.=~-]{16,})""",
    re.I | re.A,
)
#: A value: in quotes up to its own closing quote on that line (one that is not escaped, if there is any), else to a blank.
VALUE = re.compile(
    r""""((?:[^"\\\r\n]|\\[^\r\n])*+)"|'((?:[^'\\\r\n]|\\[^\r\n])*+)'|"([^"\r\n]*+)"|'([^'\r\n]*+)'|["']?(\S*+)"""
)
SHORTEST_VALUE = 6
#: So far before the end of an unquoted value that is not reported the next name may begin.
LONGEST_NAME = 64
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "credential", "key", "bearer", "basic")
KINDS = ("assign", "access", "hex", "guess")
#: A value is reported that takes this many guesses (power of ten) or more. Eight random characters of two classes
#: take 12.4 or more, one or two less where a character is doubled or three follow a keyboard row.
LEAST_LOG10_GUESSES = 10.0

# Words that are tried first, the most likely one in front.
COMMON_WORDS = (
    "password admin welcome login letmein secret test user guest root master changeme default example sample "
    "token access monkey dragon sunshine princess football baseball iloveyou shadow superman batman summer winter "
    "spring autumn love hello freedom whatever michael jordan george charlie thomas daniel andrew robert jessica "
    "jennifer ashley hunter soccer hockey killer ginger pepper cheese coffee cookie banana orange purple yellow "
    "silver golden diamond computer internet server system network oracle mysql postgres google apple amazon "
    "windows linux ubuntu office manager service account private public demo none null true false placeholder "
    "your my the and key pass word value here string please insert enter company temp temporary new old"
).split()
# Rows of a keyboard and other sequences that fingers or minds follow.
WALKS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "azertyuiop", "abcdefghijklmnopqrstuvwxyz",
         "1qaz2wsx3edc4rfv5tgb6yhn7ujm", "!@#$%^&*()")
LOOKALIKES = str.maketrans("013457@$!", "oleastasi")

RANK = {word: math.log10(i + 2) for i, word in enumerate(COMMON_WORDS)}
LONGEST_WORD = max(map(len, COMMON_WORDS))
NEXT = {pair for walk in WALKS for line in (walk, walk[::-1]) for pair in zip(line, line[1:])}
WALK_COST = 2.0  # and the logarithm of its length
YEAR_COST, DAY_COST = math.log10(200), math.log10(200 * 365)
#: Years and dates, each found at every place where one starts.
DATES = [
    (re.compile(f"(?=({pattern}))"), cost)
    for pattern, cost in (
        (r"(?:19|20)[0-9]{2}", YEAR_COST),
        (r"(?:19|20)[0-9]{2}[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12][0-9]|3[01])", DAY_COST),
        (r"(?:0[1-9]|[12][0-9]|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)[0-9]{2}", DAY_COST),
    )
]


def _char_cost(char: str) -> float:
    if char.isdigit():
        return 1.0
    return math.log10(26 if char.isascii() and char.isalpha() else 33 if char.isascii() else 1000)


def mixed_char_cost(value: str) -> Callable[[str], float]:
    """The cost of single characters where all signs of the classes the value mixes have to be tried at each place.

    A capital at the front of small letters only is a shape of one class, not a second one. Characters beyond ASCII
    keep their own cost.
    """
    upper = any("A" <= char <= "Z" for char in value[1:])
    lower = any("a" <= char <= "z" for char in value)
    front = "A" <= value[:1] <= "Z" and not lower
    signs = 26 * (upper or front) + 26 * lower + 10 * any("0" <= char <= "9" for char in value)
    signs += 33 * any(char.isascii() and not char.isalnum() for char in value)
    ascii_cost = math.log10(max(signs, 10))
    return lambda char: ascii_cost if char.isascii() else _char_cost(char)


class _WalkStarts:
    """Starts within one keyboard walk, and the least of their cost plus the logarithm of the length from them.

    An earlier start that is once as good as a later one stays so, as the logarithms grow alike. So only those
    are held, the latest on top, that are the best for a while and give way to the one below: each start comes and
    goes once.
    """

    def __init__(self):
        self.held: list[tuple[int, float]] = []

    @staticmethod
    def _gives_way(early: tuple[int, float], late: tuple[int, float]) -> float:
        """From which end on the early start is as good as the late one."""
        ratio = 10 ** (late[1] - early[1])
        if ratio <= 1:
            return math.inf
        return (ratio * late[0] - early[0]) / (ratio - 1)

    def least(self, stop: int, start: int, cost: float) -> float:
        """The least for a walk that ends at ``stop``, where ``start`` is new with its cost."""
        held = self.held
        while len(held) > 1 and self._gives_way(held[-2], held[-1]) <= stop:
            held.pop()
        new = (start, cost)
        if not held or self._gives_way(held[-1], new) > stop:
            while held and (
                held[-1][1] >= cost
                or len(held) > 1 and self._gives_way(held[-2], held[-1]) <= self._gives_way(held[-1], new)
            ):
                held.pop()
            held.append(new)
        return held[-1][1] + math.log10(stop - held[-1][0])


def guess_cost(value: str, longest_period: int = 8, char_cost: Callable[[str], float] = _char_cost) -> float:
    """The least power of ten of guesses by which words, dates, repeats, keyboard walks and single characters
    put together the value; ``char_cost`` gives what a single one takes.

    ``best[i]`` is the cost of the first ``i`` characters; every word, year, date and
    walk that ends there is tried, parts of longer walks too, and of repeats the whole run of copies.
    All are found with work in proportion to the
    length, so a value may be as long as its text.
    """
    n = len(value)
    lower, plain = value.lower(), value.lower().translate(LOOKALIKES)
    if len(lower) != n:
        lower = plain = value
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]  # at a span's end: its start and cost
    for start in range(n):
        for stop in range(start + 2, min(n, start + LONGEST_WORD) + 1):
            cost = RANK.get(lower[start:stop])
            if cost is None:
                cost = RANK.get(plain[start:stop])
                cost = None if cost is None else cost + 0.6
            if cost is not None:
                shape = value[start:stop]
                plain_case = shape == shape.lower()
                cost += 0 if plain_case else 0.3 if shape[0].isupper() and shape[1:] == shape[1:].lower() else 1.0
                ends[stop].append((start, cost))
    for pattern, cost in DATES:
        for match in pattern.finditer(value):
            ends[match.end(1)].append((match.start(1), cost))
    single = [char_cost(char) for char in value]
    best = [0.0] * (n + 1)
    walk, starts = 0, _WalkStarts()
    runs = [0] * (longest_period + 1)  # characters up to here that equal those one period before
    for stop in range(1, n + 1):
        least = best[stop - 1] + single[stop - 1]
        for start, cost in ends[stop]:
            least = min(least, best[start] + cost)
        if stop > 1 and (lower[stop - 2], lower[stop - 1]) not in NEXT:
            walk, starts = stop - 1, _WalkStarts()
        if stop - walk >= 3:
            least = min(least, WALK_COST + starts.least(stop, stop - 3, best[stop - 3]))
        for period in range(1, longest_period + 1):
            same = stop > period and value[stop - 1] == value[stop - 1 - period]
            runs[period] = runs[period] + 1 if same else 0
            times = runs[period] // period  # as many copies of the block before as end here
            if times:
                least = min(least, best[stop - times * period] + math.log10(times + 1))
        best[stop] = least
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind number, end) of the fixed patterns, leftmost and not overlapping within a kind."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guessed_spans(text: str, least: float = LEAST_LOG10_GUESSES) -> list[tuple[int, int, str]]:
    """(start, kind number, end) of values in credential contexts that take at least ``10**least`` guesses."""
    lower = text.lower()
    if not any(word in lower for word in CONTEXT_WORDS):
        return []
    found, at = [], 0
    while match := CONTEXT.search(text, at):
        if match.group(1):
            (start, stop), at, bare = match.span(1), match.end(), False
        else:
            part = VALUE.match(text, match.end())
            (start, stop), at, bare = part.span(part.lastindex), part.end(), part.lastindex == 5
        value = text[start:stop]
        if len(value) >= SHORTEST_VALUE and guess_cost(value, char_cost=mixed_char_cost(value)) >= least:
            found.append((start, 3, stop))
        elif bare:
            at = max(start, stop - LONGEST_NAME)
    return found


def _joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


COLUMNS = {
    "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "n_guess": "bigint",
    "base_spans": "string", "spans": "string",
}


def find_secrets(docs: DataFrame, text: str = "text", least: float = LEAST_LOG10_GUESSES) -> DataFrame:
    """``docs`` with the spans of secrets in every whole text, as ``kind:start:end`` in code points, end exclusive.

    Kinds are those of the fixed patterns (``assign``, ``access``, ``hex``) and
    ``guess``: the value in a credential context whose cheapest way of guessing
    (words, dates, repeats, keyboard walks, characters) takes ``10**least`` tries
    or more. ``base_spans`` has the first three kinds, ``spans`` all, by start and
    then kind. A null or empty text has none. Rows are independent: repeated rows
    get the same result, other columns stay, columns named like the results are
    replaced. Nothing is shuffled.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        for batch in slices(batches, text):
            out: dict[str, list] = {name: [] for name in COLUMNS}
            for value in strings(batch, text):
                base = base_spans(value or "")
                added = guessed_spans(value or "", least)
                for kind in range(3):
                    out[f"n_{KINDS[kind]}"].append(sum(span[1] == kind for span in base))
                out["n_guess"].append(len(added))
                out["base_spans"].append(_joined(base))
                out["spans"].append(_joined(sorted(base + added)))
            yield with_columns(
                batch,
                **{n: pa.array(v, pa.string() if COLUMNS[n] == "string" else pa.int64()) for n, v in out.items()},
            )

    return docs.mapInArrow(run, schema_with(docs, **COLUMNS))


def secret_report(docs: DataFrame) -> DataFrame:
    return find_secrets(docs.select("doc_id", "text")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_guess"
    )
