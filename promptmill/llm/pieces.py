"""Token ids of whole texts by a ``tokenizers`` file, each distinct word encoded once.

A byte-level BPE file with the usual word pattern never merges across the place
where white space follows other text, nor across the end of a run of letters
before a full stop or comma. Texts are cut there, every distinct piece goes
through the library in batches while it is remembered, and results are joined.
Files with other rules get whole texts instead.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

#: ASCII white space ahead of a run of other characters, or at the end of the text.
PIECES = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+\Z")
#: White space beyond ASCII (and controls some libraries count as such) may join the ASCII kind in one token.
OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
STOPS = ".,;:!?"
#: Pieces remembered in each of two generations, and characters sent to the library at once.
REMEMBERED = 450_000
BATCH_CHARS = 1 << 18
#: Characters of texts whose pieces are looked up at once.
PART_CHARS = 1 << 20
#: Longest piece that is remembered, and the length beyond which a text is taken in several parts.
LONGEST_REMEMBERED = 40
LONG_TEXT = 1 << 16


def word_cut_allowed(tokenizer_json: str) -> bool:
    """Whether texts may be cut ahead of white space without changing their ids."""
    rules = json.loads(tokenizer_json)
    before = rules.get("pre_tokenizer") or {}
    return (
        rules.get("model", {}).get("type") == "BPE"
        and not rules["model"].get("dropout")
        and rules.get("normalizer") is None
        and rules.get("post_processor") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space", True)
        and not any(
            token["lstrip"] or token["rstrip"] or token["single_word"] or re.search(r"\s", token["content"])
            or token["content"].lstrip(" ").isalpha()
            for token in rules.get("added_tokens", [])
        )
    )


def balanced(texts: Iterable[str], size: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Lists of texts of about ``size`` characters each; a longer text stands alone."""
    batch, held = [], 0
    for text in texts:
        if batch and held + len(text) > size:
            yield batch
            batch, held = [], 0
        batch.append(text)
        held += len(text)
    if batch:
        yield batch


def spans_of(text: str, size: int = LONG_TEXT) -> Iterator[str]:
    """Parts of a long text, each cut where a single space stands between other characters."""
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at > 0 and not (at + 1 < len(text) and text[at - 1] > " " and text[at + 1] > " "):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def _byte_letters() -> dict[int, str]:
    """Byte-level files write each byte as one printable character; this is that rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}


class PieceEncoder:
    """What ``measure`` gives for a text's ids, joined over its pieces.

    ``measure`` maps one library encoding to an int or to bytes; ``join`` is
    ``sum`` or ``b"".join``. ``measure_runs``, if given, maps all ids of one
    encoding and two lists, where its runs begin and end, to what ``measure``
    gives for each run; runs of letters then go through the library as one text,
    with a line end of its own token between them (a space ahead of a run parts
    it too). Pieces are known by their
    text behind one space, or by a space and their text where no space goes
    before. At most ``2 * remembered`` are kept: a full younger half becomes the
    older one.
    """

    def __init__(self, tokenizer_json: str, measure, join, remembered: int = REMEMBERED, measure_runs=None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(tokenizer_json)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.by_piece = word_cut_allowed(tokenizer_json)
        if self.by_piece:
            rules = json.loads(tokenizer_json) | {"pre_tokenizer": None, "decoder": None, "added_tokens": []}
            rules |= {"truncation": None, "padding": None}
            self.letters = _byte_letters()
            line_end = self.letters[ord("\n")]
            self.line_end = rules["model"]["vocab"].get(line_end) if measure_runs else None
            if self.line_end is not None:
                cuts = (line_end, "Isolated"), (self.letters[ord(" ")], "MergedWithNext")
                cuts = [{"type": "Split", "pattern": {"String": x}, "behavior": how, "invert": False} for x, how in cuts]
                rules["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": cuts}
            self.words = Tokenizer.from_str(json.dumps(rules))
        self.measure, self.join, self.remembered, self.measure_runs = measure, join, remembered, measure_runs
        self.young: dict = {}
        self.old: dict = {}

    def _whole(self, texts: list[str]) -> list:
        return [self.measure(e) for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, words: list[str]) -> list:
        """Runs of letters with at most one space ahead are one unit for the word pattern."""
        if self.line_end is not None:
            ids = self.words.encode_batch_fast([self._spelled("\n".join(words))], add_special_tokens=False)[0].ids
            ids = np.array(ids, "<u4")
            ends = np.flatnonzero(ids == self.line_end)
            return self.measure_runs(ids, [0, *(ends + 1).tolist()], [*ends.tolist(), len(ids)])
        spelled = [word.encode().decode("latin-1").translate(self.letters) for word in words]
        return [self.measure(e) for e in self.words.encode_batch_fast(spelled, add_special_tokens=False)]

    def _spelled(self, text: str) -> str:
        """Letters, spaces and line ends as a byte-level file writes them."""
        if text.isascii():
            return text.replace(" ", self.letters[32]).replace("\n", self.letters[10])
        return text.encode().decode("latin-1").translate(self.letters)

    @staticmethod
    def _atoms(key: str) -> list[str]:
        """The parts, as keys, that a piece is encoded in which is not just letters and stops."""
        atoms = []
        for part in PIECES.findall(key[1:] if key[0] == " " else " " + key):
            if part[0] == "\n" and part[1:2].strip():
                atoms.append(" \n")
                part = part[1:]
            word = part.rstrip(STOPS)
            stops = part[len(word):]
            if stops and word.lstrip(" ").isalpha() and word[:2] != "  ":
                atoms.append(word[1:] if word[0] == " " else " " + word)
                part = stops
            atoms.append(part[1:] if part[0] == " " and len(part) > 1 and part[1] > " " else " " + part)
        return atoms

    def _learn(self, keys: set[str]) -> list[str]:
        """Put the results of keys into the younger half; returns those to forget after this batch."""
        young, old = self.young, self.old
        fresh = self._remind(keys)
        words = set(filter(str.isalpha, fresh))
        ends_in_stops, made_of = {}, {}
        for key in fresh.difference(words):
            word = key.rstrip(STOPS)
            if word.isalpha():
                ends_in_stops[key] = word, " " + key[len(word):]
            else:
                made_of[key] = self._atoms(key)
        words.update(self._remind(set().union(*made_of.values(), *zip(*ends_in_stops.values())).difference(young)))
        others = [key for key in words if not key.isalpha()]
        words.difference_update(others)
        bare = [key for key in others if key[0] == " " and key[1:].isalpha()]
        others = list(set(others).difference(bare))
        forget = []
        for these, spelled, encode in (
            (list(words), [" " + key for key in words], self._word),
            (bare, [key[1:] for key in bare], self._word),
            (others, [key[1:] if key[0] == " " else " " + key for key in others], self._whole),
        ):
            done = 0
            for batch in balanced(spelled):
                young.update(zip(these[done:done + len(batch)], encode(batch)))
                done += len(batch)
        for key, (word, stops) in ends_in_stops.items():
            young[key] = young[word] + young[stops]
            if len(key) > LONGEST_REMEMBERED:
                forget += [part for part in (key, word, stops) if len(part) > LONGEST_REMEMBERED]
        for key, atoms in made_of.items():
            if key not in young:
                young[key] = self.join([young[atom] for atom in atoms])
            if len(key) > LONGEST_REMEMBERED or "\n" in key:
                forget.append(key)
                forget += [atom for atom in atoms if len(atom) > LONGEST_REMEMBERED]
        forget += [key for key in words if len(key) > LONGEST_REMEMBERED]
        return forget

    def _remind(self, keys: set[str]) -> set[str]:
        """Move what the older half knows to the younger one; returns the keys neither knows."""
        known = keys & self.old.keys()
        self.young.update(zip(known, map(self.old.__getitem__, known)))
        return keys - known

    @staticmethod
    def keys(text: str, inside: bool = False) -> list[str] | None:
        """A text's pieces as keys, or None if it must be encoded whole; ``inside``: a space went before it."""
        if not text:
            return []
        if text.replace("\n", "").isprintable() and " \n" not in text and "\n " not in text:
            keys = text.split(" ")
            if "" not in keys:
                if not inside:
                    keys[0] = " " + keys[0]
                return keys
        if OTHER_SPACE.search(text):
            return None
        return [
            part[1:] if part[0] == " " and len(part) > 1 and part[1] > " " else " " + part
            for part in PIECES.findall(" " + text if inside else text)
        ]

    def __call__(self, texts: list[str]) -> list:
        """One result per text, in order; an empty text gives that of no ids."""
        results: list = []
        for batch in balanced(texts, PART_CHARS if self.by_piece else BATCH_CHARS):
            if not self.by_piece:
                results += self._whole(batch)
                continue
            if len(self.young) > self.remembered:
                self.old, self.young = self.young, {}
            results += self._batch(batch)
        return results

    def _batch(self, batch: list[str]) -> list:
        cut = []
        for text in batch:
            if len(text) <= LONG_TEXT or OTHER_SPACE.search(text):
                cut.append([self.keys(text)])
            else:
                first, *rest = spans_of(text)
                cut.append([self.keys(first), *(self.keys(span[1:], inside=True) for span in rest)])
        young = self.young
        forget = self._learn(set().union(*(keys for spans in cut for keys in spans if keys)).difference(young))
        results = [
            self._whole([text])[0] if None in spans else self.join([self.join(map(young.__getitem__, keys)) for keys in spans])
            for text, spans in zip(batch, cut)
        ]
        for key in forget:
            young.pop(key, None)
        return results
