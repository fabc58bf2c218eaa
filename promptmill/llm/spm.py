"""SentencePiece encoding by a streaming Viterbi search, and decoding."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.shared import broadcast_file, ready, schema_with, slices, strings, with_columns, worker_state

SPACE = "▁"
UNIGRAM, BPE = 1, 2  # fixed values of the model file
#: What an unknown character costs beyond the rarest piece in a unigram model; fixed value of the library.
UNKNOWN_PENALTY = 10.0
#: Bytes of remembered words in each of two generations (ids, text and some 120 bytes of Python a word),
#: and pairs of pieces, that a worker holds.
REMEMBERED_BYTES = 12 << 20
REMEMBERED_PAIRS = 200_000
#: Steps from one place in a text to the next, by the piece beginnings there, that a worker holds.
REMEMBERED_PLACES = 200_000
WORD_OVERHEAD = 120
#: A worker's search of many words looks into a table of 2**20 pairs of pieces (8 MB) and one of a quarter as many steps.
TABLE_BITS = 20
#: Words that are searched side by side; two numbers are held for each place in each of them.
SIDE_BY_SIDE = 8192
#: Longest word that is remembered.
LONGEST_REMEMBERED = 40
#: Characters between two looks for a boundary on which all paths agree.
LOOK_EVERY = 32
#: Bytes of text whose ids, decoded text and result batch a worker holds at once.
PART_BYTES = 1 << 20
SINGLE = (1,)


def _model_type(model: bytes) -> int:
    """The model type a model file states (unigram where it states none)."""

    def fields(data: bytes):
        at = 0

        def number() -> int:
            nonlocal at
            value = shift = 0
            while True:
                byte = data[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value

        while at < len(data):
            tag = number()
            kind = tag & 7
            if kind == 0:
                yield tag >> 3, number()
            else:
                length = {1: 8, 5: 4}.get(kind) or number()
                yield tag >> 3, data[at: at + length]
                at += length

    for field, trainer in fields(model):
        if field == 2:
            return next((value for inner, value in fields(trainer) if inner == 3), UNIGRAM)
    return UNIGRAM


class PieceModel:
    """The pieces of a SentencePiece model file (unigram or BPE, without user-defined symbols)."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.kind = _model_type(model)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        ids = range(sp.get_piece_size())
        self.pieces = [sp.id_to_piece(i) for i in ids]
        self.unknown = sp.unk_id()
        special = {i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        self.control = {i for i in ids if sp.is_control(i)}
        self.ids = {self.pieces[i]: i for i in ids if i not in special}
        self.scores = {self.pieces[i]: sp.get_score(i) for i in ids if i not in special}
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in ids if sp.is_byte(i)}
        self.byte_of = {i: byte for byte, i in self.bytes.items()}
        self.longest = max(map(len, self.ids), default=1)
        self.alphabet = set("".join(self.ids))
        self.unknown_score = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.prefixed = sp.normalize("a").startswith(SPACE)
        #: Whether a word that follows other text always starts a piece.
        self.words_apart = not any(SPACE in piece.lstrip(SPACE) for piece in self.ids)
        self.pairs: dict[int, bool] = {}
        self.root: tuple = ({}, (), "")
        self.known: dict[str, tuple] = {}
        self.places = 0
        #: Stops that no piece joins to a letter before them: a word may be cut ahead of them.
        self.stops = "".join(c for c in ".,;:!?|" if not any(re.search(r"[^\W\d_]" + re.escape(c), p) for p in self.ids))

        # decoding: what each id stands for; bytes beyond ASCII only mean something together
        self.high = np.zeros(len(self.pieces), bool)
        self.texts = [piece.replace(SPACE, " ") for piece in self.pieces]
        for i, byte in self.byte_of.items():
            self.texts[i] = chr(byte)
            self.high[i] = byte > 127
        for i in self.control:
            self.texts[i] = ""

    @cached_property
    def usable(self) -> dict[str, int]:
        """Pieces a search may use, with their ids: in a BPE model only those that their own text gives."""
        return {p: i for p, i in self.ids.items() if self.kind == UNIGRAM or self.merged(p) == [p]}

    @cached_property
    def lengths(self) -> dict[str, tuple[int, ...]]:
        """The last three or two characters of a place, and how long usable pieces that end there are, longest first."""
        ends: dict[str, set[int]] = {piece: {2} for piece in self.usable if len(piece) == 2}
        for piece in self.usable:
            if len(piece) > 2:
                ends.setdefault(piece[-3:], {2} if piece[-2:] in self.usable else set()).add(len(piece))
        return {end: (*sorted(found, reverse=True), 1) for end, found in ends.items()}

    @cached_property
    def beginnings(self) -> set[str]:
        """All beginnings of usable pieces."""
        return {piece[:n] for piece in self.usable for n in range(1, len(piece) + 1)}

    def place(self, before: tuple, char: str) -> tuple:
        """BPE: the place behind one more character, remembered with the place before it.

        A place is (places by the next character, pieces that end here as (length, code), longest first,
        the longest beginning of a piece that ends here). A character no piece has leads to the same kind of
        place from everywhere and is not remembered.
        """
        if self.places > REMEMBERED_PLACES:
            self.places = 0
            self.root[0].clear()
            for held in self.known.values():
                held[0].clear()
            self.known.clear()
        held = before[2] + char
        while held and held not in self.beginnings:
            held = held[1:]
        if not held:
            return {}, ((1, len(self.pieces) + ord(char)),), ""
        found = self.known.get(held)
        if found is None:
            ends = [(len(held) - at, self.usable.get(held[at:])) for at in range(len(held))]
            if ends[-1][1] is None:
                ends[-1] = (1, len(self.pieces) + ord(char))
            found = self.known[held] = ({}, tuple(end for end in ends if end[1] is not None), held)
        before[0][char] = found
        self.places += 1
        return found

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by the BPE rule itself: the best pair first, the leftmost of equals."""
        parts, get = list(text), self.scores.get
        scores = [get(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == -np.inf:
                break
            at = scores.index(best)
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = get(parts[at - 1] + parts[at], -np.inf)
            if at < len(scores):
                scores[at] = get(parts[at] + parts[at + 1], -np.inf)
        return parts

    def follows(self, key: int, left: str, right: str) -> bool:
        """BPE: whether two pieces stay apart side by side, remembered under ``key``.

        A row of pieces is the encoding if all its pairs stay apart.
        """
        if len(self.pairs) > REMEMBERED_PAIRS:
            self.pairs.clear()
        known = self.pairs[key] = self.merged(left + right) == [left, right]
        return known

    def piece_ids(self, piece: str) -> list[int]:
        found = self.ids.get(piece)
        if found is not None:
            return [found]
        if self.bytes:
            return [self.bytes[byte] for byte in piece.encode()]
        return [self.unknown]


class StreamingViterbi:
    """Pieces of a normalized text that comes in parts; memory is bounded by the longest piece.

    Every boundary keeps the last piece of the best path to it. A later piece
    starts at most ``longest`` characters back, so only the paths to the last
    ``longest`` boundaries survive; where all of them go through one boundary,
    everything before it is final and given out. In a unigram model the best path
    has the highest sum of scores. In a BPE model a piece may only follow one it
    stays apart from, which leaves exactly one path to each boundary: the BPE
    encoding.
    """

    def __init__(self, model: PieceModel):
        self.model = model
        self.text = ""  # what is not final yet
        self.place = model.root  # BPE: which pieces end where the text ends
        self.starts = [0]  # for each boundary in the text, where its last piece starts
        self.codes = [0]  # BPE: and which piece that is; unigram: the sum of scores

    def feed(self, part: str) -> list[str]:
        """Take more text; returns the pieces that are now final."""
        take = self._take_bpe if self.model.kind == BPE else self._take_unigram
        if len(part) <= LOOK_EVERY and not self.text:
            self.text = part
            take()
            return []
        out: list[str] = []
        for at in range(0, len(part), LOOK_EVERY):
            self.text += part[at: at + LOOK_EVERY]
            take()
            out += self._agreed()
        return out

    def finish(self) -> list[str]:
        return self._path(len(self.text))

    def _take_bpe(self) -> None:
        model, text, starts, codes, place = self.model, self.text, self.starts, self.codes, self.place
        pairs, add_start, add_code = model.pairs, starts.append, codes.append
        end = len(starts)
        for char in text[end - 1:]:
            place = place[0].get(char) or model.place(place, char)
            for length, code in place[1]:
                start = end - length
                if start > 0:
                    key = codes[start] << 22 | code
                    apart = pairs.get(key)
                    if apart is None:
                        apart = model.follows(key, text[starts[start]: start], text[start:end])
                    if not apart:
                        continue
                elif start < 0:
                    continue
                add_start(start)
                add_code(code)
                break
            end += 1
        self.place = place

    def _take_unigram(self) -> None:
        model, text, starts, scores = self.model, self.text, self.starts, self.codes
        for end in range(len(starts), len(text) + 1):
            best, begin = -np.inf, end - 1
            ending = text[end - 3: end] if end > 2 else text[:end]
            for length in model.lengths.get(ending) or model.lengths.get(ending[-2:], SINGLE):
                start = end - length
                if start < 0:
                    continue
                score = model.scores.get(text[start:end])
                if score is None:
                    if length > 1:
                        continue
                    score = model.unknown_score
                if scores[start] + score > best:
                    best, begin = scores[start] + score, start
            starts.append(begin)
            scores.append(best)

    def _agreed(self) -> list[str]:
        """Give out all before the boundary that the paths to the last boundaries share."""
        end = len(self.text)
        alive = set(range(max(0, end - self.model.longest + 1), end + 1))
        while len(alive) > 1:
            latest = max(alive)
            alive.discard(latest)
            alive.add(self.starts[latest])
        common = alive.pop()
        if self.model.kind == BPE and common:
            # the next pieces are judged by the last one before the boundary, so that one stays
            common = self.starts[common]
        return self._path(common) if common else []

    def _path(self, end: int) -> list[str]:
        pieces, at, starts, text = [], end, self.starts, self.text
        while at:
            start = starts[at]
            pieces.append(text[start:at])
            at = start
        self.text = text[end:]
        self.starts = [0, *(start - end for start in starts[end + 1:])]
        self.codes = self.codes[end:]
        return pieces[::-1]


class KnownValues:
    """Small numbers (below 2**20) by number (below 2**43) in a table of fixed size; a number may push out another.

    Lookups take whole arrays. A number stands in one of four neighbouring slots.
    """

    def __init__(self, bits: int):
        self.held = np.full(1 << bits, -1, np.int64)  # number << 20 | value
        self.shift = np.uint64(64 - bits)

    def get(self, keys: np.ndarray, make) -> np.ndarray:
        """The values of ``keys``; ``make`` gives one that the table does not hold."""
        mixed = (keys ^ keys >> 17).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        slots = (mixed >> self.shift).view(np.int64)
        held = self.held[slots]
        lacks = np.flatnonzero(held >> 20 != keys)
        for near in (1, 2, 3):
            if not len(lacks):
                return held & 0xFFFFF
            held[lacks] = again = self.held[slots[lacks] ^ near]
            lacks = lacks[again >> 20 != keys[lacks]]
        if len(lacks):
            fresh, at, where = np.unique(keys[lacks], return_index=True, return_inverse=True)
            entries = [key << 20 | make(key) for key in fresh.tolist()]
            held[lacks] = np.array(entries, np.int64)[where]
            for entry, slot in zip(entries, slots[lacks[at]].tolist()):
                near = next((near for near in range(4) if self.held[slot ^ near] < 0), entry >> 20 & 3)
                self.held[slot ^ near] = entry
        return held & 0xFFFFF


class WordSearch:
    """BPE: the search of ``StreamingViterbi`` over many short whole texts side by side, a character at a time.

    Each text has its own place and its own last piece at every boundary; a step
    handles one character of all texts that are long enough. Steps between places
    and pairs of pieces are looked up in tables of fixed size. Places are numbered
    as they are met; there are no more than beginnings of pieces.
    """

    def __init__(self, model: PieceModel):
        self.model, self.unknown = model, len(model.pieces)
        self.steps, self.apart = KnownValues(TABLE_BITS - 2), KnownValues(TABLE_BITS)
        self.number: dict[str, int] = {"": 0}
        self.places = [""]  # the longest beginning of a piece that ends at a place, by its number
        self.first = np.zeros(1024, np.int64)  # where the pieces that end at a place are listed, longest first
        self.lengths, self.codes = np.ones(4096, np.int64), np.zeros(4096, np.int64)
        self.listed = 1  # the first is that of a character no piece has: its code comes from the character

    def _step(self, key: int) -> int:
        """The number of the place behind one more character; key: number of the place before << 21 | character."""
        char = chr(key & 0x1FFFFF)
        held, model = self.places[key >> 21] + char, self.model
        while held and held not in model.beginnings:
            held = held[1:]
        found = self.number.get(held)
        if found is None:
            found = self.number[held] = len(self.places)
            if found >= 1 << 20:
                raise ValueError("the pieces have more than a million beginnings")
            self.places.append(held)
            ends = [(len(held) - at, model.usable.get(held[at:])) for at in range(len(held))]
            if ends[-1][1] is None:
                ends[-1] = (1, self.unknown + ord(char))
            ends = [end for end in ends if end[1] is not None]
            if found >= len(self.first):
                self.first = np.append(self.first, np.zeros_like(self.first))
            while self.listed + len(ends) > len(self.codes):
                self.lengths, self.codes = (np.append(a, np.zeros_like(a)) for a in (self.lengths, self.codes))
            self.first[found] = self.listed
            for length, code in ends:
                self.lengths[self.listed], self.codes[self.listed] = length, code
                self.listed += 1
        return found

    def _piece(self, code: int) -> str:
        return self.model.pieces[code] if code < self.unknown else chr(code - self.unknown)

    def _stay_apart(self, key: int) -> bool:
        left, right = self._piece(key >> 22), self._piece(key & 0x3FFFFF)
        return self.model.merged(left + right) == [left, right]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, which must not be empty, as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(texts)
        order = np.argsort([-len(text) for text in texts]).tolist()
        for at in range(0, len(order), SIDE_BY_SIDE):
            part = order[at: at + SIDE_BY_SIDE]
            for i, found in zip(part, self._search([texts[i] for i in part])):
                out[i] = found
        return out

    def _search(self, texts: list[str]) -> list[bytes]:
        """``texts`` come longest first."""
        n, sizes = len(texts), np.array([len(text) for text in texts])
        longest = int(sizes[0])
        chars = np.zeros((n, longest), np.int64)
        chars[np.arange(longest) < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        chars = np.ascontiguousarray(chars.T)
        # for each boundary of each text, where its last piece starts and which one it is
        starts, codes = np.zeros((longest + 1, n), np.int64), np.zeros((longest + 1, n), np.int64)
        flat = codes.ravel()
        place, long_enough = np.zeros(n, np.int64), np.searchsorted(-sizes, -np.arange(longest + 1), side="right")
        for end in range(1, longest + 1):
            active = int(long_enough[end])
            char = chars[end - 1, :active]
            place = self.steps.get(place[:active] << 21 | char, self._step)
            at, rows = self.first[place], np.arange(active)
            while len(rows):
                start, code = end - self.lengths[at], self.codes[at]
                strange = np.flatnonzero(at == 0)
                code[strange] = self.unknown + char[rows[strange]]
                good = start == 0
                inner = np.flatnonzero(~good)
                keys = flat[start[inner] * n + rows[inner]] << 22 | code[inner]
                good[inner] = self.apart.get(keys, self._stay_apart)
                done = rows[good]
                starts[end, done], codes[end, done] = start[good], code[good]
                if len(done) == len(rows):
                    break
                bad = ~good
                rows, at = rows[bad], at[bad] + 1
        return self._read(sizes, starts, codes)

    def _read(self, sizes: np.ndarray, starts: np.ndarray, codes: np.ndarray) -> list[bytes]:
        """The pieces on the way back from each text's end, as ids in order."""
        n = len(sizes)
        at, rows, back = sizes, np.arange(n), []
        counts = np.zeros(n, np.int64)
        while len(rows):
            back.append((rows, codes[at, rows]))
            counts[rows] += 1
            at = starts[at, rows]
            more = at > 0
            rows, at = rows[more], at[more]
        last = np.cumsum(counts)
        ids = np.zeros(int(last[-1]), "<i4")
        for k, (rows, found) in enumerate(back, 1):
            ids[last[rows] - k] = found
        packed, bounds = ids.tobytes(), [0, *(last * 4).tolist()]
        out = [packed[b:e] for b, e in zip(bounds, bounds[1:])]
        for row in set(np.searchsorted(last, np.flatnonzero(ids >= self.unknown), side="right").tolist()):
            row_codes = np.frombuffer(out[row], "<i4").tolist()
            row_ids = [i for c in row_codes for i in ([c] if c < self.unknown else self.model.piece_ids(self._piece(c)))]
            out[row] = np.array(row_ids, "<i4").tobytes()
        return out


class PieceCodec:
    """Encodes and decodes whole texts with a model.

    Where no piece goes on behind a space into a next word, the boundary ahead of
    a space is one that all paths share, whatever follows. Words between two such
    boundaries are therefore searched once and remembered, within a bound.
    """

    def __init__(self, model: bytes):
        self.model = PieceModel(model)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.young_bytes = 0
        self.breaks_line = "\n" not in self.model.alphabet

    @cached_property
    def _words(self) -> WordSearch:
        return WordSearch(self.model)

    def _search(self, text: str) -> bytes:
        viterbi = StreamingViterbi(self.model)
        ids: list[int] = []
        for at in range(0, len(text), 1 << 14):
            for piece in viterbi.feed(text[at: at + (1 << 14)]):
                ids += self.model.piece_ids(piece)
        for piece in viterbi.finish():
            ids += self.model.piece_ids(piece)
        return array("i", ids).tobytes()

    def _search_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text (none is empty); a BPE model's short ones are searched side by side."""
        if self.model.kind != BPE:
            return [self._search(text) for text in texts]
        short = [text for text in texts if len(text) <= LOOK_EVERY]
        found = iter(self._words.ids(short))
        if len(short) == len(texts):
            return list(found)
        return [next(found) if len(text) <= LOOK_EVERY else self._search(text) for text in texts]

    def _cut(self, normal: str) -> list[str]:
        """A normalized text's stretches as keys.

        The key of a word behind one space is the word; that of a stretch without
        a space ahead has the space behind it instead. Any other stretch (more
        spaces, or a whole text) has one more space ahead.
        """
        if not normal:
            return []
        if not self.model.words_apart:
            return [SPACE + normal]
        if normal[0] == SPACE and SPACE * 2 not in normal and normal[-1] != SPACE:
            return normal[1:].split(SPACE)
        parts = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+\\Z", normal)
        return [p + SPACE if p[0] != SPACE else p[1:] if len(p) > 1 and p[1] != SPACE else SPACE + p for p in parts]

    @staticmethod
    def _text(key: str) -> str:
        return key[1:] if key[:1] == SPACE else key[:-1] if key[-1:] == SPACE else SPACE + key

    def _atoms(self, key: str) -> list[str] | None:
        """A key's parts that are encoded apart, as keys; None if it has none."""
        if key[:1] == SPACE:
            return None
        bare = SPACE if key[-1:] == SPACE else ""
        word = key.removesuffix(SPACE)
        if self.breaks_line and "\n" in word:
            first, *rest = word.split("\n")
            if word == "\n" and bare:
                return None
            atoms = [first + bare] if first or not bare else []
            for part in rest:
                atoms += ["\n" + SPACE, part + SPACE] if part else ["\n" + SPACE]
            return atoms
        plain = word.rstrip(self.model.stops)
        if plain != word and plain.isalpha():
            return [plain + bare, word[len(plain):] + SPACE]
        return None

    def _learn(self, keys: set[str]) -> list[str]:
        """Have the ids of all these keys in the younger half; returns the long ones, to forget after use.

        A younger half of REMEMBERED_BYTES becomes the older one first, and the older goes.
        """
        if self.young_bytes > REMEMBERED_BYTES:
            self.old, self.young, self.young_bytes = self.young, {}, 0
        young, single, levels = self.young, set(), []
        wanted = self._remind(keys)
        while wanted:
            words = set(filter(str.isalpha, wanted))
            made = {key: atoms for key in wanted.difference(words) if (atoms := self._atoms(key))}
            single |= words
            single |= wanted.difference(words, made)
            levels.append(made)
            wanted = self._remind(set().union(*made.values()).difference(single))
        fresh = list(single)
        young.update(zip(fresh, self._search_all([SPACE + key if key.isalpha() else self._text(key) for key in fresh])))
        for made in reversed(levels):
            for key, atoms in made.items():
                young[key] = b"".join([young[atom] for atom in atoms])
        fresh = single.union(*levels)
        self.young_bytes += sum(map(len, fresh)) + sum(map(len, map(young.__getitem__, fresh))) + WORD_OVERHEAD * len(fresh)
        return [key for key in fresh if len(key) > LONGEST_REMEMBERED]

    def _remind(self, keys: set[str]) -> set[str]:
        """Move what the older half knows to the younger one; returns the keys neither knows."""
        keys = keys.difference(self.young)
        known = keys & self.old.keys()
        found = list(map(self.old.__getitem__, known))
        self.young.update(zip(known, found))
        self.young_bytes += sum(map(len, known)) + sum(map(len, found)) + WORD_OVERHEAD * len(known)
        return keys - known

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; what is not remembered of all of them is searched together."""
        cut = [self._cut(self.model.library.normalize(text) if text else "") for text in texts]
        long = self._learn(set().union(*cut))
        known, out = self.young.__getitem__, []
        for keys in cut:
            ids = np.frombuffer(b"".join(map(known, keys)), np.int32)
            if not self.model.bytes:
                # a run of unknown characters is one unknown piece
                unknown = ids == self.model.unknown
                ids = ids[~(unknown & np.append(False, unknown[:-1]))]
            out.append(ids)
        for key in long:
            self.young_bytes -= len(key) + len(self.young.pop(key)) + WORD_OVERHEAD
        return out

    def decode(self, ids: np.ndarray) -> str:
        model, texts = self.model, self.model.texts
        if not model.high[ids].any():
            text = "".join([texts[i] for i in ids.tolist()])
        else:
            parts, held = [], bytearray()
            for i in ids.tolist():
                byte = model.byte_of.get(i)
                if byte is not None:
                    held.append(byte)
                    continue
                if held:
                    parts.append(held.decode(errors="replace"))
                    held.clear()
                parts.append(texts[i])
            parts.append(held.decode(errors="replace"))
            text = "".join(parts)
        return text[1:] if model.prefixed and text.startswith(" ") else text


def _codec(held) -> PieceCodec:
    """One codec per worker process and model file."""
    return worker_state(("pieces", hash(held.value)), lambda: PieceCodec(held.value))


def encode_pieces(
    docs: DataFrame, model: str, text: str = "text", out: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``docs`` with the SentencePiece ids of each whole text in ``out`` (array of int).

    With ``decoded`` the text that these ids stand for goes into that column, as
    ``decode_pieces`` would put it there, but in the same pass.

    ``model`` is the path of a unigram or BPE ``.model`` file, read once on the
    driver and broadcast. Ids of a BPE model are those of the library without
    begin and end marks; of a unigram model those of the highest sum of scores
    (in double precision, of equals the one with the longest last piece). A null or empty text has none. Rows are independent: repeated rows get
    the same ids, other columns stay, a column named ``out`` is replaced, an empty
    table stays empty. A text of any length is searched with a window bounded by
    the longest piece.
    """
    spark = ready(docs.sparkSession)
    held = broadcast_file(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(held)
        for batch in slices(batches, text, PART_BYTES):
            ids = codec.encode_all([value or "" for value in strings(batch, text)])
            ends = np.concatenate([[0], np.cumsum([len(one) for one in ids])]).astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            new = {out: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))}
            if decoded:
                new[decoded] = pa.array([codec.decode(one) for one in ids], pa.string())
            yield with_columns(batch, **new)

    kinds = {out: "array<int>"} | ({decoded: "string"} if decoded else {})
    return docs.mapInArrow(run, schema_with(docs, **kinds))


def decode_pieces(docs: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text that each row's ``ids`` stand for in ``out``.

    Control ids stand for nothing, byte ids for their bytes (what is no UTF-8
    becomes U+FFFD). Null or empty ids give an empty text.
    """
    spark = ready(docs.sparkSession)
    held = broadcast_file(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(held)
        for batch in batches:
            column = batch.column(ids)
            values = column.values.to_numpy(zero_copy_only=False)
            bounds = column.offsets.to_numpy()
            lacks = column.is_null().to_pylist()
            texts = [
                "" if lack else codec.decode(values[b:e]) for lack, b, e in zip(lacks, bounds, bounds[1:])
            ]
            yield with_columns(batch, **{out: pa.array(texts, pa.string())})

    return docs.mapInArrow(run, schema_with(docs, **{out: "string"}))


def piece_report(docs: DataFrame, model: str) -> DataFrame:
    """Per document: ids and their checksum, and whether decoding them gives the text back."""
    told = encode_pieces(docs.select("doc_id", "text"), model, decoded="decoded")
    return told.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_ids"),
        F.crc32(F.encode(F.array_join("ids", ","), "UTF-8")).alias("ids_crc32"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )
