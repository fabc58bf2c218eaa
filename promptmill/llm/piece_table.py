"""Token ids of a column of texts: a slice is cut, looked up and joined in arrays, each distinct piece encoded once.

Texts are cut ahead of the last character of every run of white space and, if
there is more, ahead of the run; a run at the end stays whole. A piece is white
space alone, or a white character or nothing, a word or other characters, and
stops or nothing; these parts are kept in a table by their text, a space with
what follows it. Texts with special tokens go through ``PieceEncoder``.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from promptmill.llm.pieces import BATCH_CHARS, STOPS, PieceEncoder

#: Stands where a text is cut.
CUT = "\x02"
#: What the library's word pattern takes as white space.
WHITE = " \t\n\x0b\x0c\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"
#: Characters of texts that are not cut here: the mark, and controls some libraries count as white space.
NOT_CUT = CUT + "\x1c-\x1f\u180e"
#: White space other than spaces and line ends, or more of these than are right when each is cut off.
RUNS = f"[{WHITE[1]}{WHITE[3:]}]|[ \n]{{3}}|[ \n]{{2}}\\z"
#: A run at the end of a text, or another run's last character and what stands ahead of it.
RUN = f"([{WHITE}]+)\\z|([{WHITE}]*)([{WHITE}])"
#: A longer text (bytes) is not cut in one array.
LONGEST = 1 << 29
#: Bytes of parts and ids remembered from slice to slice.
REMEMBERED_BYTES = 48 << 20


def gather(flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` one behind the other, and where each ends."""
    ends = np.cumsum(length)
    at = np.repeat(begin - (ends - length), length)
    at += np.arange(len(at))
    return flat[at], ends


class PieceTable:
    """Called with a column of texts, gives each one's ids as little-endian unsigned 32-bit integers.

    ``others`` is an encoder of the same file that gives such bytes; it takes the
    texts that are not cut here. The table holds parts of pieces as one array of
    texts and one of all their ids. When it is full, only the parts of the last
    slice are kept.
    """

    def __init__(self, tokenizer_json: str, others: PieceEncoder, remembered: int = REMEMBERED_BYTES):
        self.others, self.remembered = others, remembered
        self.by_piece = self.others.by_piece and self.others.line_end is not None
        if self.by_piece:
            rules = json.loads(tokenizer_json)
            special = [re.escape(token["content"]) for token in rules.get("added_tokens", []) if token["content"]]
            self.not_cut = "|".join([f"[{NOT_CUT}]", *special])
            vocab = rules["model"]["vocab"]
            space = self.others.letters[ord(" ")]
            self.opens = np.zeros(max(vocab.values()) + 1, bool)
            self.opens[[number for piece, number in vocab.items() if piece.startswith(space)]] = True
        self._forget()

    def _forget(self) -> None:
        self.parts = pa.array([], pa.string())
        self.flat = np.empty(0, "<u4")
        self.begin = self.length = np.empty(0, np.int64)

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """One result per text, in order; a null text has no ids."""
        texts = pc.fill_null(texts, "")
        if not self.by_piece:
            return self.others(texts.to_pylist())
        other = pc.or_(pc.match_substring_regex(texts, self.not_cut), pc.greater(pc.binary_length(texts), LONGEST))
        runs = pc.and_not(pc.match_substring_regex(texts, RUNS), other)
        kinds = (pc.invert(pc.or_(other, runs)), self._plain), (runs, self._with_runs), (other, self._other)
        results: list = [b""] * len(texts)
        for mask, encode in kinds:
            rows = np.flatnonzero(mask.to_numpy(zero_copy_only=False))
            if len(rows):
                these = texts if len(rows) == len(texts) else texts.take(pa.array(rows))
                for row, ids in zip(rows.tolist(), encode(these)):
                    results[row] = ids
        return results

    def _other(self, texts: pa.Array) -> list[bytes]:
        return self.others(texts.to_pylist())

    def _plain(self, texts: pa.Array) -> list[bytes]:
        return self._join(pc.replace_substring(pc.replace_substring(texts, " ", CUT + " "), "\n", CUT + "\n"))

    def _with_runs(self, texts: pa.Array) -> list[bytes]:
        return self._join(pc.replace_substring_regex(texts, RUN, f"{CUT}\\1\\2{CUT}\\3"))

    def _join(self, marked: pa.Array) -> list[bytes]:
        cut = pc.split_pattern(marked.cast(pa.string()), CUT)
        coded = cut.flatten().dictionary_encode()
        flat, begin, length = self._pieces(coded.dictionary)
        which = coded.indices.to_numpy()
        ids, ends = gather(flat, begin[which], length[which])
        ends = (4 * ends[cut.offsets.to_numpy()[1:] - 1]).tolist()
        packed = ids.tobytes()
        return [packed[b:e] for b, e in zip([0, *ends], ends)]

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces: all of them, where each piece's begin, and how many it has."""
        body = pc.utf8_ltrim(pieces, WHITE)
        white = pc.equal(pc.binary_length(body), 0)
        spaced = pc.starts_with(pieces, " ")
        led = pc.and_not(pc.less(pc.binary_length(body), pc.binary_length(pieces)), pc.or_(white, spaced))
        lead = pc.utf8_slice_codeunits(pieces.filter(led), 0, 1)
        word = pc.ascii_rtrim(body, STOPS)
        is_word = pc.utf8_is_alpha(word)
        stopped = pc.and_(is_word, pc.less(pc.binary_length(word), pc.binary_length(body)))
        stops = pc.struct_field(pc.extract_regex(body.filter(stopped), f"(?P<stops>[{STOPS}]+)\\z"), "stops")
        main = pc.if_else(white, pieces, pc.if_else(is_word, word, body))
        main = pc.binary_join_element_wise(pc.if_else(pc.and_not(spaced, white), " ", ""), main, "")
        coded = pa.concat_arrays([pa.array([""]), main, lead, stops]).dictionary_encode()
        known = self._rows(coded.dictionary)
        rows = known[coded.indices.to_numpy()]
        parts = np.full((len(pieces), 3), rows[0])
        parts[led.to_numpy(zero_copy_only=False), 0] = rows[1 + len(pieces): 1 + len(pieces) + len(lead)]
        parts[:, 1] = rows[1: 1 + len(pieces)]
        parts[stopped.to_numpy(zero_copy_only=False), 2] = rows[1 + len(pieces) + len(lead):]
        flat, ends = gather(self.flat, self.begin[parts.ravel()], self.length[parts.ravel()])
        ends = ends[2::3]
        length = np.diff(ends, prepend=0)
        self._bound(coded.dictionary, known)
        return flat, ends - length, length

    def _rows(self, parts: pa.Array) -> np.ndarray:
        """Each distinct part's row of the table; parts that are not there are encoded and put at its end."""
        rows = pc.fill_null(pc.index_in(parts, self.parts), -1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(rows < 0)
        if not len(missing):
            return rows
        fresh = parts.take(pa.array(missing))
        spaced = pc.starts_with(fresh, " ").to_numpy(zero_copy_only=False)
        word = pc.utf8_is_alpha(pc.ascii_ltrim(fresh, " ")).to_numpy(zero_copy_only=False)
        white = pc.equal(pc.binary_length(pc.utf8_trim(fresh, WHITE)), 0).to_numpy(zero_copy_only=False)
        kinds = (
            (word & spaced, self._spaced_words),
            (word & ~spaced, lambda texts: self._by_lines(self.others.words, self.others._spelled("\n".join(texts)), texts)),
            (~word & ~white, lambda texts: self._by_lines(self.others.whole, "\n".join(texts), texts)),
            (white, self._singly),
        )
        order, flats, lengths, held = [], [self.flat], [self.length], len(self.parts)
        for mask, encode in kinds:
            where = np.flatnonzero(mask)
            order.append(where)
            these = fresh.take(pa.array(where))
            shares = np.cumsum(pc.binary_length(these).to_numpy(), dtype=np.int64) // BATCH_CHARS
            for share in np.split(np.arange(len(where)), np.flatnonzero(np.diff(shares)) + 1) if len(where) else ():
                flat, length = encode(these.slice(int(share[0]), len(share)).to_pylist())
                flats.append(flat)
                lengths.append(length)
        order = np.concatenate(order)
        rows[missing[order]] = held + np.arange(len(order))
        self.parts = pa.concat_arrays([self.parts, fresh.take(pa.array(order))])
        self.flat, self.length = np.concatenate(flats), np.concatenate(lengths)
        self.begin = np.cumsum(self.length) - self.length
        return rows

    def _bound(self, parts: pa.Array, rows: np.ndarray) -> None:
        """Keep a full table to the parts of one slice, or to none if these alone are too many."""
        if self._bytes() > self.remembered:
            self.flat, ends = gather(self.flat, self.begin[rows], self.length[rows])
            self.parts, self.length = parts, self.length[rows]
            self.begin = ends - self.length
            if self._bytes() > self.remembered:
                self._forget()

    def _bytes(self) -> int:
        return self.parts.nbytes + self.flat.nbytes + self.begin.nbytes + self.length.nbytes

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _spaced_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Runs of letters behind a space as one text; a token that begins with a space begins a run."""
        ids = self._ids(self.others.words, self.others._spelled("".join(texts)))
        begins = np.flatnonzero(self.opens[ids])
        if len(begins) != len(texts) or begins[0]:
            return self._singly(texts)
        return ids, np.diff(begins, append=len(ids))

    def _by_lines(self, tokenizer, text: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Texts without white space between line ends, each of which is a token of its own."""
        ids = self._ids(tokenizer, text)
        ends = np.flatnonzero(ids == self.others.line_end)
        if len(ends) != len(texts) - 1:
            return self._singly(texts)
        return np.delete(ids, ends), np.diff(ends, prepend=-1, append=len(ids)) - 1

    def _singly(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.others.whole.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], "<u4"), np.array([len(ids) for ids in found], np.int64)
