"""SentencePiece, token files and token counts against the libraries themselves."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import zstandard
from tokenizers import Tokenizer

from promptmill.llm import piece_table, pieces, spm, token_files
from promptmill.llm.token_counts import count_tokens, token_count_report
from promptmill.workspace import fresh_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RAW = open(PIECES, "rb").read()


def random_texts(n, seed=1, longest=40):
    rnd = random.Random(seed)
    units = list("abeinrst.,;'! \n\t\r\xa0éß12<|#　\x1c中🙂") + ["  ", "<|endoftext|>", " the", "n't", "'re", "tion", "▁"]
    return ["".join(rnd.choice(units) for _ in range(rnd.randrange(longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def test_pieces_add_up_to_the_library(library, monkeypatch):
    monkeypatch.setattr(pieces, "LONG_TEXT", 16)
    monkeypatch.setattr(pieces.spans_of, "__defaults__", (16,))
    monkeypatch.setattr(pieces, "BATCH_CHARS", 200)
    encode = pieces.PieceEncoder(open(BYTE_BPE).read(), lambda e: list(e.ids), lambda parts: sum(parts, []), remembered=60)
    texts = random_texts(4000)
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encode(texts) == wanted


def test_runs_of_letters_go_through_the_library_as_one_text(library):
    """Not a text each: the ids of one encoding are cut at the line ends between the words."""
    class Counted:
        def __init__(self, words):
            self.words, self.asked = words, []

        def encode_batch_fast(self, texts, **options):
            self.asked.append(len(texts))
            return self.words.encode_batch_fast(texts, **options)

    text = open(BYTE_BPE).read()
    encode = pieces.PieceEncoder(text, token_files._to_bytes, b"".join, measure_runs=token_files._bytes_of_runs)
    encode.words = Counted(encode.words)
    texts = ["", "one", "a" + "." * 50, "x" * 50 + ",", "the same words\nin lines, \u00fcber \u6f22\u5b57 \u00e9t\u00e9.\n\nthe", *random_texts(3000, seed=12)]
    found = encode(texts)
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == wanted
    assert encode.words.asked and max(encode.words.asked) == 1
    assert max(map(len, encode.young)) <= pieces.LONGEST_REMEMBERED


def spaced_texts(n, seed):
    rnd = random.Random(seed)
    units = [*"ab.,;'! \n12\u00e9\u6f22", " ", " ", "\n", " the", "'s", "!?", ". ", "Word", "\tx", "<|endoftext|>"]
    weights = [8] * (len(units) - 2) + [1, 1]
    return ["".join(rnd.choices(units, weights, k=rnd.randrange(25))) for _ in range(n)]


def test_texts_of_a_column_are_looked_up_in_arrays(library, monkeypatch):
    """No Python lookup for each piece: the encoder by pieces is not asked, and the library gets many parts at a time."""
    class Held:
        value = open(BYTE_BPE, "rb").read()

    monkeypatch.setattr(pieces.PieceEncoder, "__call__", None)
    texts = ["", "one", " ", "\n\n\n", "a\t\tb.\r\n\r\n    if c:\xa0d\u3000 e   \n", " two,\n\nthree  four.\n", "\nfive!? 'tis \u00fcber-6f22\u6f22 ", *(f"word{'abc'[i % 3] * (i % 50)}, and {i}\nThe." for i in range(3000))]
    found = token_files._encoder(Held)(pa.array([None, *texts]))
    assert found[0] == b""
    wanted = library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found[1:]] == [e.ids for e in wanted]


def test_table_of_parts_is_bounded_and_changes_nothing(library):
    """Texts with special tokens and without side by side; a full table is cut to the last slice or to nothing."""
    table = token_files._table(open(BYTE_BPE).read())
    asked, other = [], table._other
    table._other = lambda texts: asked.append(len(texts)) or other(texts)
    for remembered in (piece_table.REMEMBERED_BYTES, 30_000, 100):
        table.remembered = remembered
        for seed in range(5):
            texts = [*spaced_texts(800, seed), *random_texts(100, seed)]
            wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
            assert [np.frombuffer(ids, "<u4").tolist() for ids in table(pa.array(texts))] == wanted
            assert table._bytes() <= remembered
    assert 0 < sum(asked) < 0.6 * 15 * 900


def test_parts_the_library_does_not_part_are_encoded_singly(library):
    """If a joined text does not come apart in as many runs as words went in, each goes in by itself."""
    table = token_files._table(open(BYTE_BPE).read())
    table.opens[:] = False
    table.others.line_end = -1
    texts = ["some words here.\nAnd 12 more, it's all"] * 2
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in table(pa.array(texts, pa.large_string()))] == wanted


def test_only_plain_byte_files_are_cut():
    assert pieces.word_cut_allowed(open(BYTE_BPE).read())
    assert not pieces.word_cut_allowed(open(WORD_BPE).read())


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE, PIECES])
def test_counts(odd, path):
    found = count_tokens(odd, path)
    assert found.columns == odd.columns
    if path == PIECES:
        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda text: len(processor.encode(text))
    else:
        tokenizer = Tokenizer.from_file(path)
        count = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
    rows = found.collect()
    assert len(rows) == odd.count()
    for row in rows:
        assert row.n_tokens == count(row.text or ""), repr(row.text)[:60]


def test_count_report(odd, none):
    rows = {r.doc_id: r for r in token_count_report(odd, BYTE_BPE).collect()}
    assert rows[0].n_bytes == 0 and rows[0].n_tokens == 0 and not rows[0].over_limit
    assert rows[9].n_bytes == 5000 and rows[10].over_limit
    assert token_count_report(none, BYTE_BPE).count() == 0


def test_token_files_round_trip(spark, odd, library):
    digest = token_files.token_file_digest(odd, BYTE_BPE).collect()
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    at, wanted = 0, []
    for row in rows:
        ids = library.encode(row.text or "", add_special_tokens=False).ids + [0]
        wanted.append((row.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    found = sorted(map(tuple, digest), key=lambda r: r[1])
    assert found == wanted


def test_token_files_of_nothing(none):
    assert token_files.token_file_digest(none, BYTE_BPE).count() == 0


def test_one_document_from_many(spark, library):
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 50)) for i in range(400)], "doc_id long, text string")
    manifest = token_files.write_token_files(docs, BYTE_BPE, fresh_dir(spark, "tokens"))
    spark.conf.unset(coalesce)
    assert manifest.count() > 1
    rows = token_files.read_token_files(manifest, [7, 399, 1234]).collect()
    assert sorted(r.doc_id for r in rows) == [7, 399]
    for row in rows:
        ids = library.encode(f"text number {row.doc_id} " * (row.doc_id % 50), add_special_tokens=False).ids + [0]
        assert bytes(row.ids) == np.array(ids, "<u4").tobytes()


def make_file(texts, frame_bytes=64):
    out = io.BytesIO()
    writer = token_files.TokenFileWriter(out, frame_bytes)
    for i, ids in enumerate(texts):
        writer.add(i, np.array(ids, "<u4").tobytes())
    writer.close()
    return out.getvalue()


def test_file_layout_is_seekable_zstandard():
    texts = [list(range(n)) for n in (3, 0, 40, 5, 1)]
    data = make_file(texts)
    plain = b"".join(np.array(ids, "<u4").tobytes() for ids in texts)
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == plain
    reader = token_files.TokenFileReader(io.BytesIO(data), len(data))
    assert len(reader.sizes) > 3
    found = {int(i): d for part, ids in reader.documents() for i, d in zip(part, ids)}
    assert [len(found[i]) // 4 for i in range(5)] == [3, 0, 40, 5, 1]


def test_only_wanted_frames_are_read_and_checked():
    data = bytearray(make_file([list(range(40)), list(range(100, 160)), list(range(30))]))
    data[12] ^= 255  # inside the first frame
    reader = token_files.TokenFileReader(io.BytesIO(bytes(data)), len(data))
    last = np.array([False, False, True])
    assert [len(ids[0]) for _, ids in reader.documents(last)] == [120]
    with pytest.raises(Exception):
        list(reader.documents())


@pytest.fixture(scope="module")
def codec():
    return spm.PieceCodec(RAW)


def test_viterbi_gives_the_library_s_bpe(codec):
    library = codec.model.library
    for text in random_texts(2500, seed=5, longest=60):
        ids = library.encode(text)
        assert codec.encode(text).tolist() == ids, repr(text)
        assert codec.decode(np.array(ids, np.int32)) == library.decode(ids), repr(text)


def test_streaming_without_words(codec):
    """Whole texts through the window alone, fed in small parts."""
    for text in random_texts(300, seed=6, longest=200):
        normal = codec.model.library.normalize(text) if text else ""
        viterbi = spm.StreamingViterbi(codec.model)
        found = []
        for at in range(0, len(normal), 37):
            found += viterbi.feed(normal[at: at + 37])
            assert len(viterbi.text) <= 37 + 40 * codec.model.longest
        found += viterbi.finish()
        ids = [i for piece in found for i in codec.model.piece_ids(piece)]
        assert ids == (codec.model.library.encode(text) if text else [])


def test_window_stays_small(codec):
    viterbi, most = spm.StreamingViterbi(codec.model), 0
    for _ in range(200):
        viterbi.feed("theinstitutionalization" * 5)
        most = max(most, len(viterbi.text))
    assert most < 400


def test_unigram_model():
    """The same pieces as a unigram model: no way to cut a text has a higher sum of scores."""
    at = RAW.rindex(b"\x18\x02")  # the trainer's model type
    codec = spm.PieceCodec(RAW[:at] + b"\x18\x01" + RAW[at + 2:])
    assert codec.model.kind == spm.UNIGRAM
    scores, unknown = codec.model.scores, codec.model.unknown_score
    rnd = random.Random(3)
    words = [p.strip("▁") for p in rnd.sample(sorted(codec.model.ids), 3000)]
    for _ in range(150):
        text = " ".join("".join(rnd.sample(words, 2)) for _ in range(3))
        normal = codec.model.library.normalize(text)
        best = [0.0]
        for end in range(1, len(normal) + 1):
            cuts = [best[b] + scores[normal[b:end]] for b in range(end) if normal[b:end] in scores]
            best.append(max(cuts + [best[end - 1] + unknown] * (normal[end - 1] not in scores)))
        viterbi = spm.StreamingViterbi(codec.model)
        found = viterbi.feed(normal) + viterbi.finish()
        assert "".join(found) == normal
        assert sum(scores.get(p, unknown) for p in found) == best[-1]
        assert codec.encode(text).tolist() == [i for p in found for i in codec.model.piece_ids(p)]


def test_encode_and_decode_tables(odd, none):
    told = spm.decode_pieces(spm.encode_pieces(odd, PIECES, out="n_tokens"), PIECES, ids="n_tokens")
    assert told.columns == [*odd.columns, "decoded"]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for row in told.collect():
        assert row.n_tokens == library.encode(row.text or "")
        assert row.decoded == (row.text or "")
    assert spm.piece_report(none, PIECES).count() == 0
    both = spm.encode_pieces(odd, PIECES, decoded="a b")
    assert both.columns == [*odd.columns, "ids"] and all(r["a b"] == (r.text or "") for r in both.collect())
    assert all(r.round_trip for r in spm.piece_report(odd, PIECES).collect())


def test_short_words_are_searched_side_by_side(monkeypatch):
    """All words of a part that are not remembered are searched together, none by itself; the ids are the library's."""
    monkeypatch.setattr(spm, "SIDE_BY_SIDE", 100)
    codec, sp = spm.PieceCodec(RAW), sentencepiece.SentencePieceProcessor(model_proto=RAW)
    monkeypatch.setattr(spm, "StreamingViterbi", None)
    texts = ["", "\n", "a\n\nb. c", "\n.", "one, two.\nthree", "\u6f22\u5b57 \u00e9\U0001f642x. ", *random_texts(2000, seed=10, longest=25)]
    texts = [text for text in texts if all(len(word) < 30 for word in sp.normalize(text).replace("\u2581", " ").split(" "))]
    assert len(texts) > 1500
    for at in range(0, len(texts), 400):
        part = texts[at: at + 400]
        assert [ids.tolist() for ids in codec.encode_all(part)] == sp.encode(part)
    assert codec.young_bytes == sum(len(k) + len(v) + spm.WORD_OVERHEAD for k, v in codec.young.items())


def test_tables_of_steps_and_pairs_are_bounded_and_change_nothing(monkeypatch):
    """Numbers that push each other out of tiny tables, and forgotten words, give the same ids."""
    monkeypatch.setattr(spm, "TABLE_BITS", 5)
    monkeypatch.setattr(spm, "REMEMBERED_BYTES", 3000)
    codec, sp = spm.PieceCodec(RAW), sentencepiece.SentencePieceProcessor(model_proto=RAW)
    texts = random_texts(600, seed=11, longest=120)
    for at in range(0, len(texts), 60):
        part = texts[at: at + 60]
        assert [ids.tolist() for ids in codec.encode_all(part)] == sp.encode(part)
    assert len(codec.young) < 3000 and len(codec._words.apart.held) == 32 and len(codec._words.steps.held) == 8
    assert max(map(len, codec.young)) <= spm.LONGEST_REMEMBERED


def test_remembered_places_are_bounded_and_change_nothing(library, monkeypatch):
    """The pieces that end at a place come from remembered steps; dropping them again and again gives the same ids."""
    monkeypatch.setattr(spm, "REMEMBERED_PLACES", 50)
    monkeypatch.setattr(spm, "REMEMBERED_PAIRS", 50)
    small, sp = spm.PieceCodec(RAW), sentencepiece.SentencePieceProcessor(model_proto=RAW)
    for text in random_texts(300, seed=9, longest=70):
        assert small.encode(text).tolist() == sp.encode(text), repr(text)
        assert small.model.places <= 51 and len(small.model.known) <= 51


def test_ids_are_made_in_small_parts(spark, monkeypatch):
    """A worker holds ids, decoded texts and result batch of about a megabyte of text, not of eight."""
    sizes = []
    plain = spm.slices
    monkeypatch.setattr(spm, "slices", lambda batches, column, size=8 << 20: sizes.append(size) or plain(batches, column, size))

    class Frame:
        sparkSession, dtypes = spark, [("text", "string")]

        def mapInArrow(self, run, schema):
            import pyarrow as pa

            return list(run([pa.RecordBatch.from_pydict({"text": ["word " * 100_000] * 5})]))

    batches = spm.encode_pieces(Frame(), PIECES, decoded="decoded")
    assert sizes == [spm.PART_BYTES] and [b.num_rows for b in batches] == [2, 2, 1]
