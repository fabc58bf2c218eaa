"""The whole pipeline against its stages in plain Python."""

import collections
import re

import corpus_pipeline
import pytest
import sentencepiece

from promptmill.llm.shared import tokenizer_path
from tests.llm.test_filters import brute_lines
from tests.llm.test_pairs import brute_classes, brute_passages

WORDS = {"en": "the of and thing house water stone river", "de": "der die das über straße haus stein fluss"}


@pytest.fixture
def corpus(spark, tmp_path):
    import random

    rnd = random.Random(11)
    sentence = lambda lang, n: " ".join(rnd.choice(WORDS[lang].split()) + str(rnd.randrange(400)) for _ in range(n))
    texts = []
    for i in range(90):
        lang = rnd.choice(["en", "de"])
        texts.append([lang, "\n".join(sentence(lang, 9) for _ in range(4))])
    items = [(0, sentence("en", 30)), (1, sentence("de", 8)), (2, None)]
    texts += [["en", f"{sentence('en', 12)} {items[0][1]} {sentence('en', 5)}"] for _ in range(4)]
    texts += [["en", texts[5][1]] for _ in range(3)] + [["en", texts[6][1] + " end"] for _ in range(3)]
    for i in range(20, 35):
        texts[i][1] += "\nShared Line of all"
    texts += [["en", None], ["en", ""], ["en", "123 !!"], [None, "the house of stone"]]
    rows = [(i, t, lang, "src", len(t or "")) for i, (lang, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows, items


def test_pipeline(spark, corpus):
    path, rows, items = corpus
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    left = [(i, t) for i, t, *_ in rows if t and re.search(r"[^\W\d_]", t)]
    lines = [(i, t) for i, _, dropped, t in brute_lines(left, 10, keep_first=True) if t or not dropped]
    classes = brute_classes(lines)
    once = [(i, t) for i, t in lines if classes[i] == i]
    hits = brute_passages(once, items)
    clean = {i: t for i, t in once if not hits[i][-1]}
    assert set(found) == set(clean) and len(clean) > 60
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    for i, text in clean.items():
        assert found[i].ids == library.encode(text) and found[i].round_trip and found[i].n_chars == len(text)


def test_stages_keep_the_columns(spark, corpus):
    path, *_ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), path).count() == 0


def test_registered_queries():
    import __spark_entry__ as entry

    names = collections.Counter(re.match(r"op(\d+)_|pipeline", n).group() for n in entry.queries() if n.startswith(("op", "pipe")))
    assert names == collections.Counter([*(f"op{n}_" for n in range(1, 14)), "pipeline"])
    assert set(entry.oracle_sql()) <= set(entry.queries())
