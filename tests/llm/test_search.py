"""Ranked lexical search: term-owner stages against a plain Python scorer and the DuckDB form."""

import math
import re
from collections import Counter

import duckdb
import pytest

from promptmill.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=50):
    """(item_id, rank, doc_id, score) with each row of docs a document."""
    bags = [Counter(words(t)) for _, t in docs]
    sizes = [sum(b.values()) for b in bags]
    big_n, big_l = sum(1 for n in sizes if n), sum(sizes)
    df = Counter(t for b in bags for t in b)
    out = []
    for at, (item, text) in enumerate(items):
        scores = []
        for row, ((doc, _), bag, n) in enumerate(zip(docs, bags, sizes)):
            m = 50 + (50 * n * big_n) // big_l if big_l else 0
            score = sum(
                math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in set(words(text)) if bag[t]
            )
            if score > 0:
                scores.append((-score, doc if doc is not None else float("inf"), row, doc, score))
        for rank, (_, _, _, doc, score) in enumerate(sorted(scores)[:top], 1):
            out.append((at, (item, rank, doc, score)))
    return [r for _, r in sorted(out, key=lambda r: (r[0], r[1][1]))]


ODD_DOCS = [
    (1, "The cat sat on the MAT."), (2, "the the the the dog"), (3, None), (4, ""), (5, "!!! ???"),
    (6, "cat cat cat mat mat dog bird"), (7, "Über straße CAT"), (8, "The cat sat on the MAT."), (8, "cat"),
    (None, "cat mat"), (9, "x" * 3000 + " cat"), (10, " ".join(["word"] * 4000) + " dog"),
] + [(100 + i, f"filler{i} the cat") for i in range(70)]
ODD_ITEMS = [(1, "the CAT"), (2, "dog bird"), (3, None), (4, "nothing here matches"), (None, "mat"), (5, "straße"), (5, "über")]


@pytest.mark.parametrize("small", [False, True])
def test_against_plain_python(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(lexical_search, "DOCS_PER_SLICE", 7)
        monkeypatch.setattr(lexical_search, "ITEMS_PER_BLOCK", 2)
        monkeypatch.setattr(lexical_search, "OWNERS", 3)
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in ODD_DOCS], "doc_id long, text string, row int, term string")
    items = spark.createDataFrame([(i, t, "y") for i, t in ODD_ITEMS], "item_id long, text string, score string")
    got = [tuple(r) for r in lexical_search.search_report(docs, items).collect()]
    key = lambda r: (r[0] if r[0] is not None else -1, r[1], r[3], r[2] if r[2] is not None else -1)
    assert sorted(got, key=key) == sorted(brute(ODD_DOCS, ODD_ITEMS), key=key)


def test_pruned_bundles_keep_the_best(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "OWNERS", 3)
    docs = [(i, " ".join(f"w{(i * k) % 17}" for k in range(1, 4 + i % 9)) + (" rare" if i % 23 == 0 else "")) for i in range(400)]
    items = [(1, "rare w1 w2 w3"), (2, "w5 w7 rare"), (3, "w0")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(tuple(r) for r in lexical_search.search(df, spark.createDataFrame(items, "item_id long, text string"), top=3).collect())
    assert got == sorted(brute(docs, items, top=3))


def test_whole_table_against_sql(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "DOCS_PER_SLICE", 150)
    monkeypatch.setattr(lexical_search, "ITEMS_PER_BLOCK", 16)
    sf = "/root/testdata/sf0.01"
    got = lexical_search.search_report(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    want = sorted(db.sql(lexical_search.SEARCH_SQL).fetchall())
    assert sorted(tuple(r) for r in got.collect()) == want


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "cat")], "item_id long, text string")
    assert lexical_search.search_report(docs, items).count() == 0
    assert lexical_search.search_report(spark.createDataFrame([(1, "cat")], "doc_id long, text string"), items.limit(0)).count() == 0
