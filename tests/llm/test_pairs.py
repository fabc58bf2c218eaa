"""URL rules, benchmark passages and near duplicates: against plain Python, with odd rows and hot groups."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from promptmill.llm import components, decontaminate, near_dup, url_rules
from promptmill.llm.url_rules import UrlRule

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- URLs ---

URLS = [
    None, "", "no scheme", "http://example.com", "http://Example.COM/", "https://a.example.com/en/x?y#z",
    "https://www.example.com/en/", "http://www.example.com/fr/", "https://x.net/es/1", "https://net/fr/2", "https://net/de/",
    "http://notexample.com/en/", "http://spam-farm.org/", "http://my-spam-farm.org/", "http://x.org/casino/1",
    "http://x.org/casinos/", "http://x.org/a?u=http://spam-farm.org/", "://ads.org/x", "http://é.org/é/", "a://b://c/d",
    "http://x.org/sex-education/porn/", "ftp://u:p@h.net:80/es/",
]


def brute_url(url, rules):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (low(match.group(1)), match.group(2)) if match else ("", "")
    base = [r for r in rules if r.kind == "host" and path.startswith(r.path) and (host == r.host or host.endswith("." + r.host))]
    if base:
        best = max(base, key=lambda r: len(r.text))
        return host, path, best.text, best.verdict
    fits = {r.verdict for r in rules if r.kind == "pattern" and url is not None and re.search(r.regex, low(url))}
    return host, path, None, min(fits, default="allow")


@pytest.mark.parametrize("broadcast", [True, False])
def test_urls(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(url_rules, "MAX_BROADCAST_RULES", 0)
    rules = url_rules.BASE_RULES + url_rules.PATTERN_RULES + (UrlRule("block", "x.org/ca"), UrlRule("block", "*b://*", "pattern"))
    rows = [(i, u, "mine") for i, u in enumerate(URLS + URLS[5:7] * 20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    found = url_rules.judge_urls(pages, rules)
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = {r.page_id: tuple(r)[2:] for r in found.collect()}
    assert got == {i: brute_url(u, rules) for i, u, _ in rows}
    assert url_rules.url_report(pages.limit(0)).count() == 0


def test_rules_stand_under_their_rarest_token(spark):
    urls = spark.createDataFrame([("http://a.com/x",), ("http://b.com/x",), ("http://b.com/y",)], "url string")
    rules = [UrlRule("block", "b.com/x/"), UrlRule("block", "||a.", "pattern"), UrlRule("block", "*x*", "pattern")]
    tokens = {r.number: r.token for r in url_rules.rule_index(urls, rules).collect()}
    assert tokens == {0: "b", 1: "a", 2: ""}
    assert rules[0].tokens == ["b", "com", "x"] and UrlRule("block", "b.com/x").tokens == ["b", "com"]


def test_plans_have_no_python(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    for df in (url_rules.url_report(pages), decontaminate.contamination_report(docs, docs.withColumnRenamed("doc_id", "item_id"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# --- benchmark passages ---

def brute_passages(docs, items, window=10):
    cut = {}
    for item_id, text in items:
        words = WORD.findall(low(text))
        for i in range(max(1, len(words) - window + 1)):
            if words:
                cut.setdefault(tuple(words[i: i + window]), set()).add(item_id)
    sizes = {len(w) for w in cut}
    out = {}
    for doc_id, text in docs:
        words, hit, found = WORD.findall(low(text)), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                held = cut.get(tuple(words[i: i + size]))
                if held is not None:
                    hit.update(range(i, i + size))
                    found |= {str(h) for h in held if h is not None}
        names = ",".join(sorted(found))
        out[doc_id] = (len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit))
    return out


def passage_tables(spark, seed=3):
    rnd = random.Random(seed)
    vocabulary = ["a", "b", "c", "Éa", "éa", "x1"]
    text = lambda n: " ".join(rnd.choice(vocabulary) + rnd.choice(["", "", ",", "\n"]) for _ in range(n))
    items = [(i, text(rnd.choice([0, 1, 2, 3, 9, 10, 11, 25]))) for i in range(40)] + [(7, text(14)), (50, None), (None, text(12))]
    items += [(60, items[3][1]), (61, "solo")]
    docs = [(i, text(rnd.randrange(60))) for i in range(60)]
    docs += [(100 + i, text(5) + " " + (rnd.choice(items)[1] or "").upper() + " " + text(5)) for i in range(60)]
    docs += [(200, None), (201, ""), (202, items[5][1]), (203, "solo"), (204, " ".join(["a"] * 4000))]
    docs += [(300 + i, docs[70][1]) for i in range(50)]
    return docs, items


@pytest.mark.parametrize("broadcast", [True, False])
def test_passages(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "MAX_BROADCAST_ROWS", 0)
    docs, items = passage_tables(spark)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id: tuple(r)[1:] for r in decontaminate.contamination_report(table, benchmark).collect()}
    assert found == brute_passages(docs, items)
    clean = {r.doc_id for r in decontaminate.decontaminate(table, benchmark).collect()}
    assert clean == {i for i, row in found.items() if not row[-1]}


def test_long_items_only(spark):
    docs, items = passage_tables(spark, 8)
    items = [(i, t) for i, t in items if t and len(t.split()) >= 10]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id: tuple(r)[1:] for r in decontaminate.contamination_report(table, benchmark).collect()}
    assert found == brute_passages(docs, items)


def test_passages_take_odd_rows(spark, odd, none):
    benchmark = spark.createDataFrame([(1, "word word word"), (2, None)], "item_id long, text string")
    found = decontaminate.contamination(odd.withColumn("items", F.lit(3)), benchmark)
    assert found.count() == odd.count() and dict(found.dtypes)["items"] == "string"
    assert {r.doc_id for r in found.where("contaminated").collect()} == {10}
    assert decontaminate.contamination_report(none, benchmark).count() == 0
    empty = decontaminate.contamination(odd, benchmark.limit(0))
    assert empty.where("contaminated").count() == 0 and empty.count() == odd.count()
    assert decontaminate.decontaminate(odd, benchmark.limit(0)).count() == odd.count()


# --- near duplicates ---

def shingles(text):
    words = WORD.findall(low(text))
    return frozenset(zip(*(words[i:] for i in range(5)))) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute_classes(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def head(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                label[head(i)] = head(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[head(i)] = min(least.get(head(i), key), key)
    return {key: least[head(i)] for i, (key, _) in enumerate(rows)}


def near_rows(n_groups=6, copies=40, seed=1):
    """Groups that grow by edits of edited texts, so that their ends only hang together through others."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    rows = []
    for g in range(n_groups):
        texts = [[word() for _ in range(rnd.choice([12, 60, 150]))]]
        for _ in range(copies):
            text = list(rnd.choice(texts))
            for _ in range(rnd.choice([0, 1, 1, 2, 4])):
                text[rnd.randrange(len(text))] = word()
            texts.append(text)
        rows += [" ".join(t) for t in texts]
    rows += [None, "", "?!", "one", "One.", "two words", "two words!"] + [" ".join(word() for _ in range(40)) for _ in range(60)]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [(20_000, 400_000), (1500, 1500), (300, 2000)])
def test_classes(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", block)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.class_id for r in near_dup.near_duplicate_report(docs).collect()}
    assert found == brute_classes(rows)
    kept = {r.doc_id for r in near_dup.keep_one_of_each(docs).collect()}
    assert kept == {key for key, name in found.items() if key == name}


def test_classes_take_odd_rows(spark, odd, none):
    found = near_dup.near_duplicate_report(odd)
    rows = collections.Counter((r.doc_id, r.class_id) for r in found.collect())
    assert sum(rows.values()) == odd.count()
    assert rows[(3, 3)] == 2 and rows[(4, 3)] == 1 and rows[(0, 0)] == 1 and rows[(None, None)] == 1
    kept = near_dup.keep_one_of_each(odd.withColumn("class_id", F.lit("mine")))
    assert kept.columns == [*odd.columns, "class_id"]
    keys = collections.Counter(r.doc_id for r in kept.collect())
    assert keys[3] == 1 and keys[4] == 0 and keys[None] == 1
    assert near_dup.near_duplicate_report(none).count() == 0
    assert near_dup.keep_one_of_each(none).count() == 0


def test_copies_without_words_fall_together(spark):
    texts = ["?!", "-----", "?!", "-----", " ?!", None, "", "", " \n", " \n", "-----", "one word"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.class_id for r in near_dup.near_duplicate_report(docs).collect()}
    assert found == {i: i for i in range(12)} | {2: 0, 3: 1, 10: 1}
    assert {r.doc_id for r in near_dup.keep_one_of_each(docs).collect()} == set(range(12)) - {2, 3, 10}


def test_counted_classes_go_by_occurrences(spark):
    once = [f"w{i}" for i in range(100)]
    loop = [f"v{i}" for i in range(10)]
    texts = [once + loop * 2, once + loop * 20, once + loop * 22, once + loop * 2 + ["end"]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    classes = lambda counted: {r.key: r.class_id for r in near_dup.near_duplicate_classes(docs, counted=counted).collect()}
    assert set(classes(False).values()) == {0}
    assert classes(True) == {0: 0, 1: 1, 2: 1, 3: 0}


def test_repeated_and_missing_keys_cost_no_text(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, "a copy of one"), (2, "a copy of one"), (2, "another text"), (3, long), (3, long + " more"), (3, long),
        (4, "a text with a key"), (None, "a text with a key"), (None, "one without"), (None, "one without"), (None, "One without!"),
        (None, None), (None, None), (5, None), (6, ""), (7, "first under seven"), (7, "second under seven"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = collections.Counter((r.doc_id, r.text) for r in near_dup.keep_one_of_each(docs).collect())
    either = [n for row, n in kept.items() if row in {(3, long), (3, long + " more")}]
    neither = [n for row, n in kept.items() if row in {(None, "one without"), (None, "One without!")}]
    assert either == [1] and neither == [1]
    for row in [(1, "a copy of one"), (2, "another text"), (4, "a text with a key"), (5, None), (6, ""), *rows[-2:]]:
        assert kept.pop(row) == 1, row
    assert kept.pop((None, None)) == 2
    assert sum(kept.values()) == 2


def test_darts_estimate_the_weighted_similarity():
    rnd = np.random.default_rng(5)
    elements = rnd.integers(1, 1 << 62, 300).astype(np.uint64)
    weights = rnd.choice([1, 1, 2, 5, 40], (2, 300))
    weights[1, :150] = weights[0, :150]
    weights[0, 200:230], weights[1, 230:260] = 0, 0
    owner, place = np.nonzero(weights)
    signs = near_dup.dart_minhash(owner, elements[place], weights[owner, place], 2, 4000)
    wanted = np.minimum(*weights).sum() / np.maximum(*weights).sum()
    assert abs((signs[0] == signs[1]).mean() - wanted) < 0.03


def test_darts_do_not_depend_on_the_batch():
    rnd = np.random.default_rng(6)
    sets = [rnd.integers(1, 1 << 62, n).astype(np.uint64) for n in (1, 3, 50, 700)]
    owner = np.repeat(np.arange(4), [len(s) for s in sets])
    together = near_dup.dart_minhash(owner, np.concatenate(sets), np.ones(len(owner)), 4, 125)
    for i, one in enumerate(sets):
        alone = near_dup.dart_minhash(np.zeros(len(one), int), one, np.ones(len(one)), 1, 125)
        assert (alone[0] == together[i]).all() and (alone != 0).all()
    assert near_dup.dart_minhash(np.zeros(0, int), np.zeros(0, np.uint64), np.zeros(0), 2, 125).shape == (2, 125)


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(110)] + [(i, i + 1) for i in range(300, 340)]
    label = {n: n for e in edges for n in e}
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.label for r in found.collect()} == label
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rules_with_capitals_and_clashing_columns(spark):
    rules = (
        UrlRule("block", "x.com/Foo/"), UrlRule("allow", "Example.COM/"), UrlRule("block", "/Porn/", "pattern"),
        UrlRule("block", "||Spam.", "pattern"),
    )
    rows = [
        (1, "http://x.com/Foo/a", ("x.com/Foo/", "block")), (2, "http://X.COM/foo/a", (None, "allow")),
        (3, "http://sub.EXAMPLE.com/z", ("Example.COM/", "allow")), (4, "http://y.org/PORN/1", (None, "block")),
        (5, "https://www.spam.net/", (None, "block")), (6, "http://y.org/pornography", (None, "allow")),
    ]
    pages = spark.createDataFrame([(i, u, "a", "b", "c") for i, u, _ in rows], "page_id long, url string, `__url` string, `__at` string, `a.b` string")
    found = url_rules.judge_urls(pages, rules)
    assert found.columns == ["page_id", "url", "__url", "__at", "a.b", "host", "path", "rule", "verdict"]
    got = {r.page_id: (r.rule, r.verdict, r["__url"], r["a.b"]) for r in found.collect()}
    assert got == {i: (*want, "a", "c") for i, _, want in rows}
