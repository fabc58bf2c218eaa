"""Benchmark passages in documents: a prefix-filtered set join, all in DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.llm.shared import broadcast_if_small
from promptmill.workspace import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words once A-Z are in lower case.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3
#: Benchmark shingles or windows are broadcast up to so many rows, and joined by shuffle beyond it.
MAX_BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case; null and empty texts have none."""
    plain = F.length(text) == F.octet_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), NO_WORD), "")


def _shingle(words: Column, at: Column, size: int) -> Column:
    """A hash of ``size`` words from ``at`` on (0 is the first)."""
    return F.xxhash64(F.lit(size), *(F.get(words, at + i) for i in range(size)))


def _windows(benchmark: DataFrame, window: int) -> DataFrame:
    """Distinct windows: ``window`` (its words) and ``items`` (the ids of those that hold it, as sorted strings)."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    each = words.where(F.size("words") > 0).select("item", "words", F.explode(starts).alias("start"))
    cut = each.select("item", F.slice("words", F.col("start"), F.lit(window)).alias("window"))
    return cut.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _with_shingles(windows: DataFrame) -> DataFrame:
    """A row for each shingle of each window: its hash and its offset in the window."""
    sizes = {size: F.size("window") >= size for size in range(SHINGLE, 0, -1)}
    place = F.posexplode("window").alias("offset", "word")
    spread = windows.select("window", "items", place)
    size = F.least(F.size("window"), F.lit(SHINGLE))
    inside = F.col("offset") + size <= F.size("window")
    code = F.coalesce(
        *(F.when(fits, _shingle(F.col("window"), F.col("offset"), n)) for n, fits in sizes.items())
    )
    return spread.where(inside).select("window", "items", "offset", code.alias("code"))


def _positions(docs: DataFrame, sizes: Sequence[int], text: str) -> DataFrame:
    """A row for each word of each text: ``digest`` of the text, ``words``, ``at``, and the ``code`` of the shingle there."""
    split = docs.where(F.length(text) > 0).select(
        F.md5(F.encode(text, "UTF-8")).alias("digest"), words_of(F.col(text)).alias("words")
    )
    each = split.select("digest", "words", F.posexplode("words").alias("at", "word"))
    codes = [_shingle(F.col("words"), F.col("at"), size) for size in sizes]
    code = codes[0] if len(codes) == 1 else F.explode(F.array(*codes))
    return each.select("digest", "words", "at", code.alias("code"))


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """For each distinct text that holds a benchmark window: ``digest``, ``places`` and ``items``.

    ``digest`` is the MD5 of the text, ``places`` the distinct (begin, length) of
    windows in words, ``items`` the distinct ids as sorted strings.

    A window of n shingles is contained if all n are, so by the prefix filter one
    of them is enough to look for: the rarest. Occurrences of every benchmark
    shingle are counted over all documents, each window is indexed by its rarest
    one, and a document position with that shingle is a candidate. A candidate
    has to leave room for the window before and behind (positions) within the
    text (length); then all words are compared.
    """
    shingled = materialize(_with_shingles(_windows(benchmark, window)), "benchmark-shingles")
    n_rows = shingled.count()
    small = n_rows <= MAX_BROADCAST_ROWS
    hint = F.broadcast if small else (lambda df: df)
    sizes = sorted({row.size for row in shingled.select(F.least(F.size("window"), F.lit(SHINGLE)).alias("size")).distinct().collect()})
    if not sizes:
        kind = "digest string, places array<struct<begin: int, length: int>>, items array<string>"
        return docs.sparkSession.createDataFrame([], kind)
    positions = _positions(docs, sizes, text)
    counts = positions.select("code").join(hint(shingled.select("code").distinct()), "code").groupBy("code").count()
    counts = materialize(counts, "shingle-counts")
    least = F.min(F.struct(F.col("count"), F.col("offset"), F.col("code"))).alias("least")
    index = shingled.join(hint(counts), "code").groupBy("window", "items").agg(least, F.count("*").alias("n"))
    # a shingle without a count occurs nowhere, and neither does a window that has one
    whole = F.size("window") - F.least(F.size("window"), F.lit(SHINGLE)) + 1
    index = index.where(F.col("n") == whole).select(
        "window", "items", F.size("window").alias("length"), F.col("least.offset").alias("offset"),
        F.col("least.code").alias("code"),
    )
    begin = F.col("at") - F.col("offset")
    if small:
        asked, held = positions, F.slice("words", begin + 1, F.col("length"))
        room = (begin >= 0) & (begin + F.col("length") <= F.size("words"))
    else:
        # beyond a broadcast, rows are shuffled: only the words a window may reach go along
        first = F.greatest(F.col("at") - (window - 1), F.lit(0))
        asked = positions.select(
            "digest", "at", "code", first.alias("first"), F.slice("words", first + 1, F.lit(2 * window)).alias("near")
        )
        held = F.slice("near", begin - F.col("first") + 1, F.col("length"))
        room = (begin >= 0) & (begin + F.col("length") <= F.col("first") + F.size("near"))
    found = asked.join(hint(index), "code").where(room).where(held == F.col("window"))
    return found.groupBy("digest").agg(
        F.collect_set(F.struct(begin.alias("begin"), F.col("length"))).alias("places"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def _covered(places: Column) -> Column:
    """How many words lie in at least one place."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def add(done: Column, place: Column) -> Column:
        end = place["begin"] + place["length"]
        fresh = F.greatest(end - F.greatest(place["begin"], done["end"]), F.lit(0))
        return F.struct(F.greatest(done["end"], end).alias("end"), (done["n"] + fresh).alias("n"))

    return F.aggregate(F.array_sort(places), zero, add, lambda done: done["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items (sorted ids, comma-joined) and contaminated.

    Words are runs of characters other than ASCII ones that are no letter or
    digit, A-Z in lower case. A window is ``window`` consecutive words of an item,
    or all words of a shorter one. ``n_hit`` counts the words of a text in any
    occurrence of any window. Null or empty texts and items have no words; an
    item without id hits but is not named. Repeated rows get the same result,
    other columns stay, columns of the five names are replaced. Empty tables give
    no hits.

    Hits are found per distinct text, written, and joined to the rows by digest,
    where Spark can split the rows of a text with many copies.
    """
    hits = materialize(find_passages(docs, benchmark, window, text), "passages")
    hits = hits.withColumnRenamed("digest", "__hit")
    new = ("n_words", "n_hit", "n_items", "items", "contaminated")
    others = [name for name in docs.columns if name not in new]
    rows = docs.withColumn("__digest", F.md5(F.encode(text, "UTF-8")))
    rows = rows.withColumn("__words", F.size(words_of(F.col(text))).cast("bigint"))
    joined = rows.join(hits.withColumnRenamed("items", "__items"), F.col("__digest") == F.col("__hit"), "left")
    hit = F.coalesce(_covered(F.col("places")), F.lit(0).cast("bigint"))
    names = F.coalesce("__items", F.array().cast("array<string>"))
    return joined.select(
        *others,
        F.col("__words").alias("n_words"),
        hit.alias("n_hit"),
        F.size(names).cast("bigint").alias("n_items"),
        F.array_join(names, ",").alias("items"),
        (hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without any benchmark window, columns as they are."""
    hits = find_passages(docs, benchmark, window, text).select(F.col("digest").alias("__hit"))
    hits = broadcast_if_small(materialize(hits, "passages"))
    return docs.join(hits, F.md5(F.encode(text, "UTF-8")) == F.col("__hit"), "left_anti")


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    told = contamination(docs.select("doc_id", "text"), benchmark)
    return told.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated")


#: The same in SQL: every window of every document against every window of every item.
CONTAMINATION_SQL = rf"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, array_to_string(words[start : start + 9], ' ') AS held, least(len(words), 10) AS size
    FROM (SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS start
        FROM item_words WHERE len(words) > 0)
), doc_windows AS (
    SELECT doc_id, size, start, array_to_string(words[start : start + size - 1], ' ') AS held
    FROM (SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS start
        FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)
), found AS (
    SELECT doc_id, start, doc_windows.size AS size, item_id FROM doc_windows JOIN windows USING (held, size)
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(start, start + size - 1)) AS place FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
    FROM found GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
