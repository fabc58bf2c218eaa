"""Ranked lexical search: item bundles carry sparse document scores through term-owner stages, one cogroup each."""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promptmill.llm.shared import broadcast_if_small, ready
from promptmill.workspace import fresh_dir, materialize

# Fixed values of the contract: what a term is, the weight and the length norm.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 50

#: Term owners: stages a bundle goes through, each reading only the postings of its owner.
OWNERS = 4
#: Documents of one slice; a bundle holds the scores of one item in one slice.
DOCS_PER_SLICE = 5_000
#: Items whose bundles share one group of a stage; the postings of a slice go to each such block.
ITEMS_PER_BLOCK = 256


def terms(text) -> "F.Column":
    """The terms of a text, A-Z lower-cased; none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


def _add(key, bundles: pd.DataFrame, postings: pd.DataFrame, top: int = TOP) -> pd.DataFrame:
    """Bundles of one slice and item block after adding the contributions of their terms at this owner."""
    if bundles.empty:
        return bundles.iloc[:0][["item", "slice", "block", "rows", "docs", "scores"]]
    postings = postings.sort_values("term", kind="stable")
    names = postings["term"].to_numpy(np.int64)
    rows, docs, adds = (postings[c].to_numpy(np.int64) for c in ("row", "doc_id", "contrib"))
    out_rows, out_docs, out_scores = [], [], []
    for have_rows, have_docs, have_scores, wanted, rest in zip(bundles["rows"], bundles["docs"], bundles["scores"], bundles["terms"], bundles["rest"]):
        parts_r, parts_d, parts_s = [np.asarray(have_rows, np.int64)], [np.asarray(have_docs, np.int64)], [np.asarray(have_scores, np.int64)]
        for term in wanted if wanted is not None else ():
            lo, hi = np.searchsorted(names, term, "left"), np.searchsorted(names, term, "right")
            if hi > lo:
                parts_r.append(rows[lo:hi])
                parts_d.append(docs[lo:hi])
                parts_s.append(adds[lo:hi])
        r, d, s = np.concatenate(parts_r), np.concatenate(parts_d), np.concatenate(parts_s)
        if len(parts_r) > 1 and len(r):
            order = np.argsort(r, kind="stable")
            r, d, s = r[order], d[order], s[order]
            first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
            r, d, s = r[first], d[first], np.add.reduceat(s, first)
        if wanted is not None and len(s) > top:
            # The top-th score of this slice is a floor of the final top-th score of all slices; what cannot reach it goes.
            floor = np.partition(s, len(s) - top)[len(s) - top]
            alive = s + int(rest) >= floor
            r, d, s = r[alive], d[alive], s[alive]
        out_rows.append(r)
        out_docs.append(d)
        out_scores.append(s)
    return pd.DataFrame(
        {"item": bundles["item"], "slice": bundles["slice"], "block": bundles["block"], "rows": out_rows, "docs": out_docs, "scores": out_scores}
    )


def _best(frames, top: int = TOP):
    """Each bundle's ``top`` documents with a score above 0, highest first, equal scores by doc_id, then row."""
    for frame in frames:
        out = []
        for item, rows, docs, scores in zip(frame["item"], frame["rows"], frame["docs"], frame["scores"]):
            r, d, s = (np.asarray(x, np.int64) for x in (rows, docs, scores))
            keep = s > 0
            r, d, s = r[keep], d[keep], s[keep]
            order = np.lexsort((r, d, -s))[:top]
            out.append(pd.DataFrame({"item": item, "row": r[order], "doc_id": d[order], "score": s[order]}))
        yield pd.concat(out) if out else pd.DataFrame({"item": [], "row": [], "doc_id": [], "score": []})


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    top: int = TOP,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` best documents by the integer score of the contract.

    Each row of ``docs`` is a document (rows sharing a key are scored apart and
    may both be returned), and each row of ``items`` an item (rows sharing an
    item key are ranked apart, each from 1); a null text has no terms, so it
    counts in neither N nor L and scores 0. Items without terms, or whose terms
    no document holds, return nothing; null keys are returned as null. Scores of
    0 are never returned; equal scores go by ascending doc_id (null last), then
    by the row's place in its table.
    Other columns are ignored. Empty tables give an empty result.

    Texts are tokenized once. The postings of the items' terms are written once,
    partitioned by term owner; owners hold terms by document frequency, the
    rarest at owner 0. A bundle is the sparse scores of one item in one slice of
    the documents; in stage r the bundles meet, by a cogroup on (slice, item
    block), the postings that owner r holds for that slice and add them. After
    adding, a document whose score plus the most that the item's terms at later
    owners can add stays below the slice's ``top``-th score is dropped: it cannot
    reach the final ``top`` (exact, as scores only grow). Inside tasks a term is its
    64-bit hash. Bundles are written after each stage, so a lost executor costs
    at most one stage.
    """
    spark = ready(docs.sparkSession)
    # A row number below 0 marks a document without key; the order key puts those last.
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), terms(F.col(text)).alias("t")).select(
        F.when(F.col("doc_id").isNull(), -1 - F.monotonically_increasing_id()).otherwise(F.monotonically_increasing_id()).alias("row"),
        F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_id"), "t", F.size("t").cast("bigint").alias("n"),
    )
    wanted = items.select(
        F.monotonically_increasing_id().alias("item"), F.col(item_key).cast("bigint").alias("item_id"), F.array_distinct(terms(F.col(item_text))).alias("terms")
    )
    wanted = materialize(wanted, "search-items")
    vocabulary = wanted.select(F.explode("terms").alias("term")).distinct().select("term", F.lit(True).alias("asked"))
    # One pass over the texts: occurrences of asked terms, and one row per document for N and L.
    occurring = rows.select("row", "doc_id", "n", F.explode_outer("t").alias("term"))
    occurring = occurring.join(broadcast_if_small(vocabulary), "term", "left").select(
        "row", "doc_id", "n", F.when(F.col("asked"), F.col("term")).alias("term")
    )
    postings = materialize(occurring.groupBy("row", "doc_id", "n", "term").agg(F.count("*").alias("tf")), "search-postings")
    per_row = postings.groupBy("row").agg(F.max("n").alias("n"))
    stats = per_row.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L"), F.count("*").alias("R")).first()
    big_n, big_l, row_count = int(stats["N"]), int(stats["L"]), int(stats["R"])
    if big_l == 0:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    postings = postings.where(F.col("term").isNotNull())
    slices = max(1, math.ceil(row_count / DOCS_PER_SLICE))
    item_count = wanted.count()
    blocks = max(1, math.ceil(item_count / ITEMS_PER_BLOCK))
    df = postings.groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * big_n + 2.0) / (F.lit(2.0) * F.col("df") + 1.0))).cast("bigint")
    m = F.lit(50) + F.expr(f"(50 * n * {big_n}) div {big_l}")
    tf_part = F.expr("(1000000000 * tf) div (1000 * tf + 20 * m)")
    # Owners by document frequency: bundles meet the rarest terms first.
    owner = F.least(F.lit(OWNERS - 1), F.floor(F.lit(float(OWNERS)) * F.log("df") / F.lit(math.log(big_n + 1.0)))).cast("int")
    scored = postings.join(broadcast_if_small(df), "term").withColumn("m", m).select(
        owner.alias("owner"),
        F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int").alias("slice"),
        F.xxhash64("term").alias("code"), "term", "row", "doc_id", (weight * tf_part).alias("contrib"),
    ).where(F.col("contrib") > 0)
    path = fresh_dir(spark, "search-owners")
    scored.write.partitionBy("owner").parquet(path)
    written = spark.read.schema(scored.schema).parquet(path)
    most = written.groupBy("term", "owner").agg(F.max("contrib").alias("most"))
    # Per item and owner: its term codes there, and the most its terms at later owners can still add.
    later = Window.partitionBy("item").orderBy(F.col("owner").desc()).rowsBetween(Window.unboundedPreceding, -1)
    owned = (
        wanted.select("item", F.explode("terms").alias("term"))
        .join(broadcast_if_small(most), "term")
        .groupBy("item", "owner")
        .agg(F.collect_list(F.xxhash64("term")).alias("terms"), F.sum("most").alias("here"))
        .withColumn("rest", F.coalesce(F.sum("here").over(later), F.lit(0)))
    )
    owned = materialize(owned, "search-item-owners")
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    bundles = wanted.select(
        "item", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), block.cast("int").alias("block"),
        *[F.array().cast("array<bigint>").alias(name) for name in ("rows", "docs", "scores")],
    )
    schema = "item long, slice int, block int, rows array<long>, docs array<long>, scores array<long>"
    for stage_owner in range(OWNERS):
        held = written.where(F.col("owner") == stage_owner).select("slice", F.col("code").alias("term"), "row", "doc_id", "contrib")
        held = held.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        visiting = bundles.join(owned.where(F.col("owner") == stage_owner).select("item", "terms", "rest"), "item", "left")
        stage = visiting.groupBy("slice", "block").cogroup(held.groupBy("slice", "block")).applyInPandas(functools.partial(_add, top=top), schema)
        bundles = materialize(stage, f"search-bundles-{stage_owner}")
    best = bundles.mapInPandas(functools.partial(_best, top=top), "item long, row long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id", "row")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= top)
    ranked = ranked.join(broadcast_if_small(wanted.select("item", "item_id")), "item")
    return ranked.select("item_id", "rank", F.when(F.col("row") >= 0, F.col("doc_id")).alias("doc_id"), "score")


def search_report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return search(documents, benchmark)


_TERM_SQL = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

#: The same ranking in DuckDB, over whole tables.
SEARCH_SQL = f"""
WITH d AS (
  SELECT doc_id, {_TERM_SQL.format('text')} AS t FROM documents
), stats AS (
  SELECT count(*) FILTER (WHERE len(t) > 0) AS big_n, sum(len(t)) AS big_l FROM d
), occ AS (
  SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d
), tf AS (
  SELECT doc_id, n, term, count(*) AS tf FROM occ GROUP BY doc_id, n, term
), q AS (
  SELECT DISTINCT item_id, unnest({_TERM_SQL.format('text')}) AS term FROM benchmark
), df AS (
  SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM q) GROUP BY term
), s AS (
  SELECT q.item_id, tf.doc_id,
         sum(CAST(floor(1000.0 * ln((2.0 * big_n + 2.0) / (2.0 * df.df + 1.0))) AS BIGINT)
             * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * tf.n * big_n) // big_l)))) AS score
  FROM q JOIN tf ON q.term = tf.term JOIN df ON q.term = df.term CROSS JOIN stats
  GROUP BY q.item_id, tf.doc_id
), r AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM s WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= {TOP}
"""
