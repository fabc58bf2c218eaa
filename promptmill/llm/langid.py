"""Language of a text: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.shared import forget_state, ready, schema_with, slices, strings, with_columns

SIZES = (1, 2, 3)
#: Hash buckets, as a power of two, and what is added to every count.
BITS = 15
SMOOTHING = 0.5
#: About so many labelled rows are learned from (all of them where there are fewer).
MAX_TRAIN_DOCS = 50_000
#: Shares of a language's rows are taken in steps of one by this.
SHARES = 1 << 40
#: The broadcast matrix of log-probabilities may have this many bytes.
MAX_MODEL_BYTES = 64 << 20
UNKNOWN = "und"
#: Bytes of text scored at once; the rows gathered from the matrix take some ten times as much.
SCORE_BYTES = 1 << 19


@dataclass
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  # (buckets, languages), float32
    log_prior: np.ndarray  # (languages,)


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, lower-cased, and where each text starts (one more at the end)."""
    lowered = [text.lower() for text in texts]
    starts = np.concatenate([[0], np.cumsum([len(text) for text in lowered])]).astype(np.int64)
    return np.frombuffer("".join(lowered).encode("utf-32-le"), "<u4").astype(np.uint64), starts


def _buckets(points: np.ndarray, size: int, bits: int) -> np.ndarray:
    """A bucket for the n-gram of ``size`` that starts at each point (the last ``size - 1`` points start none)."""
    mixed = np.full(max(0, len(points) - size + 1), size, np.uint64)
    for offset in range(size):
        mixed = (mixed ^ points[offset: offset + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int64)


def _shares(totals: dict[str, int], max_docs: int) -> dict[str, float]:
    """The share of each language's rows to learn from, about ``max_docs`` rows in all."""
    shares, left = {}, max_docs
    for i, (language, total) in enumerate(sorted(totals.items(), key=lambda item: item[1])):
        taken = min(total, left / (len(totals) - i))
        shares[language] = taken / total
        left -= taken
    return shares


def train_language_model(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    bits: int = BITS,
    max_docs: int = MAX_TRAIN_DOCS,
) -> LanguageModel:
    """Learn from rows with text and label; rows lacking one are ignored.

    Where there are more than ``max_docs`` of them, each language gets an equal
    part of that number; one with fewer rows is learned whole and leaves the rest
    to the others. Of a language with more, the rows are taken whose hashed
    ``key`` falls below its share. How likely a language is beforehand comes from
    all labelled rows. Every task sums its counts per language and
    bucket before they are shuffled; the driver gets at most one count for each
    language and bucket. Without any labelled row the model knows no language.
    """
    ready(labelled.sparkSession)
    rows = labelled.where(F.col(text).isNotNull() & F.col(label).isNotNull())
    most = MAX_MODEL_BYTES // (4 << bits)
    found = rows.groupBy(F.col(label).cast("string").alias("language")).count().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} languages in {1 << bits} buckets are more than {MAX_MODEL_BYTES} bytes")
    totals = {row["language"]: row["count"] for row in found}
    below = {language: int(SHARES * share) for language, share in _shares(totals, max_docs).items() if share < 1}
    if below:
        limit = F.create_map(*[F.lit(part) for pair in below.items() for part in pair])[F.col(label).cast("string")]
        rows = rows.where(limit.isNull() | (F.pmod(F.xxhash64(key), F.lit(SHARES)) < limit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in slices(batches, text, SCORE_BYTES):
            texts, labels = strings(batch, text), strings(batch, label)
            for language in set(labels):
                own = [t for t, name in zip(texts, labels) if name == language]
                held = counts.setdefault(language, np.zeros(1 << bits, np.int64))
                docs[language] = docs.get(language, 0) + len(own)
                for one in own:
                    points, _ = _points([one])
                    for size in SIZES:
                        held += np.bincount(_buckets(points, size, bits), minlength=1 << bits)
        for language, held in counts.items():
            used = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([language] * (len(used) + 1), pa.string()),
                    pa.array([-1, *used.tolist()], pa.int64()),
                    pa.array([docs[language], *held[used].tolist()], pa.int64()),
                ],
                names=["language", "bucket", "n"],
            )

    small = rows.select(F.col(text), F.col(label).cast("string").alias(label))
    counted = small.mapInArrow(run, "language string, bucket bigint, n bigint")
    sums = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n"))
    languages = sorted(row.language for row in sums.where("bucket = -1").select("language").collect())
    table = sums.toArrow()
    place = {language: i for i, language in enumerate(languages)}
    columns = np.array([place[name] for name in table["language"].to_pylist()], np.int64)
    buckets, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    counts = np.zeros((1 << bits, len(languages)))
    prior = np.array([totals[language] for language in languages], float)
    feature = buckets >= 0
    counts[buckets[feature], columns[feature]] = n[feature]
    smooth = counts + SMOOTHING
    return LanguageModel(
        languages,
        np.log(smooth / smooth.sum(axis=0)).astype(np.float32),
        np.log(prior / max(1, prior.sum())),
    )


def _scores(model: LanguageModel, texts: list[str], bits: int) -> np.ndarray:
    """Log-likelihoods (texts, languages): the matrix rows of the n-grams a text has, summed per text."""
    points, starts = _points(texts)
    total = np.zeros((len(texts), len(model.languages)))
    for size in SIZES:
        begin, end = starts[:-1], starts[1:] - (size - 1)
        some = np.flatnonzero(end > begin)
        if not len(some):
            continue
        rows = model.log_prob[_buckets(points, size, bits)]
        rows = np.concatenate([rows, np.zeros((1, rows.shape[1]), rows.dtype)])
        bounds = np.stack([begin[some], end[some]], axis=1).ravel()
        total[some] += np.add.reduceat(rows, bounds, axis=0, dtype=np.float64)[::2]
    return total


def predict_language(
    docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``docs`` with the likeliest learned language of each whole text and its posterior probability.

    A null text, or one without a letter, gives ``und`` and a score of 0, and so
    does every text if the model knows no language; of equally likely languages
    the first by name is taken. Columns named ``out`` or ``score`` are replaced,
    others stay and are never looked at. Nothing is shuffled.
    """
    spark = ready(docs.sparkSession)
    held = spark.sparkContext.broadcast(model)
    bits = int(model.log_prob.shape[0]).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        known = held.value
        for batch in slices(batches, text, SCORE_BYTES):
            texts = strings(batch, text)
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            lettered = [i for i, t in enumerate(texts) if t and known.languages and any(map(str.isalpha, t))]
            if lettered:
                found = _scores(known, [texts[i] for i in lettered], bits) + known.log_prior
                best = found.argmax(axis=1)
                share = 1 / np.exp(found - found.max(axis=1, keepdims=True)).sum(axis=1)
                for i, language, value in zip(lettered, best.tolist(), share.tolist()):
                    names[i], scores[i] = known.languages[language], value
            yield with_columns(batch, **{out: pa.array(names, pa.string()), score: pa.array(scores, pa.float64())})

    return docs.mapInArrow(run, schema_with(docs, **{out: "string", score: "double"}))


def held_out(key: str = "doc_id", folds: int = 5):
    """Whether a row is kept out of learning: its key's checksum leaves no remainder."""
    return F.coalesce(F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % folds == 0, F.lit(False))


def language_report(docs: DataFrame) -> DataFrame:
    model = train_language_model(docs.where(~held_out()))
    told = docs.select("doc_id", "text", held_out().alias("held_out"))
    return predict_language(told, model).select("doc_id", "held_out", "lang_pred", "score")


def keep_known_language(docs: DataFrame, model: LanguageModel, least: float = 0.5) -> DataFrame:
    """The rows whose language is known with a probability of at least ``least``; columns stay as they are."""
    names = docs.columns
    told = predict_language(docs, model, out="__language", score="__score")
    return told.where((F.col("__language") != UNKNOWN) & (F.col("__score") >= least)).select(*names)
