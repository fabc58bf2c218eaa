"""Lines that many documents share, found by two Bloom filters and an exact count of the suspects."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.shared import forget_state, ready, schema_with, slices, utf8, with_columns
from promptmill.workspace import materialize

BLANKS = b" \t\n\r\x0b\x0c"
#: Bits a line has in the filters, up to MAX_FILTER_BYTES; a fuller filter only means more suspects to count.
BITS_PER_LINE = 12
MAX_FILTER_BYTES = 32 << 20
#: Pieces a filter is merged in.
BLOCKS = 256
#: Repeated keys are broadcast up to this many bytes of text, and joined beyond it.
MAX_BROADCAST_KEYS = 16 << 20


def line_key(line: bytes) -> bytes:
    """A line without blanks at its ends and with A-Z in lower case (UTF-8 bytes; other letters stay)."""
    return line.strip(BLANKS).lower()


def _document_keys(text: bytes | None, shortest: int) -> set[bytes]:
    keys = {line.strip(BLANKS) for line in (text or b"").lower().split(b"\n")}
    if shortest <= 1:
        keys.discard(b"") if shortest == 1 else None
        return keys
    return {key for key in keys if len(key.decode()) >= shortest}


def _places(keys: Iterable[bytes], bits: int) -> np.ndarray:
    """Two filter places for each key, as rows."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)
    mask = np.uint64(bits - 1)
    return np.stack([hashes & mask, (hashes >> np.uint64(32)) & mask], axis=1).astype(np.int64)


def _holds(bloom: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which rows of places are all set in a filter of packed bits."""
    return ((bloom[places >> 3] & (128 >> (places & 7))) > 0).all(axis=1)


def _add(bloom: np.ndarray, places: np.ndarray) -> None:
    flat = places.ravel()
    np.bitwise_or.at(bloom, flat >> 3, (128 >> (flat & 7)).astype(np.uint8))


def _filter_bits(docs: DataFrame, text: str) -> int:
    """Filter size for all lines of ``docs``, a power of two."""
    lines = F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1
    total = docs.agg(F.sum(lines)).first()[0] or 1
    return min(MAX_FILTER_BYTES * 8, max(BLOCKS * 64, 1 << int(np.ceil(np.log2(total * BITS_PER_LINE)))))


def _twice_seen(docs: DataFrame, text: str, shortest: int, bits: int) -> bytes:
    """The filter of keys that at least two documents may hold.

    Every task fills a once-seen and a twice-seen filter; both are merged block
    by block: what one side saw twice, or both sides saw once, was seen twice.
    """
    block = bits // 8 // BLOCKS

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in slices(batches, text, 1 << 20):
            # one slice at a time: how many of its documents hold a key, then the slice as a whole
            seen = Counter()
            for value in utf8(batch, text):
                seen.update(_document_keys(value, shortest))
            if not seen:
                continue
            places = _places(seen.keys(), bits)
            many = np.fromiter((n > 1 for n in seen.values()), bool, len(seen))
            _add(twice, places[_holds(once, places) | many])
            _add(once, places)
        packed = [side.reshape(BLOCKS, block) for side in (once, twice)]
        used = np.flatnonzero(packed[0].any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *(pa.array([side[i].tobytes() for i in used], pa.binary()) for side in packed)],
            names=["block", "once", "twice"],
        )

    def merge(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, once, twice = None, np.zeros(block, np.uint8), np.zeros(block, np.uint8)
        for piece in pieces:
            for row in piece.to_pylist():
                number = row["block"]
                one, two = (np.frombuffer(row[side], np.uint8) for side in ("once", "twice"))
                twice |= two | (once & one)
                once |= one
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([twice.tobytes()], pa.binary())], names=["block", "twice"]
        )

    built = docs.select(text).mapInArrow(build, "block int, once binary, twice binary")
    merged = built.groupBy("block").applyInArrow(merge, "block int, twice binary")
    whole = np.zeros((BLOCKS, block), np.uint8)
    for row in merged.toLocalIterator():
        whole[row.block] = np.frombuffer(row.twice, np.uint8)
    return whole.tobytes()


def shared_lines(
    docs: DataFrame, text: str = "text", min_docs: int = 10, shortest: int = 1, order: str = "doc_id"
) -> DataFrame:
    """Keys (``key`` binary) in at least ``min_docs`` rows, their number (``n_docs``) and the least ``order`` (``first``).

    Only keys the twice-seen filter holds are shuffled; they are counted exactly,
    by their own bytes, after partial counts in every task. For ``min_docs`` of 1
    nothing is filtered.
    """
    spark = ready(docs.sparkSession)
    bits = _filter_bits(docs, text)
    twice = spark.sparkContext.broadcast(_twice_seen(docs, text, shortest, bits)) if min_docs > 1 else None

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        held = None if twice is None else np.frombuffer(twice.value, np.uint8)
        for batch in slices(batches, text):
            counts: Counter = Counter()
            first: dict[bytes, int] = {}
            for value, place in zip(utf8(batch, text), batch.column("place").to_pylist()):
                own = _document_keys(value, shortest)
                counts.update(own)
                if place is not None:
                    for key in own:
                        if place < first.get(key, place + 1):
                            first[key] = place
            keys = list(counts)
            if held is not None and keys:
                keys = [keys[i] for i in np.flatnonzero(_holds(held, _places(keys, bits)))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.binary()),
                    pa.array([counts[k] for k in keys], pa.int64()),
                    pa.array([first.get(k) for k in keys], pa.int64()),
                ],
                names=["key", "n", "first"],
            )

    placed = docs.select(text, F.col(order).cast("bigint").alias("place"))
    counted = placed.mapInArrow(suspects, "key binary, n bigint, first bigint")
    counted = counted.groupBy("key").agg(F.sum("n").alias("n_docs"), F.min("first").alias("first"))
    return counted.where(F.col("n_docs") >= min_docs)


def drop_shared_lines(
    docs: DataFrame,
    text: str = "text",
    min_docs: int = 10,
    shortest: int = 1,
    keep_first: bool = False,
    order: str = "doc_id",
) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``: all lines gone that ``min_docs`` documents share.

    Texts are split at newlines; a null or empty text is one empty line and stays
    empty. A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z
    in lower case. Keys of at least ``shortest`` code points found in at least
    ``min_docs`` rows lose every line in every row; the other lines stay as they
    are, joined by newlines. Rows are documents: a repeated row counts again, a
    line repeated inside one row once. All other columns stay; columns of the
    three names above are replaced. An empty table stays empty.

    With ``keep_first`` the first line of a key stays in the row with the least
    ``order`` (an integer column, unique where given; rows that lack it never
    hold a first occurrence).

    The repeated keys are written to the shared folder. Up to 16 MB of them go
    to every task; beyond that each row's repeated keys are joined to it by a
    digest of its text.
    """
    spark = ready(docs.sparkSession)
    shared = materialize(shared_lines(docs, text, min_docs, shortest, order), "shared-lines")
    size = shared.agg(F.sum(F.length("key") + 100)).first()[0] or 0
    schema = schema_with(docs, kept_text="string", n_lines="bigint", n_dropped="bigint")
    place = F.col(order).cast("bigint") if keep_first else F.lit(None).cast("bigint")
    names = docs.columns
    if size <= MAX_BROADCAST_KEYS:
        firsts = {bytes(row.key): row.first for row in shared.toLocalIterator()}
        held = spark.sparkContext.broadcast(firsts)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget_state()
            drop = held.value
            for batch in slices(batches, text):
                places = batch.column("__place").to_pylist()
                yield _without_lines(batch.select(names), text, [drop] * batch.num_rows, places)

        return docs.withColumn("__place", place).mapInArrow(run, schema)

    own = _own_keys(docs, text, shared)
    joined = docs.withColumns({"__place": place, "__digest": _digest(text)}).join(own, "__digest", "left")

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            drops = [{bytes(k["key"]): k["first"] for k in keys or ()} for keys in batch.column("__drop").to_pylist()]
            places = batch.column("__place").to_pylist()
            yield _without_lines(batch.select(names), text, drops, places)

    return joined.select(*names, "__place", "__drop").mapInArrow(run_joined, schema)


def _digest(text: str):
    return F.sha2(F.encode(F.col(text), "UTF-8"), 256)


def _own_keys(docs: DataFrame, text: str, shared: DataFrame) -> DataFrame:
    """The way for many repeated keys: each distinct text's digest with its own repeated keys."""

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            keys = [list(_document_keys(value, 0)) for value in utf8(batch, text)]
            yield with_columns(batch.select(["__digest"]), key=pa.array(keys, pa.list_(pa.binary())))

    digested = docs.select(text, _digest(text).alias("__digest"))
    lines = digested.mapInArrow(keys_of, "__digest string, key array<binary>")
    lines = lines.select("__digest", F.explode("key").alias("key")).distinct()
    found = lines.join(shared.select("key", "first"), "key")
    return found.groupBy("__digest").agg(F.collect_set(F.struct("key", "first")).alias("__drop"))


def _without_lines(batch: pa.RecordBatch, text: str, drops: list[dict], places: list[int | None]) -> pa.RecordBatch:
    kept, lines_of, dropped = [], [], []
    for value, drop, place in zip(utf8(batch, text), drops, places):
        lines = (value or b"").split(b"\n")
        stay, spared = [], set()
        for line in lines:
            key = line.strip(BLANKS).lower()
            if key in drop:
                if place is None or drop[key] != place or key in spared:
                    continue
                spared.add(key)
            stay.append(line)
        kept.append(b"\n".join(stay).decode())
        lines_of.append(len(lines))
        dropped.append(len(lines) - len(stay))
    return with_columns(
        batch,
        kept_text=pa.array(kept, pa.string()),
        n_lines=pa.array(lines_of, pa.int64()),
        n_dropped=pa.array(dropped, pa.int64()),
    )


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    kept = drop_shared_lines(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


#: The same by SQL, without filters.
LINE_DEDUP_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents
), keyed AS (
    SELECT doc_id, place, line,
        translate(
            regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
        ) AS key
    FROM lines
), shared AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(shared.key)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE shared.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key)
GROUP BY doc_id
"""
