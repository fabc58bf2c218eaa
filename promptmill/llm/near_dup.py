"""Near duplicates: DartMinHash signatures, banding, and exact similarity inside what the bands connect."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.components import connected_components
from promptmill.llm.shared import broadcast_if_small, ready, slices, utf8, worker_state
from promptmill.workspace import materialize

WORDS = 5
#: Bands and coordinates in each: of pairs with a similarity of 0.8, one in 20,000 shares no band.
BANDS, ROWS = 25, 5
#: Numerator and denominator of the least similarity, so that it is compared exactly.
LEAST = (4, 5)
#: Bytes of text sketched at once.
SKETCH_BYTES = 1 << 20
#: Shingles that a block of one crowd holds, at least and at most; in between a crowd is cut into so many parts.
BLOCK_SHINGLES = (20_000, 400_000)
CROWD_PARTS = 16
#: So many texts are picked by a broadcast of their keys; beyond it by a shuffle.
MAX_BROADCAST_ROWS = 1_000_000

#: ASCII but for letters and digits becomes a blank, A-Z lower case; other bytes stay.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


class _WordCodes(dict):
    """64-bit codes of words, the most recent two hundred thousand remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(*numbers: int) -> np.uint64:
    x = 0x9E3779B97F4A7C15
    for number in numbers:
        x = (x ^ number) * 0xD6E8FEB86659FD93 % (1 << 64)
        x ^= x >> 32
    return np.uint64(x)


def _share(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers above 0 and up to 1."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def shingle_sets(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle code, how often), by text and code; texts without words have no rows.

    A shingle is five consecutive words; a text of fewer words is one shingle.
    """
    split = [(text or b"").translate(WORD_BYTES).split() for text in texts]
    sizes = np.array([len(words) for words in split], np.int64)
    code_of = worker_state("word-codes", _WordCodes)
    codes = np.fromiter((code_of[w] for words in split for w in words), np.uint64, int(sizes.sum()))
    text_of = np.repeat(np.arange(len(texts)), sizes)
    starts = np.cumsum(sizes) - sizes
    last = np.repeat(starts + sizes, sizes)
    at = np.arange(len(codes))
    begin = at[(at + WORDS <= last) | ((at == last - np.repeat(sizes, sizes)) & (last - at < WORDS))]
    shingles = np.full(len(begin), np.uint64(WORDS))
    for offset in range(WORDS):
        inside = begin + offset < last[begin]
        word = np.where(inside, codes[np.minimum(begin + offset, max(0, len(codes) - 1))], np.uint64(offset))
        shingles = _mix(shingles * np.uint64(0x9E3779B97F4A7C15) + word)
    order = np.lexsort((shingles, text_of[begin]))
    owner, shingles = text_of[begin][order], shingles[order]
    fresh = np.append(True, (owner[1:] != owner[:-1]) | (shingles[1:] != shingles[:-1])) if len(owner) else np.zeros(0, bool)
    first = np.flatnonzero(fresh)
    return owner[first], shingles[first], np.diff(np.append(first, len(owner)))


def dart_minhash(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n_sets: int, k: int) -> np.ndarray:
    """Signatures (``n_sets``, ``k``) of weighted sets; two agree in a coordinate as often as their weighted Jaccard says.

    Over each element lies a strip of unbounded weight, cut into the regions
    [0, 1), [1, 2), [2, 4) ... Hashes throw darts into a region at random times,
    as many per time as it is wide, at random weights in it, each for a random
    coordinate. A set holds the darts below its elements' weights and keeps the
    earliest one of each coordinate. Darts are thrown up to a time by which all
    coordinates are expected to have one; a set that lacks some goes on for twice
    the time. Sets with few large weights and many small ones cost the same.
    """
    out = np.zeros((n_sets, k), np.uint64)
    total = np.bincount(owner, weight, n_sets)
    until = np.zeros(n_sets)
    open_ = total > 0
    until[open_] = k * (np.log(k) + 2) / total[open_]
    while open_.any():
        mine = np.flatnonzero(open_[owner])
        sets, things, sizes = owner[mine], element[mine], weight[mine].astype(np.float64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        region, low, width = 0, 0.0, 1.0
        while len(sets):
            at = np.zeros(len(sets))
            row_sets, row_things, row_sizes, throw = sets, things, sizes, 0
            while len(row_sets):
                code = _mix(row_things ^ _salt(region, throw))
                at = at - np.log(_share(code)) / width
                early = np.flatnonzero(at < until[row_sets])
                at, code = at[early], code[early]
                row_sets, row_things, row_sizes = row_sets[early], row_things[early], row_sizes[early]
                detail = _mix(code + np.uint64(0x9E3779B97F4A7C15))
                under = low + width * _share(detail) <= row_sizes if width > 1 or (row_sizes < low + width).any() else None
                coordinate = (_mix(detail) >> np.uint64(32)).astype(np.int64) % k
                place = row_sets * k + coordinate
                found.append((place, at, code) if under is None else (place[under], at[under], code[under]))
                throw += 1
            low, width, region = low + width, low + width, region + 1
            more = np.flatnonzero(sizes > low)
            sets, things, sizes = sets[more], things[more], sizes[more]
        place, time, code = (np.concatenate(part) for part in zip(*found))
        order = np.lexsort((time, place))
        place, code = place[order], code[order]
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
        filled = np.bincount(place[first] // k, minlength=n_sets)
        done = open_ & (filled == k)
        take = first[done[place[first] // k]]
        out.reshape(-1)[place[take]] = code[take]
        open_ &= ~done
        until[open_] *= 2
    return out


def _band_codes(signatures: np.ndarray) -> np.ndarray:
    """One hash for each band of each signature, different in different bands."""
    codes = np.empty((len(signatures), BANDS), np.uint64)
    for band in range(BANDS):
        code = np.full(len(signatures), _salt(band, 77))
        for row in range(ROWS):
            code = _mix(code * np.uint64(0x9E3779B97F4A7C15) + signatures[:, band * ROWS + row])
        codes[:, band] = code
    return codes.view(np.int64)


def _digests(owner: np.ndarray, shingles: np.ndarray, n: int) -> tuple[np.ndarray, list[str | None]]:
    """Bounds of each text's shingles and a 128-bit digest of them."""
    bounds = np.searchsorted(owner, np.arange(n + 1))
    return bounds, [
        xxhash.xxh3_128_hexdigest(shingles[b:e].tobytes()) if e > b else None for b, e in zip(bounds, bounds[1:])
    ]


def _each_time(owner: np.ndarray, shingles: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A code of its own for each time a shingle occurs, by text and code: the Jaccard similarity of such sets is the
    weighted one, sum of least by sum of largest counts."""
    owner, shingles = np.repeat(owner, times), np.repeat(shingles, times)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
    codes = np.where(nth > 0, _mix(shingles + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), shingles)
    order = np.lexsort((codes, owner))
    return owner[order], codes[order]


def sketch(docs: DataFrame, text: str = "text", counted: bool = False) -> DataFrame:
    """``key``, ``text_code``, ``node`` (digest of the shingle set), ``size`` and ``bands`` for each row of (key, text).

    ``counted`` weighs a shingle by its number of occurrences instead of 1. A text
    without words has a ``size`` of 0 and its own digest as ``node``; that is null
    if it is null or blank.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SKETCH_BYTES):
            texts = utf8(batch, text)
            owner, shingles, times = shingle_sets(texts)
            bounds, nodes = _digests(*(_each_time(owner, shingles, times) if counted else (owner, shingles)), batch.num_rows)
            nodes = [
                "text-" + xxhash.xxh3_128_hexdigest(one) if node is None and one and one.strip() else node
                for node, one in zip(nodes, texts)
            ]
            weights = times if counted else np.ones(len(times), np.int64)
            bands = _band_codes(dart_minhash(owner, shingles, weights, batch.num_rows, BANDS * ROWS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("text_code"),
                    pa.array(nodes, pa.string()),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel(), pa.int64()), BANDS).cast(pa.list_(pa.int64())),
                ],
                names=["key", "text_code", "node", "size", "bands"],
            )

    return docs.mapInArrow(run, "key bigint, text_code bigint, node string, size bigint, bands array<bigint>")


def _crowds(sketches: DataFrame) -> DataFrame:
    """(code, crowd): a hash of each node that shares a band with another node, and what such bands connect.

    Every bucket ties its members to its least one, so a bucket of any size adds
    as many edges as it has members. Nodes are told by 64-bit hashes here: two
    that fall together only make one crowd of two.
    """
    rows = sketches.where("size > 0").select(F.xxhash64("node").alias("code"), F.explode("bands").alias("bucket"))
    buckets = rows.groupBy("bucket").agg(F.min("code").alias("least"), F.max("code").alias("most"))
    shared = materialize(buckets.where("least <> most").select("bucket", "least"), "shared-bands")
    edges = rows.join(shared, "bucket").where("code <> least").select(F.col("least").alias("a"), F.col("code").alias("b"))
    return connected_components(edges).select(F.col("node").alias("code"), F.col("label").alias("crowd"))


def _blocks(members: DataFrame) -> DataFrame:
    """(node, unit): the units in which a node meets all others of its crowd that its size lets it resemble.

    A crowd whose shingles fill one small block is one unit. A larger one is cut into
    classes by size, so wide that similar sets lie in the same or in neighbouring
    classes, and these into blocks by hash; a unit is a pair of such blocks.
    """
    width = F.log(F.lit(LEAST[1] / LEAST[0]))
    classed = members.withColumn("class", F.floor(F.log("size") / width + F.lit(1e-9)).cast("int"))
    sums = classed.groupBy("crowd", "class").agg(F.sum("size").alias("held"))
    least, most = BLOCK_SHINGLES
    per_crowd = sums.groupBy("crowd").agg(
        F.sum("held").alias("total"), F.collect_list(F.struct("class", "held")).alias("classes")
    )
    block = F.least(F.greatest(F.col("total") / CROWD_PARTS, F.lit(least)), F.lit(most))
    counts = F.transform(
        "classes", lambda c: F.struct(c["class"].alias("class"), F.ceil(c["held"] / block).cast("int").alias("n"))
    )
    per_crowd = materialize(per_crowd.select("crowd", "total", F.map_from_entries(counts).alias("blocks")), "crowds")
    placed = classed.join(per_crowd, "crowd")
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.element_at("blocks", F.col("class"))).cast("int")
    placed = placed.select("node", "crowd", "class", "total", "blocks", own.alias("own"))

    def partners(step: int):
        other = F.col("class") + step
        n = F.coalesce(F.try_element_at("blocks", other), F.lit(0))
        mine = F.struct(F.col("class").alias("c"), F.col("own").alias("b"))
        theirs = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        def pair(block):
            they = F.struct(other.alias("c"), block.alias("b"))
            return F.xxhash64("crowd", F.least(mine, they), F.greatest(mine, they))
        return F.transform(theirs, pair)

    pairs = F.array_distinct(F.concat(partners(-1), partners(0), partners(1)))
    one = F.col("total") <= least
    return placed.select("node", F.explode(F.when(one, F.array(F.xxhash64("crowd"))).otherwise(pairs)).alias("unit"))


def _linked(sets: list[np.ndarray]) -> np.ndarray:
    """For each set the least set it is connected with by similarities of at least LEAST, counted exactly."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    token = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(token, kind="stable")
    by_token = owner[order]
    begin = np.concatenate([[0], np.cumsum(np.bincount(token))])
    starts = np.cumsum(sizes) - sizes
    label = np.arange(n)
    top, bottom = LEAST
    for i in range(n):
        own = token[starts[i]: starts[i] + sizes[i]]
        lists = [by_token[begin[t]: begin[t + 1]] for t in own[begin[own + 1] - begin[own] > 1]]
        if not lists:
            continue
        common = np.bincount(np.concatenate(lists), minlength=n)
        # a/(x+y-a) >= top/bottom
        near = np.flatnonzero(common * (top + bottom) >= top * (sizes[i] + sizes))
        labels = np.unique(label[near])
        if len(labels) > 1:
            label[np.isin(label, labels)] = labels[0]
    return label


def _links(sets: DataFrame, units: DataFrame) -> DataFrame:
    """(a, b): similar nodes, as few as keep connected what is similar within a unit."""

    def run(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for piece in pieces:
            for node, packed in zip(piece.column("node").to_pylist(), piece.column("shingles").to_pylist()):
                found[node] = np.frombuffer(packed, np.uint64)
        nodes = sorted(found)
        label = _linked([found[node] for node in nodes])
        own = np.flatnonzero(label != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([nodes[label[i]] for i in own], pa.string()), pa.array([nodes[i] for i in own], pa.string())],
            names=["a", "b"],
        )

    joined = units.join(sets, "node").select("unit", "node", "shingles")
    return joined.groupBy("unit").applyInArrow(run, "a string, b string")


def _sets_of(docs: DataFrame, wanted: DataFrame, text: str, counted: bool) -> DataFrame:
    """(node, shingles as bytes) of the rows whose (text_code, key) is wanted; each time it occurs if ``counted``."""
    wanted = broadcast_if_small(wanted, MAX_BROADCAST_ROWS)
    picked = docs.join(
        wanted, (docs.text_code == wanted.w_code) & docs.key.eqNullSafe(wanted.w_key), "left_semi"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SKETCH_BYTES):
            owner, shingles, times = shingle_sets(utf8(batch, text))
            if counted:
                owner, shingles = _each_time(owner, shingles, times)
            bounds, nodes = _digests(owner, shingles, batch.num_rows)
            packed = [shingles[b:e].tobytes() for b, e in zip(bounds, bounds[1:])]
            rows = [(node, data) for node, data in zip(nodes, packed) if node is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())],
                names=["node", "shingles"],
            )

    return picked.select(text).mapInArrow(run, "node string, shingles binary")


def _classes(docs: DataFrame, key: str, text: str, counted: bool) -> DataFrame:
    """(key, text_code, node, one): each row with the (none, key, text_code) that comes first in its class.

    ``none`` tells a row without a key; those come last. ``one`` is null for a row that is alone in its class.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("text_code"))
    sketches = materialize(sketch(rows, "text", counted), "sketches")
    named = sketches.where("node IS NOT NULL").select("key", "text_code", "node", "size", F.xxhash64("node").alias("code"))
    members = named.join(_crowds(sketches), "code").groupBy("node", "crowd").agg(
        F.min(F.struct("key", "text_code")).alias("one"), F.max("size").alias("size")
    )
    members = materialize(members, "members")
    wanted = members.select(F.col("one.text_code").alias("w_code"), F.col("one.key").alias("w_key"))
    links = materialize(_links(_sets_of(rows, wanted, "text", counted), _blocks(members)), "links")
    labels = connected_components(links)
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "text_code")).alias("one")
    least = named.join(labels, "node").groupBy("label").agg(first)
    linked = materialize(labels.join(least, "label").select("node", "one"), "classes")
    copies = named.groupBy("node").agg(first, F.count("*").alias("n")).where("n > 1")
    copies = copies.join(linked.select("node"), "node", "left_anti").select("node", "one")
    names = materialize(linked.union(copies), "class-names")
    return sketches.select("key", "text_code", "node").join(names, "node", "left").select("key", "text_code", "node", "one")


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", counted: bool = False) -> DataFrame:
    """(key, text_code, node, class_id): each row's class of near duplicates, named by the least key in it.

    Two texts are linked if the sets of their five-word shingles (words as runs of
    letters and digits, A-Z in lower case) have a Jaccard similarity of 0.8 or
    more, with ``counted`` the weighted one over how often each shingle occurs;
    a class is what links connect. Copies and texts with the same set fall
    together at once. Bands of DartMinHash signatures find the candidates; within
    what shared bands connect (a crowd) similarities are counted exactly in
    blocks of bounded size, and only links that connect something leave a task.
    The work in a crowd grows with its number of blocks squared, where a block
    has up to 400,000 shingles of different texts; copies take no part in it.

    Texts without words are put together if they are the same; null and blank
    texts are each a class of their own, named by their key. Rows that share a key share nothing else, so where keys are
    repeated two classes may have one name; a class without any key has a null
    name. ``text_code`` is a hash of the text. An empty table gives an empty result.
    """
    found = _classes(docs, key, text, counted)
    return found.select("key", "text_code", "node", F.coalesce("one.key", "key").alias("class_id"))


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    found = near_duplicate_classes(docs.select("doc_id", "text"))
    return found.select(F.col("key").alias("doc_id"), "class_id")


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, that with the key that names it; columns as they are.

    Of rows that share this key that with the least hash of its text stays, also
    where a class has no key at all. Keys may be repeated: a row goes only if its
    own text has another row in its class. Rows without text all stay. Rows
    repeated with key and text stay once, but those without both text and key.
    """
    found = _classes(docs, key, text, False)
    first = F.col("one").isNull() | F.col("key").eqNullSafe(F.col("one.key")) & (F.col("text_code") == F.col("one.text_code"))
    found = materialize(found.select("key", "text_code", "node", first.alias("first")), "near-duplicates")

    def is_in(df: DataFrame, keys: DataFrame):
        return df[key].cast("bigint").eqNullSafe(keys["__key"]) & (F.xxhash64(df[text]) == keys["__code"])

    names = [F.col("key").alias("__key"), F.col("text_code").alias("__code")]
    gone = broadcast_if_small(found.where("NOT first").select(*names))
    kept = docs.join(gone, is_in(docs, gone), "left_anti")
    repeated = found.where("first AND (key IS NOT NULL OR node IS NOT NULL)").groupBy("key", "text_code").count()
    repeated = materialize(repeated.where("count > 1").select(*names), "repeated-keys")
    if repeated.isEmpty():
        return kept
    again = broadcast_if_small(repeated)
    once = kept.join(again, is_in(kept, again), "left_semi").dropDuplicates([key, text])
    return kept.join(again, is_in(kept, again), "left_anti").unionByName(once)
