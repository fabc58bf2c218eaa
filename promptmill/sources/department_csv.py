"""Folders of delimited files in unknown encodings, read in splits.

A file counts only as a whole: one undecodable byte or one malformed record
rejects all of it. Files may still be of any size, because no task ever reads
more than one input split:

1. The raw lines of every split are checked once. The result is one small row
   per split: which encodings its bytes are valid in, and whether a quoted
   field is open at its end if one was (or was not) open at its start.
2. A window over those small rows gives, per file, the encoding and the real
   quoting state at the start of each split.
3. The lines are read again and cut into records, which takes no shuffle: the
   small rows are matched by a 64-bit key and broadcast after a check of their
   number. A record that crosses a split boundary is put together from its
   pieces, and only such records are grouped.

Line feeds, quotes and commas are never part of a multi-byte character in the
supported encodings, so cutting can work on undecoded bytes.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptmill.workspace import escape_glob, materialize, path_exists

# The department folders and their names.
DEPARTMENTS = {
    "IM_内科": "内科",
    "Surgical_外科": "外科",
    "Pediatric_儿科": "儿科",
    "Oncology_肿瘤科": "肿瘤科",
    "OAGD_妇产科": "妇产科",
    "Andriatria_男科": "男科",
}

# The encodings tried, in this order. Every gb2312 text is valid
# gbk, so it needs no check of its own.
GBK_FIRST = ("gbk", "gb2312", "gb18030", "utf-8")
UTF8_FIRST = ("utf-8", "gbk", "gb2312", "gb18030")
ENCODING_ORDERS = {"gbk_first": GBK_FIRST, "utf8_first": UTF8_FIRST}
_CHECKED = ("gbk", "gb18030", "utf-8")

# A broadcast split takes some 200 bytes as a hashed row, so this many take about
# 40 MB; at 128 MB per split they stand for 25 TB. Beyond it the splits are
# joined by a shuffle.
MAX_BROADCAST_SPLITS = 200_000

# Why a whole file is rejected.
UNDECODABLE = "undecodable_file"
MALFORMED = "malformed_file"
EMPTY = "empty_file"
HIDDEN = "hidden_name"

# One field of a record. A quote opens a quoted field only at its very start;
# behind a closing quote, or inside an unquoted field, it is plain text.
_FIELD = rb'(?:"(?:[^"]|"")*+"[^,\r]*+|(?!")[^,\r]*+)'
_CLOSED_FROM_START = re.compile(_FIELD + rb"(?:[,\r]" + _FIELD + rb")*+")
_CLOSED_FROM_QUOTE = re.compile(
    rb'(?:[^"]|"")*+"[^,\r]*+(?:[,\r]' + _FIELD + rb")*+"
)


def departments_table(spark: SparkSession, departments: dict[str, str] | None = None) -> DataFrame:
    """Folder name and department name as a small table."""
    pairs = list((DEPARTMENTS if departments is None else departments).items())
    return spark.createDataFrame(pairs, "dept_dir string, department string")


def attach_department(
    df: DataFrame, departments: dict[str, str] | None = None, on: str = "dept_dir"
) -> DataFrame:
    """Add the department name; the table comes from a literal mapping, so it is tiny."""
    table = departments_table(df.sparkSession, departments).withColumnRenamed("dept_dir", on)
    return df.join(F.broadcast(table), on, "left")


@dataclass(frozen=True)
class DepartmentFolders:
    """The configured folders below one data folder."""

    data_dir: str
    departments: dict[str, str] = field(default_factory=lambda: dict(DEPARTMENTS))

    def folder(self, dept_dir: str) -> str:
        return f"{self.data_dir.rstrip('/')}/{dept_dir}"

    def present(self, spark: SparkSession) -> list[str]:
        return [d for d in self.departments if path_exists(spark, self.folder(d))]

    def missing(self, spark: SparkSession) -> list[str]:
        """Configured folders that do not exist; they are skipped, and returned as ``missing``."""
        return [d for d in self.departments if not path_exists(spark, self.folder(d))]

    def csv_globs(self, spark: SparkSession) -> list[str]:
        """Files directly in the folders whose names end in ``.csv``, in lower case."""
        return [escape_glob(self.folder(d)) + "/*.csv" for d in self.present(spark)]


def _folder_of(path: Column) -> Column:
    return F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1)


_FILES_SCHEMA = "file long, path string, dept_dir string"


def scan_department_files(spark: SparkSession, folders: DepartmentFolders) -> DataFrame:
    """One row per file that Spark reads, from the listing alone; contents are not read.

    A folder whose name ends in ``.csv`` is no file, and what lies in it is not listed.
    """
    globs = _matching(spark, folders)
    if not globs:
        return spark.createDataFrame([], _FILES_SCHEMA)
    listing = spark.read.format("binaryFile").load(globs)
    path = F.col("path")
    return listing.select(
        _file_key().alias("file"), path, _folder_of(path).alias("dept_dir")
    ).where(F.col("dept_dir").isin(*folders.departments))


def unread_files(spark: SparkSession, folders: DepartmentFolders, listing: DataFrame) -> DataFrame:
    """Files Spark passes over, with the reason: names that start with ``_`` or ``.``, and empty ones.

    Single files are only looked at in folders where the numbers differ.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    read = {row.dept_dir: row["count"] for row in listing.groupBy("dept_dir").count().collect()}
    found = []
    for dept_dir in folders.present(spark):
        glob = hadoop.Path(escape_glob(folders.folder(dept_dir)) + "/*.csv")
        statuses = glob.getFileSystem(conf).globStatus(glob) or []
        if len(statuses) == read.get(dept_dir, 0):
            continue
        for status in statuses:
            path = status.getPath()
            hidden = path.getName()[0] in "_."
            if status.isFile() and (hidden or status.getLen() == 0):
                found.append((path.toString(), dept_dir, HIDDEN if hidden else EMPTY))
    return spark.createDataFrame(found, "path string, dept_dir string, reject_reason string")


def _matching(spark: SparkSession, folders: DepartmentFolders) -> list[str]:
    """The folder patterns that match at least one file; Spark refuses others."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [(glob, hadoop.Path(glob)) for glob in folders.csv_globs(spark)]
    return [glob for glob, path in paths if path.getFileSystem(conf).globStatus(path)]


def _file_key() -> Column:
    """64-bit key of a file, the same for every way of reading it."""
    return F.xxhash64("_metadata.file_path")


def _read_lines(spark: SparkSession, globs: list[str], folders: DepartmentFolders) -> DataFrame:
    """Undecoded lines with keys of the file and the split they come from."""
    start = F.col("_metadata.file_block_start")
    folder = F.url_decode(F.replace(_folder_of(F.col("_metadata.file_path")), F.lit("+"), F.lit("%2B")))
    return (
        spark.read.option("lineSep", "\n")
        .text(globs)
        .where(folder.isin(*folders.departments))
        .select(
            F.xxhash64("_metadata.file_path", start).alias("split"),
            _file_key().alias("file"),
            start.alias("start"),
            F.col("value").cast("binary").alias("line"),
        )
    )


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal neighbours."""
    if len(keys) == 0:
        return
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    bounds = [0, *cuts.tolist(), len(keys)]
    yield from zip(bounds[:-1], bounds[1:])


def _end_state(line: bytes, quoted: bool) -> bool:
    """Whether a quoted field is open behind the line."""
    pattern = _CLOSED_FROM_QUOTE if quoted else _CLOSED_FROM_START
    return pattern.fullmatch(line) is None


def _valid_encodings(lines: pa.Array, still: int) -> int:
    """Bits of the encodings, among those still possible, that all lines decode in."""
    joined = pc.binary_join(
        pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), b"\n"
    )[0].as_py()
    for bit, encoding in enumerate(_CHECKED):
        if still >> bit & 1:
            try:
                joined.decode(encoding)
            except UnicodeDecodeError:
                still &= ~(1 << bit)
    return still


_SPLIT_SCHEMA = (
    "split long, file long, start long, encodings int, open_if_plain boolean, "
    "open_if_quoted boolean, closes_if_quoted boolean"
)


def _summarize_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split; rows of a split are neighbours because nothing was shuffled."""
    names = [part.split()[0] for part in _SPLIT_SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_()]

    def packed(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names
        )

    row = None
    for batch in batches:
        done = []
        keys = batch.column("split").to_numpy(zero_copy_only=False)
        lines = batch.column("line")
        has_quote = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
        for low, high in _runs(keys):
            if row is None or int(keys[low]) != row[0]:
                if row:
                    done.append(row)
                file, start = batch.column("file")[low].as_py(), batch.column("start")[low].as_py()
                row = [int(keys[low]), file, start, (1 << len(_CHECKED)) - 1, False, True, False]
            row[3] = _valid_encodings(lines.slice(low, high - low), row[3])
            for at in np.flatnonzero(has_quote[low:high]):
                line = lines[low + int(at)].as_py()
                row[4] = _end_state(line, row[4])
                row[5] = _end_state(line, row[5])
                row[6] = row[6] or not row[5]
        if done:
            yield packed(done)
    if row:
        yield packed([row])


def _first_valid(order: tuple[str, ...]) -> Column:
    """First encoding of the order whose bit is set; null without any."""
    picks = [
        F.when(F.col("encodings").bitwiseAND(F.lit(1 << _CHECKED.index(e))) != 0, F.lit(e))
        for e in order
        if e in _CHECKED
    ]
    return F.coalesce(*picks)


def _resolve_splits(summaries: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Encoding, verdict and quoting state per split, from one row per split.

    A split maps "quoted at its start" to "quoted at its end". It either ends
    the same way whatever the start was (then the start no longer matters), or
    keeps or flips it. So the state before a split is that of the last
    preceding split of the first kind, flipped once per flipping split since.
    """
    per_file = Window.partitionBy("file")
    before = (
        per_file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    )
    fixed = F.col("open_if_plain") == F.col("open_if_quoted")
    flips = F.when(~fixed & F.col("open_if_plain"), 1).otherwise(0)
    flips_until_here = F.sum(flips).over(
        per_file.orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    )
    reset = F.when(
        F.col("fixed"),
        F.struct(F.col("open_if_plain").cast("int").alias("open"), F.col("flips_so_far")),
    )
    known = F.coalesce(
        F.last(reset, ignorenulls=True).over(before),
        F.struct(F.lit(0).alias("open"), F.lit(0).cast("long").alias("flips_so_far")),
    )
    flips_before = F.coalesce(F.lag("flips_so_far").over(per_file.orderBy("start")), F.lit(0))
    quoted = (F.col("known.open") + F.col("flips_before") - F.col("known.flips_so_far")) % 2 == 1
    opens_record = F.col("quoted_after") & (~F.col("quoted") | F.col("closes_if_quoted"))
    return (
        summaries.withColumns({"fixed": fixed, "flips_so_far": flips_until_here})
        .withColumns({"known": known, "flips_before": flips_before})
        .withColumn("quoted", quoted)
        .withColumn(
            "quoted_after",
            F.when(F.col("quoted"), F.col("open_if_quoted")).otherwise(F.col("open_if_plain")),
        )
        .withColumns(
            {
                # The split in which the record open at this split's start began.
                "owner": F.last(F.when(opens_record, F.col("start")), ignorenulls=True).over(
                    before
                ),
                "encodings": F.bit_and("encodings").over(per_file),
                "open_at_end": F.max_by("quoted_after", "start").over(per_file),
            }
        )
        .withColumn("encoding", _first_valid(order))
        .withColumn(
            "reject_reason",
            F.when(F.col("encoding").isNull(), F.lit(UNDECODABLE)).when(
                F.col("open_at_end"), F.lit(MALFORMED)
            ),
        )
        .select("split", "file", "start", "quoted", "owner", "encoding", "reject_reason")
    )


# A piece is valid for splits that start plain (0), quoted (1) or either way (2).
_PLAIN, _QUOTED, _EITHER = 0, 1, 2
_RECORD_SCHEMA = "split long, offset long, valid_for int, early boolean, record binary"
_PIECE_SCHEMA = "split long, offset long, valid_for int, role string, piece binary"


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    kinds |= {"string": pa.string(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [
            column if isinstance(column, pa.Array) else pa.array(column, kinds[kind])
            for column, (_, kind) in zip(columns, fields)
        ],
        [name for name, _ in fields],
    )


class _Track:
    """Record cutting under one assumption about the start of a split.

    ``pending`` holds the lines of the record being read, and is None while
    that record began in an earlier split. ``offset`` is the place of its first
    line in bytes. The first two records that are not blank count as early:
    the header and the first data record of a file are always among those.
    """

    def __init__(self, assumption: int):
        self.assumption = assumption
        self.quoted = assumption == _QUOTED
        self.pending: list[bytes] | None = None if self.quoted else []
        self.offset = 0
        self.n_early = 0

    def early(self, record: bytes) -> bool:
        if self.n_early == 2 or not record.strip(b" \t\r"):
            return False
        self.n_early += 1
        return True

    def hold(self, offset: int, lines: list[bytes]) -> None:
        """Lines inside an open quoted field, or the first one that opens it."""
        if self.pending is not None and lines:
            if not self.pending:
                self.offset = offset
            self.pending.extend(lines)

    def feed(self, offset: int, line: bytes) -> bytes | None:
        """The finished record, if this line finishes one that began in the split."""
        self.hold(offset, [line])
        if b'"' in line:
            self.quoted = _end_state(line, self.quoted)
        if self.quoted:
            return None
        finished, self.pending = self.pending, []
        return None if finished is None else b"\n".join(finished)


def _located_runs(batches: Iterator[pa.RecordBatch]):
    """Yield (is new split, split, offsets, lines, has_quote) per run, None per batch end."""
    current, ahead = None, 0
    for batch in batches:
        keys = batch.column("split").to_numpy(zero_copy_only=False)
        lines = batch.column("line")
        has_quote = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
        sizes = pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        for low, high in _runs(keys):
            fresh = current is None or keys[low] != current
            if fresh:
                current = keys[low]
                ahead = 0
            ends = ahead + np.cumsum(sizes[low:high])
            yield (
                fresh,
                int(current),
                ends - sizes[low:high],
                lines.slice(low, high - low),
                has_quote[low:high],
            )
            ahead = int(ends[-1])
        yield None


def _cut(
    batches: Iterator[pa.RecordBatch], on_record, on_stretch, on_head, on_end
) -> Iterator[None]:
    """Follow the quoting state through each split; yields after every batch.

    Calls ``on_record(split, offset, valid_for, early, record)`` for a record
    with quotes, ``on_stretch`` with arrays for a stretch of records without
    any, ``on_head(split, offsets, lines)`` for lines that belong to a record
    from before the split, and ``on_end(split, tracks)`` behind its last line.
    """
    tracks: list[_Track] = []
    current = None
    for run in _located_runs(batches):
        if run is None:
            yield
            continue
        fresh, split, offsets, lines, has_quote = run
        if fresh:
            if current is not None:
                on_end(current, tracks)
            current, tracks = split, [_Track(_PLAIN), _Track(_QUOTED)]
        at = 0
        for quote_at in [*np.flatnonzero(has_quote).tolist(), len(lines)]:
            stretch = lines.slice(at, quote_at - at)
            for track in tracks:
                if quote_at == at:
                    pass
                elif not track.quoted:
                    early = np.zeros(len(stretch), bool)
                    if track.n_early < 2:
                        early[:] = [track.early(line.as_py()) for line in stretch]
                    on_stretch(split, offsets[at:quote_at], track.assumption, early, stretch)
                elif track.pending is None:
                    on_head(split, offsets[at:quote_at], stretch)
                else:
                    track.hold(int(offsets[at]), stretch.to_pylist())
                if quote_at < len(lines):
                    if track.pending is None:
                        on_head(split, offsets[quote_at : quote_at + 1], lines.slice(quote_at, 1))
                    record = track.feed(int(offsets[quote_at]), lines[quote_at].as_py())
                    if record is not None:
                        early = track.n_early < 2 and track.early(record)
                        on_record(split, track.offset, track.assumption, early, record)
            if len(tracks) == 2 and not tracks[0].quoted and not tracks[1].quoted:
                # Both assumptions agree from here on.
                tracks[0].n_early = min(track.n_early for track in tracks)
                tracks[0].assumption = _EITHER
                tracks = tracks[:1]
            at = quote_at + 1
    if current is not None:
        on_end(current, tracks)
    yield


def _cut_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that begin and end within one split."""
    single: list[tuple] = []
    chunks: list[pa.RecordBatch] = []

    def stretch(split, offsets, valid_for, early, records) -> None:
        splits = pa.repeat(pa.scalar(split, pa.int64()), len(records))
        valid = pa.repeat(pa.scalar(valid_for, pa.int32()), len(records))
        chunks.append(_batch(_RECORD_SCHEMA, [splits, offsets, valid, early, records]))

    def record(*row) -> None:
        single.append(row)

    for _ in _cut(batches, record, stretch, lambda *_: None, lambda *_: None):
        if single:
            yield _batch(_RECORD_SCHEMA, list(zip(*single)))
            single.clear()
        if chunks:
            yield pa.Table.from_batches(chunks).combine_chunks().to_batches()[0]
            chunks.clear()


def _cut_boundary_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last lines of a split that belong to a record crossing its bounds."""
    out: list[tuple] = []

    def head(split, offsets, lines) -> None:
        for offset, line in zip(offsets.tolist(), lines.to_pylist()):
            out.append((split, offset, _QUOTED, "head", line))

    def tail(split, tracks) -> None:
        for track in tracks:
            if track.quoted:
                # Offsets only have to keep the order of the lines.
                for n, line in enumerate(track.pending or []):
                    out.append((split, track.offset + n, track.assumption, "tail", line))

    def ignore(*_) -> None:
        return None

    for _ in _cut(batches, ignore, ignore, head, tail):
        if out:
            yield _batch(_PIECE_SCHEMA, list(zip(*out)))
            out.clear()


# Which pieces fit the real state at the start of their split.
_VALID_HERE = "valid_for = 2 OR valid_for = CAST(quoted AS INT)"


def _boundary_records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Records that cross split bounds, one group per record."""
    pieces = lines.select("split", "line").mapInArrow(_cut_boundary_pieces, _PIECE_SCHEMA)
    begins = F.when(F.col("role") == "tail", F.col("start")).otherwise(F.col("owner"))
    owned = pieces.join(splits, "split").where(_VALID_HERE).withColumn("begins", begins)
    ordered = F.array_sort(F.collect_list(F.struct("start", "offset", "piece")))
    # Joined as hexadecimal text, because the pieces are not decoded yet.
    glued = F.unhex(F.array_join(F.transform("pieces", lambda p: F.hex(p["piece"])), "0A"))
    return (
        owned.groupBy("file", "begins", "encoding")
        .agg(ordered.alias("pieces"))
        .select(
            "file",
            (F.col("begins") + F.col("pieces")[0]["offset"]).alias("offset"),
            "encoding",
            F.lit(True).alias("early"),
            glued.alias("record"),
        )
    )


def _fields_of(text: str) -> list[list[str]]:
    """Fields of the records in a text; blank lines give none.

    A lone carriage return ends a record too, so one text may hold several.
    """
    if text.endswith("\r"):
        text = text[:-1]
    if not text.strip(" \t\r"):
        return []
    if '"' not in text and "\r" not in text:
        return [text.split(",")]
    rows = csv.reader(io.StringIO(text, newline=""))
    return [row for row in rows if row and (len(row) > 1 or row[0].strip(" \t") or '"' in text)]


_PARSED_SCHEMA = "file long, place long, early boolean, width int, fields array<string>"


def _parse_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decoded fields per record. Its place is the byte offset of its text plus
    its number therein; every record takes a byte at least, so places are distinct.
    """
    csv.field_size_limit(2**31 - 1)
    for batch in batches:
        cells: list[str] = []
        bounds, texts, numbers = [0], [], []
        raw, encodings = batch.column("record").to_pylist(), batch.column("encoding").to_pylist()
        for at, (record, encoding) in enumerate(zip(raw, encodings)):
            for number, fields in enumerate(_fields_of(record.decode(encoding))):
                cells.extend(fields)
                bounds.append(len(cells))
                texts.append(at)
                numbers.append(number)
        index = pa.array(texts, pa.int64())
        ends = np.array(bounds, np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("file").take(index),
                pc.add(batch.column("offset").take(index), pa.array(numbers, pa.int64())),
                batch.column("early").take(index),
                pa.array(np.diff(ends)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(cells, pa.string())),
            ],
            ["file", "place", "early", "width", "fields"],
        )


@dataclass(frozen=True)
class DepartmentRows:
    """What reading the folders gives.

    ``rows`` has one row per data record: path, dept_dir, encoding, header,
    fields, shift. ``files`` has one row per file with its encoding, header and,
    for a rejected file, the reason. ``missing`` lists absent folders.
    """

    rows: DataFrame
    files: DataFrame
    missing: list[str]


def read_department_rows(
    spark: SparkSession, folders: DepartmentFolders, order: str = "utf8_first"
) -> DepartmentRows:
    """Read all records of all files, each file in the first encoding that fits it.

    ``order`` is ``"utf8_first"``, or ``"gbk_first"`` to try the Chinese
    encodings first; that order reads some UTF-8 texts as other characters.
    """
    encodings = ENCODING_ORDERS[order]
    listing = scan_department_files(spark, folders)
    globs = _matching(spark, folders)
    if not globs:
        empty = "path string, dept_dir string, encoding string, header array<string>"
        return DepartmentRows(
            spark.createDataFrame([], empty + ", fields array<string>, shift int"),
            spark.createDataFrame([], empty + ", reject_reason string"),
            folders.missing(spark),
        )

    lines = _read_lines(spark, globs, folders)
    splits = materialize(
        _resolve_splits(lines.mapInArrow(_summarize_splits, _SPLIT_SCHEMA), encodings),
        "csv-splits",
    )
    found = splits.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("split").alias("n_keys"),
        F.coalesce(F.bool_or("quoted"), F.lit(False)).alias("any_quoted"),
    ).first()
    n_files = listing.agg(F.countDistinct("file"), F.countDistinct("path")).first()
    if found["n_keys"] != found["n"] or n_files[0] != n_files[1]:
        raise RuntimeError("two files or splits share a 64-bit key; read the folders separately")
    usable = splits.where(F.col("reject_reason").isNull())
    keyed = usable.select("split", "file", "start", "quoted", "encoding")
    if found["n"] <= MAX_BROADCAST_SPLITS:
        keyed = F.broadcast(keyed)

    records = (
        lines.select("split", "line")
        .mapInArrow(_cut_records, _RECORD_SCHEMA)
        .join(keyed, "split")
        .where(_VALID_HERE)
        .select(
            "file", (F.col("start") + F.col("offset")).alias("offset"), "encoding", "early", "record"
        )
    )
    # Only a quoted line break at a split bound makes the extra pass necessary.
    if found["any_quoted"]:
        records = records.unionByName(_boundary_records(lines, usable))

    parsed = materialize(records.mapInArrow(_parse_records, _PARSED_SCHEMA), "csv-records")
    rank = F.row_number().over(Window.partitionBy("file").orderBy("place"))
    first_two = parsed.where("early").withColumn("rank", rank).where("rank <= 2")
    heads = first_two.groupBy("file").agg(
        F.min_by("fields", "place").alias("header"),
        F.min("place").alias("header_at"),
        F.max_by("width", "place").alias("first_width"),
    )
    widths = parsed.groupBy("file").agg(F.max("width").alias("widest"))
    # A first data record wider than the header shifts the columns to the
    # right; any later record wider than that makes the file malformed.
    columns = F.greatest(F.size("header"), F.col("first_width"))
    verdicts = (
        splits.where("start = 0")
        .select("file", "encoding", F.col("reject_reason").alias("split_reason"))
        .join(heads, "file", "left")
        .join(widths, "file", "left")
        .select(
            "file",
            "encoding",
            "header",
            "header_at",
            (columns - F.size("header")).alias("shift"),
            F.coalesce(
                "split_reason",
                F.when(F.col("header").isNull(), F.lit(EMPTY)),
                F.when(F.col("widest") > columns, F.lit(MALFORMED)),
            ).alias("reject_reason"),
        )
    )
    files = listing.join(verdicts, "file", "left")
    rows = (
        parsed.select("file", "place", "fields")
        .join(files.where(F.col("reject_reason").isNull()), "file")
        .where("place > header_at")
        .select("path", "dept_dir", "encoding", "header", "fields", "shift")
    )
    return DepartmentRows(
        rows,
        files.select("path", "dept_dir", "encoding", "header", "reject_reason").unionByName(
            unread_files(spark, folders, listing), allowMissingColumns=True
        ),
        folders.missing(spark),
    )
