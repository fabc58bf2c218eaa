"""What several operators of this subpackage need: batches of texts, tokenizer files, result batches."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.workspace import ship_package

#: A tokenizer file is broadcast; larger files than this are refused.
MAX_TOKENIZER_BYTES = 64 << 20
#: Bytes of text a Python task handles at once.
SLICE_BYTES = 8 << 20


_STATE: dict = {}


def worker_state(key, make):
    """What a Python worker keeps from task to task; asking for another thing drops the one before.

    Workers serve many stages, so what each operator remembers must not add up.
    """
    if key not in _STATE:
        forget_state()
        _STATE[key] = make()
    return _STATE[key]


def forget_state() -> None:
    """Drop what an earlier operator's tasks left in this worker, and give the freed memory back to the system."""
    if not _STATE:
        return
    _STATE.clear()
    import gc

    gc.collect()
    _trim()


def _trim() -> None:
    """Return free heap pages to the system where the C library can (glibc); elsewhere nothing happens."""
    import ctypes
    import ctypes.util

    try:
        ctypes.CDLL(ctypes.util.find_library("c") or "libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def broadcast_file(spark: SparkSession, path: str):
    """A tokenizer file's bytes as a broadcast, read once on the driver; its size is checked."""
    size = os.path.getsize(path)
    if size > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} has {size} bytes, more than {MAX_TOKENIZER_BYTES}")
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package."""
    ship_package(spark)
    return spark


def slices(batches: Iterable[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that ``column`` holds about ``size`` bytes in each; one long text stands alone."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start, before = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start, before = stop, int(ends[stop - 1])


def broadcast_if_small(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """A join side marked for broadcast if it has at most ``rows`` (short) rows; else Spark joins by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """A batch with columns set, those of the same name replaced in place."""
    names, arrays = list(batch.schema.names), list(batch.columns)
    for name, array in columns.items():
        if name in names:
            arrays[names.index(name)] = array
        else:
            names.append(name)
            arrays.append(array)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def strings(batch: pa.RecordBatch, column: str) -> list[str | None]:
    return batch.column(column).to_pylist()


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """A text column's values as UTF-8 bytes."""
    array = batch.column(column)
    return array.cast(pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()).to_pylist()


def schema_with(df: DataFrame, **columns: str) -> str:
    """DDL of a frame's columns with some set, those of the same name replaced in place."""
    fields = {name: kind for name, kind in df.dtypes} | columns
    return ", ".join("`" + name.replace("`", "``") + "` " + kind for name, kind in fields.items())


def sha256_text(column) -> "F.Column":
    """Lowercase hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(F.encode(column, "UTF-8"), 256)
