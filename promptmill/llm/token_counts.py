"""Token counts of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.pieces import PieceEncoder
from promptmill.llm.shared import broadcast_file, ready, schema_with, slices, strings, with_columns, worker_state

def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of ``text`` in the long column ``out``.

    ``tokenizer`` is the path of a ``.json`` file of the ``tokenizers`` library or
    a ``.model`` file of ``sentencepiece``. No begin, end or added special tokens;
    special strings inside a text are taken as the library takes them by default.
    A null or empty text has 0 tokens. Rows, repeated ones too, keep all their
    columns; a column already named ``out`` is replaced. Nothing is shuffled.

    Arrow batches are cut into slices by bytes, texts are cut at safe boundaries
    (so a long text never builds one huge encoding) and their distinct pieces go
    through the library in batches of equal size; only lengths are kept.
    """
    spark = ready(docs.sparkSession)
    held = broadcast_file(spark, tokenizer)
    model = tokenizer.endswith(".model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _piece_model_counter(held.value) if model else _file_counter(held)
        for batch in slices(batches, text):
            counts = count([value or "" for value in strings(batch, text)])
            yield with_columns(batch, **{out: pa.array(counts, pa.int64())})

    return docs.mapInArrow(run, schema_with(docs, **{out: "bigint"}))


def _file_counter(held):
    """One encoder per worker process and tokenizer file, so that later tasks know the words of earlier ones."""
    return worker_state(("counts", hash(held.value)), lambda: PieceEncoder(held.value.decode(), len, sum))


def _piece_model_counter(model: bytes):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]


def token_count_report(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """doc_id, UTF-8 bytes, tokens, and whether a document has more than ``limit`` tokens."""
    small = docs.select("doc_id", "text")
    return count_tokens(small, tokenizer).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
