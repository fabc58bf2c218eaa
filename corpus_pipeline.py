"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame; all but the last
return the columns of ``documents``. ``run`` writes every stage as Parquet to the
shared folder and reads it again as the next one's documents, so a lost executor
costs a re-read and no stage is computed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm.decontaminate import decontaminate
from promptmill.llm.langid import held_out, keep_known_language, train_language_model
from promptmill.llm.line_dedup import drop_shared_lines
from promptmill.llm.near_dup import keep_one_of_each
from promptmill.llm.shared import read_table, tokenizer_path
from promptmill.llm.spm import encode_pieces
from promptmill.workspace import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; those without text or a letter go."""
    return keep_known_language(docs, train_language_model(docs.where(~held_out())))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents share stay in the first of them only; a document with nothing left goes."""
    told = drop_shared_lines(docs, keep_first=True)
    told = told.where((F.col("kept_text") != "") | (F.col("n_dropped") == 0))
    told = told.withColumns({"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)})
    return told.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether they decode to its text."""
    model = tokenizer_path("piece_bpe_32k.model")
    told = encode_pieces(docs, model, decoded="decoded")
    return told.select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.size("ids").cast("bigint").alias("n_ids"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: SQL can express neither the classifier nor the signatures nor the encoder; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
