"""Datasets laid out in split (and subset) folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INSTRUCTION_SCHEMA = "instruction string, input string, output string"
QA_SCHEMA = "question string, answer string"
MANIFEST_SCHEMA = "id string, prompt string, image string, response string"


def _reader(spark: SparkSession, format: str, schema: str | None):
    reader = spark.read.format(format)
    if format == "csv":
        reader = reader.options(header=True, quote='"', escape='"', multiLine=True)
    return reader.schema(schema) if schema else reader


def read_instructions(
    spark: SparkSession,
    path: str,
    split: str = "train",
    format: str = "parquet",
    schema: str | None = INSTRUCTION_SCHEMA,
) -> DataFrame:
    """Instruction rows of one split, from a table partitioned by ``split``."""
    if schema:
        schema = f"{schema}, split string"
    return _reader(spark, format, schema).load(path).where(F.col("split") == split).drop("split")


def read_qa_subset(
    spark: SparkSession,
    path: str,
    subset: str = "main",
    split: str = "train",
    format: str = "parquet",
    schema: str | None = QA_SCHEMA,
) -> DataFrame:
    """Question-answer rows of one subset and split; other folders are not read."""
    if schema:
        schema = f"{schema}, subset string, split string"
    wanted = (F.col("subset") == subset) & (F.col("split") == split)
    return _reader(spark, format, schema).load(path).where(wanted).drop("subset", "split")


def read_manifest(
    spark: SparkSession, path: str, format: str = "csv", schema: str | None = MANIFEST_SCHEMA
) -> DataFrame:
    """Table of image paths with prompts and responses.

    A file that cannot be read fails with Spark's own error. Pass a schema for
    other column names, or None to take them from the file.
    """
    return _reader(spark, format, schema).load(path)


CORRUPT = "_corrupt_record"
MALFORMED = "malformed_record"


def read_checked(
    spark: SparkSession, path: str, format: str = "json", schema: str = INSTRUCTION_SCHEMA, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON-lines or CSV files that parse, and the broken records as rejects.

    Spark reads in permissive mode and keeps a record it cannot parse (bad JSON,
    a value of the wrong type) in its corrupt-record column (a CSV line with fewer or more fields is padded
    or cut by Spark, not rejected). The one scan is written once below the
    shared folder and split there: good rows with their ``file``, rejects as
    (file, record, reject_reason).
    """
    from promptmill.workspace import materialize

    reader = spark.read.format(format).schema(f"{schema}, {CORRUPT} string")
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if format == "csv":
        reader = reader.options(header=header, quote='"', escape='"')
    scanned = reader.load(path).withColumn("file", F.col("_metadata.file_path"))
    scanned = materialize(scanned, "checked-records")
    good = scanned.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = scanned.where(F.col(CORRUPT).isNotNull()).select(
        "file", F.col(CORRUPT).alias("record"), F.lit(MALFORMED).alias("reject_reason")
    )
    return good, bad
