"""Instruction rows to training text, and batch-wise user functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptmill.functions.templates import format_instruction_prompt, format_qa_prompt


@dataclass(frozen=True)
class InstructionOptions:
    template: str | None = None
    eos: str | None = None
    compat: bool = False


def label_instructions(
    df: DataFrame,
    options: InstructionOptions = InstructionOptions(),
    needed: tuple[str, ...] = ("instruction", "output"),
) -> DataFrame:
    """Add ``reject_reason`` for rows that lack a needed cell, named by the first one lacking."""
    lacking = [F.when(F.col(name).isNull(), F.lit(f"missing_{name}")) for name in needed]
    reason = F.lit(None).cast("string") if options.compat else F.coalesce(*lacking)
    return df.withColumn("reject_reason", reason)


def format_instructions(df: DataFrame, options: InstructionOptions = InstructionOptions()) -> DataFrame:
    """Add ``text``; a table that has it already is returned as it is."""
    if "text" in df.columns:
        return df
    usable = label_instructions(df, options).where(F.col("reject_reason").isNull())
    text = format_instruction_prompt(
        F.col("instruction"),
        F.col("input"),
        F.col("output"),
        template=options.template,
        eos=options.eos,
        compat=options.compat,
    )
    return usable.drop("reject_reason").withColumn("text", text)


def format_qa(df: DataFrame, eos: str, template: str | None = None, compat: bool = False) -> DataFrame:
    """Add ``text`` from ``input`` and ``output`` alone, unless it is there already.

    Rows that lack one drop out; ``label_instructions`` with ``needed=("input",
    "output")`` names them.
    """
    if "text" in df.columns:
        return df
    options = InstructionOptions(compat=compat)
    usable = label_instructions(df, options, ("input", "output")).where("reject_reason IS NULL")
    text = format_qa_prompt(F.col("input"), F.col("output"), eos, template=template, compat=compat)
    return usable.drop("reject_reason").withColumn("text", text)


def select_text_field(df: DataFrame, field: str = "text") -> DataFrame:
    """The one column a trainer reads."""
    return df.select(field)


def map_batched(
    df: DataFrame,
    function: Callable[[dict[str, list]], dict[str, list]],
    new_columns: str,
    batch_columns: list[str] | None = None,
) -> DataFrame:
    """Apply a user function to batches of columns given as lists.

    ``new_columns`` declares the returned columns; they replace columns of the
    same name. ``batch_columns`` limits what the function gets to see. Use
    ``df.withColumns`` instead wherever Spark functions can express the work.
    """
    added = T.StructType.fromDDL(new_columns)
    kept = [f for f in df.schema.fields if f.name not in added.names]
    seen = batch_columns or df.columns
    schema = T.StructType(kept + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        for batch in batches:
            result = function({name: batch.column(name).to_pylist() for name in seen})
            arrays = [batch.column(f.name) for f in kept]
            arrays += [pa.array(result[f.name], to_arrow_type(f.dataType)) for f in added.fields]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def preview_first(df: DataFrame, order_by: list[str], **fields) -> DataFrame:
    """The named fields of the first row in the given order."""
    return (
        df.orderBy(*order_by)
        .limit(1)
        .select(*[column.alias(name) for name, column in fields.items()])
    )
