"""Question-answer cleaning with a recorded reason for every rejected row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from promptmill.functions.templates import MEDICAL_INSTRUCTION
from promptmill.functions.text import py_strip, to_text

# Accepted column names, in order of preference.
QUESTION_ALIASES = ("question", "问题", "ask")
ANSWER_ALIASES = ("answer", "回答", "response")

# Cell texts a default pandas read takes for missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

MISSING_QUESTION = "missing_question"
MISSING_ANSWER = "missing_answer"
QUESTION_TOO_LONG = "question_too_long"
ANSWER_TOO_LONG = "answer_too_long"


@dataclass(frozen=True)
class CleaningOptions:
    """``compat=True`` keeps a missing cell as the word ``nan`` instead of rejecting it."""

    max_length: int = 200
    instruction: str = MEDICAL_INSTRUCTION
    compat: bool = False


def pick_alias(columns: Sequence[str], aliases: Sequence[str]) -> str | None:
    """First alias among the columns of a table with one fixed header."""
    return next((alias for alias in aliases if alias in columns), None)


def alias_position(header: Column, aliases: Sequence[str]) -> Column:
    """1-based place of the first alias that the header holds; null without any.

    The choice depends on the header only: a null cell under the first alias
    does not fall back to another column.
    """
    places = [F.nullif(F.array_position(header, F.lit(a)), F.lit(0)) for a in aliases]
    return F.coalesce(*places)


def aliased_cell(
    header: Column, fields: Column, aliases: Sequence[str], shift: Column | None = None
) -> Column:
    """Cell under the first matching alias; null when no alias or cell exists."""
    place = alias_position(header, aliases).cast("int")
    index = place - F.lit(1) + (F.lit(0) if shift is None else shift)
    return F.get(fields, index)


def pick_qa_columns(
    df: DataFrame,
    question_aliases: Sequence[str] = QUESTION_ALIASES,
    answer_aliases: Sequence[str] = ANSWER_ALIASES,
) -> DataFrame:
    """Add ``question_raw`` and ``answer_raw`` from a table with one fixed header.

    Absent columns and null cells are both null here; ``question_known`` and
    ``answer_known`` tell them apart.
    """

    def picked(aliases: Sequence[str]) -> tuple[Column, Column]:
        name = pick_alias(df.columns, aliases)
        cell = F.lit(None).cast("string") if name is None else to_text(F.col(f"`{name}`"))
        return cell, F.lit(name is not None)

    question, question_known = picked(question_aliases)
    answer, answer_known = picked(answer_aliases)
    return df.withColumns(
        {
            "question_raw": question,
            "answer_raw": answer,
            "question_known": question_known,
            "answer_known": answer_known,
        }
    )


def pick_qa_cells(df: DataFrame) -> DataFrame:
    """The same from per-row ``header``, ``fields`` and ``shift`` columns."""
    header, fields, shift = F.col("header"), F.col("fields"), F.col("shift")
    return df.withColumns(
        {
            "question_raw": aliased_cell(header, fields, QUESTION_ALIASES, shift),
            "answer_raw": aliased_cell(header, fields, ANSWER_ALIASES, shift),
            "question_known": alias_position(header, QUESTION_ALIASES).isNotNull(),
            "answer_known": alias_position(header, ANSWER_ALIASES).isNotNull(),
        }
    )


def _cleaned(raw: Column, known: Column, compat: bool) -> Column:
    if not compat:
        return py_strip(raw)
    missing = raw.isNull() | raw.isin(*NA_TOKENS)
    return F.when(known, F.when(missing, F.lit("nan")).otherwise(py_strip(raw)))


def label_qa(df: DataFrame, options: CleaningOptions = CleaningOptions()) -> DataFrame:
    """Add stripped ``question`` and ``answer``, and ``reject_reason`` (null when kept).

    Lengths count characters; a text of exactly the limit is kept. A row with
    several faults gets the first one in the fixed order of checks.
    """
    question = _cleaned(F.col("question_raw"), F.col("question_known"), options.compat)
    answer = _cleaned(F.col("answer_raw"), F.col("answer_known"), options.compat)
    limit = options.max_length
    n_question = F.coalesce(F.length("question"), F.lit(0))
    n_answer = F.coalesce(F.length("answer"), F.lit(0))
    reason = (
        F.when(n_question == 0, F.lit(MISSING_QUESTION))
        .when(n_answer == 0, F.lit(MISSING_ANSWER))
        .when(n_question > limit, F.lit(QUESTION_TOO_LONG))
        .when(n_answer > limit, F.lit(ANSWER_TOO_LONG))
    )
    return df.withColumns({"question": question, "answer": answer}).withColumn(
        "reject_reason", reason
    )


def kept(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("reject_reason").isNotNull())


def to_canonical_triple(
    df: DataFrame, instruction: str = MEDICAL_INSTRUCTION, provenance: Sequence[str] = ()
) -> DataFrame:
    """Constant instruction, question as input, answer as output."""
    return df.select(
        F.lit(instruction).alias("instruction"),
        F.col("question").alias("input"),
        F.col("answer").alias("output"),
        *provenance,
    )


def clean_qa(
    df: DataFrame,
    options: CleaningOptions = CleaningOptions(),
    provenance: Sequence[str] = (),
) -> DataFrame:
    """Canonical triples of the rows that pass every check."""
    return to_canonical_triple(kept(label_qa(df, options)), options.instruction, provenance)


def reject_report(labelled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per reason, kept rows under ``kept``, optionally by further columns."""
    reason = F.coalesce(F.col("reject_reason"), F.lit("kept")).alias("reason")
    return labelled.groupBy(*by, reason).agg(F.count(F.lit(1)).alias("n_rows"))


def reject_rollup(labelled: DataFrame, levels: Sequence[str] = ("dept_dir", "file")) -> DataFrame:
    """Rows per reason with subtotals per level and a grand total, by one rollup.

    ``level`` names the row: ``reason`` for a count of one reason (kept rows
    under ``kept``) at the finest level, then the name of the finest level that
    is still set (a subtotal over all reasons), and ``total``. Rows are combined
    before the one shuffle that a rollup needs; a null in a level column is a
    value of its own, told apart from a subtotal by ``level``.
    """
    reason = F.coalesce(F.col("reject_reason"), F.lit("kept")).alias("reason")
    keys = [*levels, "reason"]
    grouped = labelled.select(*levels, reason).rollup(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.grouping(key).alias(f"__g{i}") for i, key in enumerate(keys)]
    )
    level = F.when(F.col(f"__g{len(keys) - 1}") == 0, F.lit("reason"))
    for i in range(len(levels) - 1, -1, -1):
        level = level.when(F.col(f"__g{i}") == 0, F.lit(levels[i]))
    level = level.otherwise(F.lit("total"))
    return grouped.select(level.alias("level"), *keys, "n_rows")


def kept_count(df: DataFrame) -> DataFrame:
    """Number of rows as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def count_while_writing(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count taken by the next action on the result, without a pass of its own."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("n_rows")), observation


def require_non_empty(df: DataFrame, what: str = "samples") -> DataFrame:
    """Fail when nothing is left. Looks at the first row it can find only."""
    if df.isEmpty():
        raise ValueError(f"no {what} left")
    return df


def union_sources(*sources: DataFrame) -> DataFrame:
    """All rows of all sources; columns a source lacks become null."""
    result = sources[0]
    for source in sources[1:]:
        result = result.unionByName(source, allowMissingColumns=True)
    return result


def union_with_extras(sources: Sequence[DataFrame], known: Sequence[str], extras: str = "extras") -> DataFrame:
    """All rows of sources with differing columns: ``known`` ones as columns, all others kept in one VARIANT.

    A known column a source lacks is null. Every other column of a source goes
    into ``extras`` by its own name and type (an object; empty where a source has
    none), so extras of any source can be read by name with ``variant_get``. A
    column of the name ``extras`` is an extra like the others.
    """
    result = None
    for source in sources:
        present = set(source.columns)
        others = [name for name in source.columns if name not in known]
        packed = (
            F.to_variant_object(F.struct(*[F.col(f"`{name.replace('`', '``')}`") for name in others]))
            if others else F.parse_json(F.lit("{}"))
        )
        frame = source.select(
            *[F.col(f"`{name}`") if name in present else F.lit(None).cast("string").alias(name) for name in known],
            packed.alias(extras),
        )
        result = frame if result is None else result.unionByName(frame)
    return result


def table_profile(df: DataFrame) -> DataFrame:
    """Column list and shape as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(", ".join(df.columns)).alias("columns"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
    )
