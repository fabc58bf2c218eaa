"""Prompt templates compiled to plain string concatenation."""

from __future__ import annotations

from collections.abc import Sequence
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prompt texts and constants that results must agree with.
INSTRUCTION_TEMPLATE = (
    "Below is an instruction that describes a task,\n"
    "paired with an input that provides further context.\n"
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{}\n\n"
    "### Input:\n{}\n\n"
    "### Response:\n{}"
)
# The same text with a blank behind the comma of the first line.
INSTRUCTION_TEMPLATE_SPACED = INSTRUCTION_TEMPLATE.replace("a task,\n", "a task, \n", 1)
MEDICAL_TEMPLATE = (
    "你是一个专业的医疗助手。请根据患者的问题提供专业、准确的回答。\n\n"
    "### 问题：\n{}\n\n### 回答：\n{}"
)
MEDICAL_INSTRUCTION = "请回答以下医疗相关问题"


def compile_template(template: str) -> list[str | int]:
    """Split a positional template into literal texts and slot numbers.

    Follows ``str.format``: ``{}`` counts up, ``{0}`` addresses, ``{{`` and
    ``}}`` are literal braces. Named slots, conversions and format
    specifications have no meaning for plain columns and are refused.
    """
    parts: list[str | int] = []
    counted = 0
    addressed = False
    for literal, field, spec, conversion in Formatter().parse(template):
        if literal:
            if parts and isinstance(parts[-1], str):
                parts[-1] += literal
            else:
                parts.append(literal)
        if field is None:
            continue
        if spec or conversion:
            raise ValueError(f"template slot {{{field}}} may not carry a format")
        if field == "":
            parts.append(counted)
            counted += 1
        elif field.isdigit():
            parts.append(int(field))
            addressed = True
        else:
            raise ValueError(f"template slot {{{field}}} is not positional")
    if counted and addressed:
        raise ValueError("a template cannot mix {} with numbered slots")
    return parts


def fill_template(template: str, values: Sequence[Column]) -> Column:
    """Template text with its slots filled; values beyond the slots are unused."""
    parts = compile_template(template)
    highest = max((part for part in parts if isinstance(part, int)), default=-1)
    if highest >= len(values):
        raise ValueError(f"template needs {highest + 1} values, got {len(values)}")
    pieces = [F.lit(part) if isinstance(part, str) else values[part] for part in parts]
    return F.concat(*pieces) if pieces else F.lit("")


def append_eos(text: Column, eos: str | None) -> Column:
    """Text followed by the end-of-sequence marker, when there is one."""
    return F.concat(text, F.lit(eos)) if eos else text


def _or_none_word(value: Column, compat: bool) -> Column:
    return F.coalesce(value, F.lit("None")) if compat else value


def format_instruction_prompt(
    instruction: Column,
    input_text: Column,
    response: Column,
    template: str | None = None,
    eos: str | None = None,
    compat: bool = False,
) -> Column:
    """Instruction, input and response in the three-slot template.

    A null input renders as empty text. A null instruction or response gives a
    null result, so the row can be rejected; ``compat=True`` renders every null
    as the word ``None``, as Python's own formatting does.
    """
    if not compat:
        input_text = F.coalesce(input_text, F.lit(""))
    values = [_or_none_word(v, compat) for v in (instruction, input_text, response)]
    return append_eos(fill_template(template or INSTRUCTION_TEMPLATE, values), eos)


def build_inference_prompt(
    instruction: Column,
    input_text: Column,
    template: str | None = None,
    eos: str | None = None,
    compat: bool = False,
) -> Column:
    """The instruction template with an empty response slot, open-ended by default."""
    return format_instruction_prompt(
        instruction, input_text, F.lit(""), template=template, eos=eos, compat=compat
    )


def format_qa_prompt(
    question: Column,
    answer: Column,
    eos: str,
    template: str | None = None,
    compat: bool = False,
) -> Column:
    """Question and answer in the two-slot template; the marker is mandatory."""
    if eos is None:
        raise ValueError("question-answer text needs an end-of-sequence marker")
    values = [_or_none_word(question, compat), _or_none_word(answer, compat)]
    return append_eos(fill_template(template or MEDICAL_TEMPLATE, values), eos)


def format_xml_cot(reasoning: Column, answer: Column) -> Column:
    """Reasoning and answer in the tagged multi-line layout."""
    return F.concat(
        F.lit("<reasoning>\n"),
        reasoning,
        F.lit("\n</reasoning>\n<answer>\n"),
        answer,
        F.lit("\n</answer>\n"),
    )
