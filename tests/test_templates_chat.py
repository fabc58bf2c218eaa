import pytest
from pyspark.sql import functions as F

from promptmill.functions import chat, templates
from promptmill.operators.instructions import (
    InstructionOptions, format_instructions, format_qa, label_instructions, map_batched,
)

ROWS = [
    ("50% {off} {}", "1, 1, 2", "ok"), (None, "x", "y"), ("q", None, "y"), ("q", "x", None),
    ("q", "", "}{"),
]


@pytest.fixture
def triples(spark):
    return spark.createDataFrame(ROWS, "instruction string, input string, output string")


def test_default_nulls(triples):
    options = InstructionOptions(eos="</s>")
    got = {r.text for r in format_instructions(triples, options).collect()}
    t = templates.INSTRUCTION_TEMPLATE
    assert got == {
        t.format(i, x or "", o) + "</s>" for i, x, o in ROWS if i is not None and o is not None
    }
    reasons = {r.reject_reason for r in label_instructions(triples).collect()}
    assert reasons == {None, "missing_instruction", "missing_output"}


def test_compatible_nulls(triples):
    got = [r.text for r in format_instructions(triples, InstructionOptions(compat=True)).collect()]
    assert sorted(got) == sorted(templates.INSTRUCTION_TEMPLATE.format(*row) for row in ROWS)


def test_text_column_is_kept(spark):
    df = spark.createDataFrame([("a", "b", "c", "mine")], "instruction string, input string, output string, text string")
    assert format_instructions(df).first().text == "mine"
    assert format_qa(df, "</s>").first().text == "mine"


def test_qa_needs_marker(triples):
    with pytest.raises(ValueError):
        format_qa(triples, None)


@pytest.mark.parametrize(
    "template", ["{}-{}-{}", "{2}{0}{1}{0}", "{{{}}} %s {} {{}}", "none", "", "{}"]
)
def test_custom_template(apply, template):
    values = (["a{}"], ["%d"], ["c"])
    got = apply(lambda a, b, c: templates.fill_template(template, [a, b, c]), *values)
    assert got == [template.format("a{}", "%d", "c")]


@pytest.mark.parametrize("template", ["{name}", "{0}{}", "{!r}", "{:>5}", "{}{}{}{}", "{3}"])
def test_bad_template(spark, template):
    with pytest.raises(ValueError):
        templates.fill_template(template, [F.lit("a"), F.lit("b"), F.lit("c")])


def test_spaced_template():
    assert templates.INSTRUCTION_TEMPLATE_SPACED.startswith(
        "Below is an instruction that describes a task, \n"
    )


def test_inference_prompt_is_open(apply):
    got = apply(templates.build_inference_prompt, ["Continue."], ["1, 1"])[0]
    assert got == templates.INSTRUCTION_TEMPLATE.format("Continue.", "1, 1", "")


def test_xml_layout(apply):
    assert apply(templates.format_xml_cot, ["r"], ["a"]) == [
        "<reasoning>\nr\n</reasoning>\n<answer>\na\n</answer>\n"
    ]


def test_chat_text(apply):
    got = apply(lambda c: chat.build_chat_text(c, "sys"), ["hi"])[0]
    assert got == (
        "<|im_start|>system\nsys<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n"
    )
    # An empty system text falls back to the default.
    assert "<reasoning>" in apply(lambda c: chat.build_chat_text(c, ""), ["hi"])[0]


def test_vision_messages(spark):
    df = spark.range(1).select(
        chat.build_vision_conversation(F.lit(5), F.lit("r")).alias("train"),
        chat.build_vision_inference_messages(F.lit("q")).alias("ask"),
    )
    row = df.first()
    assert [p.type for p in row.train[0].content] == ["text", "image"]
    assert row.train[0].content[0].text == "5"
    assert [p.type for p in row.train[1].content] == ["text"]
    assert [p.type for p in row.ask[0].content] == ["image", "text"]


def test_map_batched_replaces_and_adds(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) s")
    got = map_batched(
        df, lambda b: {"s": [v + "!" for v in b["s"]], "n": [len(b["s"])] * len(b["s"])},
        "s string, n int", ["s"],
    )
    assert got.columns == ["id", "s", "n"]
    assert sorted(r.s for r in got.collect()) == [f"{i}!" for i in range(10)]
