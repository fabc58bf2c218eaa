"""Text expressions against the Python behaviour they stand for."""

import re

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptmill.functions import text

PIECES = [
    "<answer>", "</answer>", "<reasoning>", "</reasoning>", "\n", "\n</answer>\n", "\n<answer>\n",
    "####", "#", "### Response:", " ", "\t", "\r", "\x1c", "\x85", "\xa0", "\u2028", "\u3000",
    "7", "²", "٣", "-", "a", "é", "发", "😀", ",", ".",
]
texts = st.lists(st.sampled_from(PIECES), max_size=9).map("".join)
batches = st.lists(texts, min_size=150, max_size=150)
few = settings(
    max_examples=4, deadline=None, phases=[Phase.explicit, Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.large_base_example,
                           HealthCheck.data_too_large, HealthCheck.too_slow],
)


def xml_answer(t):
    return t.split("<answer>")[-1].split("</answer>")[0].strip()


def hash_answer(t):
    return t.split("####")[1].strip() if "####" in t else None


def response(t):
    at = t.find("### Response:")
    return t if at < 0 else t[at + len("### Response:"):].strip()


@few
@given(batches)
def test_strings_like_python(apply, batch):
    def everything(c):
        return F.struct(
            text.py_strip(c), text.extract_xml_answer(c), text.extract_hash_answer(c),
            text.extract_response(c), text.is_digit(c), text.count_occurrences(c, "\n<answer>\n"),
            text.tail_after_last(c, "\n</answer>\n"), text.tail_after_last(c, "\n</answer>"),
            text.whitespace_tokens(c), F.length(c),
        )

    for t, out in zip(batch, apply(everything, batch)):
        assert tuple(out) == (
            t.strip(), xml_answer(t), hash_answer(t), response(t), t.isdigit(),
            t.count("\n<answer>\n"), t.split("\n</answer>\n")[-1], t.split("\n</answer>")[-1],
            t.split(), len(t),
        ), repr(t)


def test_every_basic_plane_character(apply):
    chars = [chr(i) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000]
    digits = apply(text.is_digit, chars)
    stripped = apply(text.py_strip, chars)
    for char, digit, rest in zip(chars, digits, stripped):
        assert digit == char.isdigit(), hex(ord(char))
        assert rest == char.strip(), hex(ord(char))


def test_overlapping_separator_is_counted_from_the_left(apply):
    value = "\n</answer>\n</answer>\n"
    assert apply(lambda c: text.tail_after_last(c, "\n</answer>\n"), [value]) == ["</answer>\n"]


def test_hash_answer_edges(apply):
    values = ["none", "a #### 18", "a #### 18 #### 20", "a####", "a#####b"]
    assert apply(text.extract_hash_answer, values) == [None, "18", "18", "", "#b"]


def test_messages(spark):
    df = spark.sql(
        "SELECT array(named_struct('role','a','content','x'), named_struct('role','b','content','y')) m"
    )
    row = df.select(
        text.first_message_content(F.col("m")), text.last_message_content(F.col("m"))
    ).first()
    assert tuple(row) == ("x", "y")


def test_missing_preview_and_cast(spark):
    df = spark.sql("SELECT double('NaN') d, cast(null as string) s, repeat('ab', 800) t, 1.5D v")
    row = df.select(
        text.is_missing(F.col("d"), floating=True), text.is_missing(F.col("s")),
        F.length(text.preview_text(F.col("t"))), text.to_text(F.col("v")),
    ).first()
    assert tuple(row) == (True, True, 1000, "1.5")


def test_constants():
    every = {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert set(text.WHITESPACE) == every
    assert not re.search("[^\x00-\x7f]", text.WHITESPACE_CLASS)
