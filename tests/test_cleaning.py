import pytest
from pyspark.sql import functions as F

from promptmill.operators import cleaning

ROWS = [
    ("\u3000q\x85", "a"), (" \t", "a"), ("q", None), (None, "a"), ("q" * 200, "😀" * 200),
    ("q" * 201, "a"), ("q", "😀" * 201), ("NA", "nan"), ("\x1cq", " a\xa0"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, "question string, answer string")


def test_reasons(raw):
    labelled = cleaning.label_qa(cleaning.pick_qa_columns(raw))
    report = {r.reason: r.n_rows for r in cleaning.reject_report(labelled).collect()}
    assert report == {
        "kept": 4, "missing_question": 2, "missing_answer": 1, "question_too_long": 1,
        "answer_too_long": 1,
    }
    kept = {(r.question, r.answer) for r in cleaning.kept(labelled).collect()}
    assert kept == {("q", "a"), ("q" * 200, "😀" * 200), ("NA", "nan")}
    assert cleaning.rejected(labelled).count() == 5


def test_compatible_missing_cells(raw):
    options = cleaning.CleaningOptions(compat=True)
    got = sorted((r.input, r.output) for r in cleaning.clean_qa(cleaning.pick_qa_columns(raw), options).collect())
    assert got == sorted([
        ("q", "a"), ("q", "nan"), ("nan", "a"), ("q" * 200, "😀" * 200), ("nan", "nan"), ("q", "a"),
    ])


def test_alias_is_chosen_by_header_only(spark):
    both = spark.createDataFrame([(None, "ask it", "a")], "question string, ask string, response string")
    row = cleaning.pick_qa_columns(both).first()
    assert row.question_raw is None and row.question_known and row.answer_raw == "a"
    none = spark.createDataFrame([("x",)], "other string")
    labelled = cleaning.label_qa(cleaning.pick_qa_columns(none), cleaning.CleaningOptions(compat=True))
    assert labelled.first().reject_reason == "missing_question"


def test_alias_cells_with_shift(spark):
    df = spark.createDataFrame(
        [(["ask", "回答"], ["i", "q", "a"], 1), (["回答", "ask"], ["a"], 0)],
        "header array<string>, fields array<string>, shift int",
    )
    got = {(r.question_raw, r.answer_raw) for r in cleaning.pick_qa_cells(df).collect()}
    assert got == {("q", "a"), (None, "a")}


def test_canonical_triple(raw):
    row = cleaning.clean_qa(cleaning.pick_qa_columns(raw)).first()
    assert row.asDict().keys() == {"instruction", "input", "output"}
    assert row.instruction == "请回答以下医疗相关问题"


def test_counts_and_emptiness(spark, tmp_path):
    df = spark.range(7)
    observed, observation = cleaning.count_while_writing(df, "prep")
    observed.write.parquet(str(tmp_path / "out"))
    assert observation.get == {"n_rows": 7}
    assert cleaning.kept_count(df).first().n_rows == 7
    assert cleaning.require_non_empty(df) is df
    with pytest.raises(ValueError):
        cleaning.require_non_empty(df.where("id < 0"))


def test_profile_and_union(spark):
    a, b = spark.range(2).withColumn("x", F.lit("x")), spark.range(3)
    assert cleaning.union_sources(a, b).count() == 5
    assert tuple(cleaning.table_profile(a).first()) == ("id, x", 2, 2)
