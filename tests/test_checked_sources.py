"""Broken JSON and CSV records come back as rejects with their file; the rest are read."""

from promptmill.sources import tables
from promptmill.workspace import fresh_dir


def test_broken_records_are_rejects(spark):
    folder = fresh_dir(spark, "records")
    lines = ['{"instruction": "a", "input": "b", "output": "c"}', '{"instruction": "cut', "not json at all", '{"instruction": "d"}']
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{folder}/json")
    good, bad = tables.read_checked(spark, f"{folder}/json", "json")
    assert sorted((r.instruction, r.input) for r in good.collect()) == [("a", "b"), ("d", None)]
    rejects = bad.collect()
    assert sorted(r.record for r in rejects) == ["not json at all", '{"instruction": "cut']
    assert all(r.reject_reason == "malformed_record" and r.file.endswith(".txt") for r in rejects)

    rows = ["n,question", "1,fine", "2x,bad key", '3,"quoted, with comma"']
    spark.createDataFrame([(line,) for line in rows], "value string").coalesce(1).write.text(f"{folder}/csv")
    good, bad = tables.read_checked(spark, f"{folder}/csv", "csv", "n long, question string")
    assert sorted((r.n, r.question) for r in good.collect()) == [(1, "fine"), (3, "quoted, with comma")]
    assert [r.record for r in bad.collect()] == ["2x,bad key"]


def test_empty_folder_of_files(spark):
    folder = fresh_dir(spark, "records")
    spark.createDataFrame([], "value string").write.text(folder)
    good, bad = tables.read_checked(spark, folder, "json")
    assert good.count() == 0 and bad.count() == 0
