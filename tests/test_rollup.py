"""Reject subtotals: one rollup, one shuffle, levels told apart from null values."""

from promptmill.operators import cleaning


def test_rollup_levels_and_one_shuffle(spark):
    rows = [("a", "f1", None), ("a", "f1", "too_long"), ("a", "f2", None), ("b", "f3", "missing"), (None, "f4", None)]
    df = spark.createDataFrame(rows, "dept_dir string, file string, reject_reason string")
    found = cleaning.reject_rollup(df)
    got = sorted((r.level, r.dept_dir or "", r.file or "", r.reason or "", r.n_rows) for r in found.collect())
    assert ("total", "", "", "", 5) in got
    assert ("dept_dir", "a", "", "", 3) in got and ("dept_dir", "", "", "", 1) in got  # the null department
    assert ("file", "a", "f1", "", 2) in got and ("reason", "a", "f1", "too_long", 1) in got
    assert len(got) == 1 + 3 + 4 + 5
    plan = cleaning.reject_rollup(df)._jdf.queryExecution().executedPlan().toString()  # not run: the initial plan
    assert plan.count("Exchange") == 1 and "Expand" in plan
