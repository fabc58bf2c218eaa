"""Column profile: exact counts and lengths, sketches within their error, profiles of parts merged as the whole."""

import random

import numpy as np
import pytest

from promptmill.operators import profile


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(2)
    rows = []
    for i in range(20_000):
        word = None if i % 17 == 0 else "" if i % 23 == 0 else "w" * rng.randint(1, 60) + str(rng.randint(0, 4000))
        rows.append((i, word, [i % 3, i % 5] if i % 11 else None, float(i % 97) / 4))
    return spark.createDataFrame(rows, "id long, word string, pair array<int>, `odd name.x` double")


def exact(table):
    out = {}
    data = table.collect()
    for name in table.columns:
        texts = [None if r[name] is None else r[name] for r in data]
        cast = table.select(table[f"`{name}`"].cast("string").alias("t")).collect()
        values = [r.t for r in cast]
        lengths = sorted(len(v) for v in values if v is not None)
        out[name] = dict(
            n_rows=len(values), n_null=sum(v is None for v in texts), n_empty=sum(v == "" for v in values),
            min_length=lengths[0] if lengths else None, max_length=lengths[-1] if lengths else None, sum_length=sum(lengths),
            distinct=len({v for v in values if v is not None}), lengths=lengths,
        )
    return out


def test_exact_figures_and_sketches_within_their_error(table):
    want = exact(table)
    got = {r.column: r for r in profile.column_profile(table).collect()}
    assert set(got) == set(table.columns)
    for name, w in want.items():
        r = got[name]
        assert (r.n_rows, r.n_null, r.n_empty, r.min_length, r.max_length, r.sum_length) == (
            w["n_rows"], w["n_null"], w["n_empty"], w["min_length"], w["max_length"], w["sum_length"]
        )
        # HLL of 2^12 buckets: 1.6 % standard error; three of them.
        assert abs(r.distinct_estimate - w["distinct"]) <= 0.05 * w["distinct"] + 1
        lengths = np.asarray(w["lengths"])
        for q, value in ((0.5, r.median_length), (0.9, r.p90_length)):
            rank = np.searchsorted(lengths, value, "right") / len(lengths)
            low = np.searchsorted(lengths, value, "left") / len(lengths)
            assert low - 0.03 <= q <= rank + 0.03


def test_merged_parts_equal_the_whole(table):
    whole = profile.profile_sketches(table)
    parts = [profile.profile_sketches(table.where(f"id % 3 = {k}")) for k in range(3)]
    merged = profile.merge_profiles(*parts)
    a = {r.column: r for r in profile.finish_profile(whole).collect()}
    b = {r.column: r for r in profile.finish_profile(merged).collect()}
    for name in a:
        assert [a[name][c] for c in profile.EXACT] == [b[name][c] for c in profile.EXACT]
        assert a[name].distinct_estimate == pytest.approx(b[name].distinct_estimate, rel=1e-9)
        assert abs(a[name].median_length - b[name].median_length) <= 3


def test_empty_table(spark):
    empty = spark.createDataFrame([], "id long, word string")
    rows = {r.column: r for r in profile.column_profile(empty).collect()}
    assert rows["word"].n_rows == 0 and rows["word"].min_length is None and rows["word"].median_length is None
