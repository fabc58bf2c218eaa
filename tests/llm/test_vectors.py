"""Embedding near duplicates by a random-projection forest: against all pairs, with odd vectors and copies."""

import math

import numpy as np

from promptmill.llm import vector_forest


def brute(rows):
    """(n_links, component_id) by key from all pairs of equal labels."""
    def ok(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)

    good = [(i, r) for i, r in enumerate(rows) if r[0] is not None and r[2] is not None and ok(r[1])]
    links = {i: set() for i, _ in good}
    for x, (i, a) in enumerate(good):
        for j, b in good[x + 1 :]:
            if a[2] != b[2] or len(a[1]) != len(b[1]):
                continue
            u, v = np.asarray(a[1], float), np.asarray(b[1], float)
            if u @ v / (math.sqrt(u @ u) * math.sqrt(v @ v)) >= vector_forest.LEAST_COSINE:
                links[i].add(j)
                links[j].add(i)
    result = {}
    for i, row in enumerate(rows):
        if i not in links:
            result[i] = (0, row[0])
            continue
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        result[i] = (len(links[i]), min(rows[j][0] for j in seen))
    return result


def odd_rows():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((6, 8))
    rows = []
    for k in range(40):
        v = base[k % 6] + rng.standard_normal(8) * (0.05 if k % 3 else 0.8)
        rows.append((k, [float(x) for x in v], k % 2))
    rows += [(40, None, 0), (41, [0.0] * 8, 0), (42, [1.0, None] + [0.0] * 6, 0), (43, [float("nan")] * 8, 0)]
    rows += [(44, rows[0][1], None), (None, rows[0][1], 0), (45, rows[0][1], 0), (45, rows[0][1], 0), (46, [], 0)]
    rows += [(47, rows[0][1][:4], 0), (48, rows[0][1][:4], 0), (49, [float("inf")] + [1.0] * 7, 0)]
    return rows


def run(spark, rows):
    df = spark.createDataFrame(
        [(k, v, lab, "x", 1) for k, v, lab in rows], "vec_id long, embedding array<float>, label int, `__vec` string, n_links int"
    )
    found = vector_forest.vector_report(df).collect()
    assert len(found) == len(rows)
    return found


def test_odd_vectors_against_all_pairs(spark):
    rows = odd_rows()
    rows = [(k, None if v is None else [float(np.float32(x)) if x is not None else None for x in v], lab) for k, v, lab in rows]
    found = run(spark, rows)
    want = brute(rows)
    got = sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id if r.component_id is not None else -1) for r in found)
    expect = sorted((k if k is not None else -1, n, c if c is not None else -1) for (k, _, _), (n, c) in zip(rows, want.values()))
    assert got == expect
    for r in found:
        assert r.kept == (r.vec_id is None or r.vec_id == r.component_id)


def test_recall_when_spark_and_tasks_split(spark, monkeypatch):
    monkeypatch.setattr(vector_forest, "LOCAL_ROWS", 60)
    monkeypatch.setattr(vector_forest, "LEAF", 16)
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((30, 16))
    rows = []
    for k in range(600):
        v = centres[k % 30] + rng.standard_normal(16) * 0.12
        rows.append((k, [float(np.float32(x)) for x in v], k % 3))
    rows += [(1000 + k, rows[5][1], rows[5][2]) for k in range(200)]  # a large group of copies
    found = {r.vec_id: (r.n_links, r.component_id) for r in run(spark, rows)}
    want = brute(rows)
    total = sum(n for n, _ in want.values())
    got = sum(found[k][0] for k, _, _ in rows)
    assert got <= total
    assert got >= 0.9 * total
    assert all(found[rows[i][0]][0] <= want[i][0] for i in want)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_forest.vector_report(df).count() == 0
