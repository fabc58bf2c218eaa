"""Group advantages of arriving completions: keyed state, emission when full, timers for the rest."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from promptmill.operators.scoring import group_advantage
from promptmill.streaming import group_state, streams
from promptmill.workspace import fresh_dir

SCHEMA = "prompt_id long, gen_id long, reward_total double, n_generations long, arrived timestamp"


def test_moments_merge_like_one_pass():
    rng = np.random.default_rng(1)
    values = rng.normal(size=101)
    parts = np.split(values, [3, 4, 50, 50, 99])
    merged = group_state.moments(np.zeros(0))
    for part in parts:
        merged = group_state.merge_moments(merged, group_state.moments(part))
    n, mean, m2, low, high = merged
    assert n == 101 and low == values.min() and high == values.max()
    assert mean == pytest.approx(values.mean(), abs=1e-12)
    assert m2 / (n - 1) == pytest.approx(values.var(ddof=1), rel=1e-12)


def land(spark, folder, batches):
    """Each batch of rows one file, read one file a trigger."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/part={i:03d}")
    return streams.read_arriving(spark, f"{folder}/part=*", SCHEMA, maxFilesPerTrigger=1)


def collect(spark, arriving, **options):
    result = group_state.stream_advantages(arriving, event_time="arrived", **options)
    path = fresh_dir(spark, "advantages")
    streams.write_arriving(result, path, fresh_dir(spark, "advantages-state")).awaitTermination()
    return spark.read.schema(result.schema).parquet(path)


def test_any_arrival_order_equals_the_batch_query(spark):
    rng = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for prompt in range(40):
        size = rng.choice([1, 2, 6, 6, 6, 9])
        same = rng.random() < 0.2
        for g in range(size):
            reward = 1.5 if same else rng.choice([0.0, 0.5, 2.0, 2.5, None])
            rows.append((prompt, prompt * 100 + g, reward, size, t0))
    rows += [(7777, 10**6 + g, float(g % 3), 300, t0) for g in range(300)]  # one hot prompt
    rng.shuffle(rows)
    batches = [rows[i : i + 97] for i in range(0, len(rows), 97)]
    got = collect(spark, land(spark, fresh_dir(spark, "arriving"), batches))
    assert got.where("timed_out").count() == 0
    table = spark.createDataFrame(rows, SCHEMA)
    want = group_advantage(table).select("gen_id", F.round("advantage", 9).alias("want"))
    both = got.select("gen_id", F.round("advantage", 9).alias("got")).join(want, "gen_id", "full")
    assert both.count() == len(rows)
    assert both.where(~F.col("got").eqNullSafe(F.col("want"))).count() == 0


def test_incomplete_group_leaves_when_its_timer_fires(spark):
    t0 = dt.datetime(2024, 1, 1)
    later = t0 + dt.timedelta(hours=1)
    batches = [
        [(1, 10, 1.0, 3, t0), (1, 11, 2.0, 3, t0)],  # two of three
        [(2, 20, 1.0, 2, later), (2, 21, 3.0, 2, later)],  # complete; moves the watermark past the first timer
        [(3, 30, 1.0, 2, later)],
    ]
    got = {r.gen_id: r for r in collect(spark, land(spark, fresh_dir(spark, "arriving"), batches), timeout_ms=60_000).collect()}
    assert got[10].timed_out and got[11].timed_out and got[10].n == 2
    assert got[10].advantage == pytest.approx((1.0 - 1.5) / (np.std([1.0, 2.0], ddof=1) + 1e-4))
    assert not got[20].timed_out and got[21].advantage > 0
    assert 30 not in got  # its timer lies ahead of the watermark; it waits in the state store


def test_state_calls_follow_buckets_not_prompts(spark):
    """A dozen messages to the state server a prompt made a stream over a million prompts take hours."""
    calls = spark.sparkContext.accumulator(0)

    class Counting(group_state.GroupAdvantages):
        def handleInputRows(self, key, rows, timerValues):
            calls.add(1)
            yield from super().handleInputRows(key, rows, timerValues)

    t0 = dt.datetime(2024, 1, 1)
    rows = [(p, p * 10 + g, float(g), 3, t0) for g in range(3) for p in range(2000)]
    arriving = land(spark, fresh_dir(spark, "arriving"), [rows[:3000], rows[3000:]])
    plain, group_state.GroupAdvantages = group_state.GroupAdvantages, Counting
    try:
        result = group_state.stream_advantages(arriving, event_time="arrived", buckets=16)
    finally:
        group_state.GroupAdvantages = plain
    path = fresh_dir(spark, "advantages")
    streams.write_arriving(result, path, fresh_dir(spark, "advantages-state")).awaitTermination()
    got = spark.read.schema(result.schema).parquet(path)
    assert got.count() == 6000 and got.where("n = 3 and mean_reward = 1 and not timed_out").count() == 6000
    assert calls.value <= 2 * 16


def test_waiting_members_move_between_chunks_and_null_prompts_are_one_group(spark, monkeypatch):
    """Small chunks, prompts that complete in different batches, one that never does, rows without a prompt or a reward."""
    monkeypatch.setattr(group_state, "EMIT_ROWS", 5)
    rng = random.Random(8)
    t0, later = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [(p if p else None, p * 100 + g, rng.choice([None, 0.5, 1.0, float(g)]), 1 + p % 9, t0) for p in range(60) for g in range(1 + p % 9)]
    rows += [(1000, 10**6 + g, float(g), 99, t0) for g in range(23)]
    rng.shuffle(rows)
    batches = [rows[i : i + 61] for i in range(0, len(rows), 61)] + [[(2000, 1, 1.0, 1, later)], [(2001, 2, 1.0, 1, later)]]
    got = collect(spark, land(spark, fresh_dir(spark, "arriving"), batches), buckets=3, timeout_ms=60_000).toPandas()
    assert sorted(got.gen_id) == sorted([r[1] for r in rows] + [1, 2])
    assert set(got[got.timed_out].prompt_id) == {1000} and (got[got.timed_out].n == 23).all()
    for prompt, group in got.groupby("prompt_id", dropna=False):
        reward = group.reward_total.dropna()
        std = reward.std(ddof=1) if len(reward) > 1 else 0.0
        assert (group.n == len(reward)).all()
        if std:
            want = (group.reward_total - reward.mean()) / (std + 1e-4)
            np.testing.assert_allclose(group.advantage.astype(float), want.astype(float), atol=1e-9)
        else:
            assert (group.advantage == 0).all()
    assert got.prompt_id.isna().sum() == 1
