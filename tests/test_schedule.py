import hashlib

import pytest
from pyspark.sql import functions as F

from promptmill.operators import schedule


def key(i, seed=3407):
    return (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i)


@pytest.fixture
def rows(spark):
    return spark.range(1000).repartition(5).withColumnRenamed("id", "k")


@pytest.mark.parametrize("digits", [1, 4])
def test_rank_is_the_sorted_place(rows, digits):
    order = sorted(range(1000), key=key)
    got = {r.rank: r.k for r in schedule.seeded_rank(rows, ["k"], digits=digits).collect()}
    assert [got[i] for i in range(1000)] == order
    assert [r.k for r in schedule.seeded_shuffle(rows, ["k"]).collect()] == order


def test_budget_takes_the_first_ranks(rows):
    order = sorted(range(1000), key=key)
    options = schedule.ScheduleOptions(max_steps=60)
    assert options.budget == 480
    got = schedule.sample_budget(rows, ["k"], options)
    assert {(r.rank, r.k) for r in got.collect()} == set(enumerate(order[:480]))


@pytest.mark.parametrize("max_steps, epochs", [(-1, 2), (300, 1), (125, 9), (10, 3)])
def test_schedule(rows, max_steps, epochs):
    options = schedule.ScheduleOptions(max_steps=max_steps, epochs=epochs)
    expected = set()
    n_steps = max_steps if max_steps > 0 else epochs * 125
    for epoch in range(-(-n_steps // 125)):
        order = sorted(range(1000), key=lambda i: key(i, 3407 + epoch))
        for rank, k in enumerate(order):
            step = epoch * 125 + rank // 8
            if step < n_steps:
                expected.add((k, epoch, rank, step, rank % 8 // 2))
    got = schedule.training_schedule(rows, ["k"], options).collect()
    assert {(r.k, r.epoch, r.rank, r.step, r.micro_step) for r in got} == expected
    assert len(got) == len(expected)


def test_schedule_of_nothing(spark):
    empty = spark.range(0).withColumnRenamed("id", "k")
    assert schedule.training_schedule(empty, ["k"], schedule.ScheduleOptions()).count() == 0


def test_token_limits(spark):
    df = spark.createDataFrame([(1, "a b\u3000c\nd"), (2, " "), (3, "")], "k long, text string")
    got = {r.k: (r.n_tokens, r.tokens) for r in schedule.limit_tokens(df, max_tokens=3).collect()}
    assert got == {1: (4, ["a", "b", "c"]), 2: (0, []), 3: (0, [])}


def test_pluggable_tokenizer(spark):
    df = spark.createDataFrame([(1, "abcd")], "k long, text string")
    row = schedule.limit_tokens(df, max_tokens=2, tokenize=lambda c: F.split(c, "")).first()
    assert row.n_tokens == 4 and row.tokens == ["a", "b"]


def test_prompt_and_completion_limits(spark):
    df = spark.createDataFrame(
        [("w " * 256, "w " * 768), ("w " * 257, "w"), ("w", "w " * 769)], "prompt string, completion string"
    )
    got = {(r.prompt_tokens, r.completion_tokens): r.fits for r in schedule.limit_prompt_completion(df).collect()}
    assert got == {(256, 768): True, (257, 1): False, (1, 769): False}


def test_packing_lays_tokens_end_to_end(spark):
    sizes = {i: (i * 7) % 23 for i in range(200)}
    sizes[5] = 400  # longer than several blocks
    df = spark.createDataFrame(
        [(i, n, [f"{i}.{t}" for t in range(n)]) for i, n in sizes.items()],
        "k long, n_tokens long, tokens array<string>",
    )
    stream = [f"{i}.{t}" for i in sorted(sizes, key=key) for t in range(sizes[i])]
    placed = schedule.pack_sequences(df, ["k"], block_length=64)
    blocks = {r.block_id: r.tokens for r in schedule.assemble_blocks(placed).collect()}
    expected = [stream[i:i + 64] for i in range(0, len(stream), 64)]
    assert [blocks[i] for i in range(len(blocks))] == expected
