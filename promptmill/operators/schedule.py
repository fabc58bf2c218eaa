"""Reproducible order, sample budgets, training schedule, token limits and packing.

All of it rests on one idea. Rows get a pseudo-random sort key, the md5 of seed
and id. Leading hex digits of an md5 spread distinct ids evenly over a fixed
number of buckets, and bucket order is key order. So a global running sum is
the sum of all earlier buckets, taken from a table of fixed size, plus a running
sum inside the row's own bucket. Nothing ever passes through a single task, and
the result depends on the data alone, not on how it happens to be partitioned.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions.text import whitespace_tokens
from promptmill.workspace import materialize

# Fixed value: the seed of every recipe.
DEFAULT_SEED = 3407

# 16**4 = 65,536 buckets: a table of that size is about a megabyte.
BUCKET_DIGITS = 4
MAX_BUCKET_DIGITS = 5


def shuffle_key(ids: Sequence[str], seed: int | Column = DEFAULT_SEED) -> Column:
    """Sort key of a row, equal on every engine and partitioning."""
    seed_text = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws(":", seed_text, *[F.col(c).cast("string") for c in ids]))


def seeded_shuffle(df: DataFrame, ids: Sequence[str], seed: int = DEFAULT_SEED) -> DataFrame:
    """The rows in reproducible pseudo-random order (a range-partitioned sort)."""
    return df.orderBy(shuffle_key(ids, seed), *ids)


def with_place(df: DataFrame) -> DataFrame:
    """Add ``place``, the 0-based place of each row as the frame is ordered.

    The rows are written once with their partition and number in it; the rows of
    earlier partitions are counted from one small row per partition.
    """
    at = "place_"
    held = materialize(df.withColumn(at, F.monotonically_increasing_id()), "places")
    part = F.shiftright(at, 33)
    sizes = held.groupBy(part.alias("part_")).agg(F.count("*").alias("n_"))
    ahead = F.sum("n_").over(Window.orderBy("part_")) - F.col("n_")
    starts = sizes.select("part_", ahead.alias("start_"))
    joined = held.withColumn("part_", part).join(F.broadcast(starts), "part_")
    inside = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn("place", F.col("start_") + inside).drop(at, "part_", "start_")


def _running_total(
    df: DataFrame,
    ids: Sequence[str],
    value: Column,
    before: str,
    digits: int,
    limit: int | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Add ``before``, the sum of ``value`` over all rows ahead in ``key_`` order.

    ``ids`` must identify a row. ``within`` restarts the sum per value of those
    columns. With ``limit``, buckets that start at or beyond it are dropped
    before any row is shuffled.
    """
    if not 1 <= digits <= MAX_BUCKET_DIGITS:
        raise ValueError(f"digits must be 1 to {MAX_BUCKET_DIGITS}: the bucket table is broadcast")
    groups = [*within, "bucket_"]
    valued = df.withColumns(
        {"bucket_": F.substring("key_", 1, digits), "value_": value.cast("long")}
    )
    sums = valued.groupBy(*groups).agg(F.sum("value_").alias("sum_"))
    # A window over at most 16**digits small rows (per group of ``within``),
    # however large the input.
    in_order = Window.partitionBy(*within).orderBy("bucket_")
    offsets = sums.select(
        *groups, (F.sum("sum_").over(in_order) - F.col("sum_")).alias("offset_")
    )
    located = valued.join(offsets if within else F.broadcast(offsets), groups)
    if limit is not None:
        located = located.where(F.col("offset_") < limit)
    ahead = (
        Window.partitionBy(*groups)
        .orderBy("key_", *ids)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum("value_").over(ahead), F.lit(0))
    return located.withColumn(before, F.col("offset_") + inside).drop(
        "bucket_", "value_", "offset_", "key_"
    )


def seeded_rank(
    df: DataFrame,
    ids: Sequence[str],
    seed: int = DEFAULT_SEED,
    limit: int | None = None,
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Add ``rank``, the 0-based place of each row in the seeded order."""
    keyed = df.withColumn("key_", shuffle_key(ids, seed))
    ranked = _running_total(keyed, ids, F.lit(1), "rank", digits, limit)
    return ranked if limit is None else ranked.where(F.col("rank") < limit)


@dataclass(frozen=True)
class ScheduleOptions:
    """Run size. ``max_steps`` above 0 takes precedence over ``epochs``."""

    per_device_batch: int = 2
    accumulation: int = 4
    devices: int = 1
    epochs: int = 1
    max_steps: int = -1
    seed: int = DEFAULT_SEED

    @property
    def micro_batch(self) -> int:
        return self.per_device_batch * self.devices

    @property
    def effective_batch(self) -> int:
        return self.per_device_batch * self.accumulation * self.devices

    @property
    def budget(self) -> int | None:
        """Samples a step limit consumes; None when epochs decide."""
        return self.max_steps * self.effective_batch if self.max_steps > 0 else None


def sample_budget(
    df: DataFrame, ids: Sequence[str], options: ScheduleOptions, digits: int = BUCKET_DIGITS
) -> DataFrame:
    """The samples a run consumes in its first epoch, with their ``rank``."""
    return seeded_rank(df, ids, options.seed, options.budget, digits)


def training_schedule(
    df: DataFrame,
    ids: Sequence[str],
    options: ScheduleOptions,
    n_rows: int | None = None,
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """One row per use of a sample: ``epoch``, ``step`` and ``micro_step``.

    Each epoch has its own order, seeded with the seed plus its number. ``step``
    counts optimizer steps through the whole run, ``micro_step`` the batches
    accumulated within one. Counting the rows is a job of its own, unless the
    count is known; everything else is lazy.
    """
    n_rows = df.count() if n_rows is None else n_rows
    size = options.effective_batch
    per_epoch = max(1, -(-n_rows // size))
    n_steps = options.max_steps if options.max_steps > 0 else options.epochs * per_epoch
    whole_epochs, rest = divmod(n_steps, per_epoch)
    parts = []
    if whole_epochs:
        copies = df.withColumn(
            "epoch", F.explode(F.sequence(F.lit(0), F.lit(whole_epochs - 1)))
        )
        keyed = copies.withColumn("key_", shuffle_key(ids, F.lit(options.seed) + F.col("epoch")))
        parts.append(_running_total(keyed, ids, F.lit(1), "rank", digits, within=["epoch"]))
    if rest:
        last = seeded_rank(df, ids, options.seed + whole_epochs, rest * size, digits)
        parts.append(last.withColumn("epoch", F.lit(whole_epochs)))
    ranked = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    step = F.expr(f"epoch * {per_epoch}L + rank div {size}L")
    micro_step = F.expr(f"CAST(rank % {size}L div {options.micro_batch}L AS INT)")
    return ranked.withColumns({"step": step, "micro_step": micro_step})


TokenCounter = Callable[[Column], Column]


def limit_tokens(
    df: DataFrame,
    text: str = "text",
    max_tokens: int = 2048,
    tokenize: TokenCounter = whitespace_tokens,
) -> DataFrame:
    """Add ``n_tokens`` and ``tokens``, the token array cut to the limit.

    ``tokenize`` maps a text column to an array column; an Arrow UDF around a
    real tokenizer fits as well as the default whitespace split.
    """
    return (
        df.withColumn("all_tokens_", tokenize(F.col(text)))
        .withColumns(
            {
                "n_tokens": F.size("all_tokens_"),
                "tokens": F.slice("all_tokens_", 1, max_tokens),
            }
        )
        .drop("all_tokens_")
    )


def limit_prompt_completion(
    df: DataFrame,
    prompt: str = "prompt",
    completion: str = "completion",
    max_prompt: int = 256,
    max_length: int = 1024,
    tokenize: TokenCounter = whitespace_tokens,
) -> DataFrame:
    """Add token counts of prompt and completion and whether both fit.

    The completion may use what the prompt limit leaves of the whole length.
    """
    return df.withColumns(
        {
            "prompt_tokens": F.size(tokenize(F.col(prompt))),
            "completion_tokens": F.size(tokenize(F.col(completion))),
        }
    ).withColumn(
        "fits",
        (F.col("prompt_tokens") <= max_prompt)
        & (F.col("completion_tokens") <= max_length - max_prompt),
    )


def pack_sequences(
    df: DataFrame,
    ids: Sequence[str],
    block_length: int = 2048,
    n_tokens: str = "n_tokens",
    seed: int = DEFAULT_SEED,
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Lay all samples end to end in seeded order and cut into equal blocks.

    One row per sample and block it touches: ``block_id``, the place
    ``block_offset`` inside the block, and ``token_from`` and ``token_count``
    within the sample. Only the last block can be short. Samples without
    tokens take no room. The input is read twice, so hand over a written table
    of ids and counts rather than an expression that tokenizes.
    """
    keyed = df.withColumn("key_", shuffle_key(ids, seed))
    placed = _running_total(keyed, ids, F.col(n_tokens), "start_", digits)
    length = F.lit(block_length).cast("long")
    first = F.expr(f"start_ div {block_length}L")
    last = F.expr(f"(start_ + `{n_tokens}` - 1) div {block_length}L")
    low = F.greatest(F.col("start_"), F.col("block_id") * length)
    high = F.least(F.col("start_") + F.col(n_tokens), (F.col("block_id") + 1) * length)
    blocks = F.when(F.col(n_tokens) > 0, F.sequence(first, last))
    return (
        placed.withColumn("block_id", F.explode(blocks))
        .withColumns(
            {
                "block_offset": low - F.col("block_id") * length,
                "token_from": low - F.col("start_"),
                "token_count": high - low,
            }
        )
        .drop("start_")
    )


def assemble_blocks(placements: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Token arrays of the packed blocks. A group never exceeds one block."""
    piece = F.slice(tokens, F.col("token_from").cast("int") + 1, F.col("token_count").cast("int"))
    pieces = F.array_sort(F.collect_list(F.struct("block_offset", piece.alias("piece"))))
    return placements.groupBy("block_id").agg(
        F.flatten(F.transform(pieces, lambda p: p["piece"])).alias("tokens")
    )
