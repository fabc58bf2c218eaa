"""Group statistics of completions while they arrive: keyed state with timers.

Each prompt's completions are held in the state store until the group is full
(``n_generations`` of them) or its time is over; then every member gets its
advantage, as ``group_advantage`` gives it over a whole table, and the state of
the prompt is dropped. Running statistics (count, mean, sum of squared
deviations, least and greatest reward) are merged batch by batch, so a group of
any size is never held in memory at once; its members are read back from the
state store in pieces when it is emitted.

Every call on a state variable is a message between the Python worker and the
JVM. The state is therefore keyed by buckets of prompts: the statistics of a
bucket are one value, the members lie in chunks of up to ``EMIT_ROWS`` rows, and
a batch costs a few messages a bucket, not a dozen a prompt.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Rows of a chunk of members, and rows emitted at once.
EMIT_ROWS = 65_536
#: Buckets of prompts, which are also the most tasks that can share a batch; fixed for the life of a checkpoint.
BUCKETS = 256
#: The bucket of rows without a prompt, which are one group.
NO_PROMPT = -1
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

OUTPUT = "prompt_id long, gen_id long, reward_total double, n long, mean_reward double, std_reward double, advantage double, timed_out boolean"

MOMENTS = ("n", "mean", "m2", "low", "high")
#: What is known of one prompt: moments, members, how many are wanted, when its time is over, and between which chunks its members lie.
STATS = np.dtype([
    ("prompt", "<i8"), *[(name, "<f8") for name in MOMENTS],
    ("size", "<i8"), ("wanted", "<i8"), ("due", "<i8"), ("first", "<i8"), ("last", "<i8"),
])
MEMBER = np.dtype([("prompt", "<i8"), ("gen", "<i8"), ("reward", "<f8")])
UNKNOWN, NEVER = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def merge_moments(left: tuple, right: tuple) -> tuple:
    """(n, mean, m2, low, high) of two parts together (Chan's pairwise update); numbers, or arrays of many groups."""
    n1, mean1, m21, low1, high1 = left
    n2, mean2, m22, low2, high2 = right
    n = n1 + n2
    with np.errstate(invalid="ignore"):  # infinite rewards have no mean
        delta = mean2 - mean1
        share = n2 / np.maximum(n, 1)
        mean = np.where(n1 == 0, mean2, np.where(n2 == 0, mean1, mean1 + delta * share))
        m2 = np.where(n1 == 0, m22, np.where(n2 == 0, m21, m21 + m22 + delta * delta * n1 * share))
    return n, mean, m2, np.minimum(low1, low2), np.maximum(high1, high2)


def moments(values: np.ndarray, group: np.ndarray | None = None, groups: int = 1) -> tuple:
    """(n, mean, m2, low, high) of the values, or arrays of them by ``group`` (numbers below ``groups``)."""
    alone = group is None
    group = np.zeros(len(values), np.int64) if alone else group
    n = np.bincount(group, minlength=groups)
    low, high = np.full(groups, np.inf), np.full(groups, -np.inf)
    np.minimum.at(low, group, values)
    np.maximum.at(high, group, values)
    with np.errstate(invalid="ignore"):
        mean = np.bincount(group, values, groups) / np.maximum(n, 1)
        m2 = np.bincount(group, (values - mean[group]) ** 2, groups)
    found = n, mean, m2, low, high
    return tuple(part[0].item() for part in found) if alone else found


class GroupAdvantages(StatefulProcessor):
    """Advantages of each prompt's completions once all have come, or when its time is over; keyed by bucket.

    Rows without a reward count as members but take no part in the statistics
    and get a null advantage (0 where the group's rewards are all equal), as in
    the batch query. A completion arriving after
    its group was emitted starts a new group. ``timeout_ms`` is measured in
    event time from the group's first row; a bucket's timer stands at the
    earliest such time and fires once the watermark passes it.
    """

    def __init__(self, epsilon: float = 1e-4, timeout_ms: int = 10 * 60 * 1000, event_time: str = "arrived"):
        self.event_time = event_time
        self.epsilon = epsilon
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.members = handle.getMapState("members", "chunk long", "rows binary")
        self.state = handle.getValueState("stats", "stats binary, chunks binary, next long, armed long")

    def _load(self) -> None:
        """The bucket's statistics, the numbers of its chunks, the next number, and the earliest timer."""
        held = self.state.get()
        stats, chunks, self.next, self.armed = held if held is not None else (b"", b"", 0, NEVER)
        self.stats = np.frombuffer(bytes(stats), STATS).copy()
        self.chunks = np.frombuffer(bytes(chunks), "<i8").tolist()
        self.tail = np.zeros(0, MEMBER)

    def _save(self) -> None:
        while len(self.tail):
            self._write_chunk()
        if not len(self.stats):
            self.state.clear()
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            return
        earliest = int(self.stats["due"].min())
        if earliest < self.armed:
            self.handle.registerTimer(earliest)
            self.armed = earliest
        self.state.update((self.stats.tobytes(), np.array(self.chunks, "<i8").tobytes(), self.next, self.armed))

    def _keep(self, rows: np.ndarray) -> None:
        """Members that wait; what exceeds a chunk is written to the state store."""
        self.tail = np.concatenate([self.tail, rows])
        while len(self.tail) >= EMIT_ROWS:
            self._write_chunk()

    def _write_chunk(self) -> None:
        rows, self.tail = self.tail[:EMIT_ROWS], self.tail[EMIT_ROWS:]
        self.members.updateValue((self.next,), (rows.tobytes(),))
        at = np.searchsorted(self.stats["prompt"], np.unique(rows["prompt"]))
        self.stats["first"][at] = np.minimum(self.stats["first"][at], self.next)
        self.stats["last"][at] = self.next
        self.chunks.append(self.next)
        self.next += 1

    def _count(self, frame: pd.DataFrame, key: int) -> None:
        """Take a frame of rows into the statistics and among the waiting members."""
        rows = np.zeros(len(frame), MEMBER)
        if key != NO_PROMPT:
            rows["prompt"] = frame["prompt_id"].astype("int64")
        rows["gen"] = frame["gen_id"].astype("int64")
        rows["reward"] = frame["reward_total"].astype("float64")
        prompts, group = np.unique(rows["prompt"], return_inverse=True)
        k, known = len(prompts), ~np.isnan(rows["reward"])

        stats = self.stats
        fresh = np.setdiff1d(prompts, stats["prompt"], assume_unique=True)
        if len(fresh):
            more = np.zeros(len(fresh), STATS)
            more["prompt"], more["low"], more["high"] = fresh, np.inf, -np.inf
            more["wanted"], more["due"], more["first"], more["last"] = UNKNOWN, NEVER, NEVER, -1
            stats = np.concatenate([stats, more])
            self.stats = stats = stats[np.argsort(stats["prompt"])]
            self.fresh = np.union1d(self.fresh, fresh)
        at = np.searchsorted(stats["prompt"], prompts)

        merged = merge_moments(tuple(stats[name][at] for name in MOMENTS), moments(rows["reward"][known], group[known], k))
        for name, values in zip(MOMENTS, merged):
            stats[name][at] = values
        stats["size"][at] += np.bincount(group, minlength=k)
        told = frame["n_generations"].notna().to_numpy()
        some, row = np.unique(group[told], return_index=True)
        asked = frame["n_generations"].to_numpy()[told][row].astype("int64")
        stats["wanted"][at[some]] = np.where(stats["wanted"][at[some]] == UNKNOWN, asked, stats["wanted"][at[some]])

        times = pd.to_datetime(frame[self.event_time]).to_numpy("datetime64[ns]").view("int64")
        first = np.full(k, NEVER)
        np.minimum.at(first, group, np.where(times == UNKNOWN, NEVER, times))
        due = np.where(first == NEVER, UNKNOWN, first) // 1_000_000 + self.timeout_ms
        new = np.isin(prompts, self.fresh)
        stats["due"][at[new]] = np.minimum(stats["due"][at[new]], due[new])
        self._keep(rows)

    def _emit(self, key: int, done: np.ndarray, timed_out: bool) -> Iterator[pd.DataFrame]:
        """Members of the prompts marked in ``done``, chunk by chunk; what else lies in those chunks goes into new ones."""
        ready, first, last = self.stats[done], self.stats["first"][done], self.stats["last"][done]
        tail, self.tail = self.tail, np.zeros(0, MEMBER)
        parts, held = [], 0
        for chunk in [*self.chunks, None]:
            if chunk is None:
                rows = tail
            elif ((first <= chunk) & (chunk <= last)).any():
                rows = np.frombuffer(bytes(self.members.getValue((chunk,))[0]), MEMBER)
            else:
                continue
            at = np.minimum(np.searchsorted(ready["prompt"], rows["prompt"]), len(ready) - 1)
            out = ready["prompt"][at] == rows["prompt"]
            if chunk is not None and out.any():
                self.members.removeKey((chunk,))
                self.chunks.remove(chunk)
            if chunk is None or out.any():
                self._keep(rows[~out])
            parts.append(self._frame(key, rows[out], ready[at[out]], timed_out))
            held += len(parts[-1])
            if held >= EMIT_ROWS:
                yield pd.concat(parts)
                parts, held = [], 0
        if held:
            yield pd.concat(parts)
        self.stats = self.stats[~done]

    def _frame(self, key: int, rows: np.ndarray, group: np.ndarray, timed_out: bool) -> pd.DataFrame:
        """Rows with their group's statistics (one for each row) and their advantage."""
        n, reward = group["n"], rows["reward"]
        with np.errstate(invalid="ignore"):
            std = np.where(n > 1, np.sqrt(group["m2"] / np.maximum(n - 1, 1)), np.nan)
            # as in the batch query, also for a row without a reward
            same = (n <= 1) | (group["low"] == group["high"])
            advantage = np.where(same, 0.0, (reward - group["mean"]) / (std + self.epsilon))
        return pd.DataFrame({
            "prompt_id": pd.array([None] * len(rows), "Int64") if key == NO_PROMPT else rows["prompt"],
            "gen_id": rows["gen"],
            "reward_total": reward,
            "n": n.astype("int64"),
            "mean_reward": np.where(n > 0, group["mean"], np.nan),
            "std_reward": std,
            "advantage": advantage,
            "timed_out": timed_out,
        })

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self._load()
        self.fresh = np.zeros(0, np.int64)  # prompts whose first rows are in this batch
        for frame in rows:
            if len(frame):
                self._count(frame, key[0])
        stats = self.stats
        done = (stats["wanted"] != UNKNOWN) & (stats["size"] >= stats["wanted"])
        if done.any():
            yield from self._emit(key[0], done, False)
        self._save()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._load()
        if not len(self.stats):
            return
        over = self.stats["due"]
        done = (over < timerValues.getCurrentWatermarkInMs()) | (over <= expiredTimerInfo.getExpiryTimeInMs())
        if done.any():
            yield from self._emit(key[0], done, True)
        self.armed = NEVER  # this timer is gone; the next one stands at the earliest time left
        self._save()

    def close(self) -> None:
        pass


def use_state_store(spark: SparkSession) -> None:
    """The RocksDB state store, which keyed state with lists and timers needs, where none or the HDFS-backed one is set.

    Another provider a user chose stays.
    """
    chosen = spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or ""
    if not chosen or chosen.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)


def run_caught_up(result: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append a stream to a folder until all that has arrived is processed, then stop and read the folder.

    Processing-time timers keep a stream asking for further batches, so the
    available-now trigger would not end; the stream runs on the default trigger
    and is stopped once it has caught up.
    """
    query = (
        result.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint).start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return result.sparkSession.read.schema(result.schema).parquet(path)


def stream_advantages(
    scored: DataFrame, group: str = "prompt_id", epsilon: float = 1e-4, timeout_ms: int = 10 * 60 * 1000,
    event_time: str | None = None, delay: str = "10 minutes", buckets: int = BUCKETS,
) -> DataFrame:
    """Arriving scored completions (gen_id, ``group``, reward_total, n_generations) with their group's advantage.

    A row is returned once, when its group is complete or timed out (``timed_out``).
    ``event_time`` names a timestamp of arrival; without one, the time of the
    batch that reads a row stands in. Rows later than the watermark (``delay``
    behind the latest arrival) are not taken. Prompts are dealt into ``buckets``
    by hash; a checkpoint goes on only with the number it began with.
    """
    use_state_store(scored.sparkSession)
    # The processor is unpickled by a Python process beside the driver that does not see the shipped package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    arrived = F.col(event_time) if event_time else F.current_timestamp()
    rows = scored.select(
        scored[group].cast("bigint").alias("prompt_id"), "gen_id", "reward_total", "n_generations", arrived.alias("arrived")
    ).withWatermark("arrived", delay)
    bucket = F.when(F.col("prompt_id").isNull(), NO_PROMPT).otherwise(F.pmod(F.xxhash64("prompt_id"), F.lit(buckets)))
    return rows.withColumn("bucket", bucket.cast("int")).groupBy("bucket").transformWithStateInPandas(
        GroupAdvantages(epsilon, timeout_ms, "arrived"), OUTPUT, "Append", "EventTime"
    )
