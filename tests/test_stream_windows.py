"""Reward means over logging windows of a stream: update mode, latest row per window, late rows left out."""

import glob
import os

from promptmill.streaming import streams, windows
from promptmill.workspace import fresh_dir


def stream_of(spark, parts):
    folder = fresh_dir(spark, "arriving")
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "step long, reward double").coalesce(1).write.parquet(f"{folder}/part={i}")
        for name in glob.glob(f"{folder}/part={i}/*.parquet"):  # the source takes files by time of change
            os.utime(name, (1_700_000_000 + 60 * i, 1_700_000_000 + 60 * i))
    return streams.read_arriving(spark, f"{folder}/part=*", "step long, reward double", maxFilesPerTrigger=1)


def run(spark, parts, late_steps):
    means = windows.window_means(stream_of(spark, parts), ["reward"], "step", 10, late_steps)
    found = windows.run_window_means(means, fresh_dir(spark, "windows"), fresh_dir(spark, "windows-state"))
    return {r.logging_step: (r.n, r.reward) for r in found.collect()}


def test_windows_over_several_batches(spark):
    parts = [[(0, 1.0), (9, 3.0)], [(5, 2.0), (12, None), (19, 4.0)], [(25, 1.0), (11, 0.0), (None, 9.0)]]
    assert run(spark, parts, 100) == {0: (3, 2.0), 10: (3, 2.0), 20: (1, 1.0)}


def test_rows_behind_the_watermark_are_not_counted(spark):
    parts = [[(0, 1.0), (9, 3.0)], [(40, 5.0)], [(45, 6.0)], [(3, 100.0), (41, 7.0)]]
    # Spark drops rows by the watermark of the batch before: after the second batch it is at step 35, so in the
    # fourth, step 3 comes too late and window 0 keeps its mean. One batch earlier it would still count.
    assert run(spark, parts, 5) == {0: (2, 2.0), 40: (3, 6.0)}
