"""Samples and rejects of one stream: replayed batches change nothing, cut attempts are not read."""

import os

from pyspark.sql import functions as F

from promptmill.streaming import exactly_once, streams
from promptmill.workspace import fresh_dir

SCHEMA = "id long, text string, reject_reason string"


def label(batch):
    return batch.withColumn("reject_reason", F.when(F.length("text") < 3, F.lit("too_short")).when(F.col("text").isNull(), "missing"))


def arriving(spark, parts):
    folder = fresh_dir(spark, "arriving")
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "id long, text string").coalesce(1).write.parquet(f"{folder}/part={i}")
    return streams.read_arriving(spark, f"{folder}/part=*", "id long, text string", maxFilesPerTrigger=1)


def rows_of(df):
    return sorted(tuple(r) for r in df.drop("batch_id").collect())


def test_replayed_batch_changes_nothing(spark):
    parts = [[(1, "hello"), (2, "no"), (3, None)], [(4, "fine"), (5, "x")], [(6, "again"), (7, "ok")]]
    stream = arriving(spark, parts)
    samples, rejects, state = (fresh_dir(spark, name) for name in ("samples", "rejects", "state"))
    kept, gone = exactly_once.run_split_stream(label, stream, samples, rejects, state)
    first = rows_of(kept), rows_of(gone)
    assert first[0] == [(1, "hello"), (4, "fine"), (6, "again")]
    assert first[1] == [(2, "no", "too_short"), (3, None, "missing"), (5, "x", "too_short"), (7, "ok", "too_short")]
    assert exactly_once.committed_batches(spark, samples) == [0, 1, 2]
    # Forget that the last batch finished: Spark runs it again with the same id and offsets.
    for name in ("2", ".2.crc"):
        if os.path.exists(f"{state}/commits/{name}"):
            os.remove(f"{state}/commits/{name}")
    again = exactly_once.run_split_stream(label, stream, samples, rejects, state)
    assert (rows_of(again[0]), rows_of(again[1])) == first
    # The same batch written twice by hand gives the same rows once.
    batch = spark.createDataFrame([(8, "twice"), (9, "no")], "id long, text string")
    exactly_once.write_batch(label(batch), 3, samples, rejects)
    exactly_once.write_batch(label(batch), 3, samples, rejects)
    kept, gone = exactly_once.run_split_stream(label, stream, samples, rejects, state)
    assert rows_of(kept) == first[0] + [(8, "twice")]
    assert rows_of(gone) == sorted(first[1] + [(9, "no", "too_short")])


def test_attempt_without_marker_is_not_read(spark):
    samples, rejects = fresh_dir(spark, "samples"), fresh_dir(spark, "rejects")
    batch = label(spark.createDataFrame([(1, "hello"), (2, "no")], "id long, text string"))
    exactly_once.write_batch(batch, 0, samples, rejects)
    batch.where("reject_reason IS NULL").drop("reject_reason").write.parquet(f"{samples}/batch_id=1")  # cut short
    schema = "id long, text string, batch_id long"
    got = exactly_once.read_committed(spark, samples, samples, spark.createDataFrame([], schema).schema)
    assert rows_of(got) == [(1, "hello")]
    empty = fresh_dir(spark, "none")
    assert exactly_once.read_committed(spark, empty, empty, spark.createDataFrame([], schema).schema).count() == 0
