"""Training rows in schedule order, in shards with a range manifest; resuming opens only the shards it needs."""

from pyspark.sql import functions as F

from promptmill.operators import schedule
from promptmill.sinks import writers
from promptmill.workspace import fresh_dir


def test_resume_reads_only_later_shards(spark):
    docs = spark.range(0, 500).withColumnRenamed("id", "doc_id")
    scheduled = schedule.training_schedule(docs, ["doc_id"], schedule.ScheduleOptions(epochs=2, devices=2))
    path = fresh_dir(spark, "shards")
    writers.write_schedule_shards(scheduled, path, 5)
    manifest = sorted(tuple(r) for r in spark.read.parquet(f"{path}/manifest").collect())
    assert [m[0] for m in manifest] == list(range(len(manifest)))
    assert all(first == 5 * shard and last == 5 * shard + 4 for shard, first, last, _ in manifest[:-1])
    assert sum(m[3] for m in manifest) == scheduled.count()
    resumed = writers.read_from_step(spark, path, 23)
    files = {r.f for r in resumed.select(F.input_file_name().alias("f")).distinct().collect()}
    opened = {int(f.split("shard=")[1].split("/")[0]) for f in files}
    assert opened == set(range(23 // 5, len(manifest)))  # none of the shards before step 20
    want = sorted(tuple(r) for r in scheduled.where("step >= 23").select("doc_id", "epoch", "step").collect())
    assert sorted(tuple(r) for r in resumed.select("doc_id", "epoch", "step").collect()) == want
    assert writers.read_from_step(spark, path, 10_000).count() == 0
