import pytest
from pyspark.sql import functions as F

from promptmill.operators import scoring
from promptmill.operators.instructions import format_instructions
from promptmill.plans import recipes
from promptmill.sinks import writers
from promptmill.sources import tables
from promptmill.streaming import streams


@pytest.fixture
def triples(spark):
    return spark.createDataFrame(
        [("i1", "x", "o1"), ("i2", None, "o2"), (None, "x", "o3")],
        tables.INSTRUCTION_SCHEMA,
    )


def test_training_set_by_split(spark, triples, tmp_path):
    path = str(tmp_path / "set")
    with pytest.raises(ValueError):
        writers.write_training_set(triples, path)
    two = format_instructions(triples).withColumn(
        "split", F.when(F.col("instruction") == "i1", "train").otherwise("test")
    )
    writers.write_training_set(two, path)
    assert [r.instruction for r in tables.read_instructions(spark, path).collect()] == ["i1"]
    assert [r.output for r in tables.read_instructions(spark, path, "test").collect()] == ["o2"]
    plan = tables.read_instructions(spark, path)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    prepared = recipes.prepare_instructions(spark, path)
    assert prepared.samples.count() == 1 and prepared.labelled.count() == 1
    with pytest.raises(ValueError):
        recipes.prepare_instructions(spark, path, split="none")


@pytest.mark.parametrize("format", ["parquet", "json"])
def test_prompt_set(spark, tmp_path, format):
    source, path = str(tmp_path / "qa"), str(tmp_path / "prompts")
    rows = [("q1", "#### 1", "main", "train"), ("q2", "x", "main", "test"), ("q3", "#### 3", "other", "train")]
    df = spark.createDataFrame(rows, "question string, answer string, subset string, split string")
    df.write.format(format).partitionBy("subset", "split").save(source)
    prompts = recipes.prepare_reasoning(spark, source, format=format)
    writers.write_prompt_set(prompts, path, format=format)
    row = spark.read.schema(prompts.schema).format(format).load(path).first()
    assert row.question == "q1" and row.answer == "1" and row.prompt[1].content == "q1"
    with pytest.raises(ValueError):
        writers.write_prompt_set(df.drop("answer"), path)
    with pytest.raises(ValueError):
        writers.write_vision_set(df, path)


def test_rejects(spark, tmp_path):
    path = str(tmp_path / "rejects")
    df = spark.createDataFrame([(1, None), (2, "bad"), (3, "worse")], "k int, reject_reason string")
    writers.write_rejects(df, path)
    assert {(r.k, r.reject_reason) for r in spark.read.parquet(path).collect()} == {(2, "bad"), (3, "worse")}


def test_streams_equal_batch(spark, triples, tmp_path):
    landed = str(tmp_path / "landed")
    triples.repartition(3).write.parquet(landed)
    result = streams.run_to_end(
        streams.stream_format, streams.read_arriving(spark, landed, triples.schema),
        str(tmp_path / "out"), str(tmp_path / "state"),
    )
    batch = format_instructions(triples)
    assert sorted(r.text for r in result.collect()) == sorted(r.text for r in batch.collect())
    # A second run finds nothing new and adds nothing.
    again = streams.run_to_end(
        streams.stream_format, streams.read_arriving(spark, landed, triples.schema),
        str(tmp_path / "out"), str(tmp_path / "state"),
    )
    assert again.count() == batch.count()


def test_stream_scoring_equals_batch(spark, tmp_path):
    prompts = spark.createDataFrame([(1, "7"), (2, None)], "prompt_id long, answer string")
    rows = spark.createDataFrame(
        [(1, "<answer>7</answer>"), (2, "7"), (3, "x")], "prompt_id long, completion string"
    )
    rows.write.parquet(str(tmp_path / "in"))
    result = streams.run_to_end(
        lambda df: streams.stream_score(df, prompts),
        streams.read_arriving(spark, str(tmp_path / "in"), rows.schema),
        str(tmp_path / "out"), str(tmp_path / "state"),
    )
    batch = scoring.score_completions(scoring.attach_gold(rows, prompts))
    assert sorted(map(tuple, result.collect()), key=repr) == sorted(
        map(tuple, batch.select(result.columns).collect()), key=repr
    )


def test_shared_folder_is_needed_on_a_cluster():
    from types import SimpleNamespace

    from promptmill.workspace import shared_dir

    def session(master, folder=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)

    with pytest.raises(ValueError):
        shared_dir(session("yarn"))
    with pytest.raises(ValueError):
        shared_dir(session("local-cluster[3,2,3000]"))
    assert shared_dir(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_dir(session("local[4]"))
