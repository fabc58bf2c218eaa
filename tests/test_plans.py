"""What the physical plans must and must not hold."""

import os
import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry
from promptmill.catalog.oracles import ORACLES
from promptmill.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")

PYTHON_QUERIES = {"map_batched", "reward_python", "vision_pixels", "to_rgb"}
FILE_QUERIES = {
    "decode_csv", "file_rejects", "vision_files", "vision_file_rejects", "observed_count", "training_set_files", "prompt_set_files", "vision_set_files", "reject_files",
    "stream_format", "stream_score",
}
GLOBAL_AGGREGATES = {"kept_count", "table_profile"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FILE_QUERIES))
def test_plan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    if name not in PYTHON_QUERIES:
        assert not re.search(r"Python|MapInArrow|MapInPandas|ArrowEval", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if "SinglePartition" in text:
        # Global aggregates merge one row per task; bucket offsets are a table
        # of fixed size. No table of rows is ever drawn into one partition.
        singles = re.findall(r"Exchange SinglePartition[^\n]*\n[^\n]*", text)
        assert all("HashAggregate" in s for s in singles), singles


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_scan_reads_needed_columns_only(spark):
    text = plan(QUERIES["reward_total"](spark, SF))
    schema = re.search(r"orders.*?ReadSchema: struct<([^>]*)>", text, re.S)
    assert "o_totalprice" not in text and schema is not None


def test_filter_reaches_the_scan(spark):
    text = plan(QUERIES["format_qa"](spark, SF))
    assert "EqualTo(role,user)" in text


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 1500 and "reward_total" in df.columns


def test_turns_have_no_gaps(spark):
    """Replies are found at the next number, so numbers must follow each other."""
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    odd = turns.groupBy("conv_id").agg(
        F.count("*").alias("n"), F.countDistinct("turn").alias("d"), (F.max("turn") - F.min("turn") + 1).alias("span")
    )
    assert odd.where("n <> d OR n <> span").count() == 0


def test_packing_keeps_every_token(spark):
    packed = QUERIES["packed_text"](spark, SF).agg(F.sum("n_tokens")).first()[0]
    counted = QUERIES["token_limit"](spark, SF).agg(F.sum("n_tokens")).first()[0]
    assert packed == counted


def test_advantages_score_once(spark):
    text = plan(QUERIES["advantages"](spark, SF))
    assert "orders.parquet" not in text and "rlike" not in text.lower()
