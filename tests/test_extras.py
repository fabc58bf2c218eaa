"""Sources with differing columns united; what is not known stays queryable by name in a VARIANT."""

from pyspark.sql import functions as F

from promptmill.operators import cleaning


def test_extras_by_name(spark):
    a = spark.createDataFrame([(1, "x", "en")], "id long, text string, lang string")
    b = spark.createDataFrame([("y", 2, 7, "s")], "text string, id long, n int, `odd.name` string")
    c = spark.createDataFrame([(3,)], "id long")
    united = cleaning.union_with_extras([a, b, c], ["id", "text"])
    assert united.columns == ["id", "text", "extras"]
    got = united.select(
        "id", "text", F.variant_get("extras", "$.lang", "string").alias("lang"), F.variant_get("extras", "$.n", "int").alias("n"),
        F.variant_get("extras", "$['odd.name']", "string").alias("odd"),
    ).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "x", "en", None, None), (2, "y", None, 7, "s"), (3, None, None, None, None)]
