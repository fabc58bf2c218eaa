"""The recipes' inputs, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.functions.templates import format_xml_cot
from promptmill.sources.department_csv import DEPARTMENTS

EOS = "<|endoftext|>"
#: Picture files that one task writes.
PICTURES_A_TASK = 5_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns_with_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn with the assistant turn right behind it, null without one.

    Turns are numbered without gaps, so the reply is found by an equi-join on
    conversation and number. A long conversation thus spreads over many tasks.
    """
    turns = table(spark, sf_dir, "conversations")
    replies = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    users = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("question")
    )
    return users.join(replies, ["conv_id", "turn"], "left")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns_with_reply(spark, sf_dir).where(F.col("answer").isNotNull())


def instruction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question as instruction, the conversation number as input."""
    return pairs(spark, sf_dir).select(
        "conv_id",
        "turn",
        F.col("question").alias("instruction"),
        F.concat(F.lit("conversation "), F.col("conv_id").cast("string")).alias("input"),
        F.col("answer").alias("output"),
    )


def raw_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs before cleaning: padded, blank and absent answers among them."""
    rows = turns_with_reply(spark, sf_dir)
    kind = F.col("conv_id") % 7
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 1, F.concat(F.lit(" \n\t"), "question", F.lit("\n ")))
        .when(kind == 2, F.lit(" \n "))
        .otherwise(F.col("question"))
        .alias("question"),
        F.when(kind == 3, F.lit(None).cast("string"))
        .when(kind == 4, F.concat(F.lit("  "), "answer", F.lit("\n\n")))
        .otherwise(F.col("answer"))
        .alias("answer"),
    )


def prompt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per customer; those of one segment have no marked answer."""
    number = (F.col("c_custkey") % 4).cast("string")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("prompt_id"),
        F.concat(F.lit("What is the code of "), "c_name", F.lit("?")).alias("question"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("unknown "), number))
        .otherwise(F.concat(F.lit("take the key\n#### "), number, F.lit(" ")))
        .alias("answer"),
    )


def completion_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One completion per order, in six layouts, for the prompt of its customer."""
    kind = F.col("o_orderkey") % 11
    answer = (
        F.when(kind == 0, "-7").when(kind == 1, "7.0").when(kind == 2, "seven")
        .when(kind == 3, "²").when(kind == 4, "")
        .otherwise((F.col("o_orderkey") % 4).cast("string"))
    )
    thought = F.concat(F.lit("priority "), F.col("o_orderpriority"))
    strict = format_xml_cot(thought, answer)
    layout = F.col("o_orderkey") % 6
    text = (
        F.when(layout == 0, strict)
        .when(
            layout == 1,
            F.concat(
                F.lit("<reasoning>"),
                thought,
                F.lit("</reasoning> <answer>"),
                answer,
                F.lit("</answer>"),
            ),
        )
        .when(
            layout == 2,
            F.concat(
                format_xml_cot(F.concat(thought, F.lit("\nso it is")), answer),
                F.lit("That is all."),
            ),
        )
        .when(layout == 3, F.concat(F.lit("  "), answer, F.lit(" \n")))
        .when(
            layout == 4,
            F.concat(
                format_xml_cot(thought, F.lit("9")), F.lit("<answer>\n"), answer, F.lit("\n</answer>\n")
            ),
        )
        .otherwise(F.substring(strict, F.lit(1), F.length(strict) - 1))
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("gen_id"),
        F.col("o_custkey").alias("prompt_id"),
        F.col("o_orderstatus").alias("status"),
        text.alias("completion"),
    )


def solutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worked solutions with no, one or two answer markers."""
    number = (F.col("o_orderkey") % 100).cast("string")
    kind = F.col("o_orderkey") % 5
    text = (
        F.when(kind == 0, F.concat(F.lit("no result "), number))
        .when(kind == 1, F.concat(F.lit("first #### "), number, F.lit(" #### 7")))
        .when(kind == 2, F.concat(F.lit("work "), number, F.lit("####")))
        .otherwise(F.concat(F.lit("work\n#### "), number, F.lit("\n")))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("subset"),
        F.concat(F.lit("How urgent is "), F.col("o_orderpriority"), F.lit("?")).alias(
            "question"
        ),
        text.alias("answer"),
    )


def department_of(number: Column) -> Column:
    """One of the department folders by a running number."""
    folders = F.array(*[F.lit(name) for name in DEPARTMENTS])
    return F.get(folders, (number % len(DEPARTMENTS)).cast("int"))


def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A picture per document; short texts lack the path, one language the response."""
    path = F.concat(F.lit("pictures/"), F.col("doc_id").cast("string"), F.lit(".png"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("prompt"),
        F.when(F.col("n_chars") < 200, F.lit(""))
        .when(F.col("n_chars") >= 300, path)
        .alias("image"),
        F.when(F.col("lang") != "de", F.col("source")).alias("response"),
    )


def write_pictures(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """A PNG file per labelled document below a folder all executors share; those of toxic ones are no pictures.

    4x4 gray, RGB or RGBA by ``doc_id % 3``, with the bytes of a digest of the id.
    """

    def write(batches):
        import hashlib
        import struct
        import zlib

        import pyarrow.fs

        def chunk(kind: bytes, body: bytes) -> bytes:
            return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                channels, color = ((1, 0), (3, 2), (4, 6))[row["doc_id"] % 3]
                pixels = hashlib.md5(str(row["doc_id"]).encode()).digest() * channels
                lines = [b"\0" + pixels[i: i + 4 * channels] for i in range(0, 16 * channels, 4 * channels)]
                header = struct.pack(">IIBBBBB", 4, 4, 8, color, 0, 0, 0)
                data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header)
                data += chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
                with system.open_output_stream(f"{root}/{row['doc_id']}.png", compression=None) as file:
                    file.write(b"no picture" if row["toxic"] else data)
            yield batch

    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    # the table is small where its pictures are many: without this one task writes them all
    labels = labels.repartition(max(spark.sparkContext.defaultParallelism, labels.count() // PICTURES_A_TASK), "doc_id")
    labels.mapInArrow(write, labels.schema).write.format("noop").mode("overwrite").save()


def picture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decoded picture per labelled document: 4x4 gray, BGR or BGRA, some invalid."""
    labels = table(spark, sf_dir, "labels")
    digest = F.md5(F.col("doc_id").cast("string"))
    channels = F.when(F.col("doc_id") % 3 == 0, 1).when(F.col("doc_id") % 3 == 1, 3).otherwise(4)
    path = F.concat(F.lit("/store/pictures/"), F.col("doc_id").cast("string"), F.lit(".png"))
    valid = F.col("toxic") == 0
    image = F.struct(
        path.alias("origin"),
        F.when(valid, 4).otherwise(-1).alias("height"),
        F.when(valid, 4).otherwise(-1).alias("width"),
        F.when(valid, channels).otherwise(-1).alias("nChannels"),
        F.when(valid, (channels - 1) * 8).otherwise(-1).alias("mode"),
        F.when(valid, F.unhex(F.repeat(digest, channels))).alias("data"),
    )
    return labels.select("doc_id", path.alias("path"), image.alias("image"))
