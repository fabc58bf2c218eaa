"""Folders shared by all executors, and small session helpers."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; on a local master a temporary one where none is configured.

    Executors of a cluster would each write to their own disk without one, so
    there it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder all executors share ({master})")
        configured = tempfile.mkdtemp(prefix="promptmill-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/promptmill/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a result once to the shared folder and read it back.

    Used where one expensive step feeds several later ones. A lost executor
    costs only a re-read of the written files.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).exists(hadoop_path)


def touch(spark: SparkSession, *paths: str) -> None:
    """Create empty files on whatever file system they name."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(conf).create(hadoop_path).close()


def escape_glob(path: str) -> str:
    """Path text with glob characters taken literally."""
    return "".join("\\" + ch if ch in "{}[]*?\\" else ch for ch in path)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed."""
    context = spark.sparkContext
    name = f"promptmill-{context.applicationId}"
    if any(name in str(url) for url in context.listArchives + context.listFiles):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="promptmill-"), name)
    archive = shutil.make_archive(
        target, "zip", os.path.dirname(package), os.path.basename(package)
    )
    context.addPyFile(archive)


def prepare_session(spark: SparkSession) -> None:
    """Settings and files the operators count on; safe to call again.

    Skewed joins are split even where that costs one more shuffle, because the
    rows of one prompt or picture are often joined and then grouped by the same
    key, and Spark would otherwise leave a hot key in one task.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    ship_package(spark)
