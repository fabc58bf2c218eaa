"""Image files and their listing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Scheme and authority of a store other than the local file system.
_STORE = r"^(?!file:)[A-Za-z][A-Za-z0-9+.-]*://[^/]*"


def plain_path(uri: Column) -> Column:
    """File URI without percent encoding, as file listings show it."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def bare_path(path: Column) -> Column:
    """Path to compare by: no empty or ``.`` components and no ``file:``; other stores keep scheme and bucket."""
    plain = F.regexp_replace(path, r"^file:(?://[^/]*)?(?=/)", "")
    store = F.regexp_extract(plain, _STORE, 0)
    inside = F.substring(plain, F.length(store) + 1, F.length(plain))
    inside = F.regexp_replace(inside, r"/(?:\.?/)+", "/")
    return F.concat(store, F.regexp_replace(inside, r"^\./", ""))


def resolve_path(path: Column, base_dir: str | None) -> Column:
    """Relative paths below ``base_dir``, absolute ones without a scheme in its store, others as they are."""
    if not base_dir:
        return bare_path(path)
    relative = ~F.rlike(path, F.lit(r"^(?:/|[A-Za-z][A-Za-z0-9+.-]*:/)"))
    joined = F.concat(F.lit(base_dir.rstrip("/") + "/"), path)
    store = re.match(_STORE, base_dir)
    rooted = F.concat(F.lit(store.group() if store else ""), path)
    return bare_path(F.when(relative, joined).when(path.startswith("/"), rooted).otherwise(path))


def list_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Paths of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", recursive)
        .load(path)
        .select(bare_path(F.col("path")).alias("path"))
    )


def read_images(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Decoded images by path; a file that is no image has mode -1.

    Pixels are decoded on the executors, in blue, green, red (alpha) order or gray.
    """
    return (
        spark.read.format("image")
        .option("recursiveFileLookup", recursive)
        .load(path)
        .select(bare_path(plain_path(F.col("image.origin"))).alias("path"), "image")
    )
