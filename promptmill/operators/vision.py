"""Image manifests to conversation records, with reasons for rejected rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions.chat import build_vision_conversation
from promptmill.functions.images import UNDECODABLE_MODE, to_rgb
from promptmill.sources.images import resolve_path

EMPTY_PATH = "empty_image_path"
MISSING_FILE = "image_not_found"
MISSING_TEXT = "missing_prompt_or_response"
BAD_IMAGE = "undecodable_image"


@dataclass(frozen=True)
class VisionOptions:
    """Column names of the manifest, and the folder relative paths start from."""

    image_column: str = "image"
    prompt_column: str = "prompt"
    response_column: str = "response"
    base_dir: str | None = None


def _column_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None)


def normalize_manifest(df: DataFrame, options: VisionOptions = VisionOptions()) -> DataFrame:
    """Add ``image_path`` and text versions of prompt and response.

    A column the manifest lacks counts as null.
    """
    path = _column_or_null(df, options.image_column).cast("string")
    return df.withColumns(
        {
            "image_path": F.when(path == "", path).otherwise(resolve_path(path, options.base_dir)),
            "prompt_text": _column_or_null(df, options.prompt_column).cast("string"),
            "response_text": _column_or_null(df, options.response_column).cast("string"),
        }
    )


def require_image_path(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("image_path").isNotNull() & (F.col("image_path") != ""))


def require_prompt_response(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("prompt_text").isNotNull() & F.col("response_text").isNotNull())


def _listed(files: DataFrame) -> DataFrame:
    return files.select(F.col("path").alias("image_path"))


def require_image_exists(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Rows whose image is in the listing (one ``path`` column)."""
    return manifest.join(_listed(files), "image_path", "left_semi")


def without_image(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Rows whose image is not in the listing."""
    return manifest.join(_listed(files), "image_path", "left_anti")


def attach_image(manifest: DataFrame, images: DataFrame) -> DataFrame:
    """Add the decoded ``image`` by path; rows without an image file drop out.

    Comes after all cheaper filters, because the image bytes are the wide part.
    """
    manifest = manifest.drop("image")
    return manifest.join(images.select(F.col("path").alias("image_path"), "image"), "image_path")


def require_decodable_image(df: DataFrame) -> DataFrame:
    return df.where(F.col("image.mode") != UNDECODABLE_MODE)


def label_manifest(
    manifest: DataFrame, files: DataFrame | None = None, images: DataFrame | None = None
) -> DataFrame:
    """Add ``reject_reason``: path, then file, then texts, then decoding.

    ``files`` and ``images`` must hold a path once. Rows without a path take no
    part in the join, so many of them cannot pile up under one join key. Of the
    images only the mode is read. Without ``files`` the images, which have a row
    for every file, are the listing too.
    """
    pathless = F.col("image_path").isNull() | (F.col("image_path") == "")
    if images is not None:
        known = images.select(F.col("path").alias("image_path"), F.col("image.mode").alias("mode"))
        known = known.withColumn("listed", F.lit(True)) if files is None else known
    if files is not None:
        listed = _listed(files).withColumn("listed", F.lit(True))
        known = listed.withColumn("mode", F.lit(None).cast("int")) if images is None else listed.join(known, "image_path", "left")
    reason = (
        F.when(F.col("listed").isNull(), F.lit(MISSING_FILE))
        .when(F.col("prompt_text").isNull() | F.col("response_text").isNull(), F.lit(MISSING_TEXT))
        .when(F.col("mode") == UNDECODABLE_MODE, F.lit(BAD_IMAGE))
    )
    return (
        manifest.where(~pathless)
        .join(known, "image_path", "left")
        .withColumn("reject_reason", reason)
        .drop("listed", "mode")
        .unionByName(manifest.where(pathless).withColumn("reject_reason", F.lit(EMPTY_PATH)))
    )


def _reference_to(image_path: Column, decoded: Column | None = None) -> Column:
    """Image struct that names the file and leaves the pixels there."""

    def known(field: str, kind: str) -> Column:
        return (F.lit(None) if decoded is None else decoded[field]).cast(kind).alias(field)

    return F.struct(
        image_path.alias("origin"),
        *[known(field, "int") for field in ("height", "width", "nChannels", "mode")],
        F.lit(None).cast("binary").alias("data"),
    )


def vision_records(
    manifest: DataFrame,
    files: DataFrame | None = None,
    images: DataFrame | None = None,
    keep: tuple[str, ...] = (),
    with_pixels: bool = False,
) -> DataFrame:
    """Conversations of the manifest rows that pass every check.

    With ``images`` (path, image) only decodable ones count, and the records
    carry their path and size, or with ``with_pixels`` their RGB pixels. With ``files`` alone the records carry the path.

    Pixels pass through Arrow batches. Set
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` so that one batch of
    pictures fits into a worker's memory; its default of 10,000 is for short rows.
    """
    usable = require_prompt_response(require_image_path(manifest))
    if images is not None:
        if not with_pixels:
            images = images.withColumn("image", F.col("image").dropFields("data"))
        usable = require_decodable_image(attach_image(usable, images))
        picture = F.col("image")
        image = to_rgb(picture) if with_pixels else _reference_to(F.col("image_path"), picture)
    else:
        if files is not None:
            usable = require_image_exists(usable, files)
        image = _reference_to(F.col("image_path"))
    messages = build_vision_conversation(F.col("prompt_text"), F.col("response_text"), image)
    return usable.select(*keep, messages.alias("messages"))
