import struct
import zlib

import pytest
from pyspark.sql import functions as F

from promptmill.operators import vision
from promptmill.plans.recipes import prepare_vision
from promptmill.sources import images as image_source

SCHEMA = "id string, prompt string, image string, response string"


def png(color_type, rows):
    """A PNG file of the given raw pixel rows."""
    channels = {0: 1, 2: 3, 6: 4}[color_type]
    chunk = lambda kind, body: (
        struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    )
    header = struct.pack(">IIBBBBB", len(rows[0]) // channels, len(rows), 8, color_type, 0, 0, 0)
    body = b"".join(b"\0" + bytes(row) for row in rows)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


@pytest.fixture
def folder(tmp_path):
    pictures = tmp_path / "图 片"
    pictures.mkdir()
    (pictures / "rgb.png").write_bytes(png(2, [[1, 2, 3, 4, 5, 6]]))
    (pictures / "gray 1.png").write_bytes(png(0, [[7, 8]]))
    (pictures / "rgba.png").write_bytes(png(6, [[1, 2, 3, 128, 4, 5, 6, 255]]))
    (pictures / "bad.png").write_bytes(b"no image")
    return pictures


ROWS = [
    ("1", "p", "rgb.png", "r"), ("2", "p", "gray 1.png", "r"), ("3", "p", "./rgba.png", "5"),
    ("4", "p", "bad.png", "r"), ("5", "p", "gone.png", "r"), ("6", "p", None, "r"),
    ("7", "p", "", "r"), ("8", None, "rgb.png", "r"), ("9", "p", "bad.png", None),
    ("10", None, "gone.png", "r"),
]


def test_records_and_reasons(spark, folder):
    manifest = vision.normalize_manifest(
        spark.createDataFrame(ROWS, SCHEMA), vision.VisionOptions(base_dir=str(folder))
    )
    files = image_source.list_files(spark, str(folder))
    images = image_source.read_images(spark, str(folder))
    records = vision.vision_records(manifest, files, images, keep=("id",), with_pixels=True).collect()
    pixels = {
        r.id: (r.messages[0].content[1].image.nChannels, list(r.messages[0].content[1].image.data))
        for r in records
    }
    assert pixels == {
        "1": (3, [1, 2, 3, 4, 5, 6]), "2": (3, [7, 7, 7, 8, 8, 8]), "3": (3, [1, 2, 3, 4, 5, 6]),
    }
    labelled = vision.label_manifest(manifest, files, images)
    assert {r.id: r.reject_reason for r in labelled.collect()} == {
        "1": None, "2": None, "3": None, "4": vision.BAD_IMAGE, "5": vision.MISSING_FILE,
        "6": vision.EMPTY_PATH, "7": vision.EMPTY_PATH, "8": vision.MISSING_TEXT,
        "9": vision.MISSING_TEXT, "10": vision.MISSING_FILE,
    }
    assert {r.id for r in vision.without_image(vision.require_image_path(manifest), files).collect()} == {"5", "10"}


def test_paths_only(spark, folder):
    manifest = vision.normalize_manifest(
        spark.createDataFrame(ROWS, SCHEMA), vision.VisionOptions(base_dir=str(folder))
    )
    records = vision.vision_records(manifest, image_source.list_files(spark, str(folder)))
    origins = {r.messages[0].content[1].image.origin.rsplit("/", 1)[1] for r in records.collect()}
    assert origins == {"rgb.png", "gray 1.png", "rgba.png", "bad.png"}


def test_decodable_pictures_by_reference(spark, folder):
    manifest = vision.normalize_manifest(
        spark.createDataFrame(ROWS, SCHEMA), vision.VisionOptions(base_dir=str(folder))
    )
    images = image_source.read_images(spark, str(folder))
    records = vision.vision_records(manifest, images=images, keep=("id",), with_pixels=False)
    got = {r.id: r.messages[0].content[1].image for r in records.collect()}
    assert got.keys() == {"1", "2", "3"}
    assert got["1"].data is None and got["1"].width == 2 and got["1"].origin.endswith("/rgb.png")


def test_missing_column_counts_as_null(spark):
    df = spark.createDataFrame([("p", "x.png")], "prompt string, image string")
    manifest = vision.normalize_manifest(df)
    assert vision.require_prompt_response(manifest).count() == 0


def test_recipe_with_other_names(spark, folder, tmp_path):
    (tmp_path / "manifest.csv").write_text('ask,pic,reply\n"say ""it"", now",rgb.png,7\n', encoding="utf-8")
    options = vision.VisionOptions("pic", "ask", "reply", str(folder))
    result = prepare_vision(
        spark, str(tmp_path / "manifest.csv"), str(folder), options,
        schema="ask string, pic string, reply string",
    )
    row = result.records.first()
    assert row.messages[0].content[0].text == 'say "it", now'
    assert row.messages[1].content[0].text == "7"
    assert result.labelled.first().reject_reason is None


@pytest.mark.parametrize("value, bare", [
    ("file:/a/b.png", "/a/b.png"), ("file:///a//b.png", "/a/b.png"), ("hdfs://n:1/a/./b.png", "hdfs://n:1/a/b.png"),
    ("./a/b.png", "a/b.png"), ("/a/b c.png", "/a/b c.png"),
])
def test_bare_path(apply, value, bare):
    assert apply(image_source.bare_path, [value]) == [bare]


def test_resolve_path(apply):
    paths = ["x.png", "/abs/./x.png", "s3a://b//x.png", "file:///abs/x.png", None, "hdfs://n1/x.png"]
    got = apply(lambda c: image_source.resolve_path(c, "file:/base"), paths)
    assert got == ["/base/x.png", "/abs/x.png", "s3a://b/x.png", "/abs/x.png", None, "hdfs://n1/x.png"]
    got = apply(lambda c: image_source.resolve_path(c, "s3a://c/in/"), paths)
    assert got == ["s3a://c/in/x.png", "s3a://c/abs/x.png", "s3a://b/x.png", "/abs/x.png", None, "hdfs://n1/x.png"]
    assert apply(lambda c: image_source.resolve_path(c, None), paths)[:2] == ["x.png", "/abs/x.png"]


def test_one_key_in_two_buckets(spark):
    rows = spark.createDataFrame([("1", "p", "s3a://b/x.png", "r")], SCHEMA)
    manifest = vision.normalize_manifest(rows)
    image = "struct(origin, 1 AS height, 1 AS width, 1 AS nChannels, 0 AS mode, binary('x') AS data) AS image"
    images = spark.createDataFrame([("s3a://a/x.png",), ("s3a://b/x.png",)], "origin string")
    images = images.select(image_source.bare_path(F.col("origin")).alias("path"), F.expr(image))
    labelled = vision.label_manifest(manifest, images.select("path"), images).collect()
    assert [r.reject_reason for r in labelled] == [None]
    attached = vision.attach_image(manifest, images).collect()
    assert [r.image.origin for r in attached] == ["s3a://b/x.png"]


def test_recipe_lists_the_folder_once(spark, folder, tmp_path):
    """The pictures themselves are the listing; a second one doubled the files' cost."""
    (tmp_path / "manifest.csv").write_text("id,image,prompt,response\n1,rgb.png,p,r\n2,absent.png,p,r\n3,rgb.png,,r\n", encoding="utf-8")
    result = prepare_vision(spark, str(tmp_path / "manifest.csv"), str(folder), vision.VisionOptions(base_dir=str(folder)))
    assert {r.id: r.reject_reason for r in result.labelled.collect()} == {"1": None, "2": vision.MISSING_FILE, "3": vision.MISSING_TEXT}
    plan = result.labelled._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3 and "binaryFile" not in plan  # manifest with and without paths, and the pictures
