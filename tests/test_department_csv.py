import io
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from promptmill.operators.cleaning import CleaningOptions
from promptmill.plans.recipes import MedicalOptions, prepare_medical
from promptmill.sources import department_csv as source


@pytest.fixture
def small_splits(spark):
    """Files cut into splits of a few bytes."""

    def use(n_bytes):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(folder, files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, raw in files.items():
        (folder / name).write_bytes(raw)


def expected(raw, order):
    """What a default whole-file read makes of the bytes, cells kept as text."""
    for encoding in order:
        try:
            raw.decode(encoding)
        except UnicodeDecodeError:
            continue
        try:
            df = pd.read_csv(io.BytesIO(raw), encoding=encoding, dtype=str, keep_default_na=False)
        except (pd.errors.ParserError, pd.errors.EmptyDataError):
            return None
        return sorted(tuple(row) for row in df.values.tolist())
    return None


def actual(result):
    rows = {}
    for r in result.rows.collect():
        fields = list(r.fields)[r.shift:]
        fields += [""] * (len(r.header) - len(fields))
        rows.setdefault(r.path.rsplit("/", 1)[1], []).append(tuple(fields))
    return {
        r.path.rsplit("/", 1)[1]: None
        if r.reject_reason
        else sorted(rows.get(r.path.rsplit("/", 1)[1], []))
        for r in result.files.collect()
    }


@pytest.mark.parametrize("n_bytes, seed", [(1 << 27, 1), (50, 2)])
def test_like_a_whole_file_read(spark, tmp_path, small_splits, n_bytes, seed):
    rnd = random.Random(seed)
    alphabet = ["a", "b", '"', '"', ",", "\n", "\r\n", '""', "发烧", "é", " ", '"\n', '",', '\n"', '",\n"']
    files = {}
    for k in range(14):
        if k % 4 == 0:
            body = "q,a\n" + "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60)))
        else:
            cell = lambda: '"' + "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(8))).replace('"', '""') + '"'
            body = "q,a\n" + "".join(f"{cell()},{cell()}\n" for _ in range(rnd.randrange(12)))
        try:
            raw = body.encode(rnd.choice(["utf-8", "gb18030", "gbk"]))
        except UnicodeEncodeError:
            raw = body.encode()
        files[f"f{k}.csv"] = raw + (b"\xff\xff\n" if k == 9 else b"")
    write(tmp_path / "d", files)
    small_splits(n_bytes)
    result = source.read_department_rows(spark, source.DepartmentFolders(str(tmp_path), {"d": "D"}))
    assert actual(result) == {name: expected(raw, source.UTF8_FIRST) for name, raw in files.items()}


EDGE_FILES = {
    "shifted.csv": b"q,a\nindex,1,2\nx,3\n",
    "too_wide.csv": b"q,a\n1,2\n3,4,5\n",
    "open_quote.csv": b'q,a\n1,"2\n',
    "blank_lines.csv": b"\n  \nq,a\n\n1,2\n \t\n3,4",
    "short.csv": b"q,a\n1\n",
    "header_only.csv": b"q,a\n",
    "only_blank.csv": b"\n\n",
    "quoted_header.csv": b'"q\nq",a\n1,2\n',
}


@pytest.mark.parametrize("n_bytes", [1 << 27, 9])
def test_malformed_files(spark, tmp_path, small_splits, n_bytes):
    write(tmp_path / "d", EDGE_FILES)
    small_splits(n_bytes)
    result = source.read_department_rows(spark, source.DepartmentFolders(str(tmp_path), {"d": "D"}))
    assert actual(result) == {n: expected(raw, source.UTF8_FIRST) for n, raw in EDGE_FILES.items()}


def test_joining_splits_by_shuffle_gives_the_same(spark, tmp_path, small_splits, monkeypatch):
    write(tmp_path / "d", EDGE_FILES)
    small_splits(9)
    monkeypatch.setattr(source, "MAX_BROADCAST_SPLITS", 0)
    result = source.read_department_rows(spark, source.DepartmentFolders(str(tmp_path), {"d": "D"}))
    assert actual(result) == {n: expected(raw, source.UTF8_FIRST) for n, raw in EDGE_FILES.items()}


def test_encoding_orders(spark, tmp_path):
    files = {
        "gbk.csv": "ask,回答\n头痛怎么办,多休息\n".encode("gbk"),
        "utf8.csv": "question,answer\n发烧吗,是的\n".encode(),
        "both.csv": "question,answer\n发烧,x\n".encode(),
        "gb18030.csv": 'q,a\n"x\n😀",y\n'.encode("gb18030"),
        "broken.csv": b"question,answer\n\xff\xff\xff,x\n",
    }
    write(tmp_path / "d", files)
    folders = source.DepartmentFolders(str(tmp_path), {"d": "D"})
    for order in ("gbk_first", "utf8_first"):
        result = source.read_department_rows(spark, folders, order)
        got = {r.path.rsplit("/", 1)[1]: r for r in result.files.collect()}
        assert got["gbk.csv"].encoding == "gbk"
        assert got["utf8.csv"].encoding == "utf-8"
        assert got["gb18030.csv"].encoding == "gb18030"
        assert got["broken.csv"].reject_reason == source.UNDECODABLE
        cells = {tuple(r.fields) for r in result.rows.collect()}
        assert (("鍙戠儳", "x") if order == "gbk_first" else ("发烧", "x")) in cells
        assert ("x\n😀", "y") in cells


def test_medical_recipe(spark, tmp_path):
    base = tmp_path / "数据 [1]+%20"
    write(base / "IM_内科", {
        "a 1.csv": "department,ask,answer\n内科,头痛怎么办, 多休息 \n内科,,x\n".encode("gbk"),
        "b.CSV": "question,answer\nupper,case\n".encode(),
        "bad.csv": b"question,answer\n1,2\n1,2,3\n",
    })
    write(base / "Surgical_外科", {"c.csv": ("question,answer\nNA,nan\n" + "长" * 201 + ",x\n").encode()})
    write(base / "unlisted", {"d.csv": b"question,answer\nno,no\n"})
    result = prepare_medical(spark, MedicalOptions(str(base), "</s>"))
    got = {(r.department, r.instruction, r.input, r.output) for r in result.samples.collect()}
    constant = "请回答以下医疗相关问题"
    assert got == {("内科", constant, "头痛怎么办", "多休息"), ("外科", constant, "NA", "nan")}
    texts = {r.text for r in result.samples.collect()}
    assert (
        "你是一个专业的医疗助手。请根据患者的问题提供专业、准确的回答。\n\n### 问题：\n头痛怎么办\n\n### 回答：\n多休息</s>"
        in texts
    )
    assert len(result.missing_folders) == 4
    reasons = {r.reject_reason for r in result.labelled.collect()}
    assert reasons == {None, "missing_question", "question_too_long"}
    files = {r.path.rsplit("/", 1)[1]: r.reject_reason for r in result.files.collect()}
    assert files == {"a 1.csv": None, "bad.csv": source.MALFORMED, "c.csv": None}


def test_compatible_recipe_and_nothing_there(spark, tmp_path):
    write(tmp_path / "IM_内科", {"a.csv": b"question,answer\n,x\nNULL,y\n"})
    options = MedicalOptions(str(tmp_path), "", cleaning=CleaningOptions(compat=True))
    assert {r.input for r in prepare_medical(spark, options).samples.collect()} == {"nan"}
    nowhere = source.DepartmentFolders(str(tmp_path / "none"))
    nothing = source.read_department_rows(spark, nowhere)
    assert nothing.rows.count() == 0 and nothing.files.count() == 0 and len(nothing.missing) == 6
    with pytest.raises(ValueError):
        prepare_medical(spark, MedicalOptions(str(tmp_path / "none"), "</s>"))


def test_every_csv_name_is_accounted_for(spark, tmp_path):
    good = b"question,answer\nq,a\n"
    write(tmp_path / "IM_内科", {"a.csv": good, "_b.csv": good, ".c.csv": good, "e.csv": b"", "f.CSV": good, "g.txt": good})
    write(tmp_path / "IM_内科" / "sub.csv", {"part-0.csv": good})
    write(tmp_path / "Oncology_肿瘤科", {"_only.csv": good})
    read = source.read_department_rows(spark, source.DepartmentFolders(str(tmp_path)))
    found = {r.path.rsplit("/", 1)[1]: r.reject_reason for r in read.files.collect()}
    assert found == {
        "a.csv": None, "_b.csv": source.HIDDEN, ".c.csv": source.HIDDEN, "e.csv": source.EMPTY, "_only.csv": source.HIDDEN,
    }
    assert [(r.dept_dir, r.fields) for r in read.rows.collect()] == [("IM_内科", ["q", "a"])]


def test_departments(spark):
    df = spark.createDataFrame([("IM_内科",), ("other",)], "dept_dir string")
    got = {r.dept_dir: r.department for r in source.attach_department(df).collect()}
    assert got == {"IM_内科": "内科", "other": None}
    assert source.departments_table(spark).where(F.col("dept_dir") == "OAGD_妇产科").count() == 1
