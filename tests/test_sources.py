import json

import pytest
from pyspark.sql import functions as F

from packwright.operators import split
from packwright.sources import readers, writers
from packwright.sources.checkpoints import checkpoint_folder


def test_url_list(spark, tmp_path):
    (tmp_path / "urls.txt").write_text("https://a \n\n \t\n  https://b\n")
    assert [r.url for r in readers.read_url_list(spark, str(tmp_path)).collect()] == ["https://a", "https://b"]


@pytest.mark.parametrize("sep", [",", "\t"])
def test_delimited_round_trip(spark, tmp_path, sep):
    rows = [(1, 'a "quoted", text\twith tab', 1.5), (2, None, None), (3, "é中", -0.0)]
    df = spark.createDataFrame(rows, "i int, s string, d double")
    writers.write_delimited(df, f"{tmp_path}/t", sep)
    back = readers.read_delimited(spark, f"{tmp_path}/t", sep, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    broken = spark.createDataFrame([("a\nb", 1), ("c", 2)], "s string, i int")
    writers.write_delimited(broken, f"{tmp_path}/lines", sep)
    whole = readers.read_delimited(spark, f"{tmp_path}/lines", sep, broken.schema, multi_line=True)
    assert sorted(map(tuple, whole.collect())) == [("a\nb", 1), ("c", 2)]
    inferred = readers.read_delimited(spark, f"{tmp_path}/t", sep)
    assert dict(inferred.dtypes)["i"] == "int"


def test_ws_table(spark, tmp_path):
    (tmp_path / "a.txt").write_text('\n  1 2.5 "x y" \n\n3  NA z\n4 5\n')
    found = readers.read_ws_table(spark, str(tmp_path)).drop("file")
    assert dict(found.dtypes) == {"col_0": "bigint", "col_1": "double", "col_2": "string"}
    assert sorted(map(tuple, found.collect())) == [(1, 2.5, "x y"), (3, None, "z"), (4, 5.0, None)]


def test_ws_table_rejects_files_with_wider_lines(spark, tmp_path):
    (tmp_path / "bad.txt").write_text("1 2\n3 4 5\n")
    (tmp_path / "good.txt").write_text("7 8\n9\n")
    files = {r.file.rsplit("/", 1)[1]: r.accepted for r in readers.ws_files(spark, str(tmp_path)).collect()}
    assert files == {"bad.txt": False, "good.txt": True}
    rows = readers.read_ws_table(spark, str(tmp_path)).drop("file").collect()
    assert sorted(map(tuple, rows)) == [(7, 8.0), (9, None)]


def test_ws_table_with_types_of_each_file(spark, tmp_path):
    texts = {"a": "1 2 x\n3 4 NA\n", "b": "1.5 2\n7\n", "c": "n 99999999999999999999 3\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_text(text)
    found = readers.read_ws_table(spark, str(tmp_path), per_file=True)
    kinds = [F.schema_of_variant(f"col_{i}") for i in range(3)]
    rows = found.select(F.substring_index("file", "/", -1), *kinds, *[F.to_json(f"col_{i}") for i in range(3)]).collect()
    assert sorted(map(tuple, rows), key=repr) == [
        ("a.txt", "BIGINT", "BIGINT", "STRING", "1", "2", '"x"'),
        ("a.txt", "BIGINT", "BIGINT", None, "3", "4", None),
        ("b.txt", "DOUBLE", "DOUBLE", None, "1.5", "2.0", None),
        ("b.txt", "DOUBLE", None, None, "7.0", None, None),
        ("c.txt", "STRING", "DOUBLE", "BIGINT", '"n"', "1.0E20", "3"),
    ]
    whole = readers.read_ws_table(spark, str(tmp_path)).drop("file")
    assert dict(whole.dtypes) == {"col_0": "string", "col_1": "double", "col_2": "string"}


def test_ws_table_in_blocks(spark, tmp_path):
    (tmp_path / "long.txt").write_text("a b c\n" + "x y\n" * 5000)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert readers.ws_files(spark, str(tmp_path)).first().accepted
        assert readers.read_ws_table(spark, str(tmp_path)).count() == 5001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_task_definitions(spark, tmp_path):
    good = {"source_paper": {"title": "T"}, "data_profile": {"file_formats": {".csv": 2}, "file_count": 2}}
    (tmp_path / "a.json").write_text(json.dumps(good, indent=2))
    (tmp_path / "b.json").write_text(json.dumps(good) + "{}")
    (tmp_path / "c.json").write_text("{'a': 1}")
    rows = {r.path[-6]: r for r in readers.read_task_definitions(spark, str(tmp_path)).collect()}
    assert rows["a"].task.data_profile.file_formats == {".csv": 2}
    assert [rows[k].status for k in "abc"] == ["ok", "quarantined", "quarantined"]
    assert rows["c"].json_text == "{'a': 1}"


def test_manifest_reads_no_contents(spark, tmp_path):
    (tmp_path / "cat").mkdir()
    (tmp_path / "cat" / "a b.JPG").write_bytes(b"123")
    (tmp_path / "c").write_bytes(b"4")
    found = readers.scan_manifest(spark, str(tmp_path))
    assert {(r.rel_path, r.label, r.ext, r.length) for r in found.collect()} == {
        ("cat/a b.JPG", "cat", ".jpg", 3),
        ("c", tmp_path.name, "", 1),
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content#" not in plan


def test_package_layout(spark, tmp_path):
    df = spark.range(50).selectExpr("id as Id", "id * 1.5 as y", "concat('x', id) as x")
    writers.write_package(split.random_split(df, "Id"), str(tmp_path / "p"), "Id", "y")
    read = lambda path: spark.read.option("header", True).csv(f"{tmp_path}/p/{path}")
    assert read(writers.TRAIN_PATH).columns == ["Id", "y", "x"] and read(writers.TRAIN_PATH).count() == 40
    assert read(writers.TEST_PATH).columns == ["Id", "x"]
    assert read(writers.ANSWER_PATH).columns == ["Id", "y"]
    ids = [{r.Id for r in read(p).collect()} for p in (writers.TEST_PATH, writers.SAMPLE_PATH, writers.ANSWER_PATH)]
    assert ids[0] == ids[1] == ids[2] and len(ids[0]) == 10


def test_json_text_and_labelled_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "é中", None)], "i int, s string, n string")
    writers.write_json_records(df, f"{tmp_path}/j")
    assert spark.read.text(f"{tmp_path}/j").first()[0] == '{"i":1,"s":"é中","n":null}'
    writers.write_text(df, F.col("s"), f"{tmp_path}/t")
    assert spark.read.text(f"{tmp_path}/t").first()[0] == "é中"
    files = split.random_split(spark.range(30).selectExpr("id as path", "concat('l', id % 2) as label"), "path")
    writers.write_labelled_split(files, f"{tmp_path}/s")
    back = spark.read.parquet(f"{tmp_path}/s")
    assert {tuple(r) for r in back.select("path", "label", "split").collect()} == {tuple(r) for r in files.collect()}


@pytest.mark.parametrize("fmt", [".csv", ".tsv", ".parquet"])
def test_split_is_written_in_its_format(spark, tmp_path, fmt):
    parts = split.random_split(spark.range(10), "id")
    writers.write_split(parts, f"{tmp_path}/o", fmt)
    read = spark.read.parquet if fmt == ".parquet" else spark.read.option("header", True).csv
    assert read(f"{tmp_path}/o/test").count() == 2 and read(f"{tmp_path}/o/train").count() == 8


def test_checkpoints_go_to_the_configured_folder(spark):
    assert checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_manifest_lists_hidden_and_empty_files(spark, tmp_path):
    for name, text in {"pkg/__init__.py": "", "a.csv": "x", "pkg/.hid": "abc", "pkg/deep/_m.json": "{}", "empty.csv": ""}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    (tmp_path / "no files").mkdir()
    found = {r.rel_path: r.length for r in readers.scan_manifest(spark, str(tmp_path)).collect()}
    assert found == {"pkg/__init__.py": 0, "a.csv": 1, "pkg/.hid": 3, "pkg/deep/_m.json": 2, "empty.csv": 0}


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n"x\ny",1\nz,2\n')
    rows = readers.read_delimited(spark, str(tmp_path / "t.csv"), schema="a string, b int").collect()
    assert [tuple(r) for r in rows] == [("x\ny", 1), ("z", 2)]


def test_number_suffixes_stay_text(spark, tmp_path):
    (tmp_path / "t.txt").write_text("3D 1e3 7\n4 .5 8\n")
    df = readers.read_ws_table(spark, str(tmp_path / "t.txt"))
    assert [t for _, t in df.dtypes[1:]] == ["string", "double", "bigint"]
