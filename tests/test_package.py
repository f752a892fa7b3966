import json

import pytest
from pyspark.sql import functions as F

from packwright.operators import assets, package, papers, split
from packwright.operators.profile import dataset_profile


def test_merge_widens_and_fills(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2.5, True)], "s string, n double, t boolean")
    merged = package.merge_by_name([a, b])
    assert dict(merged.dtypes) == {"n": "double", "s": "string", "t": "boolean"}
    assert {tuple(r) for r in merged.collect()} == {(1.0, "x", None), (2.5, "y", True)}


def test_targets_are_hidden(spark):
    df = split.random_split(spark.range(20).selectExpr("id as Id", "id * 2 as y", "id % 3 as x"), "Id")
    train, test, answer = package.hide_target(df, "Id", "y")
    assert train.columns == ["Id", "y", "x"] and test.columns == ["Id", "x"] and answer.columns == ["Id", "y"]
    assert (train.count(), test.count(), answer.count()) == (16, 4, 4)
    sample = package.sample_submission(test, train, "Id", "y")
    mean = train.agg(F.avg("y")).first()[0]
    assert {r.y for r in sample.collect()} == {mean}


def test_majority_prefers_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "y string")
    assert package.placeholder(df, "y") == "a"


def test_requirements(spark):
    rows = [
        (1, [".nc", ".csv"], ["PyTorch Lightning", "XGBoost"]),
        (2, [".grib"], ["tf.Keras", "Hugging Face"]),
        (3, None, None),
    ]
    df = spark.createDataFrame(rows, "i int, formats array<string>, libs array<string>")
    found = {r.i: r.r for r in df.select("i", package.requirements(F.col("formats"), F.col("libs")).alias("r")).collect()}
    base = {"pandas", "scikit-learn", "joblib", "tqdm"}
    assert found == {
        1: sorted(base | {"xarray", "netCDF4", "torch", "torchvision", "xgboost"}),
        2: sorted(base | {"cfgrib", "eccodes", "tensorflow", "transformers", "datasets"}),
        3: sorted(base),
    }


def test_defaults_record_and_report(spark):
    text = '{"source_paper": {"title": "T"}, "scientific_summary": {"key_results": "a\\nb"}}'
    df = spark.createDataFrame([(text,)], "j string")
    df = df.select(package.fill_defaults(F.from_json("j", package.TASK_SCHEMA)).alias("task"))
    task = df.first().task
    assert task.source_paper.url == "N/A" and task.data_profile.primary_format == "unknown"
    assert task.model_details.key_libraries_mentioned == [] and task.data_profile.file_formats == {}
    report = df.select(package.report_text(F.col("task"))).first()[0]
    assert "- Title: T" in report and "\n  a\n  b\n" in report
    empty = spark.createDataFrame([(None,)], "j string").select(
        package.fill_defaults(F.from_json("j", package.TASK_SCHEMA)).alias("task")
    )
    assert empty.first().task.ml_task.task_type == "N/A"


def test_cells_allow_repeated_headers_and_ragged_rows(spark):
    tables = [(1, [["a", "a"], ["1", "2", "3"], ["4"]]), (2, [["only"]]), (3, [])]
    df = spark.createDataFrame(tables, "t int, rows array<array<string>>")
    found = {tuple(r) for r in assets.rows_to_cells(df, ["t"]).collect()}
    assert found == {
        (1, 0, 0, "a", "1"),
        (1, 0, 1, "a", "2"),
        (1, 0, 2, None, "3"),
        (1, 1, 0, "a", "4"),
    }


def test_images_take_captions_by_position(spark):
    df = spark.createDataFrame([(1, "Fig. 3 | One\nFigure 4|Two", [7, 7, 8]), (2, "", [1]), (3, "Fig. 1 | x", None)], "d int, t string, i array<int>")
    found = [(r.d, r.ordinal, r.context) for r in assets.pair_images(df, "d", "i", "t").orderBy("d", "ordinal").collect()]
    none = "未找到明确的图表标题。"
    assert found == [(1, 0, "Fig. 3: One"), (1, 1, "Fig. 4: Two"), (1, 2, none), (2, 0, none)]


def test_records_first_zip_and_presplit(spark):
    record = json.dumps({"files": [{"key": "a/x.csv", "size": 1, "links": {"self": "u"}}, {"key": "b.zip", "size": 2}, {"key": "c.zip"}]})
    df = spark.createDataFrame([(1, record), (2, "{cut"), (3, '{"files": []}')], "r int, j string")
    files = assets.record_files(df, ["r"], "j")
    assert [(f.r, f.key, f.local_name, f.link) for f in files.orderBy("position").collect()][0] == (1, "a/x.csv", "a_x.csv", "u")
    assert [(z.r, z.key) for z in assets.first_zip(files, "r").collect()] == [(1, "b.zip")]
    paths = [("d", "training/a"), ("d", "val/b"), ("d", "testing/c"), ("e", "train/a"), ("f", "train"), ("f", "test/x")]
    manifest = spark.createDataFrame(paths, "dataset string, rel_path string")
    found = {tuple(r) for r in assets.detect_presplit(manifest).collect()}
    assert found == {("d", "training", "testing", True), ("e", "train", None, False), ("f", None, "test", False)}


def test_previews_and_heads(spark):
    df = spark.range(20).selectExpr("id % 2 as t", "id", "concat('r', id) as line")
    previews = {r.t: r.preview for r in assets.table_preview(df, "t", "id", F.col("line"), 3).collect()}
    assert previews == {0: "r0\nr2\nr4", 1: "r1\nr3\nr5"}
    assert sorted(r.id for r in assets.head_rows(df, ["t"], ["id"], 2).collect()) == [0, 1, 2, 3]


def test_papers_fail_one_by_one(spark):
    pages = spark.createDataFrame(
        [("u1", "<h1>Good One</h1>"), ("u2", "<h1>Bad</h1>"), ("u3", "<h1>Raise</h1>")], "url string, html string"
    )

    def provider(prompt, context):
        if "Raise" in context:
            raise RuntimeError("down")
        if "Bad" in context:
            return "no"
        return '{"ml_task": {"task_type": "t"}}'

    tasks = papers.paper_tasks(pages, "p", provider)
    found = {r.url: (r.folder, r.status) for r in tasks.collect()}
    assert found == {
        "u1": ("paper_good_one", "ok"),
        "u2": ("paper_bad", "quarantined"),
        "u3": ("paper_raise", "error"),
    }
    files = spark.createDataFrame([("paper_good_one", "x/a.csv")], "dataset string, path string")
    record = papers.final_records(tasks, dataset_profile(files)).first()
    parsed = json.loads(record.record)
    assert parsed["ml_task"]["task_type"] == "t" and parsed["data_profile"]["primary_format"] == ".csv"
    assert parsed["source_paper"] == {"title": "Good One", "url": "u1"}


def test_top_files_break_ties_by_path(spark):
    df = spark.createDataFrame([("d", "b", 5), ("d", "a", 5), ("d", "c", 9), ("e", "z", 1)], "dataset string, path string, length int")
    assert [r.path for r in split.top_files(df, 2).collect()] == ["c", "a"]
    assert {(r.path, r.place) for r in split.top_files(df, 2, "dataset").collect()} == {("c", 1), ("a", 2), ("z", 1)}


@pytest.mark.parametrize("table,proposal", [(1, 2)])
def test_names(spark, table, proposal):
    from packwright.functions import text as X

    df = spark.createDataFrame([(table, proposal, "SalePrice")], "t int, p int, target string")
    names = df.select(X.proposal_package(F.col("t"), F.col("p")), X.competition_package(F.col("t"), F.col("p"), F.col("target"))).first()
    assert tuple(names) == ("table_1_proposal_2", "comp_t1_p2_saleprice")


def test_unreadable_records_are_kept_with_a_reason(spark):
    good = '{"files": [{"key": "a", "size": 1, "links": {"self": "u"}}]}'
    texts = [good, None, " ", "{'a': 1}", good[:-1], "[1]", "3", "{}", '{"files": []}', '{"files": null}', '{"files": "x"}', '{"files": [1]}', '{"files": {"key": "a"}}']
    df = spark.createDataFrame(list(enumerate(texts)), "r int, j string")
    found = {r["r"]: r["reason"] for r in assets.unreadable_records(df, ["r"], "j").collect()}
    wrong, none = "wrong type", "no files"
    reasons = [None, "missing", "missing", "not json", "not json", "not an object", "not an object", none, none, none, wrong, wrong, wrong]
    assert [found.get(i) for i in range(len(texts))] == reasons
    readable = {r["r"] for r in assets.record_files(df, ["r"], "j").collect()}
    assert readable == {0} and readable.isdisjoint(found)
