import random
import pandas as pd
import pytest
from pyspark.sql import functions as F

from packwright.functions.jsontext import recover_object
from packwright.operators import verify


def test_layout_and_files(spark):
    full = [("p", f, False) for f in verify.REQUIRED_FILES] + [("p", "data/raw", True)]
    bare = [("q", "data", True), ("q", "prepare.py", True)]
    df = spark.createDataFrame(full + bare, "package string, rel_path string, is_dir boolean")
    layout = {(r.package, r.message) for r in verify.layout_findings(df).collect()}
    assert layout == {("q", f"missing directory {d}") for d in verify.REQUIRED_DIRECTORIES[1:]}
    files = {(r.package, r.message) for r in verify.file_findings(df).collect()}
    assert files == {("q", f"missing file {f}") for f in verify.REQUIRED_FILES}


@pytest.mark.parametrize(
    "path,source,problem",
    [
        ("prepare.py", "def prepare(a, b, c): pass", None),
        ("prepare.py", "class X:\n  def prepare(self, a, b): pass", None),
        ("prepare.py", "def prepare(a, b): pass", "prepare takes 2 arguments, not 3"),
        ("prepare.py", "def prepare(a, b, c, d=1): pass", "prepare takes 4 arguments, not 3"),
        ("prepare.py", "def prepare(a, b, c, *, d): pass", None),
        ("prepare.py", "async def prepare(a, b, c): pass", "no function prepare"),
        ("prepare.py", "x = 1", "no function prepare"),
        ("prepare.py", "def (", "cannot parse: SyntaxError"),
        ("metric.py", "class M(BaseMetric): pass", None),
        ("metric.py", "class M(base.BaseMetric): pass", "no class based on BaseMetric"),
        ("metric.py", "class M: pass", "no class based on BaseMetric"),
        ("other.py", "def (", None),
        ("prepare.py", None, None),
    ],
)
def test_interfaces(path, source, problem):
    assert verify.interface_problem(path, source) == problem


def test_interface_findings_never_run_the_code(spark, tmp_path):
    flag = tmp_path / "ran"
    source = f"open({str(flag)!r}, 'w')"
    df = spark.createDataFrame([("p", "prepare.py", source), ("p", "run.py", "def (")], "package string, rel_path string, source string")
    found = [(r.package, r.check, r.message) for r in verify.interface_findings(df).collect()]
    assert found == [("p", "interface prepare.py", "no function prepare")]
    assert not flag.exists()


GOOD = '{"prediction_target": "y", "evaluation_metric": "m", "data_utilization": "d", "justification": "j"'


def test_proposal_shape_and_batches(spark):
    rows = [
        ("a", GOOD + "}"),
        ("a", GOOD + ', "tags": []}'),
        ("b", GOOD + "}"),
        ("b", GOOD + ', "extra": 1}'),
        ("c", '{"prediction_target": null}'),
        ("d", "not json"),
    ]
    df = spark.createDataFrame(rows, "batch string, proposal string")
    alone = verify.proposal_shape(df)
    assert [r.accepted for r in alone.collect()] == [True, True, True, False, False, False]
    assert alone.filter("batch = 'c'").first().missing_keys == ["data_utilization", "evaluation_metric", "justification"]
    together = {(r.batch, r.accepted) for r in verify.proposal_shape(df, batch="batch").collect()}
    assert together == {("a", True), ("b", False), ("c", False), ("d", False)}


def test_proposal_content(spark):
    rows = [
        (1, '{"prediction_target": "y", "task_type": "regression", "feature_columns": ["x"]}'),
        (2, '{"prediction_target": "no", "task_type": "ranking", "feature_columns": ["x", "z"]}'),
    ]
    df = recover_object(spark.createDataFrame(rows, "i int, p string"), "p", verify.PROPOSAL_SCHEMA)
    found = {r.i: r.e for r in df.select("i", verify.proposal_problems(F.col("value"), ["x", "y"]).alias("e")).collect()}
    assert found == {
        1: [],
        2: ["feature is not a column: z", "target is not a column: no", "unknown task type: ranking"],
    }


def test_leakage(spark):
    df = spark.range(100).selectExpr(
        "id as y", "id as same", "2.0 * id + 1 as scaled", "id * 7919 % 101 as noise", "cast(id as string) as text", "1 as constant"
    )
    found = {r.message: r.severity for r in verify.leakage_findings(df, "y").collect()}
    assert found == {"same": "error", "scaled": "warning"}


def test_metric_fit(spark):
    tasks = [("a", "classification", "RMSE"), ("b", "classification", "Accuracy"), ("c", "classification", "F1"), ("d", "regression", "accuracy"), ("e", "classification", "accuracy")]
    labels = [("b", "x")] * 9 + [("b", "y")] + [("e", "x"), ("e", "y")]
    shares = verify.label_share(spark.createDataFrame(labels, "package string, label string"), "label")
    found = verify.metric_findings(spark.createDataFrame(tasks, "package string, task_type string, metric string"), shares)
    assert {(r.package, r.severity) for r in found.collect()} == {("a", "error"), ("b", "warning"), ("d", "error")}


def test_scores_and_gate(spark):
    scores = [("a", "ok", -1.0), ("b", "failed", 0.5), ("c", "ok", float("nan")), ("d", None, 1.0), ("e", "ok", None)]
    found = verify.score_findings(spark.createDataFrame(scores, "package string, status string, score double"))
    assert {r.package for r in found.collect()} == {"b", "c", "d", "e"}
    rows = [("a", 2, "x", "warning", "w"), ("b", 1, "x", "error", "e"), ("c", 2, "x", "error", "e"), ("c", 3, "x", "error", "e")]
    findings = spark.createDataFrame(rows, "package string, stage int, `check` string, severity string, message string")
    packages = spark.createDataFrame([(p,) for p in "abcd"], "package string")
    gate = {(r.package, r.stage): (r.reached, r.passed) for r in verify.gate(findings, packages).collect()}
    yes, no, stop = (True, True), (True, False), (False, False)
    assert [gate["a", s] for s in (1, 2, 3)] == [yes, yes, yes]
    assert [gate["b", s] for s in (1, 2, 3)] == [no, stop, stop]
    assert [gate["c", s] for s in (1, 2, 3)] == [yes, no, stop]
    assert [gate["d", s] for s in (1, 2, 3)] == [yes, yes, yes]


def test_review_findings(spark):
    rows = [("p", "description", " fail: leak"), ("p", "metric", "WARN"), ("q", "metric", "OK")]
    found = verify.review_findings(spark.createDataFrame(rows, "package string, `check` string, reply string"))
    assert {(r.package, r.check, r.severity) for r in found.collect()} == {("p", "description", "error"), ("p", "metric", "warning")}


def test_rank_correlation_and_dependence(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        y = rng.choice([None, float("nan"), *[float(rng.randrange(60))] * 8])
        cube = None if y is None or i % 17 == 0 else y**3
        rows.append((y, cube, -1.0 * i % 7, 1.0, f"g{int(y) // 20}" if y is not None and y == y else None, i))
    df = spark.createDataFrame(rows, "y double, cube double, noise double, flat double, `g.roup` string, id int").repartition(3)
    found = {r["feature"]: r for r in verify.rank_correlation(df, "y", ["cube", "noise", "flat"]).collect()}
    frame = pd.DataFrame([r[:4] for r in rows], columns=["y", "cube", "noise", "flat"])
    for name in ("cube", "noise"):
        known = frame[[name, "y"]].dropna()
        ranks = known.rank()
        assert found[name]["n"] == len(known)
        assert found[name]["rank_correlation"] == pytest.approx(ranks[name].corr(ranks["y"]), abs=1e-12)
    assert found["flat"]["rank_correlation"] is None

    shares = {r["feature"]: tuple(r)[1:] for r in verify.target_dependence(df, "g.roup", ["y", "noise", "id"]).collect()}
    known = [r for r in rows if r[4] is not None]
    assert shares["y"] == (len(known), len({r[0] for r in known}), len({r[0] for r in known}), 1.0)
    assert shares["id"][3] == 1.0 and shares["noise"][3] == 0.0
    found = {(r["check"], r["message"]) for r in verify.nonlinear_leakage_findings(df, "y", ["cube", "noise", "flat", "id"]).collect()}
    assert found == {("leakage_monotone", "cube"), ("leakage_determined", "cube")}
    assert verify.nonlinear_leakage_findings(df, "flat", ["cube", "id"]).collect() == []
