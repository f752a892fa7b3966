import math
import pytest
from pyspark.sql import functions as F

from packwright.operators import score
from packwright.operators.baseline import fit_predict
from packwright.operators.inference import infer_batch, infer_resumed, stored_answers


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"Id int, target {kind}")


def test_regression_scores(spark):
    solution = frame(spark, [(1, 1.0), (2, 2.0), (3, 4.0)])
    sent = frame(spark, [(3, 4.0), (2, 3.0), (1, 0.0)])
    found = {m: score.score(solution, sent, m).first() for m in ("rmse", "mae", "r2")}
    assert found["rmse"].score == pytest.approx((2 / 3) ** 0.5)
    assert found["mae"].score == pytest.approx(2 / 3)
    assert found["r2"].score == pytest.approx(1 - 2 / (14 / 3))
    assert {r.status for r in found.values()} == {"ok"}


@pytest.mark.parametrize(
    "sent,reason",
    [
        ([(1, 1.0)], "missing ids"),
        ([(1, 1.0), (2, 1.0), (9, 1.0)], "unknown ids"),
        ([(1, 1.0), (2, 1.0), (2, 5.0)], "repeated ids"),
        ([(1, 1.0), (2, None)], "empty predictions"),
        ([(1, float("nan")), (2, 1.0)], "score is not a number"),
    ],
)
def test_bad_submissions_fail(spark, sent, reason):
    row = score.score(frame(spark, [(1, 1.0), (2, 3.0)]), frame(spark, sent), "rmse").first()
    assert (row.status, row.score, row.reason) == ("failed", None, reason)


def test_constant_target_has_no_r2(spark):
    same = frame(spark, [(1, 2.0), (2, 2.0)])
    assert score.score(same, same, "r2").first().status == "failed"
    assert score.score(frame(spark, []), frame(spark, []), "rmse").first().reason == "empty solution"


def test_classification_scores(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("a", "z")]
    df = spark.createDataFrame(pairs, "actual string, predicted string")
    found = {r.label: (r.support, r.precision, r.recall, r.f1) for r in score.per_class_metrics(df).collect()}
    assert found["a"] == pytest.approx((3, 1 / 2, 1 / 3, 2 / 5))
    assert found["b"] == pytest.approx((1, 1 / 2, 1.0, 2 / 3))
    assert found["c"] == (1, 0.0, 0.0, 0.0) and found["z"] == (0, 0.0, 0.0, 0.0)
    total = score.classification_metrics(df).first()
    assert total.accuracy == pytest.approx(2 / 5)
    assert total.f1_macro == pytest.approx((2 / 5 + 2 / 3) / 4)


def test_own_metric(spark):
    score.register_metric("worst", lambda pairs: pairs.agg(F.max(F.abs(F.col("actual") - F.col("predicted"))).alias("score")))
    solution = frame(spark, [(1, 1.0), (2, 3.0)])
    assert score.score(solution, frame(spark, [(1, 5.0), (2, 3.0)]), "worst").first().score == 4.0
    assert "worst" in score.metric_names()
    unknown = score.score(solution, solution, "nope").first()
    assert (unknown.status, unknown.reason, unknown.score) == ("failed", "unknown metric", None)


def test_many_metrics_in_one_pass(spark):
    answers = spark.createDataFrame([(i, float(i % 2)) for i in range(8)], "Id int, target double")
    shares = [0.1, 0.9, 0.4, 0.4, 0.6, 0.8, 0.2, 0.7]
    sent = spark.createDataFrame(list(enumerate(shares)), "Id int, target double")
    found = {r["metric"]: r["score"] for r in score.scores(answers, sent, ["mse", "auc", "logloss", "rmse", "f1_macro"]).collect()}
    pairs = list(zip([i % 2 for i in range(8)], shares))
    mse = sum((a - p) ** 2 for a, p in pairs) / 8
    wins = sum((p > q) + 0.5 * (p == q) for a, p in pairs for b, q in pairs if a and not b) / 16
    loss = -sum(math.log(p if a else 1 - p) for a, p in pairs) / 8
    assert [found[m] for m in ("mse", "rmse", "auc", "logloss")] == pytest.approx([mse, mse**0.5, wins, loss])


def test_bad_text_and_repeated_answers_fail(spark):
    answers = frame(spark, [(1, 1.0), (2, 2.0)])
    text = spark.createDataFrame([(1, "1.0"), (2, "two")], "Id int, target string")
    assert score.score(answers, text, "rmse").first().reason == "text in place of numbers"
    assert score.score(answers.union(answers), answers, "rmse").first().reason == "repeated solution ids"


def test_model_beats_chance(spark):
    df = spark.range(200).selectExpr(
        "id as Id",
        "case when id % 17 = 3 then null else id % 50 end as x",
        "case id % 3 when 0 then 'u' when 1 then 'v' else null end as c",
        "concat('t', id) as free",
        "3.0 * (id % 50) + case id % 3 when 0 then 10 else 0 end as y",
    )
    train, test = df.filter("Id % 5 <> 0"), df.filter("Id % 5 = 0")
    answer = test.select("Id", "y")
    predicted = fit_predict(train.drop("free"), test.drop("y", "free"), "y")
    assert predicted.count() == 40
    model = score.score(answer, predicted, "rmse", "Id", "y", "prediction").first()
    chance = score.chance_baseline(train, answer, "rmse", "Id", "y").first()
    assert model.status == chance.status == "ok" and model.score < chance.score / 2


@pytest.mark.parametrize("one_hot", [(), ("many",)])
def test_classifier_and_text(spark, one_hot):
    df = spark.range(120).selectExpr("id as Id", "id % 2 * 1.0 as x", "concat('k', id % 40) as many", "case id % 2 when 0 then 'no' else 'yes' end as y")
    found = fit_predict(df.filter("Id < 100"), df.filter("Id >= 100").drop("y"), "y", task_type="classification", one_hot=one_hot)
    assert {(r.Id % 2, r.prediction) for r in found.collect()} == {(0, "no"), (1, "yes")}


def test_equal_requests_are_asked_once(spark, tmp_path):
    folder = str(tmp_path)

    def provider(prompt, context):
        import pathlib
        import uuid

        (pathlib.Path(folder) / uuid.uuid4().hex).write_text(context)
        if context == "bad":
            raise ValueError("no")
        return context.upper()

    rows = [(i, "p", "same") for i in range(30)] + [(30, "p", "bad"), (31, "p", None)]
    found = infer_batch(spark.createDataFrame(rows, "i int, p string, c string"), "p", "c", provider).collect()
    assert len(found) == 32 and len(list(tmp_path.iterdir())) == 3
    by_id = {r.i: (r.answer, r.status, r.reason) for r in found}
    assert by_id[0] == ("SAME", "ok", None) and by_id[30] == (None, "error", "ValueError: no")
    assert by_id[31] == ("", "ok", None)


def test_a_run_that_fails_half_way_asks_nothing_twice(spark, tmp_path):
    calls, store, flag = tmp_path / "calls", f"{tmp_path}/store", tmp_path / "down"
    calls.mkdir()
    flag.write_text("")
    folder, down = str(calls), str(flag)

    def provider(prompt, context):
        import os
        import pathlib
        import uuid

        if context == "c7" and os.path.exists(down):
            raise SystemExit("the machine stops")
        (pathlib.Path(folder) / uuid.uuid4().hex).write_text(context)
        if context in ("c3", "c4"):
            raise ValueError("no")
        return context.upper()

    df = spark.createDataFrame([(i, "p", f"c{i % 20}") for i in range(60)] + [(60, "p", None)], "i int, p string, c string")
    with pytest.raises(Exception):  # noqa: B017
        infer_resumed(df, "p", "c", provider, store, batches=20, partitions=1)
    reached = {f.read_text() for f in calls.iterdir()}
    answered = stored_answers(spark, store).count()
    flag.unlink()
    for run in (1, 2, 3):
        found = {r["i"]: (r["answer"], r["status"], r["attempts"]) for r in infer_resumed(df, "p", "c", provider, store, batches=20, attempts=2, partitions=1).collect()}
        assert len(found) == 61 and found[60] == ("", "ok", 1)
        assert all(found[i][:2] == (f"C{i % 20}", "ok") for i in range(60) if i % 20 not in (3, 4))
        assert found[3][:2] == (None, "error") and found[3][2] <= 2
    asked = [f.read_text() for f in calls.iterdir()]
    assert answered <= len(reached) < 21
    assert found[3][2] == found[4][2] == 2
    # Only errors, and what was under way when the run stopped, were asked again.
    again = {c for c in asked if asked.count(c) > 1}
    assert {"c3", "c4"} <= again and len(again - {"c3", "c4"}) <= len(reached) - answered
