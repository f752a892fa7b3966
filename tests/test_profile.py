import random

import numpy as np
import pandas as pd
import pytest

from packwright.operators import profile, quantiles


def test_numeric_summary_matches_describe(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.5, None, 4.0, float("nan")], "b": [3, 1, 2, 2, 9], "c": list("xyzxy")})
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    rows[4] = (float("nan"), 9, "y")
    df = spark.createDataFrame(rows, "a double, b int, c string")
    expected = pdf.describe()
    for row in profile.numeric_summary(df).collect():
        want = expected[row["column"]]
        assert row["count"] == want["count"]
        got = [row[c] for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]
        assert got == pytest.approx(list(want[1:]))


def test_exact_quantiles_after_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SKETCH_SIZE", 20)
    monkeypatch.setattr(quantiles, "GRID", 16)
    rng = random.Random(3)
    rows = [
        (rng.gauss(0, 1), 5.0 if i % 3 else float(i), float(i % 4), 1e300 * (-1) ** i if i % 7 else None)
        for i in range(4000)
    ]
    df = spark.createDataFrame(rows, "a double, hot double, few double, wide double").repartition(3)
    shares = (0.0, 0.25, 0.5, 0.75, 1.0)
    found = quantiles.exact_quantiles(df, df.columns, shares, list_values=5)
    for i, name in enumerate(df.columns):
        values = [r[i] for r in rows if r[i] is not None]
        assert found[name] == pytest.approx(list(np.quantile(values, shares)))


def test_exact_quartiles_of_a_summary(spark):
    df = spark.range(3000).selectExpr("id % 97 / 3 as x", "id * id % 1009 as y", "cast(null as double) as z")
    found = {r["column"]: r for r in profile.numeric_summary(df).collect()}
    for name in ("x", "y"):
        values = [float(r[name]) for r in df.collect()]
        assert list(found[name])[5:8] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))
    assert found["z"]["count"] == 0 and found["z"]["p50"] is None


def test_sketch_is_close(spark):
    df = spark.range(10_000).selectExpr("id as x")
    row = profile.numeric_summary(df, exact=False).first()
    assert abs(row.p50 - 5000) < 20


def test_categorical_summary(spark):
    rows = [("b", True, None), ("a", True, None), ("b", False, None), ("a", None, None), ("c", None, None)]
    df = spark.createDataFrame(rows, "x string, y boolean, z string")
    found = {r["column"]: tuple(r)[1:] for r in profile.categorical_summary(df).collect()}
    assert found == {"x": (5, 3, "a", 2), "y": (3, 2, "true", 2), "z": (0, 0, None, None)}


@pytest.mark.parametrize("cells", [1, 40, 1 << 16])
def test_most_frequent_values(spark, cells):
    rng = random.Random(5)
    rows = [(rng.randrange(3000), "hot" if i % 3 == 0 else f"v{i}", None, i % 7, f"u{i}") for i in range(3000)]
    df = spark.createDataFrame(rows + [(None,) * 5], "many int, hot string, `no.ne` string, tied int, unique string").repartition(3)
    found = {r["column"]: tuple(r)[1:] for r in profile.most_frequent(df, df.columns, cells).collect()}
    assert list(found) and set(found) == set(df.columns)
    for i, name in enumerate(df.columns):
        counts = {}
        for row in rows:
            if row[i] is not None:
                counts[str(row[i])] = counts.get(str(row[i]), 0) + 1
        top = min(counts, key=lambda v: (-counts[v], v)) if counts else None
        assert found[name] == (sum(counts.values()), top, counts.get(top))
    assert profile.most_frequent(df, []).count() == 0
    assert profile.most_frequent(df.limit(0), ["hot"]).collect()[0][1:] == (0, None, None)


def test_shape_and_column_info(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, `b c` string")
    assert tuple(profile.shape(df).first()) == (2, 2, ["a", "b c"])
    assert [tuple(r) for r in profile.column_info(df).orderBy("position").collect()] == [
        (0, "a", "int", 2),
        (1, "b c", "string", 1),
    ]


def test_dataset_profile(spark):
    paths = ["d/a.CSV", "d/b.csv", "d/c.tsv", "d/e.tsv", "d/README", "d/f.py", "e/x.py", "e/.hidden"]
    df = spark.createDataFrame([(p[0], p) for p in paths], "dataset string, path string")
    found = {r.dataset: (r.file_count, r.file_formats, r.primary_format) for r in profile.dataset_profile(df).collect()}
    assert found == {
        "d": (6, {".csv": 2, ".tsv": 2, ".py": 1}, ".csv"),
        "e": (2, {".py": 1}, "unknown"),
    }
    primary = {r.dataset: r.primary_format for r in profile.primary_format(df).collect()}
    assert primary == {"d": ".csv", "e": "unknown"}


def test_asset_summary(spark):
    rows = [(1, "table"), (1, "code"), (1, "table"), (2, "other")]
    df = spark.createDataFrame(rows, "doc_id int, asset_type string")
    found = {tuple(r) for r in profile.asset_summary(df).collect()}
    assert found == {(1, 2, 0, 1, False), (2, 0, 0, 0, True)}
